"""Elements of record reads, and per-document texts and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import jsontext as J
from millrace.sources.tables import RecordTables

KINDS = ("record", "state", "log")
TYPES = ("StructuredRecord", "StructuredState", "StructuredLog")


def merged_rows(tables: RecordTables, keys: Sequence[str]) -> DataFrame:
    """Records, states and logs as one table."""
    if tables.merged is not None:
        return tables.merged
    columns = ("stream", "data", "emitted_at", "level", "message")
    parts = []
    for kind, df in zip(KINDS, (tables.records, tables.states, tables.logs), strict=True):
        parts.append(
            df.select(
                *keys,
                F.lit(kind).alias("kind"),
                F.col(f"{kind}_index").cast("long").alias("index"),
                *[
                    F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                    for c in columns
                ],
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def elements_from_records(tables: RecordTables, keys: Sequence[str]) -> DataFrame:
    """Elements of records, then states, then logs.

    ``ord`` is (kind, index), which sorts the elements of one document.
    """
    kind, index = F.col("kind"), F.col("index").cast("string")

    def by_kind(values: Sequence[Column]) -> Column:
        return F.when(kind == "record", values[0]).when(kind == "state", values[1]).otherwise(
            values[2]
        )

    def metadata(name: str, more: dict[str, Column]) -> Column:
        shared = {"artifact_kind": F.lit(f'"{name}"'), "flow_kind": F.lit('"it"')}
        return J.object_text(shared | {f"{name}_index": index} | more)

    record = {
        "stream": J.quote(F.col("stream")),
        "emitted_at": J.quote(F.col("emitted_at")),
        "data": F.col("data"),
    }
    described = by_kind(
        [
            metadata("record", record),
            metadata("state", {"data": F.col("data")}),
            metadata("log", {"level": J.quote(F.col("level"))}),
        ]
    )
    stream = F.coalesce(F.col("stream"), F.lit("it"))
    return merged_rows(tables, keys).select(
        *keys,
        F.struct(
            by_kind([F.lit(i) for i in range(3)]).alias("kind"), F.col("index").alias("index")
        ).alias("ord"),
        F.concat_ws(":", stream, kind, index).alias("element_id"),
        by_kind([F.lit(t) for t in TYPES]).alias("type"),
        F.when(kind == "log", F.col("message")).otherwise(J.spaced(F.col("data"))).alias("text"),
        described.alias("metadata"),
    )


def normalized_text(
    elements: DataFrame,
    keys: Sequence[str],
    separator: str,
    skip_empty: bool,
    slice_by: Column | None = None,
) -> DataFrame:
    """One text per document from its element rows.

    Record documents join every text by a line break; other documents join the
    non-empty ones by a blank line.  The result is one value per document, so a
    document has to fit a row; ``row_evidence`` describes a read that does not, and
    for documents that are still rows the text made by ``partition_documents`` needs
    no shuffle.  With ``slice_by``, a column that never decreases along the order,
    the elements of a slice are joined first and only the pieces of a document
    meet in one task.
    """
    wanted = elements.filter(F.col("text") != "") if skip_empty else elements
    if slice_by is None:
        return _joined(wanted, keys, "ord", "text", separator, "normalized_text")
    sliced = wanted.withColumn("__slice", slice_by)
    pieces = _joined(sliced, [*keys, "__slice"], "ord", "text", separator, "__piece")
    return _joined(pieces, keys, "__slice", "__piece", separator, "normalized_text")


def _joined(
    rows: DataFrame, keys: Sequence[str], order: str, text: str, separator: str, out: str
) -> DataFrame:
    gathered = rows.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias(
            "__l"
        )
    )
    return gathered.select(
        *keys, F.array_join(F.transform("__l", lambda e: e["t"]), separator).alias(out)
    )


def doc_summary(results: DataFrame, *keys: str) -> DataFrame:
    """Element count and text length (in characters) of partitioned documents."""
    return results.select(
        *keys,
        F.size("elements").alias("elements_count"),
        F.length("normalized_text").alias("normalized_text_len"),
    )


def element_counts(elements: DataFrame, keys: Sequence[str], separator: str = "\n\n") -> DataFrame:
    """The same summary from element rows, without gathering any text."""
    filled = F.col("text") != ""
    return elements.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("elements_count"),
        (
            F.coalesce(F.sum(F.when(filled, F.length("text") + len(separator))), F.lit(len(separator)))
            - len(separator)
        ).alias("normalized_text_len"),
    )
