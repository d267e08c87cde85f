"""What is delivered: content evidence, payloads and the rows each sink receives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import identity, textrules
from millrace.functions import jsontext as J
from millrace.functions.folding import joined_text_facts

PREVIEW_CHARS = 16 * 1024
PREVIEW_RECORDS = 10
PAYLOAD_SCHEMA_VERSION = 1
RECORD_ENGINE = "records"


def text_evidence(df: DataFrame, text: str = "normalized_text") -> DataFrame:
    """Replace a text by its preview, length and sha, so that later steps do not carry it."""
    value = F.col(text)
    return df.select(
        *[c for c in df.columns if c != text],
        F.when(value.isNull(), "missing").otherwise("available").alias("normalized_text_status"),
        value.substr(1, PREVIEW_CHARS).alias("normalized_text_preview"),
        F.length(value).alias("normalized_text_len"),
        identity.sha256_of(value).alias("normalized_text_sha256"),
        (F.length(value) > PREVIEW_CHARS).alias("normalized_text_truncated"),
    )


def _evidence_kind() -> Column:
    has_text = F.col("normalized_text_preview").isNotNull()
    has_records = F.coalesce(F.col("records_status") == "available", F.lit(False))
    return (
        F.when(has_text & has_records, "normalized_text_and_records_preview_v1")
        .when(has_text, "normalized_text_preview_v1")
        .when(has_records, "records_preview_v1")
        .when(F.col("elements_count").isNotNull(), "elements_count_only_v1")
        .otherwise("artifact_reference_only_v1")
    )


def document_evidence(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Evidence of partitioned documents; a narrow transform."""
    slim = results.select(
        *keys, "normalized_text", F.size("elements").alias("elements_count")
    )
    return (
        text_evidence(slim)
        .withColumn("records_status", F.lit(None).cast("string"))
        .withColumn("evidence_kind", _evidence_kind())
        .drop("records_status")
    )


def row_evidence(
    elements: DataFrame, keys: Sequence[str], order: str, separator: str, skip_empty: bool = False
) -> DataFrame:
    """Count, preview, length, sha and truncation of a text that exists only as element rows.

    The text is never put together, so it may be larger than a row
    (``folding.joined_text_facts``).
    """
    facts = joined_text_facts(elements, keys, order, "text", separator, PREVIEW_CHARS, skip_empty)
    return facts.select(
        *keys,
        F.col("rows").alias("elements_count"),
        F.col("preview").alias("normalized_text_preview"),
        F.col("chars").alias("normalized_text_len"),
        F.col("sha256").alias("normalized_text_sha256"),
        (F.col("chars") > PREVIEW_CHARS).alias("normalized_text_truncated"),
    )


def content_evidence(
    results: DataFrame, elements: DataFrame, keys: Sequence[str], record_flow: str = "is_records"
) -> DataFrame:
    """Evidence of finished results from their element rows.

    ``results`` has the keys, ``normalized_text`` and the flag ``record_flow``.
    ``elements`` has ``type``, ``ord.index`` and, for records, ``data``.  Only the
    first records of a document are ever gathered; the others are counted.
    """
    texts = text_evidence(results.select(*keys, "normalized_text", record_flow))
    return _with_row_facts(texts, elements, keys, record_flow)


def record_evidence(
    elements: DataFrame, keys: Sequence[str], order: str = "ord", separator: str = "\n"
) -> DataFrame:
    """The same for record reads that exist only as element rows (``text`` beside the
    columns above): nothing of the size of a read is gathered."""
    texts = (
        row_evidence(elements, keys, order, separator)
        .drop("elements_count")
        .withColumn("normalized_text_status", F.lit("available"))
        .withColumn("__records_flow", F.lit(True))
    )
    return _with_row_facts(texts, elements, keys, "__records_flow")


def _with_row_facts(
    texts: DataFrame, elements: DataFrame, keys: Sequence[str], record_flow: str
) -> DataFrame:
    """Text evidence joined with what the element rows tell."""
    counts = elements.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("elements_count"),
        F.count_if(F.col("type") == "StructuredRecord").alias("records_count"),
        F.bool_or(F.col("type") == "StructuredState").alias("__states"),
        F.bool_or(F.col("type") == "StructuredLog").alias("__logs"),
    )
    first = (
        elements.filter(
            (F.col("type") == "StructuredRecord") & (F.col("ord.index") < PREVIEW_RECORDS)
        )
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("ord.index", "data"))).alias("__first"))
        .select(*keys, F.transform("__first", lambda r: r["data"]).alias("records_preview"))
    )
    def visibility(flag: str) -> Column:
        return F.when(
            F.col(record_flow),
            F.when(F.coalesce(F.col(flag), F.lit(False)), "available").otherwise("not_available"),
        )

    found = F.coalesce(F.col("records_count"), F.lit(0)) > 0
    joined = (
        texts.join(counts, list(keys), "left")
        .join(first, list(keys), "left")
        .withColumn("elements_count", F.coalesce("elements_count", F.lit(0)))
        .withColumn("records_status", F.when(found, "available"))
        .withColumn("records_count", F.when(found, F.col("records_count")))
        .withColumn("records_truncated", F.when(found, F.col("records_count") > PREVIEW_RECORDS))
        .withColumn("structured_state_visibility", visibility("__states"))
        .withColumn("structured_log_visibility", visibility("__logs"))
    )
    return joined.withColumn("evidence_kind", _evidence_kind()).drop(
        "__states", "__logs", record_flow
    )


def evidence_from_stored(
    stored: DataFrame,
    text: str = "normalized_text",
    elements_json: str = "elements_json",
    record_lines: str = "record_lines",
    record_flow: str = "is_records",
) -> DataFrame:
    """Evidence of stored artifacts, one row per document.

    A null column means that the artifact is missing.  ``record_lines`` is the
    stored JSON-lines text.
    """
    lines = F.filter(textrules.lines_of(F.col(record_lines)), lambda s: F.trim(s) != "")
    parsed = F.transform(F.slice("__lines", 1, PREVIEW_RECORDS), J.parse)
    bad = F.exists("__parsed", lambda v: v.isNull() | ~J.is_object(v))
    missing = F.col(record_lines).isNull()
    shaped = (
        stored.withColumn("__lines", lines)
        .withColumn("__parsed", parsed)
        .withColumn("elements_count", J.list_size(F.col(elements_json)))
        .withColumn(
            "records_status",
            F.when(
                F.col(record_flow),
                F.when(missing, "missing").when(bad, "invalid_jsonl").otherwise("available"),
            ),
        )
        .withColumn(
            "records_preview",
            F.when(F.col("records_status") == "available", F.transform("__parsed", J.render)),
        )
        .withColumn(
            "records_count",
            F.when(F.col("records_status") == "available", F.size("__lines")).when(
                (F.col("records_status") == "invalid_jsonl") & (F.size("__lines") > 0),
                F.size("__lines"),
            ),
        )
        .withColumn(
            "records_truncated",
            F.when(
                F.col("records_count").isNotNull(), F.col("records_count") > PREVIEW_RECORDS
            ),
        )
        .drop("__lines", "__parsed", record_lines, elements_json, record_flow)
    )
    return text_evidence(shaped, text).withColumn("evidence_kind", _evidence_kind())


def artifact_paths(out_root: str, sha: Column, record_flow: Column) -> Column:
    """Where the artifacts of a content sha are kept."""
    folder = F.concat(F.lit(out_root.rstrip("/") + "/"), sha)

    def at(name: str) -> Column:
        return F.concat(folder, F.lit("/" + name))

    return F.struct(
        folder.alias("out_dir"),
        at("run_meta.json").alias("run_meta_path"),
        at("elements.json").alias("elements_path"),
        at("normalized.txt").alias("normalized_path"),
        F.when(record_flow, at("records.jsonl")).alias("records_path"),
        F.when(record_flow, at("checkpoint.json")).alias("state_path"),
        F.when(record_flow, at("logs.jsonl")).alias("logs_path"),
    )


def build_payloads(
    run_meta: DataFrame, evidence: DataFrame, out_root: str, on: str = "sha256",
    record_engine: str = RECORD_ENGINE,
) -> DataFrame:
    """One delivery payload per run: key columns, the payload parts and its JSON text.

    ``run_meta`` has ``sha256``, ``run_id``, ``engine_name``, ``timestamp_utc`` and
    ``run_meta`` (JSON text).  A run without evidence is delivered with what
    there is.
    """
    facts = [c for c in evidence.columns if c != on]
    joined = run_meta.join(
        evidence.select(on, F.struct(*facts).alias("content_evidence")), on, "left"
    )
    return shape_payloads(joined, out_root, record_engine)


def shape_payloads(
    runs: DataFrame, out_root: str, record_engine: str = RECORD_ENGINE
) -> DataFrame:
    """The same for runs that already carry their ``content_evidence``; a narrow transform."""
    is_records = F.coalesce(F.col("engine_name") == record_engine, F.lit(False))
    paths = artifact_paths(out_root, F.col("sha256"), is_records)
    payload = J.object_text(
        {
            "schema_version": F.lit(str(PAYLOAD_SCHEMA_VERSION)),
            "sha256": J.quote(F.col("sha256")),
            "run_meta": F.col("run_meta"),
            "artifacts": F.to_json("artifacts"),
            "content_evidence": F.to_json("content_evidence"),
        },
        omit_null=True,
    )
    return (
        runs.withColumn("artifacts", paths)
        .withColumn("delivery_identity", identity.delivery_key(F.col("sha256"), F.col("run_id")))
        .withColumn("schema_version", F.lit(PAYLOAD_SCHEMA_VERSION))
        .withColumn("payload_json", payload)
    )


def table_rows(payloads: DataFrame, delivered_at: Column) -> DataFrame:
    """Rows of the table sinks."""
    return payloads.select(
        F.col("delivery_identity").alias("identity_key"),
        "sha256",
        "run_id",
        "schema_version",
        "payload_json",
        delivered_at.alias("delivered_at_utc"),
    )


def upsert_rows(
    existing: DataFrame, incoming: DataFrame, key: str = "identity_key",
    order: Sequence[str] = ("delivered_at_utc",),
) -> DataFrame:
    """The table after the upsert, with the operation done on each key.

    The last incoming row of a key wins.  A key written many times is cut to one
    row in every map task before the shuffle, since the rank filter is a limit.
    """
    others = [c for c in incoming.columns if c not in (key, *order)]
    newest = Window.partitionBy(key).orderBy(
        *[F.col(c).desc() for c in order], *[F.col(c).desc() for c in others]
    )
    latest = (
        incoming.withColumn("__rn", F.row_number().over(newest)).filter("__rn = 1").drop("__rn")
    )
    fields = [c for c in incoming.columns if c != key]
    new = latest.select(key, F.struct(*fields).alias("__new"))
    old = existing.select(key, F.struct(*fields).alias("__old"))
    joined = old.join(new, key, "full")
    return joined.select(
        key,
        *[
            F.when(F.col("__new").isNotNull(), F.col(f"__new.{f}"))
            .otherwise(F.col(f"__old.{f}"))
            .alias(f)
            for f in fields
        ],
        F.when(F.col("__new").isNull(), "unchanged")
        .when(F.col("__old").isNull(), "upsert_inserted")
        .otherwise("upsert_replaced")
        .alias("operation"),
    )


def append_rows(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The table after an append; repeated deliveries stay."""
    return existing.unionByName(incoming.select(*existing.columns))


def doc_store_rows(payloads: DataFrame) -> DataFrame:
    """Documents of the document store and the search index, replaced by ``_id``."""
    return payloads.select(
        F.col("delivery_identity").alias("_id"),
        "delivery_identity",
        F.col("payload_json").alias("payload"),
    )


def object_store_rows(payloads: DataFrame, prefix: str = "") -> DataFrame:
    """Object key and body, overwritten by key."""
    trimmed = prefix.strip().strip("/")
    head = f"{trimmed}/" if trimmed else ""
    return payloads.select(
        F.concat(F.lit(head), "delivery_identity", F.lit(".json")).alias("object_key"),
        F.col("payload_json").alias("body"),
    )


def timestamp_ns(text: Column) -> Column:
    """Nanoseconds of an ISO time; ``Z`` and a missing zone both mean UTC."""
    has_zone = text.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$")
    zoned = F.when(has_zone, text).otherwise(F.concat(text, F.lit("Z")))
    return (F.unix_micros(F.try_to_timestamp(zoned)) * 1000).cast("string")


def log_stream_rows(payloads: DataFrame, stream: str, prefix: str = "ingest") -> DataFrame:
    """Labels, nanosecond timestamp and JSON line of the log sink."""
    labels = F.map_from_arrays(
        F.array(
            *[
                F.lit(n)
                for n in (
                    "app",
                    f"{prefix}_stream",
                    f"{prefix}_delivery_identity",
                    f"{prefix}_sha256",
                    f"{prefix}_run_id",
                )
            ]
        ),
        F.array(
            F.lit(prefix),
            F.lit(stream),
            F.col("delivery_identity"),
            F.col("sha256"),
            F.col("run_id"),
        ),
    )
    now = (F.unix_micros(F.current_timestamp()) * 1000).cast("string")
    return payloads.select(
        F.map_filter(labels, lambda _, v: v.isNotNull()).alias("labels"),
        F.coalesce(timestamp_ns(F.col("timestamp_utc")), now).alias("timestamp_ns"),
        F.col("payload_json").alias("line"),
    )


VECTOR_PROPERTIES = (
    "sha256",
    "run_id",
    "pipeline_version",
    "timestamp_utc",
    "outcome",
    "filename",
    "mime_type",
    "size_bytes",
    "created_at_utc",
    "engine_name",
    "engine_backend",
    "engine_version",
    "strategy",
    "elements_count",
    "normalized_text",
    "delivery_origin",
    "execution_mode",
)


def vector_rows(runs: DataFrame, has_result: str = "has_result") -> DataFrame:
    """One object per document with a result; the others are skipped and count as delivered."""
    return runs.filter(F.col(has_result)).select(
        identity.object_uuid(F.col("sha256")).alias("uuid"), *VECTOR_PROPERTIES
    )


def kv_rows(payloads: DataFrame) -> DataFrame:
    """Message key and value."""
    return payloads.select(
        F.col("delivery_identity").alias("key"), F.col("payload_json").alias("value")
    )
