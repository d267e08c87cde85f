"""Cursor and offset reads over tables and message logs."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import jsontext as J
from millrace.functions import ordering
from millrace.functions.binding import evaluate_once
from millrace.sources.normalize import json_value, normalize_values
from millrace.sources.tables import RecordTables

OFFSET_CURSOR_WIDTH = 20


def _batch_logs(
    states: DataFrame,
    keys: Sequence[str],
    unit: str,
    position: str,
    count: str,
    batch: str,
    groups: DataFrame | None = None,
) -> DataFrame:
    """One line per batch and a closing line per group; ``groups`` names empty ones too."""
    fetched = states.select(
        *keys,
        F.col(batch).alias("log_index"),
        F.lit("INFO").alias("level"),
        F.concat(
            F.lit("fetched batch="),
            F.col(batch) + 1,
            F.lit(f" {unit}="),
            F.col(count),
            F.lit(f" {position}="),
            F.col(position),
        ).alias("message"),
    )
    ended = states.groupBy(*keys).agg(F.max(batch).alias("__last"))
    if groups is not None:
        ended = groups.join(ended, list(keys), "left")
    closing = ended.select(
        *keys,
        (F.coalesce(F.col("__last"), F.lit(-1)) + 1).alias("log_index"),
        F.lit("INFO").alias("level"),
        F.concat(
            F.lit("source exhausted after batch="),
            F.coalesce(F.col("__last"), F.lit(-1)) + 2,
        ).alias("message"),
    )
    return fetched.unionByName(closing)


def read_incremental(
    df: DataFrame,
    columns: Sequence[str],
    cursor: str,
    cursor_start: str | None,
    batch_size: int,
    stream: str,
    origin: Mapping[str, str],
    documents: bool = False,
    slice_by: Column | None = None,
) -> RecordTables:
    """Read rows after ``cursor_start`` in cursor order, cut into batches.

    The projection and the cursor filter reach the scan.  ``origin`` names the
    table (``connection_name``, ``schema``/``database``, ``table``/``collection``)
    and is repeated in every state.  ``documents`` selects the field names of a
    document store.  ``errors`` has the cursors that are null, empty or repeated; a
    read with one of them gives no records, states or logs, so that no resume starts
    behind a row that was refused.
    """
    wanted = df.select(*columns)
    if cursor_start is not None:
        kind = df.schema[cursor].dataType
        wanted = wanted.filter(F.col(cursor) > F.lit(cursor_start).cast(kind))
    normal = normalize_values(wanted)
    rows = normal.select(
        F.col(cursor).alias("cursor"),
        J.object_text({c: json_value(normal, c) for c in columns}).alias("data"),
    )
    empty = F.col("cursor").isNull() | (F.col("cursor").cast("string") == "")
    errors = (
        rows.groupBy("cursor")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn(
            "problem",
            F.when(empty, "cursor_not_a_filled_string").when(
                F.col("__n") > 1, "cursor_did_not_advance"
            ),
        )
        .filter(F.col("problem").isNotNull())
        .select(F.lit(stream).alias("stream"), F.col("cursor").cast("string"), "problem")
    )
    sound = ~errors.exists()
    indexed = ordering.group_index(rows, [], ["cursor"], "record_index", slice_by)
    batched = indexed.withColumn(
        "__batch", F.floor(F.col("record_index") / batch_size).cast("long")
    )
    records = indexed.select(
        F.lit(stream).alias("stream"), "record_index", "data", F.col("cursor").alias("emitted_at")
    )
    per_batch = batched.groupBy("__batch").agg(
        F.max("cursor").alias("cursor"), F.count(F.lit(1)).alias("__n")
    )
    count_name = "document_count" if documents else "row_count"
    shape = {name: J.quote(F.lit(value)) for name, value in origin.items()}
    shape |= {
        "cursor": J.quote(F.col("cursor")),
        ("cursor_field" if documents else "cursor_column"): J.quote(F.lit(cursor)),
        ("fields" if documents else "columns"): F.to_json(F.array(*[F.lit(c) for c in columns])),
        "read_direction": F.lit('"asc"'),
        count_name: F.col("__n").cast("string"),
    }
    states = per_batch.select(
        F.lit(stream).alias("stream"),
        F.col("__batch").alias("state_index"),
        J.object_text(shape).alias("data"),
    )
    logs = _batch_logs(
        per_batch, [], "documents" if documents else "rows", "cursor", "__n", "__batch"
    ).select(F.lit(stream).alias("stream"), "log_index", "level", "message")
    return RecordTables(
        records=records.filter(sound),
        states=states.filter(sound),
        logs=logs.filter(sound),
        errors=errors,
    )


def check_cursor(
    df: DataFrame,
    cursor: str,
    after: str | None,
    keys: Sequence[str],
    arrival: Sequence[str],
    slice_by: Column | None = None,
) -> DataFrame:
    """Rows whose cursor is empty or not greater than the one before it."""
    start = F.lit(after).cast("string")
    rows = df.select(*dict.fromkeys([*keys, *arrival]), F.col(cursor).alias("cursor"))
    before = ordering.previous_value(
        rows, keys, arrival, "cursor", "previous_cursor", slice_by, first=start
    )
    empty = F.col("cursor").isNull() | (F.col("cursor") == "")
    return (
        before.withColumn(
            "problem",
            F.when(empty, "cursor_not_a_filled_string").when(
                F.col("cursor") <= F.coalesce(F.col("previous_cursor"), start),
                "cursor_did_not_advance",
            ),
        )
        .filter(F.col("problem").isNotNull())
        .select(*keys, *[a for a in arrival if a not in keys], "cursor", "previous_cursor", "problem")
    )


def offset_cursor(offset: Column) -> Column:
    """Offset padded with zeros so that its text order is its number order."""
    return F.lpad(offset.cast("string"), OFFSET_CURSOR_WIDTH, "0")


def read_offsets(
    df: DataFrame,
    batch_size: int,
    stream: str,
    connection_name: str,
    offset_start: Column | int | None = None,
    topic: str = "topic",
    partition: str = "partition",
    offset: str = "offset",
    value: str = "value",
    offsets_per_slice: int = 1_000_000,
    contract: Mapping[str, object] | None = None,
) -> RecordTables:
    """Read message-log partitions after ``offset_start`` (exclusive; null reads all).

    Offsets are unique within a partition, so a slice holds at most
    ``offsets_per_slice`` rows.  ``errors`` lists messages that are no JSON object and
    offsets that are missing, negative or repeated; a partition with errors gives no
    records, states or logs.  A partition of ``df`` without messages after the start
    has its closing log line.  ``contract`` is repeated in every state.
    """
    keys = [topic, partition]
    start = offset_start if isinstance(offset_start, Column) else F.lit(offset_start).cast("long")
    text = F.col(value).cast("string")
    at = F.col(offset)
    given = df.filter(start.isNull() | at.isNull() | (at > start)).select(
        *keys, at.alias("offset"), text.alias("__value")
    )

    def decoded(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
        parsed = rows.withColumn("__v", J.parse(F.col("__value")))
        data = F.when(J.is_object(F.col("__v")), J.render(F.col("__v")))
        return evaluate_once(parsed, keep, {"data": data})

    offsets = (
        given.groupBy(*keys, "offset")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn(
            "problem",
            F.when(F.col("offset").isNull(), "offset_missing")
            .when(F.col("offset") < 0, "offset_negative")
            .when(F.col("__n") > 1, "offset_did_not_advance"),
        )
        .filter(F.col("problem").isNotNull())
        .select(*keys, "offset", "problem")
    )
    values = (
        decoded(given, [*keys, "offset"])
        .filter(F.col("data").isNull())
        .select(*keys, "offset", F.lit("value_not_a_json_object").alias("problem"))
    )
    # One reason for a message: that of its offset comes first.
    errors = offsets.unionByName(values).groupBy(*keys, "offset").agg(
        F.min(F.struct(F.col("problem").startswith("value"), "problem")).alias("__p")
    ).select(*keys, "offset", F.col("__p.problem").alias("problem"))
    refused = errors.select(*keys).distinct()
    sound = given.join(refused, keys, "left_anti")
    partitions = df.select(*keys).distinct().join(refused, keys, "left_anti")
    slice_by = F.floor(F.col("offset") / offsets_per_slice)
    placed = ordering.group_index(sound, keys, ["offset"], "record_index", slice_by)
    indexed = decoded(placed, [*keys, "offset", "record_index"])
    batched = placed.withColumn("__batch", F.floor(F.col("record_index") / batch_size).cast("long"))
    records = indexed.select(
        *keys,
        F.lit(stream).alias("stream"),
        "record_index",
        "data",
        offset_cursor(F.col("offset")).alias("emitted_at"),
    )
    per_batch = batched.groupBy(*keys, "__batch").agg(
        F.max("offset").alias("offset"), F.count(F.lit(1)).alias("__n")
    )
    declared = {}
    if contract is not None:
        canonical = json.dumps(contract, sort_keys=True, separators=(",", ":"))
        declared["source_operational_contract"] = F.lit(canonical)
    states = per_batch.select(
        *keys,
        F.lit(stream).alias("stream"),
        F.col("__batch").alias("state_index"),
        J.object_text(
            {
                "connection_name": J.quote(F.lit(connection_name)),
                "cursor": J.quote(offset_cursor(F.col("offset"))),
                "last_offset": F.col("offset").cast("string"),
                "partition": F.col(partition).cast("string"),
                "read_direction": F.lit('"asc"'),
                "read_mode": F.lit('"explicit_partition_offset"'),
                "record_count": F.col("__n").cast("string"),
                "topic": J.quote(F.col(topic)),
                **declared,
            }
        ).alias("data"),
    )
    logs = _batch_logs(per_batch, keys, "records", "offset", "__n", "__batch", partitions).select(
        *keys, F.lit(stream).alias("stream"), "log_index", "level", "message"
    )
    return RecordTables(records=records, states=states, logs=logs, errors=errors)
