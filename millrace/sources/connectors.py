"""Reader options for external systems; the row work is done by the other modules."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str],
    cursor: str,
    cursor_start: str | None,
    properties: Mapping[str, str],
    bounds: tuple[str, str, int] | None = None,
) -> DataFrame:
    """JDBC read whose projection and cursor filter run in the database.

    ``bounds`` (lower, upper, partitions) splits the read over a numeric or time
    cursor; without it one connection reads everything.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if bounds is not None:
        lower, upper, parts = bounds
        reader = reader.options(
            partitionColumn=cursor, lowerBound=lower, upperBound=upper, numPartitions=str(parts)
        )
    rows = reader.load().select(*columns)
    if cursor_start is None:
        return rows
    return rows.filter(F.col(cursor) > F.lit(cursor_start).cast(rows.schema[cursor].dataType))


def log_reader_options(
    brokers: Sequence[str], topic: str, after: Mapping[int, int | None]
) -> dict[str, str]:
    """Options of a bounded message-log read that starts after the given offsets."""
    starts = {str(p): -2 if o is None else o + 1 for p, o in sorted(after.items())}
    return {
        "kafka.bootstrap.servers": ",".join(sorted(brokers)),
        "assign": json.dumps({topic: sorted(after)}),
        "startingOffsets": json.dumps({topic: starts}),
        "endingOffsets": json.dumps({topic: {p: -1 for p in starts}}),
    }


def read_log(
    spark: SparkSession, brokers: Sequence[str], topic: str, after: Mapping[int, int | None]
) -> DataFrame:
    """Message rows (topic, partition, offset, value); needs the connector jar."""
    reader = spark.read.format("kafka").options(**log_reader_options(brokers, topic, after))
    return reader.load().select("topic", "partition", "offset", F.col("value").cast("string"))
