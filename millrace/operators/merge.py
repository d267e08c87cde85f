"""Upserts into a stored table: copy on write, by buckets of the key.

The table lies in folders ``bucket=<number>-of-<buckets>``, dealt by a hash of the key.
Rows that come in touch the buckets of their keys only; these are read, merged and
replaced by a dynamic overwrite, all others stay as they are.  The new files of all buckets
are moved in place when the job commits, so a lost executor leaves the old ones, and a job
that is run again gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.delivery import upsert_rows
from millrace.session import file_system

BUCKETS = 64


def _folders(spark: SparkSession, path: str) -> list[str]:
    files, place = file_system(spark, f"{path.rstrip('/')}/bucket=*")
    return [s.getPath().getName().removeprefix("bucket=") for s in files.globStatus(place) or []]


def _bucket(key: str, buckets: int) -> Column:
    return F.concat(F.pmod(F.xxhash64(key), F.lit(buckets)), F.lit(f"-of-{buckets}"))


def merge_rows(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    key: str = "identity_key",
    order: Sequence[str] = ("delivered_at_utc",),
    buckets: int = BUCKETS,
) -> list[str]:
    """Upsert into the table at ``path``; returns the buckets that were rewritten.

    The last incoming row of a key wins over others and over the stored one
    (``delivery.upsert_rows``).  A table keeps the number of buckets that it began with.
    """
    there = _folders(spark, path)
    if there:
        buckets = int(there[0].rpartition("-")[2])
    keyed = incoming.withColumn("bucket", _bucket(key, buckets))
    # At most as many names as there are buckets.
    touched = sorted(r.bucket for r in keyed.select("bucket").distinct().collect())
    if not touched:
        return []
    paths = [f"{path.rstrip('/')}/bucket={b}" for b in touched if b in set(there)]
    if paths:
        existing = spark.read.schema(incoming.schema).parquet(*paths)
    else:
        existing = incoming.limit(0)
    merged = upsert_rows(existing, incoming, key, order).select(*incoming.columns)
    (
        merged.withColumn("bucket", _bucket(key, buckets))
        .repartition("bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket")
        .parquet(path)
    )
    return touched


def merged_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a merged table."""
    return spark.read.parquet(path).drop("bucket")
