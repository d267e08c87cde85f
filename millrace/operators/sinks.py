"""Writing artifact tables and destination rows.

Artifacts are tables, not one folder per document, kept by content
(``operators.store``).  Rows without a content key lie in a folder for each batch, which a
job that is run again replaces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import jsontext as J
from millrace.operators.store import DIGITS, read_keyed, write_keyed


def record_lines(records: DataFrame, *keys: str) -> DataFrame:
    """Records as JSON lines."""
    line = J.object_text(
        {
            "data": F.col("data"),
            "emitted_at": J.quote(F.col("emitted_at")),
            "record_index": F.col("record_index").cast("string"),
            "stream": J.quote(F.col("stream")),
        }
    )
    return records.select(*keys, F.col("record_index").alias("ord"), line.alias("line"))


def log_lines(logs: DataFrame, *keys: str) -> DataFrame:
    line = J.object_text(
        {
            "level": J.quote(F.col("level")),
            "log_index": F.col("log_index").cast("string"),
            "message": J.quote(F.col("message")),
        }
    )
    return logs.select(*keys, F.col("log_index").alias("ord"), line.alias("line"))


def checkpoint_entry_lines(checkpoints: DataFrame, *keys: str) -> DataFrame:
    line = J.object_text(
        {
            "checkpoint_identity_key": J.quote(F.col("checkpoint_identity_key")),
            "checkpoint_index": F.col("checkpoint_index").cast("string"),
            "parent_checkpoint_identity_key": J.quote(F.col("parent_checkpoint_identity_key")),
            "progress": F.col("progress"),
            "progress_kind": J.quote(F.col("progress_kind")),
        }
    )
    return checkpoints.select(*keys, F.col("checkpoint_index").alias("ord"), line.alias("line"))


def write_batch(df: DataFrame, path: str, table: str, batch: str) -> None:
    (
        df.withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(f"{path.rstrip('/')}/{table}")
    )


def write_artifacts(
    run_meta: DataFrame,
    results: DataFrame,
    path: str,
    batch: str,
    digits: int = DIGITS,
    dealt: bool = False,
    **others: DataFrame,
) -> None:
    """Filesystem sink: run metadata of every run, texts and elements of successful ones.

    ``others`` are further artifact tables, such as record and log lines; ``digits`` sets the
    buckets of new tables; ``dealt`` says that the results lie as they are written
    (``store.deal_keyed``).  Run metadata is
    written last, so a content counts as known only when its other rows are there.
    """
    write_keyed(results, path, "results", batch, digits=digits, dealt=dealt)
    for table, df in others.items():
        write_keyed(df, path, table, batch, digits=digits)
    write_keyed(run_meta, path, "run_meta", batch, digits=digits)


def read_artifacts(
    spark: SparkSession,
    path: str,
    table: str,
    asked: DataFrame | Sequence[str] | None = None,
    sha: str = "sha256",
) -> DataFrame:
    """The newest stored rows of each content sha, or of those in ``asked``."""
    return read_keyed(spark, path, table, asked, sha)


def write_rows(
    rows: DataFrame, path: str, mode: str = "append", partition_by: Column | None = None
) -> None:
    """Destination rows as JSON lines, for a bulk loader of the target system."""
    out = rows if partition_by is None else rows.withColumn("part", partition_by)
    writer = out.write.mode(mode)
    if partition_by is not None:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("part")
    writer.json(path)
