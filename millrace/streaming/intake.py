"""Structured Streaming jobs for intake, deduplication, dead letters and offsets.

Progress is the stream's own checkpoint.  ``foreachBatch`` may run a batch again
after a failure, so every write replaces the partition of its batch id.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import jsontext as J
from millrace.operators.sinks import write_artifacts, write_batch
from millrace.operators.store import DIGITS, compact_keyed, known_shas
from millrace.plans.documents import ingest_documents
from millrace.sources.incremental import offset_cursor

#: Batches after which the folders of earlier ones are made one.
COMPACT_EVERY = 16


def _batch_name(batch_id: int) -> str:
    return f"{batch_id:020d}"


def stream_documents(
    documents: DataFrame,
    out: str,
    checkpoint: str,
    run: Mapping[str, str],
    kind: str = "text",
    digits: int = DIGITS,
) -> StreamingQuery:
    """Ingest everything a document stream (``uri``, ``filename``, ``text``) holds, then stop.

    A content seen in an earlier batch, or earlier in the same batch, is skipped.  A batch
    looks up its own contents only, in their buckets of the store; every
    ``COMPACT_EVERY`` batches the run metadata of earlier ones is made one, so a batch costs
    the same after many batches.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        name = _batch_name(batch_id)
        session = batch.sparkSession
        if batch_id % COMPACT_EVERY == 0:
            compact_keyed(session, out, "run_meta", before=name)

        def known(hashed: DataFrame) -> DataFrame:
            return known_shas(session, out, "run_meta", hashed, before=name)

        tables = ingest_documents(batch, known, kind, run, out, store_results=True)
        write_artifacts(
            tables.run_meta.select("sha256", "run_id", "outcome", "run_meta"),
            tables.results.select("sha256", "elements", "normalized_text"),
            out,
            name,
            digits,
            payloads=tables.payloads.select("sha256", "delivery_identity", "payload_json"),
        )

    return (
        documents.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_intake(
    spark: SparkSession,
    source: str,
    out: str,
    checkpoint: str,
    run: Mapping[str, str],
    kind: str = "text",
    max_files: int | None = None,
) -> StreamingQuery:
    """Ingest every text file that has arrived under ``source``."""
    reader = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    files = reader.schema(
        "path string, modificationTime timestamp, length long, content binary"
    ).load(source)
    documents = files.select(
        F.regexp_replace("path", r"^file:/*", "/").alias("uri"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"),
        F.decode("content", "UTF-8").alias("text"),
    )
    return stream_documents(documents, out, checkpoint, run, kind)


def stream_dedup(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First row of each delivery key; state is dropped ``delay`` after the watermark."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_dlq(receipts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Split a receipt stream into delivered rows and dead letters."""

    def split(batch: DataFrame, batch_id: int) -> None:
        name = _batch_name(batch_id)
        write_batch(batch.filter("ok"), out, "delivered", name)
        write_batch(
            batch.filter("NOT ok").withColumn("state", F.lit("pending")), out, "dlq", name
        )

    return (
        receipts.writeStream.foreachBatch(split)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_offsets(messages: DataFrame) -> DataFrame:
    """Message rows (topic, partition, offset, value) as records with an offset cursor.

    ``data`` is null for a value that is no JSON object.
    """
    value = J.parse(F.col("value").cast("string"))
    return messages.withColumn("__v", value).select(
        "topic",
        "partition",
        "offset",
        offset_cursor(F.col("offset")).alias("emitted_at"),
        F.when(J.is_object(F.col("__v")), J.render(F.col("__v"))).alias("data"),
    )


def read_log_stream(
    spark: SparkSession, brokers: Sequence[str], topic: str, starting: str = "earliest"
) -> DataFrame:
    """Message-log stream; needs the connector jar."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", ",".join(sorted(brokers)))
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
        .select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))
    )
