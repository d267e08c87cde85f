"""Queries that run a bounded stream over a given table and read back what it wrote.

Outputs go under the checkpoint folder, which is shared storage on a cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import Catalog, table
from millrace.catalog.documents import ingested_sql
from millrace.catalog.fixtures import DESTINATIONS
from millrace.operators.sinks import read_artifacts
from millrace.session import file_system, results_folder, stored
from millrace.streaming.evidence import stream_evidence
from millrace.streaming.fanout import STATE_STORE, stream_fanout
from millrace.streaming.intake import stream_dedup, stream_dlq, stream_documents, stream_offsets

catalog = Catalog()


def stream_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream of its files; it is one file or a folder of them."""
    place = f"{folder.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    files, path = file_system(spark, place)
    if files.getFileStatus(path).isDirectory():
        return reader.parquet(place)
    # A stream reads folders only.
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def scratch(spark: SparkSession) -> str:
    return f"{results_folder(spark)}/streams-{uuid.uuid4().hex}"


@catalog.add(
    "stream_intake",
    f"""SELECT sha256, delivery_identity, payload_json
FROM ({ingested_sql("CAST(doc_id AS VARCHAR) || '.txt'")})
WHERE filename IN (SELECT min_by(CAST(doc_id AS VARCHAR) || '.txt', doc_id) FROM documents GROUP BY text)""",
)
def intake(spark: SparkSession, folder: str) -> DataFrame:
    documents = stream_of(spark, folder, "documents").select(
        F.concat(F.lit("/in/"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("uri"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"),
        "text",
    )
    out = scratch(spark)
    run = {"run_id": "run-1", "pipeline_version": "p1", "timestamp_utc": "2026-01-01T00:00:00Z"}
    stream_documents(documents, f"{out}/tables", f"{out}/progress", run).awaitTermination()
    return read_artifacts(spark, f"{out}/tables", "payloads").select(
        "sha256",
        "delivery_identity",
        # The folder is another one each time.
        F.replace("payload_json", F.lit(f"{out}/tables"), F.lit("/out")).alias("payload_json"),
    )


@catalog.add(
    "stream_dedup",
    """SELECT DISTINCT user_id, event_type FROM events""",
)
def dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The delay covers the whole table, so each key is delivered once."""
    events = stream_of(spark, folder, "events").select(
        "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts")
    )
    out = scratch(spark)
    first = stream_dedup(events, ["user_id", "event_type"], "ts", "400 days")
    (
        first.writeStream.format("parquet")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{out}/rows").select("user_id", "event_type")


@catalog.add(
    "stream_dlq",
    f"""SELECT l_orderkey, l_linenumber, ({list(DESTINATIONS)})[1 + l_suppkey % 6] AS destination,
 CASE WHEN l_partkey % 3 = 0 THEN 'pending' ELSE 'delivered' END AS state FROM lineitem""",
)
def dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    items = stream_of(spark, folder, "lineitem")
    receipts = items.select(
        "l_orderkey",
        "l_linenumber",
        F.get(F.array(*[F.lit(d) for d in DESTINATIONS]), (F.col("l_suppkey") % 6).cast("int")).alias(
            "destination"
        ),
        (F.col("l_partkey") % 3 > 0).alias("ok"),
    )
    out = scratch(spark)
    stream_dlq(receipts, f"{out}/tables", f"{out}/progress").awaitTermination()
    columns = ("l_orderkey", "l_linenumber", "destination")
    letters = spark.read.parquet(f"{out}/tables/dlq").select(*columns, "state")
    delivered = spark.read.parquet(f"{out}/tables/delivered").select(
        *columns, F.lit("delivered").alias("state")
    )
    return letters.unionByName(delivered)


def _run(stream: DataFrame, out: str) -> None:
    """Run a stream over what has landed, from where it stopped before."""
    (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _landed(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)


#: A time after that of all rows, which moves the watermarks past them.
_CLOCK = "timestamp'2100-01-01 00:00:00'"


@catalog.add(
    "stream_fanout",
    """WITH c AS (SELECT l_orderkey, CAST(1 + l_orderkey % 7 AS INTEGER) AS expected, l_partkey % 3 > 0 AS ok,
  CAST(1 + l_suppkey % 4 AS INTEGER) AS attempts, l_suppkey % 2 = 0 AS retryable,
  (['timeout', 'connection', 'constraint'])[1 + l_partkey % 2] AS kind
  FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey
   FROM lineitem WHERE l_linenumber <= 1 + l_orderkey % 7 GROUP BY 1, 2))
SELECT l_orderkey, CASE WHEN count(*) = expected THEN 'complete' ELSE 'timed_out' END AS status,
 bool_and(ok) AND count(*) = expected AS ok, expected, CAST(expected - count(*) AS INTEGER) AS missing,
 CAST(count(*) AS INTEGER) AS child_count, CAST(count(*) FILTER (NOT ok) AS INTEGER) AS failed_children,
 max(attempts) AS attempts,
 CASE WHEN count(DISTINCT retryable) FILTER (NOT ok) = 1 THEN any_value(retryable) FILTER (NOT ok) END AS retryable,
 CASE WHEN count(DISTINCT kind) FILTER (NOT ok) = 1 THEN any_value(kind) FILTER (NOT ok) END AS failure_kind
FROM c GROUP BY l_orderkey, expected""",
)
def parents(spark: SparkSession, folder: str) -> DataFrame:
    """Receipts of every line arrive in two parts; the stream is restarted for the second,
    and a third time when the clock has gone on."""
    out = scratch(spark)
    items = table(spark, folder, "lineitem").filter("l_linenumber <= 1 + l_orderkey % 7")
    lines = items.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey")
    )
    children = stored(lines.selectExpr(
        "l_orderkey",
        "CAST(l_linenumber AS STRING) AS destination",
        "l_partkey % 3 > 0 AS ok",
        "CAST(1 + l_suppkey % 4 AS INT) AS attempts",
        "l_suppkey % 2 = 0 AS retryable",
        "element_at(array('timeout', 'connection', 'constraint'), CAST(1 + l_partkey % 2 AS INT)) AS failure_kind",
        "CAST(NULL AS STRING) AS error_code",
        "CAST(1 + l_orderkey % 7 AS INT) AS expected",
        "timestamp'2026-01-01 00:00:00' AS at",
    ))
    clock = children.limit(1).selectExpr(
        "-1L AS l_orderkey", "destination", "ok", "attempts", "retryable", "failure_kind", "error_code",
        "1 AS expected", f"{_CLOCK} AS at",
    )
    odd = F.pmod(F.xxhash64("l_orderkey", "destination"), F.lit(2)) == 0
    before = spark.conf.get(STATE_STORE)
    for part in (children.filter(odd), children.filter(~odd), clock):
        part.write.mode("append").parquet(f"{out}/landed")
        _run(stream_fanout(_landed(spark, f"{out}/landed", children.schema), ["l_orderkey"]), out)
    spark.conf.set(STATE_STORE, before)
    return spark.read.parquet(f"{out}/rows").filter("l_orderkey >= 0").select(
        "l_orderkey", "status", "ok", "expected", "missing", "child_count", "failed_children", "attempts",
        "retryable", "failure_kind",
    )


@catalog.add(
    "stream_evidence",
    """SELECT doc_id, doc_id IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) AS found FROM documents""",
)
def evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Labels are the evidence that documents name, both as streams; missing labels come
    out when the clock has passed."""
    out = scratch(spark)
    asked = table(spark, folder, "documents").selectExpr(
        "doc_id",
        "CAST(doc_id AS STRING) AS evidence_ref",
        # Not at the very begin of time, where the first watermark is.
        "timestamp_seconds(86400 + doc_id) AS expected_at",
    )
    given = table(spark, folder, "labels").select("doc_id").distinct().selectExpr(
        "CAST(doc_id AS STRING) AS evidence_ref", "timestamp_seconds(86400 + doc_id) AS present_at"
    )
    late = spark.range(1).selectExpr(
        "-1L AS doc_id", "'clock' AS evidence_ref", f"{_CLOCK} AS expected_at"
    )
    for left, right in (
        (asked, given),
        (late, late.selectExpr("evidence_ref", "expected_at AS present_at")),
    ):
        left.write.mode("append").parquet(f"{out}/asked")
        right.write.mode("append").parquet(f"{out}/given")
        stream = stream_evidence(
            _landed(spark, f"{out}/asked", asked.schema), _landed(spark, f"{out}/given", given.schema)
        )
        _run(stream, out)
    return spark.read.parquet(f"{out}/rows").filter("doc_id >= 0").select("doc_id", "found")


@catalog.add(
    "stream_offsets",
    """SELECT 'events' AS topic, CAST(user_id AS INTEGER) AS partition, event_id AS "offset",
 lpad(CAST(event_id AS VARCHAR), 20, '0') AS emitted_at, CAST(json(props) AS VARCHAR) AS data FROM events""",
)
def offsets(spark: SparkSession, folder: str) -> DataFrame:
    messages = stream_of(spark, folder, "events").select(
        F.lit("events").alias("topic"),
        F.col("user_id").cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("props").alias("value"),
    )
    out = scratch(spark)
    (
        stream_offsets(messages)
        .writeStream.format("parquet")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{out}/rows")
