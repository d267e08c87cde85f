"""The given tables read as ingest tables, in Spark and in SQL.

Orders stand for documents that were processed, line items for their
deliveries.  Names ending in ``_SQL`` are the same tables for the SQL side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import pick, sql_pick, table
from millrace.functions import identity
from millrace.operators.failures import (
    SHARED_ERROR_CODES,
    SHARED_FAILURE_KINDS,
    classify_http,
)
from millrace.operators.receipts import receipt_summary

DESTINATIONS = ("webhook", "opensearch", "loki", "weaviate", "s3", "clickhouse")
STATUSES = (200, 400, 401, 403, 404, 409, 413, 422, 429, 500, 503, 301)
CODES = ("ZE-DELIVERY-HTTP-FAILED", "ZE-DELIVERY-FAILED", "X-UNLISTED", None)
EXTENSIONS = (".txt", ".html", ".pdf", ".json", "")
PARENTS = ("filesystem", "webhook", "fanout")

SQL_STATUS_KIND = """CASE WHEN status_code = 429 THEN 'rate_limited'
 WHEN destination = 'weaviate' AND status_code IN (401, 403) THEN 'client_error'
 WHEN status_code BETWEEN 500 AND 599 THEN 'server_error'
 WHEN destination = 'loki' AND status_code IN (400, 413, 422) THEN 'constraint'
 WHEN destination = 'weaviate' AND status_code IN (400, 404, 409, 422) THEN 'constraint'
 WHEN destination = 'weaviate' THEN 'operational' ELSE 'client_error' END"""
SQL_RETRYABLE_STATUS = "(status_code = 429 OR status_code BETWEEN 500 AND 599)"


def sql_list(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def sql_shared(column: str, allowed: tuple[str, ...]) -> str:
    return (
        f"CASE WHEN ok THEN 'not_failed' WHEN {column} IN ({sql_list(allowed)}) "
        f"THEN {column} ELSE 'unknown' END"
    )


SQL_SUMMARY = f"""CASE WHEN ok THEN 'delivered' ELSE 'failed' END AS delivery_outcome,
 CASE WHEN ok THEN 'not_failed' WHEN retryable THEN 'retryable'
   WHEN NOT retryable THEN 'non_retryable' ELSE 'unknown' END AS failure_retryability,
 {sql_shared('failure_kind', SHARED_FAILURE_KINDS)} AS shared_failure_kind,
 {sql_shared('error_code', SHARED_ERROR_CODES)} AS shared_error_code,
 CASE WHEN attempts >= 1 THEN attempts ELSE 1 END AS attempt_count"""


def attempts_by_http(spark: SparkSession, folder: str) -> DataFrame:
    """One delivery per line item: where it went and what status came back."""
    items = table(spark, folder, "lineitem")
    return items.select(
        F.col("l_orderkey").alias("doc"),
        identity.sha256_of(F.col("l_orderkey").cast("string")).alias("sha256"),
        F.concat(F.lit("run-"), F.col("l_linenumber")).alias("run_id"),
        pick(DESTINATIONS, F.col("l_suppkey") % 6).alias("destination"),
        pick(STATUSES, (F.col("l_partkey") + F.col("l_linenumber")) % 12).alias("status_code"),
        F.col("l_linenumber").alias("attempts"),
        pick(CODES, F.col("l_linenumber") % 4).alias("__code"),
    )


ATTEMPTS_SQL = f"""SELECT l_orderkey AS doc, sha256(CAST(l_orderkey AS VARCHAR)) AS sha256,
 'run-' || l_linenumber AS run_id, {sql_pick(DESTINATIONS, 'l_suppkey % 6')} AS destination,
 {sql_pick(STATUSES, '(l_partkey + l_linenumber) % 12')} AS status_code,
 l_linenumber AS attempts, {sql_pick(CODES, 'l_linenumber % 4')} AS code FROM lineitem"""


def receipts(spark: SparkSession, folder: str) -> DataFrame:
    """Delivery receipts: details are known only for failures."""
    tried = classify_http(attempts_by_http(spark, folder))
    ok = F.col("status_code") < 400
    return tried.select(
        "doc",
        "sha256",
        "run_id",
        "destination",
        ok.alias("ok"),
        "attempts",
        F.when(~ok & (F.col("attempts") != 6), F.col("retryable")).alias("retryable"),
        F.when(~ok, F.col("failure_kind")).alias("failure_kind"),
        F.when(~ok, F.col("__code")).alias("error_code"),
    )


RECEIPTS_SQL = f"""SELECT doc, sha256, run_id, destination, status_code < 400 AS ok, attempts,
 CASE WHEN status_code >= 400 AND attempts <> 6 THEN {SQL_RETRYABLE_STATUS} END AS retryable,
 CASE WHEN status_code >= 400 THEN {SQL_STATUS_KIND} END AS failure_kind,
 CASE WHEN status_code >= 400 THEN code END AS error_code FROM ({ATTEMPTS_SQL})"""


def doc_results(spark: SparkSession, folder: str) -> DataFrame:
    """One processed document per order, with its parent receipt."""
    o = table(spark, folder, "orders")
    key, cust, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    outcome = (
        F.when(status == "F", "success")
        .when((status == "O") & (key % 4 > 0), "success")
        .when(status == "O", "failed")
        .otherwise(pick(("skipped_existing", "skipped_unsupported", "failed"), key % 3))
    )
    done = o.withColumn("outcome", outcome)
    processed = F.col("outcome") != "skipped_existing"
    success = F.col("outcome") == "success"
    ok = F.when(processed, (key + cust) % 5 > 0)
    failed_delivery = ok.isNotNull() & ~ok
    code = F.when(F.col("outcome") == "failed", "ZE-UNS-PARTITION-FAILED").when(
        F.col("outcome") == "skipped_unsupported", "ZE-UNS-UNSUPPORTED-TYPE"
    )
    kinds = ("rate_limited", "server_error", "client_error", "http_error")
    base = done.select(
        key.alias("doc"),
        identity.sha256_of(key.cast("string")).alias("sha256"),
        pick(EXTENSIONS, cust % 5).alias("extension"),
        "outcome",
        F.when(processed, F.round(F.col("o_totalprice") * 100).cast("long")).alias("duration_ms"),
        F.when(processed, 1 + cust % 4).otherwise(0).alias("run_attempts"),
        F.when(F.col("outcome") == "failed", cust % 2 == 0).alias("run_retryable"),
        code.alias("run_error_code"),
        (key % 50).alias("hash_ms"),
        F.when(success, cust * 7 % 1000).alias("partition_ms"),
        F.when(processed, cust % 300).alias("delivery_ms"),
        F.coalesce(failed_delivery, F.lit(False)).alias("dlq_written"),
        F.when(processed, pick(PARENTS, cust % 3)).alias("destination"),
        ok.alias("ok"),
        F.when(processed, 1).alias("attempts"),
        F.when(failed_delivery & (cust % 7 > 0), cust % 2 == 0).alias("retryable"),
        F.when(failed_delivery, pick(kinds, key % 4)).alias("failure_kind"),
        F.when(failed_delivery, pick(CODES, cust % 4)).alias("error_code"),
    )
    summarised = receipt_summary(base)
    delivered = F.col("ok").isNotNull()
    shared = ("failure_retryability", "shared_failure_kind", "shared_error_code")
    return summarised.select(
        "doc",
        "sha256",
        "extension",
        "outcome",
        "duration_ms",
        F.col("run_attempts").alias("attempts"),
        F.col("run_retryable").alias("retryable"),
        F.col("run_error_code").alias("error_code"),
        "hash_ms",
        "partition_ms",
        "delivery_ms",
        "dlq_written",
        "destination",
        "ok",
        F.when(delivered, F.col("delivery_outcome")).alias("delivery_outcome"),
        *[F.when(delivered, F.col(c)).alias(c) for c in shared],
    )


_KINDS = ("rate_limited", "server_error", "client_error", "http_error")
DOC_RESULTS_SQL = f"""SELECT doc, sha256, extension, outcome, duration_ms,
 run_attempts AS attempts, run_retryable AS retryable, run_error_code AS error_code,
 hash_ms, partition_ms, delivery_ms, dlq_written, destination, ok,
 CASE WHEN ok IS NOT NULL THEN d_outcome END AS delivery_outcome,
 CASE WHEN ok IS NOT NULL THEN d_retry END AS failure_retryability,
 CASE WHEN ok IS NOT NULL THEN d_kind END AS shared_failure_kind,
 CASE WHEN ok IS NOT NULL THEN d_code END AS shared_error_code
FROM (SELECT *, CASE WHEN ok THEN 'delivered' ELSE 'failed' END AS d_outcome,
  CASE WHEN ok THEN 'not_failed' WHEN retryable THEN 'retryable'
   WHEN NOT retryable THEN 'non_retryable' ELSE 'unknown' END AS d_retry,
  {sql_shared('failure_kind', SHARED_FAILURE_KINDS)} AS d_kind,
  {sql_shared('error_code', SHARED_ERROR_CODES)} AS d_code
 FROM (SELECT o_orderkey AS doc, sha256(CAST(o_orderkey AS VARCHAR)) AS sha256,
   {sql_pick(EXTENSIONS, 'o_custkey % 5')} AS extension, outcome,
   CASE WHEN processed THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS duration_ms,
   CASE WHEN processed THEN 1 + o_custkey % 4 ELSE 0 END AS run_attempts,
   CASE WHEN outcome = 'failed' THEN o_custkey % 2 = 0 END AS run_retryable,
   CASE outcome WHEN 'failed' THEN 'ZE-UNS-PARTITION-FAILED'
    WHEN 'skipped_unsupported' THEN 'ZE-UNS-UNSUPPORTED-TYPE' END AS run_error_code,
   o_orderkey % 50 AS hash_ms,
   CASE WHEN outcome = 'success' THEN o_custkey * 7 % 1000 END AS partition_ms,
   CASE WHEN processed THEN o_custkey % 300 END AS delivery_ms,
   coalesce(NOT ok, false) AS dlq_written,
   CASE WHEN processed THEN {sql_pick(PARENTS, 'o_custkey % 3')} END AS destination, ok,
   CASE WHEN NOT ok AND o_custkey % 7 > 0 THEN o_custkey % 2 = 0 END AS retryable,
   CASE WHEN NOT ok THEN {sql_pick(_KINDS, 'o_orderkey % 4')} END AS failure_kind,
   CASE WHEN NOT ok THEN {sql_pick(CODES, 'o_custkey % 4')} END AS error_code
  FROM (SELECT *, outcome <> 'skipped_existing' AS processed,
    CASE WHEN outcome <> 'skipped_existing' THEN (o_orderkey + o_custkey) % 5 > 0 END AS ok
   FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'success'
     WHEN o_orderstatus = 'O' AND o_orderkey % 4 > 0 THEN 'success'
     WHEN o_orderstatus = 'O' THEN 'failed'
     ELSE {sql_pick(('skipped_existing', 'skipped_unsupported', 'failed'), 'o_orderkey % 3')}
     END AS outcome FROM orders))))"""


def dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """One dead letter per order, named after its content."""
    o = table(spark, folder, "orders")
    sha = identity.sha256_of(F.col("o_orderkey").cast("string"))
    meta = F.concat(
        F.lit('{"engine":{"name":"builtin"},"provenance":{"run_origin":"'),
        pick(("intake", "resume", "elsewhere"), F.col("o_orderkey") % 3),
        F.lit('","delivery_origin":"primary","execution_mode":"batch","task_id":"t'),
        F.col("o_orderkey").cast("string"),
        F.lit('","extra":1},"run_id":"run-1"}'),
    )
    return o.select(
        F.concat(sha, F.lit("__run-1__"), pick(DESTINATIONS, F.col("o_custkey") % 6)).alias("name"),
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise("done").alias("state"),
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', o_orderdate)").alias(
            "mtime_s"
        ),
        F.round(F.col("o_totalprice")).cast("long").alias("size_bytes"),
        pick(DESTINATIONS, F.col("o_custkey") % 6).alias("destination"),
        sha.alias("sha256"),
        F.when(F.col("o_orderkey") % 11 > 0, "run-1").alias("run_id"),
        F.when(F.col("o_orderkey") % 13 > 0, meta).otherwise("[]").alias("run_meta"),
        F.col("o_orderkey").alias("doc"),
    )


DEAD_LETTERS_SQL = f"""SELECT sha256(CAST(o_orderkey AS VARCHAR)) || '__run-1__' ||
  {sql_pick(DESTINATIONS, 'o_custkey % 6')} AS name,
 CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'done' END AS state,
 CAST(epoch(o_orderdate) AS BIGINT) AS mtime_s, CAST(round(o_totalprice) AS BIGINT) AS size_bytes,
 {sql_pick(DESTINATIONS, 'o_custkey % 6')} AS destination,
 sha256(CAST(o_orderkey AS VARCHAR)) AS sha256,
 CASE WHEN o_orderkey % 11 > 0 THEN 'run-1' END AS run_id, o_orderkey % 13 > 0 AS has_meta,
 {sql_pick(('intake', 'resume', 'elsewhere'), 'o_orderkey % 3')} AS origin,
 o_orderkey AS doc FROM orders"""

BUCKET_OF_ORDER = ("pending", "inflight", "done", "poison", "inflight")
NOW = 1_000_000_000.0


def task_state(spark: SparkSession, folder: str) -> DataFrame:
    """One task per order."""
    o = table(spark, folder, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    bucket = pick(BUCKET_OF_ORDER, key % 5)
    born = F.expr(
        "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', o_orderdate)"
    ).cast("double")
    empty = (
        "array<struct<action:string,source_bucket:string,target_bucket:string,recorded_at:double>>"
    )
    return o.select(
        F.concat(F.lit("task-"), key.cast("string")).alias("task_id"),
        bucket.alias("bucket"),
        F.concat(
            F.lit('{"task_id":"task-'),
            key.cast("string"),
            F.lit('","kind":"uns","inputs":{"document":{"source":"'),
            F.when(cust % 2 == 0, "s3").otherwise("local_file"),
            F.lit('"}}'),
            F.when(cust % 3 > 0, F.lit(',"identity":{"pipeline_version":"p1","sha256":"x"}')).otherwise(""),
            F.lit("}"),
        ).alias("task_json"),
        (cust % 3).cast("int").alias("failure_count"),
        (cust % 2).cast("int").alias("orphan_count"),
        F.when(bucket == "inflight", born + key % 100).alias("claimed_at"),
        born.alias("created_at"),
        (born + key % 1000).alias("updated_at"),
        F.array().cast(empty).alias("provenance"),
    )


TASK_STATE_SQL = f"""SELECT 'task-' || o_orderkey AS task_id, bucket,
 '{{"task_id":"task-' || o_orderkey || '","kind":"uns","inputs":{{"document":{{"source":"' ||
  CASE WHEN o_custkey % 2 = 0 THEN 's3' ELSE 'local_file' END || '"}}}}' || CASE WHEN o_custkey % 3 > 0
  THEN ',"identity":{{"pipeline_version":"p1","sha256":"x"}}' ELSE '' END || '}}' AS task_json,
 CAST(o_custkey % 3 AS INTEGER) AS failure_count, CAST(o_custkey % 2 AS INTEGER) AS orphan_count,
 CASE WHEN bucket = 'inflight' THEN epoch(o_orderdate) + o_orderkey % 100 END AS claimed_at,
 epoch(o_orderdate) AS created_at, epoch(o_orderdate) + o_orderkey % 1000 AS updated_at,
 o_orderkey, o_custkey
FROM (SELECT *, {sql_pick(BUCKET_OF_ORDER, 'o_orderkey % 5')} AS bucket FROM orders)"""


def event_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a message log: the user is the partition, the event id the offset."""
    e = table(spark, folder, "events")
    return e.select(
        F.lit("events").alias("topic"),
        F.col("user_id").cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("props").alias("value"),
    )
