"""Queries over deliveries: sink rows, receipts, failures and outcomes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import Catalog, pick, sql_pick, table
from millrace.catalog.documents import LINES_SQL
from millrace.catalog.fixtures import (
    ATTEMPTS_SQL,
    RECEIPTS_SQL,
    SQL_RETRYABLE_STATUS,
    SQL_STATUS_KIND,
    SQL_SUMMARY,
    attempts_by_http,
    receipts,
)
from millrace.functions import identity
from millrace.operators.delivery import (
    append_rows,
    doc_store_rows,
    evidence_from_stored,
    kv_rows,
    log_stream_rows,
    object_store_rows,
    table_rows,
    upsert_rows,
)
from millrace.operators.failures import (
    classify_batch_items,
    classify_exception,
    classify_http,
    classify_response_text,
    classify_source_error,
    is_retryable,
    run_outcomes,
)
from millrace.operators.merge import merge_rows, merged_rows
from millrace.operators.partition import text_elements
from millrace.operators.receipts import fanout, receipt_details, receipt_summary
from millrace.session import results_folder

catalog = Catalog()

_ISO = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')"


def order_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """One payload per order, delivered on the order's date."""
    o = table(spark, folder, "orders")
    sha = identity.sha256_of(F.col("o_custkey").cast("string"))
    run = F.concat(F.lit("run-"), "o_orderstatus")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    zone = pick(("Z", "", "+02:00", "+00:00"), F.col("o_orderkey") % 4)
    return o.select(
        "o_orderkey",
        sha.alias("sha256"),
        run.alias("run_id"),
        F.lit(1).alias("schema_version"),
        F.concat(F.lit('{"order":'), F.col("o_orderkey").cast("string"), F.lit("}")).alias(
            "payload_json"
        ),
        identity.delivery_key(sha, run).alias("delivery_identity"),
        F.concat(stamp, zone).alias("timestamp_utc"),
        F.concat(stamp, F.lit("Z")).alias("delivered"),
    )


PAYLOADS_SQL = f"""SELECT o_orderkey, sha256(CAST(o_custkey AS VARCHAR)) AS sha256,
 'run-' || o_orderstatus AS run_id, '{{"order":' || o_orderkey || '}}' AS payload_json,
 sha256(CAST(o_custkey AS VARCHAR)) || ':run-' || o_orderstatus AS delivery_identity,
 {_ISO} AS delivered, o_orderdate FROM orders"""


def _existing_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer was delivered before, in a run that finished."""
    c = table(spark, folder, "customer")
    sha = identity.sha256_of(F.col("c_custkey").cast("string"))
    return c.select(
        identity.delivery_key(sha, F.lit("run-F")).alias("identity_key"),
        sha.alias("sha256"),
        F.lit("run-F").alias("run_id"),
        F.lit(1).alias("schema_version"),
        F.lit("{}").alias("payload_json"),
        F.lit("1990-01-01T00:00:00Z").alias("delivered_at_utc"),
    )


_EXISTING_SQL = """SELECT sha256(CAST(c_custkey AS VARCHAR)) || ':run-F' AS identity_key,
 sha256(CAST(c_custkey AS VARCHAR)) AS sha256, 'run-F' AS run_id, '{}' AS payload_json,
 '1990-01-01T00:00:00Z' AS delivered_at_utc FROM customer"""


@catalog.add(
    "upsert_rows",
    f"""WITH n AS (SELECT * FROM (SELECT delivery_identity AS identity_key, sha256, run_id, payload_json,
  delivered AS delivered_at_utc, row_number() OVER (PARTITION BY delivery_identity
   ORDER BY delivered DESC, payload_json DESC) AS rn FROM ({PAYLOADS_SQL})) WHERE rn = 1),
 o AS ({_EXISTING_SQL})
SELECT coalesce(n.identity_key, o.identity_key) AS identity_key,
 coalesce(n.run_id, o.run_id) AS run_id, coalesce(n.payload_json, o.payload_json) AS payload_json,
 coalesce(n.delivered_at_utc, o.delivered_at_utc) AS delivered_at_utc,
 CASE WHEN n.identity_key IS NULL THEN 'unchanged' WHEN o.identity_key IS NULL THEN 'upsert_inserted'
  ELSE 'upsert_replaced' END AS operation FROM n FULL JOIN o ON n.identity_key = o.identity_key""",
)
def upserts(spark: SparkSession, folder: str) -> DataFrame:
    incoming = table_rows(order_payloads(spark, folder), F.col("delivered"))
    return upsert_rows(_existing_rows(spark, folder), incoming).select(
        "identity_key", "run_id", "payload_json", "delivered_at_utc", "operation"
    )


@catalog.add(
    "merge_rows",
    f"""WITH n AS (SELECT * FROM (SELECT delivery_identity AS identity_key, sha256, run_id, payload_json,
  delivered AS delivered_at_utc, row_number() OVER (PARTITION BY delivery_identity
   ORDER BY delivered DESC, payload_json DESC) AS rn FROM ({PAYLOADS_SQL})) WHERE rn = 1),
 o AS ({_EXISTING_SQL})
SELECT coalesce(n.identity_key, o.identity_key) AS identity_key,
 coalesce(n.run_id, o.run_id) AS run_id, coalesce(n.payload_json, o.payload_json) AS payload_json,
 coalesce(n.delivered_at_utc, o.delivered_at_utc) AS delivered_at_utc
FROM n FULL JOIN o ON n.identity_key = o.identity_key""",
)
def merges(spark: SparkSession, folder: str) -> DataFrame:
    """The stored table after two upserts, of which the second is run twice."""
    place = f"{results_folder(spark)}/merged-{uuid.uuid4().hex}"
    incoming = table_rows(order_payloads(spark, folder), F.col("delivered"))
    merge_rows(spark, place, _existing_rows(spark, folder).select(*incoming.columns))
    for _ in range(2):
        merge_rows(spark, place, incoming)
    return merged_rows(spark, place).select(
        "identity_key", "run_id", "payload_json", "delivered_at_utc"
    )


@catalog.add(
    "append_rows",
    f"""SELECT identity_key, sha256, run_id, 1 AS schema_version, payload_json, delivered_at_utc
FROM ({_EXISTING_SQL})
UNION ALL SELECT delivery_identity, sha256, run_id, 1, payload_json, delivered FROM ({PAYLOADS_SQL})""",
)
def appends(spark: SparkSession, folder: str) -> DataFrame:
    incoming = table_rows(order_payloads(spark, folder), F.col("delivered"))
    return append_rows(_existing_rows(spark, folder), incoming)


@catalog.add(
    "doc_store_rows",
    f"""SELECT delivery_identity AS _id, delivery_identity, payload_json AS payload FROM ({PAYLOADS_SQL})""",
)
def doc_store(spark: SparkSession, folder: str) -> DataFrame:
    return doc_store_rows(order_payloads(spark, folder))


@catalog.add(
    "object_store_rows",
    f"""SELECT 'landing/x/' || delivery_identity || '.json' AS object_key, payload_json AS body
FROM ({PAYLOADS_SQL})""",
)
def object_store(spark: SparkSession, folder: str) -> DataFrame:
    return object_store_rows(order_payloads(spark, folder), " /landing/x/ ")


@catalog.add(
    "log_stream_rows",
    f"""SELECT 'ingest' AS app, 'docs' AS stream, delivery_identity, sha256, run_id,
 CAST((CAST(epoch(o_orderdate) AS BIGINT) - CASE WHEN o_orderkey % 4 = 2 THEN 7200 ELSE 0 END)
  * 1000000000 AS VARCHAR) AS timestamp_ns, payload_json AS line FROM ({PAYLOADS_SQL})""",
)
def log_stream(spark: SparkSession, folder: str) -> DataFrame:
    rows = log_stream_rows(order_payloads(spark, folder), "docs")
    return rows.select(
        F.col("labels")["app"].alias("app"),
        F.col("labels")["ingest_stream"].alias("stream"),
        F.col("labels")["ingest_delivery_identity"].alias("delivery_identity"),
        F.col("labels")["ingest_sha256"].alias("sha256"),
        F.col("labels")["ingest_run_id"].alias("run_id"),
        "timestamp_ns",
        "line",
    )


@catalog.add(
    "kv_rows",
    f"""SELECT delivery_identity AS key, payload_json AS value FROM ({PAYLOADS_SQL})""",
)
def key_values(spark: SparkSession, folder: str) -> DataFrame:
    return kv_rows(order_payloads(spark, folder))


STORED_LINES = ('{"a":1}', '{"a":1.0}\n\n{"b":[2]}\n', "[1]", "{", None, "\n \n")
_STORED = (
    ("available", 1, '{"a":1}'),
    ("available", 2, '{"a":1.0}|{"b":[2]}'),
    ("invalid_jsonl", 1, None),
    ("invalid_jsonl", 1, None),
    ("missing", None, None),
    ("available", 0, ""),
)
BAD_ELEMENTS = ("{}", None, "[")


def element_texts() -> Column:
    """Stored elements: the document's own, none, no list, missing, malformed."""
    form = F.col("n_chars") % 5
    own = F.to_json(text_elements(F.col("text")))
    return F.when(form == 0, own).when(form == 1, "[]").otherwise(pick(BAD_ELEMENTS, form - 2))


@catalog.add(
    "evidence_from_stored",
    f"""SELECT doc_id, normalized_text_len, elements_count, records_status, records_count, preview,
 CASE WHEN normalized_text_len IS NOT NULL AND records_status = 'available'
   THEN 'normalized_text_and_records_preview_v1'
  WHEN normalized_text_len IS NOT NULL THEN 'normalized_text_preview_v1'
  WHEN records_status = 'available' THEN 'records_preview_v1'
  WHEN elements_count IS NOT NULL THEN 'elements_count_only_v1'
  ELSE 'artifact_reference_only_v1' END AS evidence_kind
FROM (SELECT doc_id, CASE WHEN doc_id % 4 > 0 THEN length(text) END AS normalized_text_len,
 CASE WHEN n_chars % 5 = 0 THEN coalesce(n, 0) WHEN n_chars % 5 = 1 THEN 0 END AS elements_count,
 CASE WHEN doc_id % 5 > 0 THEN {sql_pick([s[0] for s in _STORED], 'doc_id % 6')} END AS records_status,
 CASE WHEN doc_id % 5 > 0 THEN {sql_pick([s[1] for s in _STORED], 'doc_id % 6')} END AS records_count,
 CASE WHEN doc_id % 5 > 0 THEN {sql_pick([s[2] for s in _STORED], 'doc_id % 6')} END AS preview
FROM documents LEFT JOIN (SELECT doc_id, CAST(count(*) AS INTEGER) AS n FROM ({LINES_SQL}) GROUP BY doc_id)
 USING (doc_id))""",
)
def stored_evidence(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    stored = docs.select(
        "doc_id",
        F.when(F.col("doc_id") % 4 > 0, F.col("text")).alias("normalized_text"),
        element_texts().alias("elements_json"),
        pick(STORED_LINES, F.col("doc_id") % 6).alias("record_lines"),
        (F.col("doc_id") % 5 > 0).alias("is_records"),
    )
    return evidence_from_stored(stored).select(
        "doc_id",
        F.col("normalized_text_len").cast("long").alias("normalized_text_len"),
        "elements_count",
        "records_status",
        "records_count",
        F.array_join("records_preview", "|").alias("preview"),
        "evidence_kind",
    )


@catalog.add(
    "classify_http",
    f"""SELECT doc, destination, status_code, {SQL_STATUS_KIND} AS failure_kind,
 {SQL_RETRYABLE_STATUS} AS retryable FROM ({ATTEMPTS_SQL})""",
)
def http_classes(spark: SparkSession, folder: str) -> DataFrame:
    return classify_http(attempts_by_http(spark, folder)).select(
        "doc", "destination", "status_code", "failure_kind", "retryable"
    )


ANSWERS = (
    "Authentication failed: no user",
    "Code: 60. UNKNOWN_TABLE x",
    "Type mismatch in column",
    "overloaded",
    None,
)


@catalog.add(
    "classify_response_text",
    f"""SELECT l_orderkey, status_code, CASE a WHEN 0 THEN 'client_error' WHEN 1 THEN 'constraint'
  WHEN 2 THEN 'constraint' ELSE CASE WHEN status_code = 429 THEN 'rate_limited'
   WHEN status_code BETWEEN 500 AND 599 THEN 'server_error' ELSE 'client_error' END END AS failure_kind,
 a > 2 AND {SQL_RETRYABLE_STATUS} AS retryable
FROM (SELECT l_orderkey, l_suppkey % 5 AS a, {sql_pick((400, 429, 500, 404), 'l_partkey % 4')}
  AS status_code FROM lineitem)""",
)
def response_classes(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select(
        "l_orderkey",
        pick((400, 429, 500, 404), F.col("l_partkey") % 4).alias("status_code"),
        pick(ANSWERS, F.col("l_suppkey") % 5).alias("response_text"),
    )
    return classify_response_text(items).select(
        "l_orderkey", "status_code", "failure_kind", "retryable"
    )


ERRORS = (
    ("mongodb", "DuplicateKeyError", "E11000", "constraint"),
    ("mongodb", "AutoReconnect", "lost", "connection"),
    ("mongodb", "OperationFailure", "Not Authorized on x", "client_error"),
    ("mongodb", "OperationFailure", "bson size too large", "constraint"),
    ("kafka", "KafkaException", "Unknown topic", "client_error"),
    ("kafka", "KafkaException", "message timed out", "timeout"),
    ("kafka", "KafkaException", "Broker down", "connection"),
    ("s3", "EndpointConnectionError", "cannot reach", "connection"),
    ("s3", "ReadTimeoutError", "slow", "timeout"),
    ("s3", "ClientError", "denied", "operational"),
    ("sqlite", "OperationalError", "database is locked", "locked"),
    ("sqlite", "IntegrityError", "unique", "constraint"),
    ("sqlite", "DatabaseError", "malformed", "database_error"),
    ("filesystem", "OSError", "Resource busy", "locked"),
    ("filesystem", "OSError", "no space", "operational"),
    ("weaviate", "UnexpectedStatus", "status 429", "rate_limited"),
    ("weaviate", "ConnectionError", "network down", "connection"),
    ("weaviate", "AuthError", "bad api key", "client_error"),
    ("webhook", "ReadTimeout", "slow", "timeout"),
    ("webhook", "TooManyRedirects", "loop", "http_error"),
    ("opensearch", "RemoteProtocolError", "cut", "protocol"),
    ("loki", "DecodingError", "odd", "operational"),
)
_ERROR_RETRY = tuple(
    e[3]
    in {
        "sqlite": ("locked",),
        "filesystem": ("locked",),
        "weaviate": ("timeout", "connection", "protocol", "rate_limited", "server_error"),
        "webhook": ("timeout", "connection", "protocol"),
        "opensearch": ("timeout", "connection", "protocol"),
        "loki": ("timeout", "connection", "protocol"),
    }.get(e[0], ("timeout", "connection"))
    for e in ERRORS
)
_ERROR_AT = f"(l_partkey + l_suppkey) % {len(ERRORS)}"


@catalog.add(
    "classify_exception",
    f"""SELECT l_orderkey, {sql_pick([e[0] for e in ERRORS], _ERROR_AT)} AS destination,
 {sql_pick([e[3] for e in ERRORS], _ERROR_AT)} AS failure_kind,
 {sql_pick(_ERROR_RETRY, _ERROR_AT)} AS retryable FROM lineitem""",
)
def exception_classes(spark: SparkSession, folder: str) -> DataFrame:
    at = (F.col("l_partkey") + F.col("l_suppkey")) % len(ERRORS)
    items = table(spark, folder, "lineitem").select(
        "l_orderkey",
        pick([e[0] for e in ERRORS], at).alias("destination"),
        pick([e[1] for e in ERRORS], at).alias("exc_type"),
        pick([e[2] for e in ERRORS], at).alias("exc"),
        F.when(at == 15, 429).alias("status_code"),
    )
    return classify_exception(items, status="status_code").select(
        "l_orderkey", "destination", "failure_kind", "retryable"
    )


_ITEM_STATUSES = (400, 404, None, 500, 429, 200)


@catalog.add(
    "classify_batch_items",
    f"""WITH i AS (SELECT l_orderkey, l_partkey * 100 + l_linenumber AS position,
  {sql_pick(_ITEM_STATUSES, '(l_partkey + l_suppkey) % 6')} AS s FROM lineitem),
 v AS (SELECT l_orderkey, arg_min(s, position) FILTER (s = 429 OR s BETWEEN 500 AND 599) AS again,
  arg_min(s, position) FILTER (s IS NOT NULL) AS first FROM i GROUP BY 1)
SELECT l_orderkey, CASE WHEN status_code IS NULL THEN 'operational' ELSE {SQL_STATUS_KIND} END
 AS failure_kind, again IS NOT NULL OR first IS NULL AS retryable
FROM (SELECT *, coalesce(again, first) AS status_code, 'weaviate' AS destination FROM v)""",
)
def batch_items(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select(
        "l_orderkey",
        (F.col("l_partkey") * 100 + F.col("l_linenumber")).alias("position"),
        pick(_ITEM_STATUSES, (F.col("l_partkey") + F.col("l_suppkey")) % 6).alias("status_code"),
    )
    return classify_batch_items(items, ["l_orderkey"])


SOURCE_ERRORS = (
    ("08006", "OperationalError", "x", True),
    ("40P01", "DeadlockDetected", "x", True),
    ("42P01", "UndefinedTable", "x", False),
    (None, "OperationalError", "Server closed the connection unexpectedly", True),
    (None, "OSError", "x", True),
    (None, "ConnectionTimeout", "x", True),
    (None, "ProgrammingError", "syntax", False),
)


@catalog.add(
    "classify_source_error",
    f"""SELECT event_id, {sql_pick([e[3] for e in SOURCE_ERRORS], 'event_id % 7')} AS retryable
FROM events""",
)
def source_errors(spark: SparkSession, folder: str) -> DataFrame:
    at = F.col("event_id") % 7
    rows = table(spark, folder, "events").select(
        "event_id",
        pick([e[0] for e in SOURCE_ERRORS], at).alias("sqlstate"),
        pick([e[1] for e in SOURCE_ERRORS], at).alias("exc_type"),
        pick([e[2] for e in SOURCE_ERRORS], at).alias("exc"),
    )
    return classify_source_error(rows).select("event_id", "retryable")


RUN_ERRORS = (
    ("ZE-UNS-EXTRA-MISSING", "true", "X", "x", False),
    ("ZE-IO-READ-FAILED", "true", "X", "x", True),
    ("ZE-IO-READ-FAILED", "false", "TimeoutError", "rate limit", False),
    (None, None, "TimeoutError", "x", True),
    (None, None, "X", "Too Many Requests", True),
    (None, None, "X", None, False),
)


@catalog.add(
    "is_retryable",
    f"""SELECT event_id, {sql_pick([e[4] for e in RUN_ERRORS], 'event_id % 6')} AS retryable FROM events""",
)
def retryable_errors(spark: SparkSession, folder: str) -> DataFrame:
    at = F.col("event_id") % 6
    rows = table(spark, folder, "events").select(
        "event_id",
        *[
            pick([e[i] for e in RUN_ERRORS], at).alias(c)
            for i, c in enumerate(("error_code", "details_retryable", "exc_type", "exc"))
        ],
    )
    return is_retryable(rows).select("event_id", "retryable")


def _details(df: DataFrame) -> Column:
    fields = ("attempts", "retryable", "failure_kind", "error_code")
    return F.to_json(F.struct(*[F.col(f) for f in fields]))


@catalog.add(
    "receipt_summary",
    f"""SELECT doc, destination, ok, {SQL_SUMMARY}, 1 AS payload_count FROM ({RECEIPTS_SQL})""",
)
def summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Details take the way through their JSON text."""
    rows = receipts(spark, folder)
    stored = rows.select("doc", "destination", "ok", _details(rows).alias("details"))
    return receipt_summary(receipt_details(stored)).select(
        "doc",
        "destination",
        "ok",
        "delivery_outcome",
        "failure_retryability",
        "shared_failure_kind",
        "shared_error_code",
        "attempt_count",
        "payload_count",
    )


@catalog.add(
    "fanout",
    f"""WITH s AS (SELECT doc, ok, {SQL_SUMMARY} FROM ({RECEIPTS_SQL})),
 g AS (SELECT doc, bool_and(ok) AS ok, count(*) AS child_count, count(*) FILTER (ok) AS ok_children,
  count(*) FILTER (NOT ok) AS failed_children, max(attempt_count) AS attempts,
  list(DISTINCT failure_retryability) FILTER (NOT ok AND failure_retryability <> 'unknown') AS r,
  list(DISTINCT shared_failure_kind) FILTER (NOT ok AND shared_failure_kind <> 'unknown') AS k,
  list(DISTINCT shared_error_code) FILTER (NOT ok AND shared_error_code <> 'unknown') AS c
  FROM s GROUP BY doc)
SELECT doc, 'fanout' AS destination, ok, child_count, ok_children, failed_children, attempts,
 CASE WHEN len(r) = 1 THEN r[1] = 'retryable' END AS retryable,
 CASE WHEN len(k) = 1 THEN k[1] END AS failure_kind,
 CASE WHEN len(c) = 1 THEN c[1] END AS error_code FROM g""",
)
def fanouts(spark: SparkSession, folder: str) -> DataFrame:
    return fanout(receipts(spark, folder), ["doc"])


@catalog.add(
    "run_outcomes",
    """WITH a AS (SELECT l_orderkey, l_linenumber AS attempt, bool_or(l_returnflag = 'N') AS ok,
  max(CASE WHEN l_returnflag <> 'N' THEN CASE WHEN l_linenumber % 3 = 0 THEN 'ZE-UNS-UNSUPPORTED-TYPE'
   ELSE 'ZE-UNS-PARTITION-FAILED' END END) AS error_code, bool_or(l_linestatus = 'O') AS retryable
  FROM lineitem GROUP BY 1, 2),
 e AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY
   CASE WHEN ok OR NOT retryable OR attempt >= 3 THEN 0 ELSE 1 END,
   CASE WHEN ok OR NOT retryable OR attempt >= 3 THEN attempt ELSE -attempt END) AS rn FROM a)
SELECT l_orderkey, CASE WHEN ok THEN 'success' WHEN error_code = 'ZE-UNS-UNSUPPORTED-TYPE'
  THEN 'skipped_unsupported' ELSE 'failed' END AS outcome, attempt AS attempts,
 CASE WHEN NOT ok THEN error_code END AS error_code, CASE WHEN NOT ok THEN retryable END AS retryable
FROM e WHERE rn = 1""",
)
def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """A line of an order is one attempt at it."""
    code = F.when(F.col("l_linenumber") % 3 == 0, "ZE-UNS-UNSUPPORTED-TYPE").otherwise(
        "ZE-UNS-PARTITION-FAILED"
    )
    attempts = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey", F.col("l_linenumber").alias("attempt"))
        .agg(
            F.bool_or(F.col("l_returnflag") == "N").alias("ok"),
            F.max(
                F.when(F.col("l_returnflag") != "N", code)
            ).alias("error_code"),
            F.bool_or(F.col("l_linestatus") == "O").alias("retryable"),
        )
    )
    return run_outcomes(attempts, ["l_orderkey"], 3)
