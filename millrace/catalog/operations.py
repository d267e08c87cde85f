"""Queries over reports, dead letters, task states and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import Catalog, pick, sql_pick, table
from millrace.catalog.delivery import element_texts
from millrace.catalog.documents import LINES_SQL
from millrace.catalog.fixtures import (
    DEAD_LETTERS_SQL,
    DOC_RESULTS_SQL,
    NOW,
    RECEIPTS_SQL,
    TASK_STATE_SQL,
    dead_letters,
    doc_results,
    receipts,
    task_state,
)
from millrace.functions import identity
from millrace.operators.audit import (
    NEGATIVE_MARKERS,
    ContextRules,
    ImportRule,
    PathRule,
    Term,
    audit_payloads,
    audit_vectors,
    backfill_governance,
    denylist_scan,
    governance_receipts,
    import_scan,
    path_rule_scan,
    path_scan_summary,
    scan_summary,
    verify_evidence,
)
from millrace.operators.deadletters import (
    build_dlq,
    prune_dlq,
    replay_apply,
    replay_select,
    replay_text,
)
from millrace.operators.reports import (
    batch_counts,
    batch_report,
    counts_by_destination,
    counts_by_error_code,
    counts_by_extension,
    delivery_counts,
    duration_stats,
    failure_kinds_by_destination,
    metric_rows,
    report_durations,
    retry_stats,
    usage_batch,
    usage_records,
)
from millrace.operators.tables_scan import rule_scan, term_scan
from millrace.operators.tasks import (
    apply_acks,
    bucket_counts,
    enqueue,
    inspect_tasks,
    recover_stale,
    requeue,
)

catalog = Catalog()

RUN = {
    "run_id": "run-1",
    "pipeline_version": "p1",
    "strategy": "auto",
    "executor": "spark",
}
WALL_MS = 90_000

COUNTS_SQL = f"""SELECT count(*) AS total, count(*) FILTER (outcome = 'success') AS success,
 count(*) FILTER (outcome = 'failed') AS failed,
 count(*) FILTER (outcome = 'skipped_unsupported') AS skipped_unsupported,
 count(*) FILTER (outcome = 'skipped_existing') AS skipped_existing FROM ({DOC_RESULTS_SQL})"""


@catalog.add("batch_counts", COUNTS_SQL)
def counts(spark: SparkSession, folder: str) -> DataFrame:
    return batch_counts(doc_results(spark, folder))


EXTENSION_SQL = f"SELECT extension, count(*) AS docs FROM ({DOC_RESULTS_SQL}) GROUP BY extension"


@catalog.add("counts_by_extension", EXTENSION_SQL)
def by_extension(spark: SparkSession, folder: str) -> DataFrame:
    return counts_by_extension(doc_results(spark, folder))


ERROR_CODE_SQL = f"""SELECT error_code, count(*) AS docs
FROM (SELECT error_code FROM ({DOC_RESULTS_SQL}) WHERE outcome IN ('failed', 'skipped_unsupported')
 UNION ALL SELECT shared_error_code FROM ({DOC_RESULTS_SQL})
 WHERE shared_error_code NOT IN ('not_failed', 'unknown')) WHERE error_code IS NOT NULL GROUP BY 1"""


@catalog.add("counts_by_error_code", ERROR_CODE_SQL)
def by_error_code(spark: SparkSession, folder: str) -> DataFrame:
    return counts_by_error_code(doc_results(spark, folder))


DELIVERY_SQL = f"""SELECT count(*) AS total, count(*) FILTER (ok) AS ok, count(*) FILTER (NOT ok) AS failed,
 count(*) FILTER (failure_retryability = 'retryable') AS failed_retryable,
 count(*) FILTER (failure_retryability = 'non_retryable') AS failed_non_retryable,
 count(*) FILTER (failure_retryability = 'unknown') AS failed_unknown
FROM ({DOC_RESULTS_SQL}) WHERE ok IS NOT NULL"""


@catalog.add("delivery_counts", DELIVERY_SQL)
def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    return delivery_counts(doc_results(spark, folder))


@catalog.add(
    "delivery_by_destination",
    f"""SELECT 'parent' AS level, destination, count(*) AS total, count(*) FILTER (ok) AS ok,
 count(*) FILTER (NOT ok) AS failed FROM ({DOC_RESULTS_SQL}) WHERE ok IS NOT NULL GROUP BY destination
UNION ALL SELECT 'child', destination, count(*), count(*) FILTER (ok), count(*) FILTER (NOT ok)
FROM ({RECEIPTS_SQL}) GROUP BY destination""",
)
def by_destination(spark: SparkSession, folder: str) -> DataFrame:
    parents = counts_by_destination(doc_results(spark, folder))
    children = counts_by_destination(receipts(spark, folder))
    return parents.withColumn("level", F.lit("parent")).unionByName(
        children.withColumn("level", F.lit("child"))
    )


KINDS_SQL = f"""SELECT destination, failure_kind, count(*) AS failures
FROM (SELECT destination, shared_failure_kind AS failure_kind FROM ({DOC_RESULTS_SQL})
  WHERE shared_failure_kind NOT IN ('not_failed', 'unknown')
 UNION ALL SELECT destination, failure_kind FROM ({RECEIPTS_SQL}) WHERE NOT ok AND failure_kind <> '')
GROUP BY 1, 2"""


@catalog.add("failure_kinds", KINDS_SQL)
def failure_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return failure_kinds_by_destination(doc_results(spark, folder), receipts(spark, folder))


def _stats_sql(column: str, source: str, where: str = "true") -> str:
    return (
        f"SELECT '{column}' AS stat_of, min({column}) AS min, max({column}) AS max, "
        f"CAST(sum({column}) // count({column}) AS BIGINT) AS avg, "
        f"CAST(quantile_disc({column}, 0.95) AS BIGINT) AS p95 FROM ({source}) WHERE {where}"
    )


DURATIONS_SQL = " UNION ALL ".join(
    [_stats_sql("duration_ms", DOC_RESULTS_SQL)]
    + [
        _stats_sql(c, DOC_RESULTS_SQL, "outcome = 'success'")
        for c in ("hash_ms", "partition_ms", "delivery_ms")
    ]
)


@catalog.add("report_durations", DURATIONS_SQL)
def durations(spark: SparkSession, folder: str) -> DataFrame:
    return report_durations(doc_results(spark, folder))


_CENTS = "SELECT CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, l_partkey AS part FROM lineitem"


@catalog.add(
    "duration_stats", _stats_sql("cents", _CENTS) + " UNION ALL " + _stats_sql("part", _CENTS)
)
def line_durations(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select(
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
        F.col("l_partkey").alias("part"),
    )
    return duration_stats(items, ["cents", "part"])


RETRY_SQL = f"""SELECT CAST(coalesce(sum(CASE WHEN attempts > 1 THEN attempts - 1 ELSE 0 END), 0) AS BIGINT)
  AS retry_attempts_total, count(*) FILTER (outcome = 'success' AND attempts > 1) AS retried_success,
 count(*) FILTER (outcome = 'failed' AND retryable) AS retryable_failed FROM ({DOC_RESULTS_SQL})"""


@catalog.add("retry_stats", RETRY_SQL)
def retries(spark: SparkSession, folder: str) -> DataFrame:
    return retry_stats(doc_results(spark, folder))


def report_of_orders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return batch_report(
        doc_results(spark, folder), RUN, WALL_MS, receipts(spark, folder)
    )


REPORT_SQL = f"""SELECT 'run-1' AS run_id, 'p1' AS pipeline_version, 'auto' AS strategy, 'spark' AS executor,
 CAST({WALL_MS} AS BIGINT) AS run_wall_ms, round(c.total / {WALL_MS} * 60000.0, 6) AS docs_per_min,
 c.total AS docs_total, c.success AS docs_success_total, c.failed AS docs_failed_total,
 c.skipped_existing + c.skipped_unsupported AS docs_skipped_total, c.skipped_existing,
 c.skipped_unsupported, d.total AS delivery_total, d.ok AS delivery_ok_total,
 d.failed AS delivery_failed_total, d.failed_retryable AS delivery_failed_retryable_total,
 d.failed_non_retryable AS delivery_failed_non_retryable_total,
 d.failed_unknown AS delivery_failed_unknown_total, l.n AS dlq_written_total,
 r.retry_attempts_total, r.retried_success, r.retryable_failed
FROM ({COUNTS_SQL}) c, ({DELIVERY_SQL}) d, ({RETRY_SQL}) r,
 (SELECT count(*) FILTER (dlq_written) AS n FROM ({DOC_RESULTS_SQL})) l"""


@catalog.add("batch_report", REPORT_SQL)
def report(spark: SparkSession, folder: str) -> DataFrame:
    row, _ = report_of_orders(spark, folder)
    return row.withColumn("docs_per_min", F.round("docs_per_min", 6))


_TRIO = "(SELECT unnest(['total', 'ok', 'failed']) AS n)"
_STAT_ROWS = "(SELECT unnest(['min', 'max', 'avg', 'p95']) AS n)"


def _trio_sql(section: str, source: str, where: str) -> str:
    return (
        f"SELECT '{section}' AS section, destination AS key, n AS subkey, CAST(CASE n WHEN 'total' "
        f"THEN count(*) WHEN 'ok' THEN count(*) FILTER (ok) ELSE count(*) FILTER (NOT ok) END AS BIGINT) "
        f"AS value FROM ({source}), {_TRIO} WHERE {where} GROUP BY destination, n"
    )


BREAKDOWN_SQL = f"""SELECT 'extension' AS section, extension AS key, CAST(NULL AS VARCHAR) AS subkey, docs AS value
 FROM ({EXTENSION_SQL})
UNION ALL SELECT 'error_code', error_code, NULL, docs FROM ({ERROR_CODE_SQL})
UNION ALL {_trio_sql('destination', DOC_RESULTS_SQL, 'ok IS NOT NULL')}
UNION ALL SELECT 'failure_kind', destination, failure_kind, failures FROM ({KINDS_SQL})
UNION ALL SELECT 'duration', stat_of, n, CASE n WHEN 'min' THEN min WHEN 'max' THEN max
  WHEN 'avg' THEN avg ELSE p95 END FROM ({DURATIONS_SQL}), {_STAT_ROWS}
UNION ALL {_trio_sql('fanout_child', RECEIPTS_SQL, 'true')}"""


@catalog.add("batch_breakdown", BREAKDOWN_SQL)
def breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return report_of_orders(spark, folder)[1]


_BASE = '"backend_kind":"local"'
_TAIL = '"executor":"spark","pipeline_version":"p1"'
_GAUGES = (
    "docs_total",
    "docs_success_total",
    "docs_failed_total",
    "docs_skipped_total",
    "delivery_total",
    "delivery_ok_total",
    "delivery_failed_total",
    "delivery_failed_retryable_total",
    "delivery_failed_non_retryable_total",
    "delivery_failed_unknown_total",
    "dlq_written_total",
)
_TOTALS_SQL = " UNION ALL ".join(
    f"SELECT 'ingest_run_{g}' AS name, '{{{_BASE},{_TAIL},\"strategy\":\"auto\"}}' AS labels, "
    f"CAST({g} AS DOUBLE) AS value FROM ({REPORT_SQL})"
    for g in _GAUGES
)


@catalog.add(
    "metric_rows",
    f"""WITH b AS ({BREAKDOWN_SQL})
SELECT name, labels, round(value, 6) AS value FROM ({_TOTALS_SQL}
UNION ALL SELECT 'ingest_run_info', '{{{_BASE},{_TAIL},"strategy":"auto"}}', 1.0
UNION ALL SELECT 'ingest_run_wall_seconds', '{{{_BASE},{_TAIL},"strategy":"auto"}}', {WALL_MS / 1000}
UNION ALL SELECT 'ingest_run_docs_per_minute', '{{{_BASE},{_TAIL},"strategy":"auto"}}', docs_per_min
 FROM ({REPORT_SQL})
UNION ALL SELECT 'ingest_run_delivery_' || subkey || '_total', '{{{_BASE},"destination":"' || key ||
 '",{_TAIL},"strategy":"auto"}}', value FROM b WHERE section = 'destination' AND subkey <> 'total' AND value > 0
UNION ALL SELECT 'ingest_run_delivery_failure_kind_total', '{{{_BASE},"destination":"' || key ||
 '","executor":"spark","failure_kind":"' || subkey || '","pipeline_version":"p1","strategy":"auto"}}', value
 FROM b WHERE section = 'failure_kind'
UNION ALL SELECT 'ingest_run_doc_duration_seconds', '{{{_BASE},{_TAIL},"stat":"' || subkey ||
 '","strategy":"auto"}}', value / 1000.0 FROM b WHERE section = 'duration' AND key = 'duration_ms'
UNION ALL SELECT 'ingest_run_stage_duration_seconds', '{{{_BASE},{_TAIL},"stage":"' || replace(key, '_ms', '') ||
 '","stat":"' || subkey || '","strategy":"auto"}}', value / 1000.0 FROM b
 WHERE section = 'duration' AND key <> 'duration_ms')""",
)
def metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = metric_rows(*report_of_orders(spark, folder), RUN, backend_kind="local")
    return rows.withColumn("value", F.round("value", 6))


def _flat_usage(usage: DataFrame) -> DataFrame:
    """All columns, lists as texts and the domains side by side."""
    lists = [c for c, kind in usage.dtypes if kind == "array<string>"]
    domains = F.col("capability_domains_used")
    return usage.withColumns(
        {
            **{c: F.array_join(c, "|") for c in lists},
            **{c: domains[c] for c in ("base", "pro", "extra")},
            "evidence": F.array_join(domains["evidence"], "|"),
        }
    ).drop("capability_domains_used")


@catalog.add(
    "usage_batch",
    f"""SELECT CAST(1 AS INTEGER) AS schema_version, 'raw_technical_usage_batch_summary_v1' AS record_kind,
 true AS non_billing, true AS base, false AS pro, false AS extra, 'batch report aggregate' AS evidence,
 'aggregate_from_task_records_and_batch_report' AS source_linkage_scope,
 'billing|pricing|license entitlement|subscription allowance|quota decision|distributed runtime evidence'
  AS not_claimed, run_id, pipeline_version, docs_total, docs_success_total AS docs_success,
 docs_failed_total AS docs_failed, docs_skipped_total AS docs_skipped, delivery_total,
 delivery_ok_total AS delivery_ok, delivery_failed_total AS delivery_failed,
 CASE WHEN docs_total = 0 THEN 'empty' WHEN docs_failed_total > 0 OR delivery_failed_total > 0
  THEN 'partial' ELSE 'succeeded' END AS status,
 CASE WHEN docs_total > 0 AND (docs_failed_total > 0 OR delivery_failed_total > 0) THEN 'batch'
  ELSE 'none' END AS failure_stage FROM ({REPORT_SQL})""",
)
def usage_of_batch(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_usage(usage_batch(report_of_orders(spark, folder)[0]))


SOURCES = ("s3", "kafka", "local_file", "postgresql", "http")
_DOC_LINK = ("s3_document_v1", None, None, None, "http_document_v1")
_RECORD_LINK = (None, "kafka_partition_offset_v1", None, "postgresql_incremental_v1", None)
ORIGINS = ("intake", "resume", "requeue", "redrive", None)


@catalog.add(
    "usage_records",
    f"""SELECT CAST(1 AS INTEGER) AS schema_version, 'raw_technical_usage_fact_v1' AS record_kind,
 true AS non_billing, true AS base, false AS pro, false AS extra,
 concat_ws('|', 'task.kind=' || CASE WHEN doc % 2 = 0 THEN 'uns' ELSE 'it' END,
  'current retained source/destination surface=base', 'source_contract_id=' || CASE WHEN doc % 2 = 0
   THEN {sql_pick(_DOC_LINK, 'doc % 5')} ELSE {sql_pick(_RECORD_LINK, 'doc % 5')} END) AS evidence,
 CASE WHEN doc % 2 = 0 THEN 'elements_count|normalized_text_len' ELSE 'duration_ms|attempts' END
  AS derivative_metrics,
 CASE WHEN doc % 2 = 0 THEN 'page|delivery_success' ELSE 'delivery_success|checkpoint' END AS not_primary_units,
 'billing|pricing|license entitlement|subscription allowance|quota decision|page is a universal raw unit|'
  || 'distributed runtime evidence' AS not_claimed,
 'run-1' AS run_id, 'p1' AS pipeline_version, '{{"task":' || doc || '}}' AS task_identity_key,
 CASE WHEN doc % 4 = 0 THEN 'c' || doc END AS checkpoint_identity_key,
 CASE WHEN doc % 2 = 0 THEN 'stable_current' ELSE 'bounded_not_fully_first_class' END AS maturity,
 {sql_pick(SOURCES, 'doc % 5')} AS task_document_source,
 CASE WHEN CASE WHEN doc % 2 = 0 THEN {sql_pick(_DOC_LINK, 'doc % 5')}
  ELSE {sql_pick(_RECORD_LINK, 'doc % 5')} END IS NULL THEN 'flow_family_only' ELSE 'linked' END
  AS source_contract_status,
 CASE WHEN doc % 2 = 0 THEN 'document_selection' ELSE 'structured_emitted_item' END AS raw_unit_relation,
 outcome AS run_outcome, delivery_outcome, {sql_pick(ORIGINS, 'doc % 5')} AS run_origin,
 CASE WHEN doc % 3 = 0 THEN 'replay' ELSE 'primary' END AS delivery_origin, 'batch' AS execution_mode,
 'task-' || doc AS task_id, CASE WHEN doc % 2 = 0 THEN 'uns' ELSE 'it' END AS flow_kind,
 CASE WHEN doc % 2 = 0 THEN 'document' ELSE 'record_or_emitted_item' END AS primary_raw_unit,
 CASE WHEN doc % 2 = 0 THEN {sql_pick(_DOC_LINK, 'doc % 5')} ELSE {sql_pick(_RECORD_LINK, 'doc % 5')} END
  AS source_contract_id,
 CASE WHEN outcome = 'success' AND coalesce(ok, true) THEN 'succeeded' WHEN outcome = 'failed' THEN 'failed'
  WHEN outcome = 'skipped_unsupported' THEN 'skipped' WHEN NOT ok THEN 'failed' ELSE 'unknown' END AS status,
 CASE WHEN NOT ok THEN 'delivery' WHEN error_code IS NOT NULL THEN 'run' ELSE 'none' END AS failure_stage,
 CASE WHEN NOT ok THEN shared_error_code ELSE error_code END AS error_code,
 shared_failure_kind AS failure_kind, failure_retryability,
 CASE WHEN doc % 5 IN (1, 2, 3) THEN {sql_pick(ORIGINS, 'doc % 5')} WHEN doc % 3 = 0 THEN 'replay'
  ELSE 'primary' END AS recovery_kind FROM ({DOC_RESULTS_SQL})""",
)
def usage(spark: SparkSession, folder: str) -> DataFrame:
    done = doc_results(spark, folder)
    doc = F.col("doc")
    task = F.concat(F.lit("task-"), doc.cast("string")).alias("task_id")
    tasks = done.select(
        task,
        F.when(doc % 2 == 0, "uns").otherwise("it").alias("kind"),
        pick(SOURCES, doc % 5).alias("source"),
        F.lit(None).cast("string").alias("source_contract_id"),
    )
    meta = done.select(
        task,
        F.lit("run-1").alias("run_id"),
        F.lit("p1").alias("pipeline_version"),
        F.concat(F.lit('{"task":'), doc.cast("string"), F.lit("}")).alias("task_identity_key"),
        F.when(doc % 4 == 0, F.concat(F.lit("c"), doc.cast("string"))).alias(
            "checkpoint_identity_key"
        ),
        "outcome",
        F.col("error_code").alias("run_error_code"),
        pick(ORIGINS, doc % 5).alias("run_origin"),
        F.when(doc % 3 == 0, "replay").otherwise("primary").alias("delivery_origin"),
        F.lit("batch").alias("execution_mode"),
    )
    delivered = done.filter(F.col("ok").isNotNull()).select(
        task,
        "ok",
        "delivery_outcome",
        "failure_retryability",
        "shared_failure_kind",
        "shared_error_code",
    )
    return _flat_usage(usage_records(tasks, meta, delivered))


@catalog.add(
    "build_dlq",
    f"""SELECT r.sha256 || '__run-1__' || regexp_replace(trim(r.destination || ' / ' || r.attempts),
  '[^A-Za-z0-9_.\\-]+', '_', 'g') AS name, 'pending' AS state, r.sha256, 'run-1' AS run_id,
 'p1' AS pipeline_version, '2026-01-01T00:00:00Z' AS timestamp_utc, CAST(3 AS INTEGER) AS run_schema_version,
 m.o_orderstatus AS outcome, r.destination || ' / ' || r.attempts AS destination, false AS ok,
 CASE WHEN r.failure_kind IS NULL THEN '{{}}' ELSE '{{"failure_kind":"' || r.failure_kind || '"}}' END AS details,
 '{{"order":' || m.o_orderkey || '}}' AS run_meta, '2026-01-01T00:00:00Z' AS written_at_utc
FROM ({RECEIPTS_SQL}) r JOIN orders m ON m.o_orderkey = r.doc WHERE NOT r.ok""",
)
def new_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Failed line deliveries with the run metadata of their order."""
    failed = receipts(spark, folder).select(
        "sha256",
        F.lit("run-1").alias("run_id"),
        F.concat("destination", F.lit(" / "), F.col("attempts").cast("string")).alias(
            "destination"
        ),
        "ok",
        F.to_json(F.struct("failure_kind")).alias("details"),
    )
    runs = table(spark, folder, "orders").select(
        identity.sha256_of(F.col("o_orderkey").cast("string")).alias("sha256"),
        F.lit("run-1").alias("run_id"),
        F.lit("p1").alias("pipeline_version"),
        F.lit("2026-01-01T00:00:00Z").alias("timestamp_utc"),
        F.lit(3).alias("run_schema_version"),
        F.col("o_orderstatus").alias("outcome"),
        F.concat(F.lit('{"order":'), F.col("o_orderkey").cast("string"), F.lit("}")).alias("run_meta"),
    )
    letters = build_dlq(runs, failed, F.lit("2026-01-01T00:00:00Z"))
    return letters.withColumns(
        {c: F.col("destination_receipt")[c] for c in ("ok", "details")}
    ).drop("destination_receipt")


PRUNE = {
    "older_than_days": 900,
    "now_epoch_s": int(NOW),
    "include_pending": True,
    "include_done": True,
    "max_total_mb": 500,
    "keep_last": 40,
    "keep_last_per_destination": True,
    "apply": True,
}
_THRESHOLD = PRUNE["now_epoch_s"] - PRUNE["older_than_days"] * 86_400
_LIMIT = PRUNE["max_total_mb"] * 1024 * 1024
PRUNED_SQL = f"""WITH d AS (SELECT *, CASE WHEN state = 'pending' THEN 0 ELSE 1 END AS o
  FROM ({DEAD_LETTERS_SQL})),
 p AS (SELECT *, row_number() OVER (PARTITION BY destination ORDER BY mtime_s DESC, o, name) <= {PRUNE['keep_last']}
  AS protected FROM d),
 a AS (SELECT *, NOT protected AND mtime_s < {_THRESHOLD} AS by_age FROM p),
 n AS (SELECT sum(size_bytes) - {_LIMIT} - coalesce(sum(size_bytes) FILTER (by_age), 0) AS need FROM a),
 c AS (SELECT *, coalesce(sum(CASE WHEN NOT protected AND NOT by_age THEN size_bytes ELSE 0 END)
  OVER (ORDER BY mtime_s, o, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM a),
 s AS (SELECT *, NOT protected AND NOT by_age AND before < (SELECT need FROM n) AS by_size FROM c)"""


@catalog.add(
    "prune_dlq",
    PRUNED_SQL
    + """ SELECT name, state, protected, by_age, by_size, by_age OR by_size AS selected,
 CASE WHEN by_age OR by_size THEN 'pruned' ELSE state END AS new_state FROM s""",
)
def prune(spark: SparkSession, folder: str) -> DataFrame:
    return prune_dlq(dead_letters(spark, folder), **PRUNE)[0].select(
        "name", "state", "protected", "by_age", "by_size", "selected", "new_state"
    )


@catalog.add(
    "prune_stats",
    PRUNED_SQL
    + f""" SELECT CAST(sum(size_bytes) AS BIGINT) AS total_bytes,
 CAST(CASE WHEN sum(size_bytes) > {_LIMIT} THEN sum(size_bytes) - {_LIMIT} END AS BIGINT) AS bytes_over_limit,
 count(*) AS scanned, count(*) FILTER (by_age OR by_size) AS selected,
 count(*) FILTER (by_age OR by_size) AS moved,
 count(*) FILTER (NOT by_age AND NOT by_size AND NOT protected) AS skipped,
 CAST(sum(size_bytes) FILTER (by_age OR by_size) AS BIGINT) AS selected_bytes,
 count(*) FILTER (by_age) AS selected_by_age, count(*) FILTER (by_size) AS selected_by_size,
 count(*) FILTER (protected) AS protected,
 count(*) FILTER ((by_age OR by_size) AND state = 'pending') AS selected_pending,
 count(*) FILTER ((by_age OR by_size) AND state = 'done') AS selected_done,
 count(*) FILTER ((by_age OR by_size) AND state = 'pending') AS moved_pending,
 count(*) FILTER ((by_age OR by_size) AND state = 'done') AS moved_done,
 CAST({int(NOW)} AS BIGINT) AS now_epoch_s, CAST(900 AS BIGINT) AS older_than_days,
 CAST({int(NOW) - 900 * 86400} AS BIGINT) AS threshold_epoch_s, true AS include_pending, true AS include_done,
 true AS apply, CAST(500 AS BIGINT) AS max_total_mb, CAST(40 AS BIGINT) AS keep_last,
 true AS keep_last_per_destination, CAST(500 * 1024 * 1024 AS BIGINT) AS max_total_bytes FROM s""",
)
def prune_totals(spark: SparkSession, folder: str) -> DataFrame:
    return prune_dlq(dead_letters(spark, folder), **PRUNE)[1]


@catalog.add(
    "prune_keep_newest",
    f"""SELECT count(*) AS scanned, count(*) FILTER (rn > 250 AND mtime_s < {_THRESHOLD}) AS selected,
 count(*) FILTER (rn <= 250) AS protected
FROM (SELECT mtime_s, row_number() OVER (ORDER BY mtime_s DESC, name) AS rn FROM ({DEAD_LETTERS_SQL})
 WHERE state = 'done')""",
)
def prune_globally(spark: SparkSession, folder: str) -> DataFrame:
    stats = prune_dlq(
        dead_letters(spark, folder), PRUNE["older_than_days"], int(NOW), keep_last=250
    )[1]
    return stats.select("scanned", "selected", "protected")


REPLAY_SQL = f"""SELECT name, run_id IS NOT NULL AND has_meta AS valid,
 CASE WHEN run_id IS NOT NULL AND has_meta THEN sha256 || ':' || run_id END AS delivery_identity,
 CASE WHEN run_id IS NOT NULL AND has_meta THEN '{{"engine":{{"name":"builtin"}},"provenance":' ||
  '{{"delivery_origin":"replay","execution_mode":"batch",' ||
  CASE WHEN origin <> 'elsewhere' THEN '"run_origin":"' || origin || '",' ELSE '' END ||
  '"task_id":"t' || doc || '"}},"run_id":"run-1"}}' END AS run_meta, doc
FROM ({DEAD_LETTERS_SQL}) WHERE state = 'pending'"""


@catalog.add(
    "replay_select",
    f"SELECT name, valid, delivery_identity, run_meta FROM ({REPLAY_SQL}) ORDER BY name LIMIT 500",
)
def replayable(spark: SparkSession, folder: str) -> DataFrame:
    """The limit is the replay's own top-k option."""
    return replay_select(dead_letters(spark, folder), 500).select(
        "name", "valid", "delivery_identity", "run_meta"
    )


@catalog.add("replay_select_all", f"SELECT name, valid, delivery_identity, run_meta FROM ({REPLAY_SQL})")
def replayable_all(spark: SparkSession, folder: str) -> DataFrame:
    return replay_select(dead_letters(spark, folder)).select(
        "name", "valid", "delivery_identity", "run_meta"
    )


def _replayed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    store = dead_letters(spark, folder)
    chosen = replay_select(store)
    sent = chosen.filter("valid").select("name", (F.col("doc") % 4 > 0).alias("ok"))
    return replay_apply(store, chosen, sent)


@catalog.add(
    "replay_apply",
    f"""SELECT l.name, CASE WHEN r.valid AND r.doc % 4 > 0 THEN 'done' ELSE l.state END AS state
FROM ({DEAD_LETTERS_SQL}) l LEFT JOIN ({REPLAY_SQL}) r ON l.name = r.name AND l.state = 'pending'""",
)
def replayed(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(spark, folder)[0].select("name", "state")


@catalog.add(
    "replay_stats",
    f"""SELECT count(*) AS total, count(*) AS attempted, count(*) FILTER (valid AND doc % 4 > 0) AS succeeded,
 count(*) FILTER (NOT (valid AND doc % 4 > 0)) AS failed,
 count(*) FILTER (valid AND doc % 4 > 0) AS moved_to_done,
 CASE WHEN count(*) FILTER (NOT (valid AND doc % 4 > 0)) = 0 THEN 'succeeded' ELSE 'failed' END AS status
FROM ({REPLAY_SQL})""",
)
def replay_totals(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(spark, folder)[1]


LINE_FORMS = ('{"data":{"b":"x: y","a":1}}\n{"data":{}}', '{"data":[1]}', None, "oops")


@catalog.add(
    "replay_text",
    f"""SELECT doc_id, CASE WHEN has_text THEN CASE e WHEN 0 THEN text WHEN 1 THEN text END
  WHEN flow AND l = 0 THEN '{{"a": 1, "b": "x: y"}}' || chr(10) || '{{}}' END AS replay_text,
 CASE WHEN has_text THEN CASE e WHEN 0 THEN coalesce(n, 0) WHEN 1 THEN 0 END WHEN flow AND l = 0 THEN 2 END
  AS replay_count,
 CASE WHEN has_text THEN CASE e WHEN 2 THEN 'invalid_elements_json' WHEN 3 THEN 'missing_elements_json'
   WHEN 4 THEN 'invalid_elements_json' END
  WHEN NOT flow THEN 'missing_normalized_txt' WHEN l = 2 THEN 'missing_records_jsonl'
  WHEN l <> 0 THEN 'invalid_records_jsonl' END AS reason
FROM (SELECT doc_id, text, doc_id % 3 > 0 AS has_text, n_chars % 5 AS e, doc_id % 2 = 0 AS flow,
  (doc_id // 6) % 4 AS l, n FROM documents LEFT JOIN
  (SELECT doc_id, CAST(count(*) AS INTEGER) AS n FROM ({LINES_SQL}) GROUP BY doc_id) USING (doc_id))""",
)
def replay_texts(spark: SparkSession, folder: str) -> DataFrame:
    stored = table(spark, folder, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 3 > 0, F.col("text")).alias("normalized_text"),
        element_texts().alias("elements_json"),
        pick(LINE_FORMS, F.floor(F.col("doc_id") / 6) % 4).alias("record_lines"),
        (F.col("doc_id") % 2 == 0).alias("is_records"),
    )
    return replay_text(stored).select("doc_id", "replay_text", "replay_count", "reason")


def _new_tasks(spark: SparkSession, folder: str) -> DataFrame:
    """Tasks named after customers; every name comes twice."""
    c = table(spark, folder, "customer").select(
        "c_custkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("again")
    )
    name = F.concat(F.lit("task-"), (F.col("c_custkey") * 17).cast("string"))
    return c.select(
        name.alias("task_id"),
        F.lit("{}").alias("task_json"),
        (F.col("c_custkey") * 2 + F.col("again")).alias("seq"),
    )


@catalog.add(
    "enqueue",
    f"""WITH s AS ({TASK_STATE_SQL}) SELECT task_id, bucket, failure_count, created_at FROM s
UNION ALL SELECT 'task-' || (c_custkey * 17), 'pending', 0, {NOW} FROM customer
WHERE 'task-' || (c_custkey * 17) NOT IN (SELECT task_id FROM s)""",
)
def enqueued(spark: SparkSession, folder: str) -> DataFrame:
    after, _ = enqueue(task_state(spark, folder), _new_tasks(spark, folder), F.lit(NOW))
    return after.select("task_id", "bucket", "failure_count", "created_at")


@catalog.add(
    "enqueue_rejected",
    f"""WITH s AS ({TASK_STATE_SQL}) SELECT 'task-' || (c_custkey * 17) AS task_id, c_custkey * 2 + again AS seq
FROM customer, (SELECT unnest([0, 1]) AS again)
WHERE again = 1 OR 'task-' || (c_custkey * 17) IN (SELECT task_id FROM s)""",
)
def rejected(spark: SparkSession, folder: str) -> DataFrame:
    _, refused = enqueue(task_state(spark, folder), _new_tasks(spark, folder), F.lit(NOW))
    return refused.select("task_id", "seq")


_ACKED = """CASE WHEN bucket <> 'inflight' OR ack IS NULL THEN bucket WHEN ack = 'success' THEN 'done'
 WHEN ack = 'failure' AND failure_count + 1 >= 3 THEN 'poison'
 WHEN ack = 'orphan' AND orphan_count + 1 >= 2 THEN 'poison' ELSE 'pending' END AS bucket,
 CAST(failure_count + CASE WHEN bucket = 'inflight' AND ack = 'failure' THEN 1 ELSE 0 END AS INTEGER)
  AS failure_count,
 CAST(orphan_count + CASE WHEN bucket = 'inflight' AND ack = 'orphan' THEN 1 ELSE 0 END AS INTEGER)
  AS orphan_count, CASE WHEN bucket <> 'inflight' OR ack IS NULL THEN claimed_at END AS claimed_at"""
ACKS = ("success", "failure", "orphan")


@catalog.add(
    "apply_acks",
    f"""WITH k AS (SELECT l_orderkey, ['success', 'failure', 'orphan'][1 + CAST(min(l_partkey) % 3 AS INTEGER)]
  AS ack FROM lineitem GROUP BY 1)
SELECT task_id, {_ACKED} FROM ({TASK_STATE_SQL}) LEFT JOIN k ON o_orderkey = l_orderkey""",
)
def acknowledged(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of an order acknowledges its task; the lowest part comes first."""
    acks = table(spark, folder, "lineitem").select(
        F.concat(F.lit("task-"), F.col("l_orderkey").cast("string")).alias("task_id"),
        F.col("l_partkey").alias("at"),
        pick(ACKS, F.col("l_partkey") % 3).alias("ack"),
    )
    return apply_acks(task_state(spark, folder), acks, F.lit(NOW)).select(
        "task_id", "bucket", "failure_count", "orphan_count", "claimed_at"
    )


_STALE_NOW = 900_000_000.0


@catalog.add(
    "recover_stale",
    f"""SELECT task_id, {_ACKED} FROM (SELECT *, CASE WHEN claimed_at <= {_STALE_NOW} - 3600 THEN 'orphan' END
 AS ack FROM ({TASK_STATE_SQL}))""",
)
def recovered(spark: SparkSession, folder: str) -> DataFrame:
    return recover_stale(task_state(spark, folder), 3600, _STALE_NOW).select(
        "task_id", "bucket", "failure_count", "orphan_count", "claimed_at"
    )


def _wanted(spark: SparkSession, folder: str) -> DataFrame:
    """Each customer asks twice for one task, from a bucket it may not be in."""
    asked = table(spark, folder, "customer").select(
        F.concat(F.lit("task-"), (F.col("c_custkey") * 11).cast("string")).alias("task_id"),
        pick(("poison", "inflight", "done"), F.col("c_custkey") % 3).alias("source_bucket"),
    )
    return asked.union(asked)


_WANTED_SQL = f"""SELECT 'task-' || (c_custkey * 11) AS task_id,
 {sql_pick(('poison', 'inflight', 'done'), 'c_custkey % 3')} AS source_bucket FROM customer"""


@catalog.add(
    "requeue",
    f"""SELECT s.task_id, CASE WHEN hit THEN 'pending' ELSE bucket END AS bucket,
 CASE WHEN NOT hit THEN claimed_at END AS claimed_at, CASE WHEN hit THEN {NOW} ELSE updated_at END AS updated_at,
 CASE WHEN hit THEN source_bucket END AS last_requeued_from
FROM (SELECT s.*, source_bucket, coalesce(source_bucket IN ('poison', 'inflight') AND bucket = source_bucket, false)
  AS hit FROM ({TASK_STATE_SQL}) s LEFT JOIN ({_WANTED_SQL}) w ON s.task_id = w.task_id) s""",
)
def requeued(spark: SparkSession, folder: str) -> DataFrame:
    after, _ = requeue(task_state(spark, folder), _wanted(spark, folder), F.lit(NOW))
    return after.select(
        "task_id",
        "bucket",
        "claimed_at",
        "updated_at",
        F.get("provenance", F.lit(0))["source_bucket"].alias("last_requeued_from"),
    )


@catalog.add(
    "requeue_results",
    f"""SELECT w.task_id, w.source_bucket, CASE
  WHEN w.source_bucket NOT IN ('poison', 'inflight') THEN 'source_bucket_not_recoverable'
  WHEN s.bucket = w.source_bucket THEN 'moved_to_pending' ELSE 'task_not_found_in_source_bucket' END AS result,
 s.failure_count, s.orphan_count, CASE WHEN s.task_id IS NOT NULL THEN 'uns' END AS kind,
 CAST({NOW} AS DOUBLE) AS recorded_at, CASE WHEN s.o_custkey % 3 > 0
  THEN '{{"kind":"uns","pipeline_version":"p1","sha256":"x"}}' END AS task_identity_key,
 CASE WHEN s.o_custkey % 2 = 0 THEN 's3_document_v1' END AS source_contract_id,
 'requeue' AS action, 'persisted_in_history' AS audit_support
FROM ({_WANTED_SQL}) w LEFT JOIN ({TASK_STATE_SQL}) s ON s.task_id = w.task_id""",
)
def requeue_answers(spark: SparkSession, folder: str) -> DataFrame:
    _, answers = requeue(task_state(spark, folder), _wanted(spark, folder), F.lit(NOW))
    return answers


_BUCKETS_SQL = ", ".join(
    f"count(*) FILTER (bucket = '{b}') AS {b}"
    for b in ("pending", "inflight", "done", "failed", "poison")
)


@catalog.add("bucket_counts", f"SELECT {_BUCKETS_SQL} FROM ({TASK_STATE_SQL})")
def buckets(spark: SparkSession, folder: str) -> DataFrame:
    return bucket_counts(task_state(spark, folder))


_INSPECTED_SQL = f"""SELECT task_id, CASE WHEN orphan_count > 0 THEN 'orphaned' ELSE '' END AS governance_labels,
 CASE WHEN orphan_count > 0 THEN 'orphaned' ELSE 'attempts_exhausted' END AS poison_kind,
 CASE WHEN orphan_count > 0 THEN 'poison_orphaned' ELSE 'poison_attempts_exhausted' END AS governance_problem,
 'requeue_supported' AS handling_expectation,
 'operator_requeue_supported_after_attempt_or_orphan_threshold' AS state_explanation
FROM ({TASK_STATE_SQL}) WHERE bucket = 'poison'"""


def _inspected(spark: SparkSession, folder: str, limit: int | None) -> DataFrame:
    return inspect_tasks(task_state(spark, folder), "poison", limit)[0].select(
        "task_id",
        F.array_join("governance_labels", ",").alias("governance_labels"),
        "poison_kind",
        "governance_problem",
        "handling_expectation",
        "state_explanation",
    )


@catalog.add("inspect_tasks", f"{_INSPECTED_SQL} ORDER BY updated_at, task_id LIMIT 200")
def inspected(spark: SparkSession, folder: str) -> DataFrame:
    """The limit is the inspection's own top-k option."""
    return _inspected(spark, folder, 200)


@catalog.add("inspect_tasks_all", _INSPECTED_SQL)
def inspected_all(spark: SparkSession, folder: str) -> DataFrame:
    return _inspected(spark, folder, None)


@catalog.add(
    "inspect_summary",
    f"""SELECT {_BUCKETS_SQL}, count(*) FILTER (bucket = 'inflight') AS listed_tasks,
 count(*) FILTER (bucket = 'inflight' AND orphan_count > 0) AS governance_problem_tasks,
 CASE WHEN count(*) FILTER (bucket = 'inflight') = 0 THEN 'none' ELSE 'result_only' END
  AS recovery_audit_support FROM ({TASK_STATE_SQL})""",
)
def inspection(spark: SparkSession, folder: str) -> DataFrame:
    return inspect_tasks(task_state(spark, folder), "inflight")[1].drop(
        "visible_requeue_history_tasks"
    )


@catalog.add(
    "governance_receipts",
    f"""SELECT CAST(1 AS INTEGER) AS schema_version, 'governance_action_receipt_v1' AS record_kind,
 'gov-' || task_id AS action_id, 'requeue' AS action_kind, 'state_changing' AS action_category,
 '2026-01-01T00:00:00Z' AS recorded_at_utc, 'succeeded' AS status, 'persisted_receipt' AS audit_support,
 'local_artifact' AS persistence_scope, 'requeue' AS recovery_kind, task_id,
 'queue_bucket=' || bucket || CASE WHEN claimed_at IS NOT NULL THEN '|claim=' || task_id ELSE '' END
  AS evidence_refs, '{{"failure_count":' || failure_count || '}}' AS result_summary,
 'billing|pricing|license entitlement|RBAC approval workflow|multi-operator collaboration platform|'
  || 'distributed governance platform' AS not_claimed FROM ({TASK_STATE_SQL})""",
)
def action_receipts(spark: SparkSession, folder: str) -> DataFrame:
    """Every task has its bucket as evidence, and its claim where it has one."""
    bucket = F.struct(F.lit("queue_bucket").alias("kind"), F.col("bucket").alias("ref"))
    claim = F.struct(F.lit("claim").alias("kind"), F.col("task_id").alias("ref"))
    actions = task_state(spark, folder).select(
        F.concat(F.lit("gov-"), "task_id").alias("action_id"),
        F.lit("requeue").alias("action_kind"),
        F.lit("state_changing").alias("action_category"),
        F.lit("2026-01-01T00:00:00Z").alias("recorded_at_utc"),
        F.lit("succeeded").alias("status"),
        F.lit("persisted_receipt").alias("audit_support"),
        F.lit("requeue").alias("recovery_kind"),
        "task_id",
        F.when(F.col("claimed_at").isNotNull(), F.array(bucket, claim))
        .otherwise(F.array(bucket))
        .alias("evidence_refs"),
        F.to_json(F.struct("failure_count")).alias("result_summary"),
    )
    refs = F.transform("evidence_refs", lambda r: F.concat_ws("=", r["kind"], r["ref"]))
    return (
        governance_receipts(actions)
        .withColumn("task_id", F.col("linkage.task_id"))
        .withColumn("evidence_refs", F.array_join(refs, "|"))
        .withColumn("not_claimed", F.array_join("not_claimed", "|"))
        .drop("linkage")
    )


def _evidence(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    expected = table(spark, folder, "documents").select(
        "source", F.col("doc_id").alias("evidence_ref")
    )
    present = table(spark, folder, "labels").select(F.col("doc_id").alias("evidence_ref"))
    return expected, present


@catalog.add(
    "missing_evidence",
    "SELECT source, doc_id AS evidence_ref FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def missing(spark: SparkSession, folder: str) -> DataFrame:
    return verify_evidence(*_evidence(spark, folder), ["source"])[0]


@catalog.add(
    "verify_evidence",
    """SELECT source, count(*) AS checked_evidence_count, count(*) FILTER (miss) AS missing_evidence_count,
 CASE WHEN bool_or(miss) THEN 'failed' ELSE 'passed' END AS verification_result,
 CASE WHEN bool_or(miss) THEN 'failed' ELSE 'succeeded' END AS status
FROM (SELECT source, doc_id NOT IN (SELECT doc_id FROM labels) AS miss FROM documents) GROUP BY source""",
)
def verified(spark: SparkSession, folder: str) -> DataFrame:
    return verify_evidence(*_evidence(spark, folder), ["source"])[1]


EVIDENCE_FORMS = (
    ('{"action":"requeue","task_id":"~","source_contract_id":5}', "requeue", None),
    (
        '{"run_id":"~","run_meta":{"provenance":{"delivery_origin":"replay","task_id":"~"}}}',
        "replay_delivery",
        None,
    ),
    ('{"action":"requeue","task_id":7}', None, "no_supported_requeue_or_replay_evidence"),
    ('{"run_id":3,"run_meta":{}}', None, "no_supported_requeue_or_replay_evidence"),
    ('["~"]', None, "missing_or_non_object_json"),
    (None, None, "missing_or_non_object_json"),
)


@catalog.add(
    "backfill_governance",
    f"""SELECT o_orderkey AS evidence_ref, CASE WHEN k IS NULL THEN 'insufficient_evidence' ELSE 'receipt_written' END
  AS backfill_status, k AS action_kind, {sql_pick([e[2] for e in EVIDENCE_FORMS], 'o_orderkey % 6')} AS reason,
 CASE WHEN k IS NOT NULL THEN 'o' || o_orderkey END AS task_id,
 CASE WHEN k = 'replay_delivery' THEN 'o' || o_orderkey END AS run_id
FROM (SELECT o_orderkey, {sql_pick([e[1] for e in EVIDENCE_FORMS], 'o_orderkey % 6')} AS k FROM orders)""",
)
def backfilled(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    form = pick([e[0] for e in EVIDENCE_FORMS], F.col("o_orderkey") % 6)
    name = F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))
    evidence = o.select("o_orderkey", F.replace(form, F.lit("~"), name).alias("text"))
    return backfill_governance(evidence, "o_orderkey", "text").select(
        "evidence_ref", "backfill_status", "action_kind", "reason", "task_id", "run_id"
    )


@catalog.add(
    "audit_payloads",
    """WITH d AS (SELECT *, doc_id IN (SELECT doc_id FROM labels) AS found FROM documents)
SELECT doc_id, found AS delivery_locator_found, found AS delivery_payload_visible,
 CASE WHEN found AND doc_id % 7 = 0 THEN 'content_evidence_missing' ELSE '' END AS note,
 found AND doc_id % 7 > 0 AS content_evidence_found,
 CASE WHEN found AND doc_id % 7 > 0 THEN 'normalized_text_preview_v1' ELSE 'missing' END AS evidence_kind,
 found AND doc_id % 7 > 0 AND contains(text, lang) AS normalized_text_preview_found,
 found AND doc_id % 7 > 0 AS records_preview_found,
 found AND doc_id % 7 > 0 AND (contains(text, lang) OR doc_id % 2 = 1) AS token_pass,
 found AND doc_id % 7 > 0 AND doc_id % 5 > 0 AS delivery_payload_core_metadata_check,
 CASE WHEN doc_id % 2 = 0 THEN 'not_applicable' WHEN found THEN 'artifact_paths_only'
  ELSE 'not_checked' END AS structured_state_log_status FROM d""",
)
def audited(spark: SparkSession, folder: str) -> DataFrame:
    """Read back the payloads of labelled documents; some are empty or of another run."""
    docs = table(spark, folder, "documents").withColumn(
        "sha256", identity.sha256_of(F.col("text"))
    )
    key = F.col("doc_id")
    evidence = F.to_json(
        F.struct(
            F.lit("normalized_text_preview_v1").alias("evidence_kind"),
            F.col("text").alias("normalized_text_preview"),
            F.array(F.struct(F.col("lang").alias("code"))).alias("records_preview"),
        )
    )
    body = F.concat(
        F.lit('{"schema_version":1,"sha256":"'),
        "sha256",
        F.lit('","artifacts":{"state_path":"s","logs_path":"l"},"run_meta":{"run_id":"'),
        F.when(key % 5 > 0, "run-1").otherwise("run-0"),
        F.lit('","engine":{"name":"e"},"metrics":{},"provenance":{}},"content_evidence":'),
        F.when(key % 7 > 0, evidence).otherwise("null"),
        F.lit("}"),
    )
    labelled = table(spark, folder, "labels").select("doc_id")
    delivered = docs.select("doc_id", body.alias("payload_json")).join(
        labelled, "doc_id", "left_semi"
    )
    expected = docs.select(
        "doc_id",
        "sha256",
        F.lit("run-1").alias("run_id"),
        F.when(key % 2 == 0, "uns").otherwise("it").alias("flow"),
        F.col("lang").alias("token"),
    )
    return audit_payloads(delivered, expected, "token", on="doc_id")


@catalog.add(
    "audit_vectors",
    """SELECT doc_id, found AS delivery_locator_found, false AS delivery_payload_visible,
 'vector_object_holds_normalized_text' AS note, found AS content_evidence_found,
 'normalized_text_projection_v1' AS evidence_kind, found AND contains(text, lang) AS normalized_text_preview_found,
 false AS records_preview_found, found AND contains(text, lang) AS token_pass,
 false AS delivery_payload_core_metadata_check, 'not_checked' AS structured_state_log_status
FROM (SELECT *, doc_id IN (SELECT doc_id FROM labels) AS found FROM documents)""",
)
def audited_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Read back the vector objects of labelled documents."""
    docs = table(spark, folder, "documents")
    held = docs.join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    objects = held.select("doc_id", F.col("text").alias("normalized_text"))
    return audit_vectors(objects, docs.select("doc_id", F.col("lang").alias("token")), "token", "doc_id")


TERMS = (
    Term("the", "common", "note", ("packages",), "frequent"),
    Term("tion", "ending", "major", ("runtime",), "ending"),
    Term("license", "legal", "blocker", ("packages", "runtime"), "terms"),
    Term("Password", "secret", "blocker", ("connector",), "secret"),
    Term("@", "personal", "blocker", ("core_contract",), "address"),
)
FOLDERS = (
    "docs/",
    "packages/core/src/",
    "packages/x/src/sources/",
    "packages/x/src/",
    "tests/",
    "tools/scan_",
    "boundary/",
    "",
)
CONTEXT = ContextRules(
    boundary_prefixes=("boundary/",),
    tooling_prefixes=("tools/scan_",),
    core_prefixes=("packages/core/src/",),
)
_CONTEXTS = (
    "historical_doc",
    "core_contract",
    "connector",
    "runtime",
    "test_fixture",
    "tooling",
    "boundary_doc",
    "other",
)


def _scanned(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    place = pick(FOLDERS, F.col("doc_id") % len(FOLDERS))
    return d.select(
        F.concat(place, F.lit("d"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"),
        "text",
    )


def _sql_strings(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_TERM_ROWS = ", ".join(
    f"('{t.term}', '{t.category}', '{t.severity}', {_sql_strings(t.blocked_in)})" for t in TERMS
)
SCAN_SQL = f"""WITH f AS (SELECT {sql_pick(FOLDERS, f'doc_id % {len(FOLDERS)}')} || 'd' || doc_id || '.md' AS path,
  {sql_pick(_CONTEXTS, f'doc_id % {len(FOLDERS)}')} AS context_kind,
  string_split_regex(text, '\\r\\n|[\\n\\r]') AS l FROM documents),
 n AS (SELECT path, context_kind, l, unnest(range(1, len(l) + 1)) AS line FROM f),
 h AS (SELECT path, context_kind, line, term, category, severity, blocked, l[line] AS text,
  lower(array_to_string(l[greatest(line - 5, 1):line + 2], chr(10))) AS near
  FROM n, (VALUES {_TERM_ROWS}) t(term, category, severity, blocked)
  WHERE contains(lower(l[line]), lower(term))),
 m AS (SELECT *, len(list_filter({_sql_strings(NEGATIVE_MARKERS)}, lambda x: contains(near, x))) > 0 AS negative,
  CASE context_kind WHEN 'runtime' THEN ['packages', 'runtime']
   WHEN 'connector' THEN ['packages', 'runtime', 'connector']
   WHEN 'core_contract' THEN ['packages', 'core_contract'] ELSE [] END AS contexts FROM h),
 c AS (SELECT path, line, term, category, CASE context_kind WHEN 'boundary_doc' THEN 'allowed_boundary'
   WHEN 'tooling' THEN 'allowed_tooling' WHEN 'test_fixture' THEN 'allowed_fixture'
   ELSE CASE WHEN negative THEN CASE WHEN context_kind = 'historical_doc' THEN 'allowed_boundary'
     ELSE 'review_required' END
    WHEN list_has_any(contexts, blocked) THEN 'blocked' ELSE 'review_required' END END AS classification,
  severity, CASE term WHEN 'the' THEN 'frequent' WHEN 'tion' THEN 'ending' WHEN 'license' THEN 'terms'
   WHEN 'Password' THEN 'secret' ELSE 'address' END AS reason, context_kind,
  CASE context_kind WHEN 'test_fixture' THEN 'test_fixture' WHEN 'boundary_doc' THEN 'historical_text'
   WHEN 'historical_doc' THEN 'historical_text' WHEN 'tooling' THEN 'tooling'
   ELSE 'actual_runtime_candidate' END AS historical_or_fixture,
  CASE context_kind WHEN 'boundary_doc' THEN 'boundary-owner' WHEN 'historical_doc' THEN 'docs-owner'
   WHEN 'tooling' THEN 'tooling-owner' WHEN 'test_fixture' THEN 'test-owner'
   WHEN 'core_contract' THEN 'core-owner' WHEN 'connector' THEN 'connector-owner'
   WHEN 'runtime' THEN 'runtime-owner' ELSE 'repo-owner' END AS suggested_owner,
  trim(text) AS text FROM m)"""


@catalog.add("denylist_scan", SCAN_SQL + " SELECT * FROM c")
def denied(spark: SparkSession, folder: str) -> DataFrame:
    hits = denylist_scan(_scanned(spark, folder), TERMS, rules=CONTEXT)
    return hits.withColumn("line", F.col("line").cast("long"))


@catalog.add(
    "denylist_summary",
    SCAN_SQL
    + """ SELECT (SELECT count(*) FROM documents) AS scanned_files,
 count(*) FILTER (classification = 'allowed_boundary') AS allowed_boundary_hits,
 count(*) FILTER (classification = 'allowed_tooling') AS allowed_tooling_hits,
 count(*) FILTER (classification = 'allowed_fixture') AS allowed_fixture_hits,
 count(*) FILTER (classification = 'review_required') AS review_required_hits,
 count(*) FILTER (classification = 'blocked') AS blocked_hits,
 count(*) FILTER (classification = 'blocked' AND severity = 'blocker') AS blocker_count,
 CASE WHEN count(*) FILTER (classification = 'blocked' AND severity = 'blocker') > 0 THEN 'fail'
  ELSE 'pass' END AS overall FROM c""",
)
def denied_summary(spark: SparkSession, folder: str) -> DataFrame:
    files = _scanned(spark, folder)
    return scan_summary(denylist_scan(files, TERMS, rules=CONTEXT), files)


# Terms of a table: the words of the benchmark, and the denylist's own.
_TABLE_TERMS_SQL = f"""SELECT DISTINCT w AS term, 'word' AS category, 'minor' AS severity, ['runtime'] AS blocked
 FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]{{6,}}')) AS w FROM benchmark)
 UNION ALL SELECT * FROM (VALUES {_TERM_ROWS}) t(term, category, severity, blocked)"""


@catalog.add(
    "term_scan",
    SCAN_SQL.replace(f"(VALUES {_TERM_ROWS}) t(term, category, severity, blocked)", f"({_TABLE_TERMS_SQL}) t")
    + """ SELECT path, line, term, category, classification, severity, context_kind, historical_or_fixture,
 suggested_owner, sha256(text) AS text_sha256 FROM c""",
)
def table_terms(spark: SparkSession, folder: str) -> DataFrame:
    """The scan with every long word of the benchmark as a term, beside the denylist."""
    words = (
        table(spark, folder, "benchmark")
        .select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{6,}"), F.lit(0))).alias("term"))
        .distinct()
        .select(
            "term",
            F.lit("word").alias("category"),
            F.lit("minor").alias("severity"),
            F.lit("of the benchmark").alias("reason"),
            F.array(F.lit("runtime")).alias("blocked_in"),
        )
    )
    own = spark.createDataFrame(
        [(t.term, t.category, t.severity, t.reason, list(t.blocked_in)) for t in TERMS], words.schema
    )
    hits = term_scan(_scanned(spark, folder), words.unionByName(own), rules=CONTEXT)
    return hits.select(
        "path",
        F.col("line").cast("long").alias("line"),
        "term",
        "category",
        "classification",
        "severity",
        "context_kind",
        "historical_or_fixture",
        "suggested_owner",
        F.sha2("text", 256).alias("text_sha256"),
    )


IMPORT_RULES = (
    ImportRule("no-the", ("packages/*",), ("the ", "ion"), "blocker"),
    ImportRule("no-eau", ("tools/*", "docs/*"), ("Eau",), "major"),
)
FILE_KINDS = ("boundary", "package", "package", "package", "fixture", "tool", "boundary", "other")
_KIND_ROWS = "('no-the', 'the '), ('no-the', 'ion'), ('no-eau', 'Eau')"


@catalog.add(
    "import_scan",
    f"""WITH f AS (SELECT {sql_pick(FOLDERS, 'doc_id % 8')} || 'd' || doc_id || '.md' AS path,
  {sql_pick(FILE_KINDS, 'doc_id % 8')} AS kind, string_split_regex(text, '\\r\\n|[\\n\\r]') AS l FROM documents),
 n AS (SELECT path, kind, lower(unnest(l)) AS t, unnest(range(1, len(l) + 1)) AS line FROM f),
 h AS (SELECT *, regexp_matches(t, 'import |from |require\\(|package|dependency|module') AS imports,
  regexp_matches(t, 'must not|not |forbidden|boundary|draft|only|cannot') AS note
  FROM n, (VALUES {_KIND_ROWS}) r(rule_id, pattern) WHERE contains(t, lower(pattern))),
 c AS (SELECT path, line, pattern, rule_id, CASE
   WHEN NOT imports THEN CASE WHEN kind = 'boundary' AND note THEN 'allowed_boundary' END
   WHEN kind = 'boundary' THEN 'allowed_boundary' WHEN kind = 'fixture' THEN 'allowed_fixture'
   WHEN kind IN ('package', 'tool') AND (rule_id = 'no-the' AND starts_with(path, 'packages/')
    OR rule_id = 'no-eau' AND (starts_with(path, 'tools/') OR starts_with(path, 'docs/'))) THEN 'blocked'
   ELSE 'review_required' END AS classification FROM h)
SELECT * FROM c WHERE classification IS NOT NULL""",
)
def imports(spark: SparkSession, folder: str) -> DataFrame:
    files = _scanned(spark, folder)
    place = F.regexp_extract("path", "^(.*)d[0-9]+\\.md$", 1)
    kind = F.lit("other")
    for where, name in zip(FOLDERS, FILE_KINDS, strict=True):
        kind = F.when(place == where, name).otherwise(kind)
    return import_scan(files, IMPORT_RULES, kind).select(
        "path",
        F.col("line").cast("long").alias("line"),
        "pattern",
        "rule_id",
        "classification",
    )


PATH_RULES = (
    PathRule("blog", ("*blog.*",), True, "boundary_docs_only", "docs"),
    PathRule("insecure", ("http:*",), True, "nowhere", "security"),
    PathRule("paged", ("*[?]page=[0-9]*", "*.html"), False, "nowhere", "web"),
)
PATHS_SQL = """WITH r AS (SELECT url AS path, 'blog' AS rule_id, 'boundary_tooling' AS classification,
  true AS required_review, 'docs' AS owner_hint FROM pages WHERE regexp_matches(url, 'blog\\.')
 UNION ALL SELECT url, 'insecure', CASE WHEN starts_with(url, 'https:') THEN '' WHEN starts_with(url, 'http://m.')
   THEN 'blocked_runtime' ELSE 'review_required' END, true, 'security' FROM pages WHERE starts_with(url, 'http:')
 UNION ALL SELECT url, 'paged', CASE WHEN starts_with(url, 'http://m.') THEN 'blocked_runtime'
   ELSE 'review_required' END, false, 'web' FROM pages
  WHERE regexp_matches(url, '\\?page=[0-9]') OR regexp_matches(url, '\\.html$'))"""


def _path_hits(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return path_rule_scan(pages, PATH_RULES, "url", runtime_prefixes=("http://m.",))


@catalog.add("path_rule_scan", PATHS_SQL + " SELECT * FROM r")
def paths(spark: SparkSession, folder: str) -> DataFrame:
    return _path_hits(spark, folder).drop("allowed_scope")


# Rules of a table: what pages' urls begin with, end with and hold.
_TABLE_RULES_SQL = """SELECT 'b:' || p AS rule_id, p || '*' AS pattern FROM (SELECT DISTINCT substr(url, 1, 18) AS p FROM pages)
 UNION ALL SELECT 'e:' || e, '*' || e FROM (SELECT DISTINCT right(url, 5) AS e FROM pages)
 UNION ALL SELECT 'm:' || m, '*' || m || '?*' FROM (SELECT DISTINCT substr(url, 10, 5) AS m FROM pages)
 UNION ALL SELECT 'w:' || page_id, url FROM pages WHERE page_id % 3 = 0
 UNION ALL SELECT 'c:' || c, '*[' || c || ']' FROM (SELECT unnest(['0-4', '!0-9', 'a-f']) AS c)"""


@catalog.add(
    "rule_scan",
    f"""SELECT DISTINCT page_id, rule_id, CASE WHEN starts_with(rule_id, 'b:') THEN 'boundary_tooling'
 WHEN starts_with(url, 'http://m.') THEN 'blocked_runtime' ELSE 'review_required' END AS classification
FROM pages JOIN ({_TABLE_RULES_SQL}) r ON url GLOB pattern""",
)
def table_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Path rules made of the urls themselves, a few for every page."""
    pages = table(spark, folder, "pages").select("page_id", "url")

    def made(tag: str, value: str, pattern: str) -> DataFrame:
        found = pages.selectExpr(f"{value} AS v").distinct()
        return found.selectExpr(f"concat('{tag}:', v) AS rule_id", f"{pattern} AS pattern")

    whole = pages.filter("page_id % 3 = 0").selectExpr("concat('w:', page_id) AS rule_id", "url AS pattern")
    classes = spark.range(1).selectExpr("explode(array('0-4', '!0-9', 'a-f')) AS v").selectExpr(
        "concat('c:', v) AS rule_id", "concat('*[', v, ']') AS pattern"
    )
    rules = (
        made("b", "substr(url, 1, 18)", "concat(v, '*')")
        .union(made("e", "right(url, 5)", "concat('*', v)"))
        .union(made("m", "substr(url, 10, 5)", "concat('*', v, '?*')"))
        .union(whole)
        .union(classes)
        .select(
            "rule_id",
            F.array("pattern").alias("path_patterns"),
            F.lit(True).alias("required_review"),
            F.when(F.col("rule_id").startswith("b:"), "tooling_only").otherwise("nowhere").alias("allowed_scope"),
            F.lit("web").alias("owner_hint"),
        )
    )
    distinct = pages.select("url").distinct()
    found = rule_scan(distinct, rules, "url", runtime_prefixes=("http://m.",))
    return (
        found.join(pages, found["path"] == pages["url"])
        .select("page_id", "rule_id", "classification")
        .distinct()
    )


@catalog.add(
    "path_scan_summary",
    PATHS_SQL
    + """ SELECT (SELECT count(*) FROM pages) AS scanned_files,
 count(*) FILTER (classification = 'boundary_tooling') AS sensitive_boundary_paths,
 count(*) FILTER (classification <> 'boundary_tooling') AS sensitive_runtime_paths,
 count(*) FILTER (classification = 'blocked_runtime') AS blocked_runtime_paths,
 count(*) FILTER (classification = 'review_required') AS review_required_paths,
 CASE WHEN count(*) FILTER (classification = 'blocked_runtime') > 0 THEN 'fail' ELSE 'pass' END AS overall
FROM r""",
)
def paths_summary(spark: SparkSession, folder: str) -> DataFrame:
    return path_scan_summary(_path_hits(spark, folder), table(spark, folder, "pages"))
