"""Batch counts, durations, the batch report, its metrics and usage facts.

``doc_results`` has one row per document: ``extension``, ``outcome``,
``duration_ms``, ``attempts``, ``retryable``, ``error_code``, ``hash_ms``,
``partition_ms``, ``delivery_ms``, ``dlq_written`` and, when something was
delivered, the receipt columns of ``receipt_summary``; ``ok`` is null without a
receipt.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import jsontext as J
from millrace.session import stored
from millrace.sources.specs import contract_id

OUTCOMES = ("success", "failed", "skipped_unsupported", "skipped_existing")
DURATION_VALUES_PER_SLICE = 4096


def _known_outcome() -> Column:
    return F.col("outcome").isin("success", "skipped_unsupported", "skipped_existing")


def _count_columns() -> dict[str, Column]:
    return {
        "total": F.count(F.lit(1)),
        "success": F.count_if(F.col("outcome") == "success"),
        "failed": F.count_if(~_known_outcome()),
        "skipped_unsupported": F.count_if(F.col("outcome") == "skipped_unsupported"),
        "skipped_existing": F.count_if(F.col("outcome") == "skipped_existing"),
    }


def _delivery_columns() -> dict[str, Column]:
    ok, retry = F.col("ok"), F.col("failure_retryability")
    return {
        "total": F.count(ok),
        "ok": F.count_if(ok),
        "failed": F.count_if(~ok),
        "failed_retryable": F.count_if(~ok & (retry == "retryable")),
        "failed_non_retryable": F.count_if(~ok & (retry == "non_retryable")),
        "failed_unknown": F.count_if(~ok & ~retry.isin("retryable", "non_retryable")),
    }


def _retry_columns() -> dict[str, Column]:
    success, tried = F.col("outcome") == "success", F.col("outcome") != "skipped_existing"
    extra = F.when(tried & (F.col("attempts") > 1), F.col("attempts") - 1).otherwise(0)
    return {
        "retry_attempts_total": F.coalesce(F.sum(extra), F.lit(0)),
        "retried_success": F.count_if(success & (F.col("attempts") > 1)),
        "retryable_failed": F.count_if(
            ~_known_outcome() & F.coalesce("retryable", F.lit(False))
        ),
    }


def _aggregated(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.agg(*[c.alias(name) for name, c in columns.items()])


def batch_counts(doc_results: DataFrame) -> DataFrame:
    """One row: documents in total and by outcome; an unknown outcome is a failure."""
    return _aggregated(doc_results, _count_columns())


def counts_by_extension(doc_results: DataFrame) -> DataFrame:
    return doc_results.groupBy("extension").agg(F.count(F.lit(1)).alias("docs"))


def counts_by_error_code(doc_results: DataFrame) -> DataFrame:
    """Run codes and shared delivery codes, added up under one name."""
    run_code = F.when(
        ~F.col("outcome").isin("success", "skipped_existing") & (F.col("error_code") != ""),
        F.col("error_code"),
    )
    delivery_code = F.when(
        ~F.col("shared_error_code").isin("not_failed", "unknown"), F.col("shared_error_code")
    )
    codes = doc_results.select(F.explode(F.array(run_code, delivery_code)).alias("error_code"))
    return (
        codes.filter(F.col("error_code").isNotNull())
        .groupBy("error_code")
        .agg(F.count(F.lit(1)).alias("docs"))
    )


def delivery_counts(doc_results: DataFrame) -> DataFrame:
    """One row: deliveries in total, by result and by retryability."""
    return _aggregated(doc_results, _delivery_columns())


def counts_by_destination(receipts: DataFrame) -> DataFrame:
    """Total, ok and failed by destination, for parents or for fan-out children."""
    return receipts.filter(F.col("ok").isNotNull()).groupBy("destination").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("ok").alias("ok"),
        F.count_if(~F.col("ok")).alias("failed"),
    )


def failure_kinds_by_destination(
    doc_results: DataFrame, children: DataFrame | None = None
) -> DataFrame:
    """Failures by destination and kind.

    Receipts count under their shared kind, failed fan-out children under the
    kind they reported.
    """
    rows = doc_results.filter(
        F.col("ok").isNotNull() & ~F.col("shared_failure_kind").isin("not_failed", "unknown")
    ).select("destination", F.col("shared_failure_kind").alias("failure_kind"))
    if children is not None:
        rows = rows.unionByName(
            children.filter(~F.col("ok") & (F.col("failure_kind") != "")).select(
                "destination", "failure_kind"
            )
        )
    return rows.groupBy("destination", "failure_kind").agg(F.count(F.lit(1)).alias("failures"))


def duration_stats(durations: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum, whole-number mean and 95th percentile of integer columns.

    The percentile is the value at rank ``ceil(0.95 n)``.  Equal values are
    counted first, and written; ranks are then added up over slices of distinct values,
    so no task sees a whole column.  A column without values has one row of nulls.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("stat_of"), F.col(c).cast("long").alias("v")) for c in columns]
    )
    counted = stored(
        durations.select(F.explode(pairs).alias("p"))
        .select("p.*")
        .groupBy("stat_of", "v")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__slice", F.floor(F.col("v") / DURATION_VALUES_PER_SLICE))
    )
    valued = F.col("v").isNotNull()
    slices = counted.groupBy("stat_of", "__slice").agg(
        F.sum(F.when(valued, F.col("__n"))).alias("__in"),
        F.min("v").alias("__min"),
        F.max("v").alias("__max"),
        F.sum(F.when(valued, F.col("v") * F.col("__n"))).alias("__sum"),
    )
    whole = Window.partitionBy("stat_of")
    before = whole.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        slices.withColumn("__total", F.coalesce(F.sum("__in").over(whole), F.lit(0)))
        .withColumn("__rank", F.floor((F.col("__total") * 95 + 99) / 100).cast("long"))
        .withColumn("__before", F.coalesce(F.sum("__in").over(before), F.lit(0)))
    )
    overall = ranked.groupBy("stat_of").agg(
        F.min("__min").alias("min"),
        F.max("__max").alias("max"),
        F.expr("sum(__sum) div sum(__in)").alias("avg"),
    )
    holding = ranked.filter(
        (F.col("__before") < F.col("__rank"))
        & (F.col("__rank") <= F.col("__before") + F.col("__in"))
    ).select("stat_of", "__slice", "__rank", "__before")
    inside = Window.partitionBy("stat_of", "__slice").orderBy("v").rowsBetween(
        Window.unboundedPreceding, 0
    )
    p95 = (
        counted.join(holding, ["stat_of", "__slice"])
        .withColumn("__upto", F.col("__before") + F.sum("__n").over(inside))
        .filter(F.col("__upto") >= F.col("__rank"))
        .groupBy("stat_of")
        .agg(F.min("v").alias("p95"))
    )
    return overall.join(p95, "stat_of", "left").select("stat_of", "min", "max", "avg", "p95")


def report_durations(doc_results: DataFrame) -> DataFrame:
    """Statistics of the report: totals over everything processed, stages over successes."""
    success = F.col("outcome") == "success"
    processed = F.col("outcome") != "skipped_existing"
    picked = doc_results.select(
        F.when(processed, F.col("duration_ms")).alias("duration_ms"),
        *[F.when(success, F.col(c)).alias(c) for c in ("hash_ms", "partition_ms", "delivery_ms")],
    )
    return duration_stats(picked, ["duration_ms", "hash_ms", "partition_ms", "delivery_ms"])


def retry_stats(doc_results: DataFrame) -> DataFrame:
    """One row: extra attempts, successes that needed them, failures worth a retry."""
    return _aggregated(doc_results, _retry_columns())


def _entry(section: str, key: Column, subkey: Column, value: Column) -> Column:
    return F.struct(
        F.lit(section).alias("section"),
        key.alias("key"),
        subkey.cast("string").alias("subkey"),
        value.cast("long").alias("value"),
    )


def _destination_entries(section: str) -> list[Column]:
    there = F.when(F.col("ok").isNotNull(), F.col("destination"))
    facts = {"total": F.lit(1), "ok": F.col("ok"), "failed": ~F.col("ok")}
    return [_entry(section, there, F.lit(n), v) for n, v in facts.items()]


def _summed(df: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """Sum entries by section and key in one pass; entries without a key do not count."""
    return (
        df.select(F.explode(F.array(*entries)).alias("e"))
        .select("e.*")
        .filter(F.col("key").isNotNull())
        .groupBy("section", "key", "subkey")
        .agg(F.sum("value").alias("value"))
    )


def batch_report(
    doc_results: DataFrame,
    run: Mapping[str, str],
    wall_ms: int,
    children: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The report as one row, and its breakdowns as rows.

    ``run`` holds the constants of the run (run_id, pipeline_version, strategy,
    executor, ...).  Breakdown rows are (section, key, subkey, value).  The row
    comes from one pass over the results, the counted breakdowns from another
    and the durations from a third.
    """
    docs = {f"docs_{n}": c for n, c in _count_columns().items()}
    sent = {f"delivery_{n}": c for n, c in _delivery_columns().items()}
    letters = {"dlq_written_total": F.count_if("dlq_written")}
    total = F.col("docs_total")
    report = _aggregated(doc_results, docs | sent | letters | _retry_columns()).select(
        *[F.lit(v).alias(k) for k, v in run.items()],
        F.lit(wall_ms).cast("long").alias("run_wall_ms"),
        F.when(F.lit(wall_ms) > 0, total / F.lit(wall_ms) * F.lit(60000.0)).alias("docs_per_min"),
        total,
        F.col("docs_success").alias("docs_success_total"),
        F.col("docs_failed").alias("docs_failed_total"),
        (F.col("docs_skipped_existing") + F.col("docs_skipped_unsupported")).alias(
            "docs_skipped_total"
        ),
        F.col("docs_skipped_existing").alias("skipped_existing"),
        F.col("docs_skipped_unsupported").alias("skipped_unsupported"),
        *[F.col(n).alias(n if n == "delivery_total" else f"{n}_total") for n in sent],
        "dlq_written_total",
        *_retry_columns(),
    )
    one, none = F.lit(1), F.lit(None)
    unsuccessful = ~F.col("outcome").isin("success", "skipped_existing")
    run_code = F.when(unsuccessful & (F.col("error_code") != ""), F.col("error_code"))

    def shared(name: str) -> Column:
        return F.when(~F.col(name).isin("not_failed", "unknown"), F.col(name))

    kind = shared("shared_failure_kind")
    breakdown = _summed(
        doc_results,
        [
            _entry("extension", F.col("extension"), none, one),
            _entry("error_code", run_code, none, one),
            _entry("error_code", shared("shared_error_code"), none, one),
            *_destination_entries("destination"),
            _entry("failure_kind", F.when(kind.isNotNull(), F.col("destination")), kind, one),
        ],
    )
    if children is not None:
        reported = F.when(~F.col("ok") & (F.col("failure_kind") != ""), F.col("failure_kind"))
        below = _summed(
            children,
            [
                *_destination_entries("fanout_child"),
                _entry(
                    "failure_kind",
                    F.when(reported.isNotNull(), F.col("destination")),
                    reported,
                    one,
                ),
            ],
        )
        breakdown = (
            breakdown.unionByName(below)
            .groupBy("section", "key", "subkey")
            .agg(F.sum("value").alias("value"))
        )
    stats = F.array(
        *[F.struct(F.lit(n).alias("n"), F.col(n).alias("v")) for n in ("min", "max", "avg", "p95")]
    )
    timed = (
        report_durations(doc_results)
        .select("stat_of", F.explode(stats).alias("p"))
        .select(
            F.lit("duration").alias("section"),
            F.col("stat_of").alias("key"),
            F.col("p.n").alias("subkey"),
            F.col("p.v").alias("value"),
        )
    )
    return report, breakdown.unionByName(timed)


GAUGES = (
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


def metric_rows(
    report: DataFrame,
    breakdown: DataFrame,
    run: Mapping[str, str],
    backend_kind: str = "unknown",
    prefix: str = "ingest",
) -> DataFrame:
    """Gauge samples (name, labels as JSON text, value) of a batch report.

    Times are in seconds, and destinations without an ok or a failed delivery
    have no such sample.
    """
    shown = ("pipeline_version", "strategy", "executor")
    base = {n: J.quote(F.lit(run[n])) for n in shown} | {
        "backend_kind": J.quote(F.lit(backend_kind))
    }
    head = f"{prefix}_run_"

    def sample(name: str, value: Column) -> Column:
        return F.struct(F.lit(head + name).alias("name"), value.cast("double").alias("value"))

    wall = F.when(F.col("run_wall_ms") > 0, F.col("run_wall_ms") / F.lit(1000.0))
    samples = [
        sample("info", F.lit(1.0)),
        sample("wall_seconds", wall),
        sample("docs_per_minute", F.col("docs_per_min")),
        *[sample(g, F.col(g)) for g in GAUGES],
    ]
    totals = (
        report.select(F.explode(F.array(*samples)).alias("s"))
        .filter(F.col("s.value").isNotNull())
        .select("s.name", J.object_text(base).alias("labels"), "s.value")
    )
    section = F.col("section")
    stage = F.regexp_replace("key", "_ms$", "")
    by_destination = section == "destination"
    timed = section == "duration"
    staged = timed & (F.col("key") != "duration_ms")
    name = (
        F.when(by_destination & (F.col("subkey") == "ok"), head + "delivery_ok_total")
        .when(by_destination & (F.col("subkey") == "failed"), head + "delivery_failed_total")
        .when(section == "failure_kind", head + "delivery_failure_kind_total")
        .when(staged, head + "stage_duration_seconds")
        .when(timed, head + "doc_duration_seconds")
    )
    labels = J.object_text(
        base
        | {
            "destination": F.when(~timed, J.quote(F.col("key"))),
            "failure_kind": F.when(section == "failure_kind", J.quote(F.col("subkey"))),
            "stage": F.when(staged, J.quote(stage)),
            "stat": F.when(timed, J.quote(F.col("subkey"))),
        },
        omit_null=True,
    )
    seconds = F.when(timed, F.col("value") / F.lit(1000.0)).otherwise(F.col("value"))
    details = breakdown.filter(
        F.col("value").isNotNull() & (~by_destination | (F.col("value") > 0))
    ).select(name.alias("name"), labels.alias("labels"), seconds.cast("double").alias("value"))
    return totals.unionByName(details.filter(F.col("name").isNotNull()))


# What usage facts do not claim.
USAGE_NOT_CLAIMED = (
    "billing",
    "pricing",
    "license entitlement",
    "subscription allowance",
    "quota decision",
    "page is a universal raw unit",
    "distributed runtime evidence",
)
BATCH_USAGE_NOT_CLAIMED = tuple(c for c in USAGE_NOT_CLAIMED if not c.startswith("page"))
USAGE_SCHEMA_VERSION = 1


def _texts(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _domains(evidence: Column) -> Column:
    """Technical domains in use; this engine has the base domain only."""
    return F.struct(
        F.lit(True).alias("base"),
        F.lit(False).alias("pro"),
        F.lit(False).alias("extra"),
        evidence.alias("evidence"),
    )


def usage_records(tasks: DataFrame, run_meta: DataFrame, receipts: DataFrame) -> DataFrame:
    """One technical usage fact per task.

    ``tasks`` has ``task_id``, ``kind``, ``source`` and ``source_contract_id``;
    ``run_meta`` one row per task with run, outcome, ``run_error_code`` and
    provenance columns; ``receipts`` at most one summarised receipt per task.
    """
    receipt = receipts.select(
        "task_id",
        "ok",
        "delivery_outcome",
        "failure_retryability",
        F.col("shared_failure_kind").alias("failure_kind"),
        "shared_error_code",
    )
    joined = tasks.join(run_meta, "task_id").join(receipt, "task_id", "left")
    ok, undelivered = F.col("ok"), F.coalesce(~F.col("ok"), F.lit(False))
    status = (
        F.when(
            (F.col("outcome") == "success") & F.coalesce(ok, F.lit(True)), "succeeded"
        )
        .when(F.col("outcome") == "failed", "failed")
        .when(F.col("outcome") == "skipped_unsupported", "skipped")
        .when(undelivered, "failed")
        .otherwise("unknown")
    )
    recovery = (
        F.when(F.col("run_origin").isin("resume", "requeue", "redrive"), F.col("run_origin"))
        .when(F.col("delivery_origin") == "replay", "replay")
        .otherwise("primary")
    )
    document = F.col("kind") == "uns"
    linked = F.coalesce(
        F.col("source_contract_id"), contract_id(F.col("kind"), F.col("source"))
    )
    evidence = F.filter(
        F.array(
            F.concat(F.lit("task.kind="), F.col("kind")),
            F.lit("current retained source/destination surface=base"),
            F.concat(F.lit("source_contract_id="), linked),
        ),
        lambda e: e.isNotNull(),
    )
    return joined.select(
        F.lit(USAGE_SCHEMA_VERSION).alias("schema_version"),
        F.lit("raw_technical_usage_fact_v1").alias("record_kind"),
        F.lit(True).alias("non_billing"),
        _domains(evidence).alias("capability_domains_used"),
        F.when(document, _texts("elements_count", "normalized_text_len"))
        .otherwise(_texts("duration_ms", "attempts"))
        .alias("derivative_metrics"),
        F.when(document, _texts("page", "delivery_success"))
        .otherwise(_texts("delivery_success", "checkpoint"))
        .alias("not_primary_units"),
        _texts(*USAGE_NOT_CLAIMED).alias("not_claimed"),
        "task_id",
        "run_id",
        "pipeline_version",
        "task_identity_key",
        "checkpoint_identity_key",
        F.col("kind").alias("flow_kind"),
        F.when(document, "document").otherwise("record_or_emitted_item").alias("primary_raw_unit"),
        F.when(document, "stable_current")
        .otherwise("bounded_not_fully_first_class")
        .alias("maturity"),
        F.col("source").alias("task_document_source"),
        linked.alias("source_contract_id"),
        F.when(linked.isNotNull(), "linked")
        .otherwise("flow_family_only")
        .alias("source_contract_status"),
        F.when(document, "document_selection")
        .otherwise("structured_emitted_item")
        .alias("raw_unit_relation"),
        status.alias("status"),
        F.col("outcome").alias("run_outcome"),
        "delivery_outcome",
        F.when(undelivered, "delivery")
        .when(F.col("run_error_code").isNotNull(), "run")
        .otherwise("none")
        .alias("failure_stage"),
        F.when(undelivered, F.col("shared_error_code"))
        .otherwise(F.col("run_error_code"))
        .alias("error_code"),
        "failure_retryability",
        "failure_kind",
        recovery.alias("recovery_kind"),
        "run_origin",
        "delivery_origin",
        "execution_mode",
    )


def usage_batch(report: DataFrame) -> DataFrame:
    """One usage row per batch report."""
    broken = (F.col("docs_failed_total") > 0) | (F.col("delivery_failed_total") > 0)
    empty = F.col("docs_total") == 0
    return report.select(
        F.lit(USAGE_SCHEMA_VERSION).alias("schema_version"),
        F.lit("raw_technical_usage_batch_summary_v1").alias("record_kind"),
        F.lit(True).alias("non_billing"),
        _domains(_texts("batch report aggregate")).alias("capability_domains_used"),
        F.lit("aggregate_from_task_records_and_batch_report").alias("source_linkage_scope"),
        _texts(*BATCH_USAGE_NOT_CLAIMED).alias("not_claimed"),
        "run_id",
        "pipeline_version",
        F.col("docs_total"),
        F.col("docs_success_total").alias("docs_success"),
        F.col("docs_failed_total").alias("docs_failed"),
        F.col("docs_skipped_total").alias("docs_skipped"),
        "delivery_total",
        F.col("delivery_ok_total").alias("delivery_ok"),
        F.col("delivery_failed_total").alias("delivery_failed"),
        F.when(empty, "empty").when(broken, "partial").otherwise("succeeded").alias("status"),
        F.when(~empty & broken, "batch").otherwise("none").alias("failure_stage"),
    )
