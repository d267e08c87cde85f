"""Task states: enqueue, acknowledge, recover, requeue and inspect.

A task row has ``task_id``, ``bucket`` (pending, inflight, done, failed, poison),
``task_json``, ``failure_count``, ``orphan_count``, ``claimed_at``, ``created_at``,
``updated_at`` (epoch seconds) and ``provenance``, an array of recovery entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import identity
from millrace.functions import jsontext as J
from millrace.functions.binding import evaluate_once
from millrace.sources.specs import contract_id

BUCKETS = ("pending", "inflight", "done", "failed", "poison")
MAX_TASK_ATTEMPTS = 3
MAX_ORPHAN_REQUEUES = 2
PROVENANCE_TYPE = (
    "array<struct<action:string,source_bucket:string,target_bucket:string,recorded_at:double>>"
)


def enqueue(
    task_state: DataFrame, new_tasks: DataFrame, now: Column, seq: str = "seq"
) -> tuple[DataFrame, DataFrame]:
    """The table with the new tasks pending, and the rejected ones.

    A task whose id exists is rejected, as is every repeat of a new id but the
    first by ``seq``, which is unique.
    """
    firsts = new_tasks.groupBy("task_id").agg(F.min(seq).alias(seq))
    accepted_ids = firsts.join(task_state.select("task_id"), "task_id", "left_anti")
    accepted = new_tasks.join(accepted_ids, ["task_id", seq], "left_semi").select(
        "task_id",
        F.lit("pending").alias("bucket"),
        "task_json",
        F.lit(0).alias("failure_count"),
        F.lit(0).alias("orphan_count"),
        F.lit(None).cast("double").alias("claimed_at"),
        now.cast("double").alias("created_at"),
        now.cast("double").alias("updated_at"),
        F.array().cast(PROVENANCE_TYPE).alias("provenance"),
    )
    rejected = new_tasks.join(accepted_ids, ["task_id", seq], "left_anti")
    return task_state.select(*accepted.columns).unionByName(accepted), rejected


def _acknowledged(joined: DataFrame, ack: Column, now: Column, columns: list[str]) -> DataFrame:
    """Apply one acknowledgement to inflight rows; the others stay as they are."""
    hit = (F.col("bucket") == "inflight") & ack.isNotNull()
    failures = F.col("failure_count") + F.when(hit & (ack == "failure"), 1).otherwise(0)
    orphans = F.col("orphan_count") + F.when(hit & (ack == "orphan"), 1).otherwise(0)
    bucket = (
        F.when(~hit, F.col("bucket"))
        .when(ack == "success", "done")
        .when(
            ((ack == "failure") & (failures >= MAX_TASK_ATTEMPTS))
            | ((ack == "orphan") & (orphans >= MAX_ORPHAN_REQUEUES)),
            "poison",
        )
        .otherwise("pending")
    )
    changed = {
        "bucket": bucket,
        "failure_count": failures,
        "orphan_count": orphans,
        "claimed_at": F.when(hit, F.lit(None).cast("double")).otherwise(F.col("claimed_at")),
        "updated_at": F.when(hit, now.cast("double")).otherwise(F.col("updated_at")),
    }
    return joined.select(*[changed.get(c, F.col(c)).alias(c) for c in columns])


def apply_acks(task_state: DataFrame, acks: DataFrame, now: Column) -> DataFrame:
    """The table after acknowledgements (``task_id``, ``ack``, ``at``).

    ``ack`` is success, failure or orphan; only the first one of a claim counts,
    since it takes the task out of inflight.
    """
    first = acks.groupBy("task_id").agg(F.min(F.struct("at", "ack")).alias("__a")).select(
        "task_id", F.col("__a.ack").alias("__ack")
    )
    joined = task_state.join(first, "task_id", "left")
    return _acknowledged(joined, F.col("__ack"), now, task_state.columns)


def recover_stale(task_state: DataFrame, max_age_s: int, now_epoch_s: float) -> DataFrame:
    """The table after inflight tasks claimed too long ago were taken back."""
    if max_age_s <= 0:
        raise ValueError("max_age_s must be > 0")
    stale = (F.col("bucket") == "inflight") & (F.col("claimed_at") <= now_epoch_s - max_age_s)
    ack = F.when(stale, F.lit("orphan"))
    return _acknowledged(task_state, ack, F.lit(float(now_epoch_s)), task_state.columns)


def requeue(
    task_state: DataFrame, wanted: DataFrame, now: Column
) -> tuple[DataFrame, DataFrame]:
    """The table after operators requeued tasks, and one result row per request.

    ``wanted`` has ``task_id`` and the ``source_bucket`` it is taken from (poison or
    inflight).  A request that is repeated counts once.  Counts stay, and the move is
    added to the provenance.
    """
    asked = wanted.select("task_id", F.col("source_bucket").alias("__from")).distinct()
    recoverable = F.col("__from").isin("poison", "inflight")
    # Of several requests for a task only the one for its own bucket can move it.
    moved = asked.filter(recoverable).join(
        task_state.select("task_id", F.col("bucket").alias("__from")), ["task_id", "__from"]
    )
    entry = F.struct(
        F.lit("requeue").alias("action"),
        F.col("__from").alias("source_bucket"),
        F.lit("pending").alias("target_bucket"),
        now.cast("double").alias("recorded_at"),
    )
    joined = task_state.join(moved.distinct(), "task_id", "left").withColumn(
        "__hit", F.col("__from").isNotNull()
    )
    changed = {
        "bucket": F.when(F.col("__hit"), "pending").otherwise(F.col("bucket")),
        "claimed_at": F.when(~F.col("__hit"), F.col("claimed_at")),
        "updated_at": F.when(F.col("__hit"), now.cast("double")).otherwise(F.col("updated_at")),
        "provenance": F.when(
            F.col("__hit"),
            F.array_append(F.coalesce("provenance", F.array().cast(PROVENANCE_TYPE)), entry),
        ).otherwise(F.col("provenance")),
    }
    after = joined.select(*[changed.get(c, F.col(c)).alias(c) for c in task_state.columns])
    found = task_state.select("task_id", "bucket", "failure_count", "orphan_count", "task_json")
    task = F.col("__task")
    kind = J.filled_string_at(task, "$.kind")
    document = "$.inputs.document"
    facts = {
        "kind": kind,
        "task_identity_key": F.when(
            J.is_object(task, "$.identity"),
            identity.task_key(
                kind,
                J.string_at(task, "$.identity.pipeline_version"),
                J.string_at(task, "$.identity.sha256"),
            ),
        ),
        "source_contract_id": F.coalesce(
            J.filled_string_at(task, f"{document}.source_contract_id"),
            contract_id(kind, J.string_at(task, f"{document}.source")),
        ),
    }
    answered = asked.join(found, "task_id", "left").withColumn(
        "__task", J.parse(F.col("task_json"))
    )
    told = evaluate_once(
        answered, ["task_id", "__from", "bucket", "failure_count", "orphan_count"], facts
    )
    results = told.select(
        "task_id",
        "kind",
        F.lit("requeue").alias("action"),
        F.col("__from").alias("source_bucket"),
        F.when(recoverable & (F.col("bucket") == F.col("__from")), "moved_to_pending")
        .when(~recoverable, "source_bucket_not_recoverable")
        .otherwise("task_not_found_in_source_bucket")
        .alias("result"),
        "failure_count",
        "orphan_count",
        now.cast("double").alias("recorded_at"),
        "task_identity_key",
        "source_contract_id",
        F.lit("persisted_in_history").alias("audit_support"),
    )
    return after, results


def bucket_counts(task_state: DataFrame) -> DataFrame:
    """One row with the number of tasks in each bucket."""
    return task_state.agg(*[F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS])


def explain_tasks(tasks: DataFrame) -> DataFrame:
    """Add what an operator needs to know about each task."""
    orphaned = F.col("orphan_count") > 0
    last = F.try_element_at("provenance", F.lit(-1))
    requeued = F.coalesce(last["action"] == "requeue", F.lit(False))
    poison_kind = F.when(F.col("bucket") != "poison", "not_poison").otherwise(
        F.when(orphaned, "orphaned").otherwise("attempts_exhausted")
    )
    explanation = (
        F.when(F.col("bucket") == "pending", "ready_for_local_worker_claim")
        .when(F.col("bucket") == "inflight", "claimed_by_local_worker_or_recoverable_if_stale")
        .when(F.col("bucket") == "done", "completed_by_local_worker")
        .when(
            F.col("bucket") == "failed",
            "reserved_terminal_failure_bucket_not_primary_retry_path",
        )
        .otherwise("operator_requeue_supported_after_attempt_or_orphan_threshold")
    )
    labels = F.filter(
        F.array(F.when(orphaned, "orphaned"), F.when(requeued, "requeued")),
        lambda x: x.isNotNull(),
    )
    return (
        tasks.withColumn("governance_labels", labels)
        .withColumn("poison_kind", poison_kind)
        .withColumn(
            "governance_problem",
            F.when(F.col("poison_kind") == "attempts_exhausted", "poison_attempts_exhausted")
            .when(F.col("poison_kind") == "orphaned", "poison_orphaned")
            .when(orphaned, "orphaned")
            .otherwise("none"),
        )
        .withColumn(
            "handling_expectation",
            F.when(F.col("bucket").isin("poison", "inflight"), "requeue_supported").otherwise(
                "none"
            ),
        )
        .withColumn("state_explanation", explanation)
        .withColumn(
            "recovery_audit_support",
            F.when(requeued, "persisted_in_history").otherwise("result_only"),
        )
    )


def inspect_tasks(
    task_state: DataFrame, bucket: str, limit: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The oldest tasks of a bucket, explained, and a summary row."""
    if bucket not in BUCKETS:
        raise ValueError(f"unknown bucket: {bucket}")
    rows = task_state.filter(F.col("bucket") == bucket)
    listed = rows if limit is None else rows.orderBy("updated_at", "task_id").limit(limit)
    explained = explain_tasks(listed)
    requeued = F.col("recovery_audit_support") == "persisted_in_history"
    view = explained.agg(
        F.count(F.lit(1)).alias("listed_tasks"),
        F.count_if(F.col("governance_problem") != "none").alias("governance_problem_tasks"),
        F.count_if(requeued).alias("visible_requeue_history_tasks"),
    )
    listed_facts = view.agg(F.max(F.struct(*view.columns))).scalar()
    summary = bucket_counts(task_state).select(
        "*",
        *[listed_facts[c].alias(c) for c in view.columns],
        F.when(listed_facts["listed_tasks"] == 0, "none")
        .when(listed_facts["visible_requeue_history_tasks"] > 0, "persisted_in_history")
        .otherwise("result_only")
        .alias("recovery_audit_support"),
    )
    return explained, summary
