"""Checkpoints of record reads: build, check, select and resume."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import identity, ordering
from millrace.functions import jsontext as J
from millrace.functions.binding import evaluate_once

SCHEMA_VERSION = 1
PROGRESS_KINDS = ("cursor_v1", "token_v1", "page_v1", "state_dict_v1")
STATES_PER_SLICE = 1_000_000
RUN_ORIGINS = ("intake", "resume", "redrive", "requeue")
DELIVERY_ORIGINS = ("primary", "replay")
EXECUTION_MODES = ("batch", "worker")


def progress_kind_of(progress: Column) -> Column:
    """Kind of a parsed progress object; the first rule that fits wins."""
    token = F.coalesce(
        J.filled_string_at(progress, "$.token"),
        J.filled_string_at(progress, "$.page_token"),
        J.filled_string_at(progress, "$.next_page_token"),
    )
    page = F.coalesce(J.integer_at(progress, "$.page_number"), J.integer_at(progress, "$.page"))
    return (
        F.when(J.filled_string_at(progress, "$.cursor").isNotNull(), "cursor_v1")
        .when(token.isNotNull(), "token_v1")
        .when(page.isNotNull(), "page_v1")
        .otherwise("state_dict_v1")
    )


def progress_kind(states: DataFrame, data: str = "data") -> DataFrame:
    parsed = states.withColumn("__p", J.parse(F.col(data)))
    return evaluate_once(
        parsed, states.columns, {"progress_kind": progress_kind_of(F.col("__p"))}
    )


def build_checkpoints(
    records: DataFrame,
    states: DataFrame,
    tasks: DataFrame,
    keys: Sequence[str],
) -> DataFrame:
    """One row per checkpoint entry, each pointing at the entry before it.

    ``tasks`` has one row per document with ``pipeline_version`` and ``sha256``
    and, when known, the run's ``run_origin``, ``delivery_origin``,
    ``execution_mode`` and ``resumed_from_checkpoint_identity_key``.  The stream
    of a document is that of its first record.
    """
    first = records.groupBy(*keys).agg(
        F.min(F.struct("record_index", "stream")).alias("__first")
    ).select(*keys, F.col("__first.stream").alias("__stream"))
    version, sha = F.col("pipeline_version"), F.col("sha256")

    def known(name: str, default: str) -> Column:
        present = name in tasks.columns
        return F.coalesce(F.col(name), F.lit(default)) if present else F.lit(default)

    resumed = "resumed_from_checkpoint_identity_key"
    headers = tasks.join(first, list(keys), "left").select(
        *keys,
        F.col("__stream").alias("stream"),
        identity.task_key(F.lit("it"), version, sha).alias("task_identity_key"),
        known("run_origin", "intake").alias("run_origin"),
        known("delivery_origin", "primary").alias("delivery_origin"),
        known("execution_mode", "batch").alias("execution_mode"),
        (F.col(resumed) if resumed in tasks.columns else F.lit(None).cast("string")).alias(resumed),
    )
    read = progress_kind(states.select(*keys, "state_index", "data"))
    entries = read.join(headers, list(keys)).withColumn(
        "checkpoint_identity_key",
        identity.checkpoint_key(
            F.col("task_identity_key"), F.col("stream"), F.col("progress_kind"), F.col("data")
        ),
    )
    chained = ordering.previous_value(
        entries,
        keys,
        ["state_index"],
        "checkpoint_identity_key",
        "parent_checkpoint_identity_key",
        F.floor(F.col("state_index") / STATES_PER_SLICE),
    )
    return chained.select(
        *keys,
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit("it").alias("flow_kind"),
        "stream",
        "task_identity_key",
        "run_origin",
        "delivery_origin",
        "execution_mode",
        resumed,
        F.col("state_index").alias("checkpoint_index"),
        "checkpoint_identity_key",
        "parent_checkpoint_identity_key",
        "progress_kind",
        F.col("data").alias("progress"),
    )


def _entry_problem(entry: Column) -> Column:
    kind_ok = J.absent(entry, "$.progress_kind") | J.string_at(entry, "$.progress_kind").isin(
        *PROGRESS_KINDS
    )
    parent_ok = J.absent(entry, "$.parent_checkpoint_identity_key") | J.filled_string_at(
        entry, "$.parent_checkpoint_identity_key"
    ).isNotNull()
    return (
        F.when(~J.is_object(entry), "entry_not_an_object")
        .when(
            J.filled_string_at(entry, "$.checkpoint_identity_key").isNull(),
            "entry_key_not_a_filled_string",
        )
        .when(~parent_ok, "entry_parent_not_a_filled_string")
        .when(~J.is_object(entry, "$.progress"), "entry_progress_not_an_object")
        .when(~F.coalesce(kind_ok, F.lit(False)), "entry_progress_kind_unsupported")
        .when(
            J.integer_at(entry, "$.checkpoint_index").isNull(), "entry_index_not_an_integer"
        )
    )


def _one_of(value: Column, allowed: Sequence[str]) -> Column:
    return F.coalesce(value.isin(*allowed), F.lit(False))


#: Fields of a checkpoint artifact beside its entries.
HEADER = ["schema_version", "flow_kind", "stream", "task_identity_key", "provenance"]


def _artifact(text: str) -> Column:
    """The header as variants and each entry as a variant of its own."""
    return J.document(F.col(text), ["checkpoints"], HEADER)


def _provenance_problem(p: Column, task: Column) -> Column:
    at = "$"
    resumed, resume = f"{at}.resumed_from_checkpoint_identity_key", f"{at}.resume"
    after = f"{resume}.continuation"
    has_resume = ~J.absent(p, resume)
    has_after = has_resume & ~J.absent(p, after)
    return (
        F.when(
            J.filled_string_at(p, f"{at}.task_identity_key").isNull(),
            "provenance_task_not_a_filled_string",
        )
        .when(
            ~_one_of(J.string_at(p, f"{at}.run_origin"), RUN_ORIGINS),
            "provenance_run_origin_unsupported",
        )
        .when(
            ~_one_of(J.string_at(p, f"{at}.delivery_origin"), DELIVERY_ORIGINS),
            "provenance_delivery_origin_unsupported",
        )
        .when(
            ~_one_of(J.string_at(p, f"{at}.execution_mode"), EXECUTION_MODES),
            "provenance_execution_mode_unsupported",
        )
        .when(
            ~J.absent(p, resumed) & J.filled_string_at(p, resumed).isNull(),
            "provenance_resumed_from_not_a_filled_string",
        )
        .when(has_resume & ~J.is_object(p, resume), "resume_not_an_object")
        .when(
            has_resume & J.filled_string_at(p, f"{resume}.checkpoint_identity_key").isNull(),
            "resume_key_not_a_filled_string",
        )
        .when(
            has_resume & ~_one_of(J.string_at(p, f"{resume}.progress_kind"), PROGRESS_KINDS),
            "resume_progress_kind_unsupported",
        )
        .when(has_after & ~J.is_object(p, after), "resume_continuation_not_an_object")
        .when(
            has_after & J.filled_string_at(p, f"{after}.exclusive_after_cursor").isNull(),
            "resume_cursor_not_a_filled_string",
        )
        .when(
            J.string_at(p, f"{at}.task_identity_key") != task, "provenance_task_differs"
        )
    )


def checkpoint_compat(df: DataFrame, text: str) -> DataFrame:
    """Add ``status``, ``schema_version``, ``flow_kind`` and ``reason``.

    Checks run in a fixed order and the first that fails gives the reason.
    """
    c = F.col("__c")
    version, flow = J.integer_at(c["schema_version"]), J.filled_string_at(c["flow_kind"])
    task = J.filled_string_at(c["task_identity_key"])
    stream, provenance, entries = c["stream"], c["provenance"], c["checkpoints"]
    too_large = F.octet_length(F.col(text)) > J.LONGEST_VARIANT
    malformed = (
        F.when(c.isNull() & F.col("__large"), "entry_too_large_or_not_a_json_object")
        .when(c.isNull(), "not_a_json_object")
        .when(F.col("schema_version").isNull(), "schema_version_not_an_integer")
        .when(F.col("flow_kind").isNull(), "flow_kind_not_a_filled_string")
    )
    unsupported = F.when(
        F.col("schema_version") != SCHEMA_VERSION, "unsupported_schema_version"
    ).when(F.col("flow_kind") != "it", "unsupported_flow_kind")
    shape = (
        F.when(
            ~J.absent(stream) & J.string_at(stream).isNull(),
            "stream_not_a_string",
        )
        .when(task.isNull(), "task_identity_key_not_a_filled_string")
        .when(
            ~J.absent(provenance) & ~J.is_object(provenance),
            "provenance_not_an_object",
        )
        .when(J.is_object(provenance), _provenance_problem(provenance, task))
    )
    shape = F.coalesce(
        shape,
        F.when(entries.isNull(), "checkpoints_not_a_list").otherwise(
            F.get(
                F.filter(F.transform(entries, _entry_problem), lambda p: p.isNotNull()), F.lit(0)
            )
        ),
    )
    read = evaluate_once(df, df.columns, {"__c": _artifact(text), "__large": too_large})
    headed = evaluate_once(
        read,
        read.columns,
        {"schema_version": version, "__flow": flow},
    ).withColumn("flow_kind", F.when(F.col("schema_version").isNotNull(), F.col("__flow")))
    wrong = F.coalesce(malformed, unsupported)
    checked = evaluate_once(
        headed,
        [*df.columns, "schema_version", "flow_kind"],
        {
            "__malformed": malformed,
            "__unsupported": F.when(malformed.isNull(), unsupported),
            "__shape": F.when(wrong.isNull(), shape),
        },
    )
    return (
        checked.withColumn(
            "status",
            F.when(F.col("__malformed").isNotNull() | F.col("__shape").isNotNull(), "malformed")
            .when(F.col("__unsupported").isNotNull(), "unsupported")
            .otherwise("supported"),
        )
        .withColumn("reason", F.coalesce("__malformed", "__unsupported", "__shape"))
        .drop("__malformed", "__unsupported", "__shape")
    )


def read_checkpoint_entries(df: DataFrame, key: str, text: str) -> DataFrame:
    """Entry rows of checkpoint documents that passed :func:`checkpoint_compat`."""
    return (
        evaluate_once(df, [key], {"__c": _artifact(text)})
        .select(
            key,
            J.string_at(F.col("__c.stream")).alias("stream"),
            J.string_at(F.col("__c.task_identity_key")).alias("task_identity_key"),
            F.posexplode("__c.checkpoints").alias("position", "__e"),
        )
        .withColumn("__p", F.try_variant_get("__e", "$.progress", "variant"))
        .select(
            key,
            "stream",
            "task_identity_key",
            "position",
            J.integer_at(F.col("__e"), "$.checkpoint_index").alias("checkpoint_index"),
            J.string_at(F.col("__e"), "$.checkpoint_identity_key").alias(
                "checkpoint_identity_key"
            ),
            J.string_at(F.col("__e"), "$.parent_checkpoint_identity_key").alias(
                "parent_checkpoint_identity_key"
            ),
            F.coalesce(
                J.string_at(F.col("__e"), "$.progress_kind"), progress_kind_of(F.col("__p"))
            ).alias("progress_kind"),
            J.render(F.col("__p")).alias("progress"),
        )
    )


ISSUE_STATUS = {
    "checkpoint_malformed": "malformed",
    "checkpoint_incompatible": "incompatible",
    "task_identity_mismatch": "incompatible",
    "empty_checkpoint_set": "blocked",
    "unknown_checkpoint_identity": "blocked",
    "missing_checkpoint_cursor": "blocked",
    "unsupported_progress_kind": "unsupported",
}


def select_resume(
    headers: DataFrame, entries: DataFrame, requests: DataFrame, ref: str, request: str
) -> DataFrame:
    """Pick the checkpoint each request resumes from, or say why it cannot.

    ``headers`` has one row per checkpoint document (``status`` of the
    compatibility check, ``task_identity_key``, ``stream``); ``entries`` has
    ``position``, the keys, ``progress_kind`` and ``progress``; ``requests`` has
    ``request``, ``ref``, ``pipeline_version``, ``sha256`` and
    ``wanted_checkpoint_key`` (null asks for the latest).  ``entries`` is read twice and should be a
    written table (``session.stored``).
    """
    fields = [
        "checkpoint_index",
        "checkpoint_identity_key",
        "parent_checkpoint_identity_key",
        "progress_kind",
        "progress",
    ]
    picked = F.struct("position", *fields)
    latest = entries.groupBy(ref).agg(F.max(picked).alias("__latest"))
    wanted = requests.select(
        ref, F.col("wanted_checkpoint_key").alias("checkpoint_identity_key")
    ).distinct()
    # Only entries that a request names are grouped by their key.
    by_key = (
        entries.join(wanted, [ref, "checkpoint_identity_key"], "left_semi")
        .groupBy(ref, "checkpoint_identity_key")
        .agg(F.min(picked).alias("__named"))
        .withColumnRenamed("checkpoint_identity_key", "wanted_checkpoint_key")
    )
    joined = (
        requests.join(headers.select(ref, "status", "task_identity_key", "stream"), ref, "left")
        .join(latest, ref, "left")
        .join(by_key, [ref, "wanted_checkpoint_key"], "left")
        .withColumn(
            "__entry",
            F.when(F.col("wanted_checkpoint_key").isNull(), F.col("__latest")).otherwise(
                F.col("__named")
            ),
        )
        .withColumn("__p", J.parse(F.col("__entry.progress")))
    )
    expected = identity.task_key(F.lit("it"), F.col("pipeline_version"), F.col("sha256"))
    cursor = J.filled_string_at(F.col("__p"), "$.cursor")
    kind = F.col("__entry.progress_kind")
    issue = (
        F.when(F.coalesce(F.col("status"), F.lit("malformed")) == "malformed", "checkpoint_malformed")
        .when(F.col("status") != "supported", "checkpoint_incompatible")
        .when(F.col("task_identity_key") != expected, "task_identity_mismatch")
        .when(F.col("__latest").isNull(), "empty_checkpoint_set")
        .when(F.col("__entry").isNull(), "unknown_checkpoint_identity")
        .when((kind == "cursor_v1") & cursor.isNull(), "missing_checkpoint_cursor")
        .when(kind != "cursor_v1", "unsupported_progress_kind")
    )
    pairs = [F.lit(x) for pair in ISSUE_STATUS.items() for x in pair]
    mode = F.when(F.col("wanted_checkpoint_key").isNull(), "latest_checkpoint").otherwise(
        "explicit_checkpoint_identity"
    )
    judged = evaluate_once(
        joined,
        [request, ref, "task_identity_key", "stream", "__entry"],
        {
            "mode": mode,
            "exclusive_after_cursor": F.when(kind == "cursor_v1", cursor),
            "issue_code": issue,
        },
    )
    return judged.select(
        request,
        ref,
        "mode",
        "task_identity_key",
        "stream",
        *[F.col(f"__entry.{f}").alias(f) for f in fields[:4]],
        "exclusive_after_cursor",
        "issue_code",
        F.try_element_at(F.create_map(*pairs), F.col("issue_code")).alias("issue_status"),
    )


def resume_provenance(
    selection: DataFrame, execution_mode: str = "batch", task_id: str | None = None
) -> DataFrame:
    """Run provenance of the requests that can resume, and their continuation."""
    ready = selection.filter(F.col("issue_code").isNull())
    return ready.withColumn(
        "provenance",
        F.struct(
            F.lit("resume").alias("run_origin"),
            F.lit("primary").alias("delivery_origin"),
            F.lit(execution_mode).alias("execution_mode"),
            (F.col(task_id) if task_id else F.lit(None).cast("string")).alias("task_id"),
            F.col("checkpoint_identity_key").alias("checkpoint_identity_key"),
            F.col("task_identity_key").alias("task_identity_key"),
        ),
    ).withColumn(
        "resume",
        F.struct(
            F.col("checkpoint_identity_key").alias("checkpoint_identity_key"),
            F.col("progress_kind").alias("progress_kind"),
            F.col("exclusive_after_cursor").alias("exclusive_after_cursor"),
        ),
    )


def resume_filter(
    records: DataFrame,
    states: DataFrame,
    selection: DataFrame,
    keys: Sequence[str],
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records, states and blocked requests of a resume.

    Records after the selected cursor stay (cursors compare as texts), and so do
    states.  One record without an emit time, or one state without a cursor,
    blocks its whole resume.  Logs do not resume.  ``selection`` has one row per
    task, and a task may own a large part of the records.
    """
    at = list(keys)
    flags = (
        records.groupBy(*at)
        .agg(F.bool_or(F.col("emitted_at").isNull()).alias("__no_emit"))
        .join(
            states.groupBy(*at).agg(
                F.bool_or(
                    J.filled_string_at(J.parse(F.col("data")), "$.cursor").isNull()
                ).alias("__no_cursor")
            ),
            at,
            "full",
        )
    )
    chosen = selection.filter(F.col("issue_code").isNull()).select(
        *at, F.col("exclusive_after_cursor").alias("__after")
    )
    judged = chosen.join(flags, at, "left").withColumn(
        "issue_code",
        F.when(F.coalesce("__no_emit", F.lit(False)), "missing_record_emitted_at").when(
            F.coalesce("__no_cursor", F.lit(False)), "missing_state_cursor"
        ),
    )
    blocked = judged.filter(F.col("issue_code").isNotNull()).select(
        *at, "issue_code", F.lit("blocked").alias("issue_status")
    )
    open_ = judged.filter(F.col("issue_code").isNull()).select(*at, "__after")

    def after(df: DataFrame, cursor: Column) -> DataFrame:
        joined = df.join(open_, at)
        return joined.filter(cursor > F.col("__after")).select(*df.columns)

    kept_records = after(records, F.col("emitted_at"))
    kept_states = after(states, J.filled_string_at(J.parse(F.col("data")), "$.cursor"))
    return kept_records, kept_states, blocked
