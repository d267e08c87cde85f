"""Governance receipts, evidence checks, payload read-back and repository scans."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import jsontext as J
from millrace.functions.binding import evaluate_once
from millrace.functions import textrules

RECEIPT_SCHEMA_VERSION = 1
PAYLOAD_SCHEMA_VERSION = 1
LINES_BEFORE = 5
LINES_AFTER = 2

# Wording that marks a line as a statement about scope.
NEGATIVE_MARKERS = (
    "not_claimed",
    "intentionally_not_claimed",
    "deferred_or_not_claimed",
    "must_not_include",
    "non_billing",
    "usage_not_billing",
    "governance_not_rbac",
    "technical_capability_domain_not_entitlement",
    "technical domains, not entitlement",
    "not billing",
    "not pricing",
    "not entitlement",
    "not rbac",
    "not cloud",
    "not kubernetes",
    "not helm",
    "not multi-tenant",
    "not saas",
    "not installer",
    "not gui",
    "not full",
    "not exhaustive",
    "must not",
    "do not",
    "forbidden",
    "forbid",
    "excluded",
    "deferred",
)
# Wording around a term that makes a hit a false one.
FALSE_POSITIVES = {
    "checkout": (
        "actions/checkout",
        "sparse-checkout",
        "checkout state",
        "ambient checkout",
    ),
    "subscription": ("subscription selector",),
}
# Wording of a line that pulls something in.
IMPORT_MARKERS = ("import ", "from ", "require(", "package", "dependency", "module")
# Wording of a boundary note.
BOUNDARY_NOTES = ("must not", "not ", "forbidden", "boundary", "draft", "only", "cannot")
BLOCKED_CONTEXTS = {
    "runtime": ("packages", "runtime"),
    "connector": ("packages", "runtime", "connector"),
    "core_contract": ("packages", "core_contract"),
}


# What a governance receipt does not claim.
GOVERNANCE_NOT_CLAIMED = (
    "billing",
    "pricing",
    "license entitlement",
    "RBAC approval workflow",
    "multi-operator collaboration platform",
    "distributed governance platform",
)
#: Who looks after a hit in each kind of file.
OWNERS = {
    "boundary_doc": "boundary-owner",
    "historical_doc": "docs-owner",
    "tooling": "tooling-owner",
    "test_fixture": "test-owner",
    "core_contract": "core-owner",
    "connector": "connector-owner",
    "runtime": "runtime-owner",
    "other": "repo-owner",
}


def governance_receipts(actions: DataFrame) -> DataFrame:
    """Receipt rows of operator actions, linked to what they touched.

    ``actions`` has ``evidence_refs`` (an array of kind and ref), or ``evidence_kind``
    and ``evidence_ref`` for one reference.
    """
    links = (
        "task_id",
        "run_id",
        "task_identity_key",
        "checkpoint_identity_key",
        "usage_record_ref",
        "source_contract_id",
    )
    present = set(actions.columns)

    def column(name: str) -> Column:
        return F.col(name) if name in present else F.lit(None).cast("string")

    if "evidence_refs" in present:
        references = F.col("evidence_refs")
    else:
        one = F.struct(
            column("evidence_kind").alias("kind"), column("evidence_ref").alias("ref")
        )
        references = F.filter(F.array(one), lambda r: r["ref"].isNotNull())
    return actions.select(
        F.lit(RECEIPT_SCHEMA_VERSION).alias("schema_version"),
        F.lit("governance_action_receipt_v1").alias("record_kind"),
        *[
            column(c).alias(c)
            for c in (
                "action_id",
                "action_kind",
                "action_category",
                "recorded_at_utc",
                "status",
                "audit_support",
            )
        ],
        F.lit("local_artifact").alias("persistence_scope"),
        column("recovery_kind").alias("recovery_kind"),
        F.struct(*[column(c).alias(c) for c in links]).alias("linkage"),
        references.alias("evidence_refs"),
        column("result_summary").alias("result_summary"),
        _literal_array(GOVERNANCE_NOT_CLAIMED).alias("not_claimed"),
    )


def verify_evidence(
    expected: DataFrame, present: DataFrame, keys: Sequence[str], ref: str = "evidence_ref"
) -> tuple[DataFrame, DataFrame]:
    """Missing evidence rows, and one verdict per action.

    Missing references stay rows, so an action may expect any number of them.
    """
    missing = expected.join(present.select(ref).distinct(), ref, "left_anti").select(*keys, ref)
    checked = expected.groupBy(*keys).agg(F.count(F.lit(1)).alias("checked_evidence_count"))
    absent = missing.groupBy(*keys).agg(F.count(F.lit(1)).alias("__missing"))
    verdict = checked.join(absent, list(keys), "left").select(
        *keys,
        "checked_evidence_count",
        F.coalesce("__missing", F.lit(0)).alias("missing_evidence_count"),
        F.when(F.col("__missing") > 0, "failed").otherwise("passed").alias("verification_result"),
        F.when(F.col("__missing") > 0, "failed").otherwise("succeeded").alias("status"),
    )
    return missing, verdict


def backfill_governance(evidence: DataFrame, ref: str, text: str) -> DataFrame:
    """Receipts rebuilt from historical evidence, or why there is not enough of it."""
    e = F.col("__e")
    task = J.string_at(e, "$.task_id")
    requeued = (J.string_at(e, "$.action") == "requeue") & task.isNotNull()
    replayed = (
        (J.string_at(e, "$.run_meta.provenance.delivery_origin") == "replay")
        & J.string_at(e, "$.run_id").isNotNull()
    )
    kind = F.when(F.coalesce(requeued, F.lit(False)), "requeue").when(
        F.coalesce(replayed, F.lit(False)), "replay_delivery"
    )
    readable = F.coalesce(J.is_object(e), F.lit(False))
    is_requeue = F.col("action_kind") == "requeue"
    is_replay = F.col("action_kind") == "replay_delivery"
    return (
        evidence.select(ref, J.parse(F.col(text)).alias("__e"))
        .withColumn("action_kind", kind)
        .select(
            F.col(ref).alias("evidence_ref"),
            F.when(F.col("action_kind").isNotNull(), "receipt_written")
            .otherwise("insufficient_evidence")
            .alias("backfill_status"),
            "action_kind",
            F.when(~readable, "missing_or_non_object_json")
            .when(F.col("action_kind").isNull(), "no_supported_requeue_or_replay_evidence")
            .alias("reason"),
            F.when(is_requeue, "requeue").when(is_replay, "replay").alias("recovery_kind"),
            F.when(is_requeue, task)
            .when(is_replay, J.string_at(e, "$.run_meta.provenance.task_id"))
            .alias("task_id"),
            F.when(is_replay, J.string_at(e, "$.run_id")).alias("run_id"),
            F.when(is_requeue, J.string_at(e, "$.task_identity_key")).alias("task_identity_key"),
            F.when(is_requeue, J.string_at(e, "$.source_contract_id")).alias(
                "source_contract_id"
            ),
            F.when(is_requeue, "historical_requeue_evidence")
            .when(is_replay, "historical_replay_evidence")
            .alias("evidence_kind"),
            F.when(F.col("action_kind").isNotNull(), "observed").alias("status"),
        )
    )


def audit_payloads(
    payloads: DataFrame, expected: DataFrame, token: str, on: str = "delivery_identity"
) -> DataFrame:
    """Read-back check of delivered payloads.

    ``expected`` has ``sha256``, ``run_id``, ``flow`` and the column ``token``
    under the join key; ``payloads`` has ``payload_json``.  The token is looked for in
    the preview text and in the string values of the previewed records.
    """
    p = F.col("__p")
    text = J.string_at(p, "$.content_evidence.normalized_text_preview")
    records = F.try_variant_get(p, "$.content_evidence.records_preview", "array<variant>")
    in_text = F.coalesce(text.contains(F.col(token)), F.lit(False))
    in_records = F.coalesce(
        F.exists(
            records, lambda r: F.exists(J.string_values(r), lambda v: v.contains(F.col(token)))
        ),
        F.lit(False),
    )
    has_evidence = J.is_object(p, "$.content_evidence")
    is_records = F.col("flow") == "it"
    located = F.coalesce(J.string_at(p, "$.artifacts.state_path"), F.lit(None)).isNotNull() & (
        J.string_at(p, "$.artifacts.logs_path").isNotNull()
    )
    core = (
        (F.coalesce(J.integer_at(p, "$.schema_version"), F.lit(-1)) == PAYLOAD_SCHEMA_VERSION)
        & F.coalesce(J.string_at(p, "$.sha256") == F.col("__sha"), F.lit(False))
        & F.coalesce(J.string_at(p, "$.run_meta.run_id") == F.col("__run"), F.lit(False))
        & J.string_at(p, "$.run_meta.engine.name").isNotNull()
        & J.is_object(p, "$.run_meta.metrics")
        & J.is_object(p, "$.run_meta.provenance")
        & has_evidence
    )
    wanted = expected.select(
        on, F.col("sha256").alias("__sha"), F.col("run_id").alias("__run"), "flow", token
    )
    joined = wanted.join(
        payloads.select(on, J.parse(F.col("payload_json")).alias("__p")), on, "left"
    )
    found = p.isNotNull()
    return joined.select(
        on,
        found.alias("delivery_locator_found"),
        found.alias("delivery_payload_visible"),
        F.when(found & ~has_evidence, "content_evidence_missing").otherwise("").alias("note"),
        (found & has_evidence).alias("content_evidence_found"),
        F.when(found & has_evidence, F.coalesce(J.string_at(p, "$.content_evidence.evidence_kind"), F.lit("unknown")))
        .otherwise("missing")
        .alias("evidence_kind"),
        in_text.alias("normalized_text_preview_found"),
        in_records.alias("records_preview_found"),
        (in_text | (is_records & in_records)).alias("token_pass"),
        (found & core).alias("delivery_payload_core_metadata_check"),
        F.when(~is_records, "not_applicable")
        .when(~J.is_object(p, "$.artifacts"), "not_checked")
        .when(located, "artifact_paths_only")
        .otherwise("not_available")
        .alias("structured_state_log_status"),
    )


def audit_vectors(
    objects: DataFrame, expected: DataFrame, token: str, on: str = "uuid"
) -> DataFrame:
    """Read-back check of vector objects, which hold the normalized text itself.

    ``expected`` has the column ``token`` under the join key; ``objects`` has
    ``normalized_text``.  The result has the columns of :func:`audit_payloads`.
    """
    text = F.col("normalized_text")
    held = F.coalesce(text.contains(F.col(token)), F.lit(False))
    objects = objects.select(on, "normalized_text", F.lit(True).alias("__found"))
    return expected.select(on, token).join(objects, on, "left").select(
        on,
        F.coalesce("__found", F.lit(False)).alias("delivery_locator_found"),
        F.lit(False).alias("delivery_payload_visible"),
        F.lit("vector_object_holds_normalized_text").alias("note"),
        text.isNotNull().alias("content_evidence_found"),
        F.lit("normalized_text_projection_v1").alias("evidence_kind"),
        held.alias("normalized_text_preview_found"),
        F.lit(False).alias("records_preview_found"),
        held.alias("token_pass"),
        F.lit(False).alias("delivery_payload_core_metadata_check"),
        F.lit("not_checked").alias("structured_state_log_status"),
    )


@dataclass(frozen=True)
class Term:
    """One denied term and where it may not appear."""

    term: str
    category: str
    severity: str
    blocked_in: tuple[str, ...] = ()
    reason: str = ""


@dataclass(frozen=True)
class ContextRules:
    """How a path decides what kind of file it is; earlier fields win."""

    boundary_names: tuple[str, ...] = ()
    boundary_prefixes: tuple[str, ...] = ()
    doc_prefixes: tuple[str, ...] = ("docs/",)
    tooling_names: tuple[str, ...] = ()
    tooling_prefixes: tuple[str, ...] = ()
    fixture_folders: tuple[str, ...] = ("tests", "testing", "fixtures")
    core_prefixes: tuple[str, ...] = ()
    package_prefix: str = "packages/"
    source_folder: str = "/src/"
    connector_folders: tuple[str, ...] = field(
        default=("sources", "destinations", "connectors")
    )


def any_of(value: Column, options: Sequence[str], test: str) -> Column:
    """Whether a test of the column, such as ``contains``, holds for one of the options."""
    hit = F.lit(False)
    for option in options:
        hit = hit | getattr(value, test)(option)
    return hit


def context_kind(path: Column, rules: ContextRules) -> Column:
    name = textrules.base_name(path)
    parts = F.split(path, "/")

    def inside(folders: Sequence[str]) -> Column:
        return F.arrays_overlap(parts, F.array(*[F.lit(f) for f in folders]))

    in_source = path.startswith(rules.package_prefix) & path.contains(rules.source_folder)
    return (
        F.when(
            any_of(name, rules.boundary_names, "eqNullSafe")
            | any_of(path, rules.boundary_prefixes, "startswith"),
            "boundary_doc",
        )
        .when(any_of(path, rules.doc_prefixes, "startswith"), "historical_doc")
        .when(
            any_of(name, rules.tooling_names, "eqNullSafe")
            | any_of(path, rules.tooling_prefixes, "startswith"),
            "tooling",
        )
        .when(inside(rules.fixture_folders), "test_fixture")
        .when(any_of(path, rules.core_prefixes, "startswith"), "core_contract")
        .when(in_source & inside(rules.connector_folders), "connector")
        .when(in_source, "runtime")
        .otherwise("other")
    )


def _literal_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def denylist_scan(
    docs: DataFrame,
    terms: Sequence[Term],
    path: str = "path",
    text: str = "text",
    rules: ContextRules | None = None,
    owners: Mapping[str, str] = OWNERS,
) -> DataFrame:
    """Every (line, term) hit of a denylist, ignoring case.

    The class of a hit depends on the kind of file and on the lines around it
    (five before, two after).  Terms are configuration and are compiled into the
    expression; lines are examined inside the document's own row, whole texts
    included, so the scan has no shuffle and no join.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(t.term).alias("term"),
                F.lit(t.term.lower()).alias("needle"),
                F.lit(t.category).alias("category"),
                F.lit(t.severity).alias("severity"),
                F.lit(t.reason).alias("reason"),
                _literal_array(t.blocked_in).alias("blocked_in"),
            )
            for t in terms
        ]
    )
    needles = [t.term.lower() for t in terms]
    excused = {t.term: FALSE_POSITIVES[t.term] for t in terms if t.term in FALSE_POSITIVES}

    def wording(lowered: Column) -> Column:
        """What a line says that matters to its neighbours; no marker spans lines."""
        excuses = [
            any_of(lowered, options, "contains").alias(name) for name, options in excused.items()
        ]
        negative = any_of(lowered, NEGATIVE_MARKERS, "contains")
        return F.struct(negative.alias("negative"), *excuses)

    def line_hits(lowered: Column, i: Column) -> Column:
        """Terms on a line with what is said around it; lines without a term are left early."""
        start = F.greatest(i - LINES_BEFORE, F.lit(0))
        near = F.slice(F.col("__wording"), start + 1, i - start + 1 + LINES_AFTER)
        found = F.filter(entries, lambda t: lowered.contains(t["needle"]))

        def said_near(name: str) -> Column:
            return F.exists(near, lambda w: w[name])

        def excuse(term: Column) -> Column:
            hit = F.lit(False)
            for name in excused:
                hit = hit | ((term == name) & said_near(name))
            return hit

        return F.when(
            lowered.rlike("|".join(re.escape(n) for n in needles)),
            F.transform(
                found,
                lambda t: F.struct(
                    (i + 1).alias("line"),
                    t["term"].alias("term"),
                    t["category"].alias("category"),
                    t["severity"].alias("severity"),
                    t["reason"].alias("reason"),
                    t["blocked_in"].alias("blocked_in"),
                    F.exists(near, lambda w: w["negative"]).alias("negative"),
                    excuse(t["term"]).alias("excused"),
                    F.trim(F.get(F.col("__lines"), i)).alias("text"),
                ),
            ),
        ).otherwise(F.array())

    listed = (
        docs.withColumn("__lines", textrules.lines_of(F.col(text)))
        .withColumn("__lowered", F.transform("__lines", F.lower))
        .withColumn("__wording", F.transform("__lowered", wording))
    )
    found_in = evaluate_once(
        listed,
        [path],
        {
            "context_kind": context_kind(F.col(path), rules or ContextRules()),
            "__hits": F.flatten(F.transform("__lowered", line_hits)),
        },
    )
    hits = found_in.select(
        F.col(path).alias("path"), "context_kind", F.explode("__hits").alias("h")
    ).filter(~F.col("h.excused"))
    return classified_hits(hits, owners)


def classified_hits(hits: DataFrame, owners: Mapping[str, str]) -> DataFrame:
    """Rows of a scan from ``path``, ``context_kind`` and ``h``, a hit and what stands near it."""
    kind = F.col("context_kind")
    blocked = F.lit(False)
    for name, contexts in BLOCKED_CONTEXTS.items():
        blocked = blocked | (
            (kind == name) & F.arrays_overlap("h.blocked_in", _literal_array(contexts))
        )
    classification = (
        F.when(kind == "boundary_doc", "allowed_boundary")
        .when(kind == "tooling", "allowed_tooling")
        .when(kind == "test_fixture", "allowed_fixture")
        .when(
            F.col("h.negative"),
            F.when(kind == "historical_doc", "allowed_boundary").otherwise("review_required"),
        )
        .when(blocked, "blocked")
        .otherwise("review_required")
    )
    owner = F.try_element_at(
        F.create_map(*[F.lit(x) for pair in owners.items() for x in pair]), kind
    )
    return hits.select(
        "path",
        "h.line",
        "h.term",
        "h.category",
        classification.alias("classification"),
        "h.severity",
        "h.reason",
        "context_kind",
        F.when(kind == "test_fixture", "test_fixture")
        .when(kind.isin("boundary_doc", "historical_doc"), "historical_text")
        .when(kind == "tooling", "tooling")
        .otherwise("actual_runtime_candidate")
        .alias("historical_or_fixture"),
        owner.alias("suggested_owner"),
        "h.text",
    )


def scan_summary(findings: DataFrame, docs: DataFrame) -> DataFrame:
    """One row of totals; any blocked hit of blocker severity fails the scan."""
    kind = F.col("classification")
    counts = findings.agg(
        F.count_if(kind == "allowed_boundary").alias("allowed_boundary_hits"),
        F.count_if(kind == "allowed_tooling").alias("allowed_tooling_hits"),
        F.count_if(kind == "allowed_fixture").alias("allowed_fixture_hits"),
        F.count_if(kind == "review_required").alias("review_required_hits"),
        F.count_if(kind == "blocked").alias("blocked_hits"),
        F.count_if((kind == "blocked") & (F.col("severity") == "blocker")).alias("blocker_count"),
    )
    scanned = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.select(
        scanned.alias("scanned_files"),
        "*",
        F.when(F.col("blocker_count") > 0, "fail").otherwise("pass").alias("overall"),
    )


@dataclass(frozen=True)
class ImportRule:
    """Patterns that files under some paths may not pull in."""

    rule_id: str
    source_paths: tuple[str, ...]
    forbidden_patterns: tuple[str, ...]
    severity: str
    reason: str = ""


def glob_regex(pattern: str) -> str:
    """Regex of a shell pattern in which ``*`` also matches slashes."""
    out = ""
    for token in re.findall(r"\[[^\]]+\]|.", pattern):
        if token == "*":
            out += ".*"
        elif token == "?":
            out += "."
        elif len(token) > 1:
            out += token.replace("[!", "[^")
        else:
            out += re.escape(token)
    return f"(?s)^{out}$"


def _matches(path: Column, patterns: Sequence[str]) -> Column:
    return path.rlike("|".join(f"(?:{glob_regex(p)})" for p in patterns))


def import_scan(
    docs: DataFrame, rules: Sequence[ImportRule], file_kind: Column,
    path: str = "path", text: str = "text",
) -> DataFrame:
    """Hits of forbidden patterns on lines that pull something in.

    ``file_kind`` is boundary, fixture, tool, package or other.  In a boundary
    file a note without an import is a hit as well.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(p).alias("pattern"),
                F.lit(p.lower()).alias("needle"),
                F.lit(r.rule_id).alias("rule_id"),
                F.lit(r.severity).alias("severity"),
                F.lit(r.reason).alias("reason"),
            )
            for r in rules
            for p in r.forbidden_patterns
        ]
    )
    needles = [p.lower() for r in rules for p in r.forbidden_patterns]

    def line_hits(lowered: Column, i: Column) -> Column:
        return F.when(
            lowered.rlike("|".join(re.escape(n) for n in needles)),
            F.transform(
                F.filter(entries, lambda t: lowered.contains(t["needle"])),
                lambda t: F.struct(
                    (i + 1).alias("line"),
                    t["pattern"].alias("pattern"),
                    t["rule_id"].alias("rule_id"),
                    t["severity"].alias("severity"),
                    t["reason"].alias("reason"),
                    any_of(lowered, IMPORT_MARKERS, "contains").alias("imports"),
                    any_of(lowered, BOUNDARY_NOTES, "contains").alias("note"),
                    F.trim(F.get(F.col("__lines"), i)).alias("text"),
                ),
            ),
        ).otherwise(F.array())

    listed = docs.withColumn("__lines", textrules.lines_of(F.col(text))).withColumn(
        "__lowered", F.transform("__lines", F.lower)
    )
    found_in = evaluate_once(
        listed,
        [path],
        {"__kind": file_kind, "__hits": F.flatten(F.transform("__lowered", line_hits))},
    )
    hits = found_in.select(F.col(path).alias("path"), "__kind", F.explode("__hits").alias("h"))
    kind = F.col("__kind")
    in_scope = F.lit(False)
    for r in rules:
        in_scope = in_scope | (
            (F.col("h.rule_id") == r.rule_id) & _matches(F.col("path"), r.source_paths)
        )
    classification = (
        F.when(
            ~F.col("h.imports"),
            F.when((kind == "boundary") & F.col("h.note"), "allowed_boundary"),
        )
        .when(kind == "boundary", "allowed_boundary")
        .when(kind == "fixture", "allowed_fixture")
        .when(in_scope & kind.isin("package", "tool"), "blocked")
        .otherwise("review_required")
    )
    return (
        hits.withColumn("classification", classification)
        .filter(F.col("classification").isNotNull())
        .select(
            "path",
            "h.line",
            "h.pattern",
            "h.rule_id",
            "classification",
            "h.severity",
            "h.reason",
            "h.text",
        )
    )


@dataclass(frozen=True)
class PathRule:
    """Paths that need a review, and who owns them."""

    rule_id: str
    path_patterns: tuple[str, ...]
    required_review: bool
    allowed_scope: str
    owner_hint: str


def path_rule_scan(
    paths: DataFrame, rules: Sequence[PathRule], path: str = "path",
    runtime_prefixes: Sequence[str] = ("packages/", "tools/"),
) -> DataFrame:
    """One row per path and matching rule, with its class and owner."""
    where = F.col(path)
    in_runtime = any_of(where, runtime_prefixes, "startswith")

    def verdict(r: PathRule) -> Column:
        allowed = r.allowed_scope in ("boundary_docs_only", "tooling_only")
        classification = (
            F.lit("boundary_tooling")
            if allowed
            else F.when(in_runtime, "blocked_runtime").otherwise("review_required")
        )
        return F.when(
            _matches(where, r.path_patterns),
            F.struct(
                F.lit(r.rule_id).alias("rule_id"),
                classification.alias("classification"),
                F.lit(r.required_review).alias("required_review"),
                F.lit(r.owner_hint).alias("owner_hint"),
                F.lit(r.allowed_scope).alias("allowed_scope"),
            ),
        )

    found = F.filter(F.array(*[verdict(r) for r in rules]), lambda v: v.isNotNull())
    judged = evaluate_once(paths, [path], {"__found": found})
    return judged.select(where.alias("path"), F.explode("__found").alias("v")).select(
        "path", "v.*"
    )


def path_scan_summary(findings: DataFrame, paths: DataFrame) -> DataFrame:
    kind = F.col("classification")
    counts = findings.agg(
        F.count_if(kind == "boundary_tooling").alias("sensitive_boundary_paths"),
        F.count_if(kind.isin("blocked_runtime", "review_required")).alias(
            "sensitive_runtime_paths"
        ),
        F.count_if(kind == "blocked_runtime").alias("blocked_runtime_paths"),
        F.count_if(kind == "review_required").alias("review_required_paths"),
    )
    scanned = paths.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.select(
        scanned.alias("scanned_files"),
        "*",
        F.when(F.col("blocked_runtime_paths") > 0, "fail").otherwise("pass").alias("overall"),
    )
