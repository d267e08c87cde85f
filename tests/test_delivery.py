from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.deadletters import (
    prune_dlq,
    replay_apply,
    replay_run_meta,
    replay_select,
    replay_text,
)
from millrace.operators.delivery import (
    artifact_paths,
    content_evidence,
    evidence_from_stored,
    text_evidence,
    timestamp_ns,
    upsert_rows,
)
from millrace.operators.failures import classify_batch_items, run_outcomes
from millrace.operators.receipts import fanout, receipt_details, receipt_summary
from millrace.operators.reports import batch_counts, duration_stats
from millrace.operators.audit import audit_payloads
from millrace.operators.tasks import (
    apply_acks,
    enqueue,
    explain_tasks,
    inspect_tasks,
    recover_stale,
    requeue,
)
from millrace.plans.replay import replay_store
from millrace.schemas import DEAD_LETTERS, RECEIPTS, TASK_STATE


def test_text_evidence_counts_code_points(spark):
    texts = [("x" * 16384,), ("é" * 16385,), (None,), ("",)]
    rows = text_evidence(spark.createDataFrame(texts, "normalized_text string")).collect()
    assert [r.normalized_text_truncated for r in rows] == [False, True, None, False]
    assert rows[1].normalized_text_len == 16385 and len(rows[1].normalized_text_preview) == 16384
    assert rows[2].normalized_text_status == "missing"


def test_record_evidence_previews_ten(spark):
    elements = spark.range(25).select(
        F.lit("d").alias("k"),
        F.lit("StructuredRecord").alias("type"),
        F.struct(F.lit(0).alias("kind"), F.col("id").alias("index")).alias("ord"),
        F.concat(F.lit('{"n":'), F.col("id").cast("string"), F.lit("}")).alias("data"),
    )
    log = spark.createDataFrame(
        [("d", "StructuredLog", (2, 0), None)],
        "k string, type string, ord struct<kind:int,index:long>, data string",
    )
    done = spark.createDataFrame(
        [("d", "t", True), ("e", "t", False)], "k string, normalized_text string, is_records boolean"
    )
    rows = {r.k: r for r in content_evidence(done, elements.unionByName(log), ["k"]).collect()}
    assert rows["d"].records_preview == ['{"n":%d}' % i for i in range(10)]
    assert (rows["d"].records_count, rows["d"].records_truncated) == (25, True)
    assert rows["d"].elements_count == 26
    assert rows["d"].structured_log_visibility == "available"
    assert rows["d"].structured_state_visibility == "not_available"
    assert rows["e"].elements_count == 0 and rows["e"].structured_log_visibility is None
    assert rows["e"].evidence_kind == "normalized_text_preview_v1"


def test_artifact_paths(spark):
    row = spark.range(1).select(artifact_paths("/o/", F.lit("s"), F.lit(False)).alias("p")).first().p
    assert row.normalized_path == "/o/s/normalized.txt" and row.records_path is None


@pytest.mark.parametrize(
    ("text", "ns"),
    [
        ("2026-01-01T00:00:00Z", 1767225600 * 10**9),
        ("2026-01-01T00:00:00", 1767225600 * 10**9),
        ("2026-01-01T02:00:00.000001+02:00", 1767225600 * 10**9 + 1000),
        ("nonsense", None),
    ],
)
def test_timestamp_ns(spark, text, ns):
    got = spark.range(1).select(timestamp_ns(F.lit(text)).alias("v")).first().v
    assert got == (None if ns is None else str(ns))


def test_upsert_twice_is_once(spark):
    schema = "identity_key string, sha256 string, payload_json string, delivered_at_utc string"
    old = spark.createDataFrame([("a", "s", "old", "1"), ("z", "s", "kept", "1")], schema)
    new = spark.createDataFrame(
        [("a", "s", "x", "2"), ("a", "s", "y", "3"), ("b", "s", "n", "2")], schema
    )
    once = upsert_rows(old, new)
    got = {r.identity_key: (r.payload_json, r.operation) for r in once.collect()}
    assert got == {
        "a": ("y", "upsert_replaced"),
        "b": ("n", "upsert_inserted"),
        "z": ("kept", "unchanged"),
    }
    twice = upsert_rows(once.drop("operation"), new)
    assert {r.identity_key: r.payload_json for r in twice.collect()} == {
        k: v[0] for k, v in got.items()
    }


def receipts(spark, *rows):
    return spark.createDataFrame([("s", "r", *row) for row in rows], RECEIPTS)


def test_fanout_keeps_only_agreed_details(spark):
    children = receipts(
        spark,
        ("webhook", False, 3, True, "server_error", "ZE-DELIVERY-HTTP-FAILED"),
        ("kafka", False, 1, True, "timeout", "ZE-DELIVERY-HTTP-FAILED"),
        ("filesystem", True, None, None, None, None),
        ("loki", False, 2, None, "http_error", None),
    )
    row = fanout(children, ["sha256"]).first()
    assert (row.ok, row.child_count, row.ok_children, row.failed_children) == (False, 4, 1, 3)
    assert (row.attempts, row.retryable, row.failure_kind) == (3, True, None)
    assert row.error_code == "ZE-DELIVERY-HTTP-FAILED"


def test_receipt_summary_of_odd_details(spark):
    details = spark.createDataFrame(
        [
            ('{"attempts":0,"retryable":"true","failure_kind":"http_error"}', False),
            ('{"attempts":4,"retryable":false,"failure_kind":"locked"}', False),
            (None, False),
            ('{"retryable":true,"failure_kind":"timeout"}', True),
        ],
        "details string, ok boolean",
    )
    rows = receipt_summary(receipt_details(details)).collect()
    assert [r.failure_retryability for r in rows] == [
        "unknown",
        "non_retryable",
        "unknown",
        "not_failed",
    ]
    assert [r.shared_failure_kind for r in rows] == ["unknown", "locked", "unknown", "not_failed"]
    assert [r.attempt_count for r in rows] == [1, 4, 1, 1]


def test_batch_items(spark):
    df = spark.createDataFrame(
        [("a", 0, 404), ("a", 1, 503), ("a", 2, 429), ("b", 0, None), ("c", 1, 422), ("c", 0, None)],
        "k string, position int, status_code int",
    )
    got = {r.k: (r.failure_kind, r.retryable) for r in classify_batch_items(df, ["k"]).collect()}
    assert got == {
        "a": ("server_error", True),
        "b": ("operational", True),
        "c": ("constraint", False),
    }


def test_run_outcomes(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, False, "X", True),
            ("a", 2, True, None, None),
            ("b", 1, False, "ZE-UNS-UNSUPPORTED-TYPE", False),
            ("c", 1, False, "X", True),
            ("c", 2, False, "X", True),
            ("c", 3, True, None, None),
        ],
        "k string, attempt int, ok boolean, error_code string, retryable boolean",
    )
    got = {r.k: (r.outcome, r.attempts) for r in run_outcomes(df, ["k"], 2).collect()}
    assert got == {"a": ("success", 2), "b": ("skipped_unsupported", 1), "c": ("failed", 2)}
    once = {r.k: r.outcome for r in run_outcomes(df, ["k"], 9, False, False).collect()}
    assert once == {"a": "failed", "b": "failed", "c": "failed"}


@pytest.mark.parametrize("n", [0, 1, 2, 19, 20, 21, 100, 777])
def test_duration_stats_follow_the_rank_rule(spark, n):
    rng = random.Random(n)
    values = [rng.randint(0, 20_000) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "ms long")
    row = duration_stats(df, ["ms"]).first()
    if not values:
        assert (row.min, row.max, row.avg, row.p95) == (None, None, None, None)
        return
    rank = (n * 95 + 99) // 100
    assert (row.min, row.max) == (min(values), max(values))
    assert row.avg == sum(values) // n and row.p95 == sorted(values)[rank - 1]


def test_counts_add_up(spark):
    df = spark.createDataFrame(
        [(o,) for o in ("success", "failed", "skipped_existing", "odd", None)], "outcome string"
    ).fillna("failed")
    row = batch_counts(df).first()
    parts = row.success + row.failed + row.skipped_unsupported + row.skipped_existing
    assert row.total == parts == 5


def prune_by_hand(files, threshold, limit_bytes, keep, per_destination):
    protected = set()
    groups = {}
    for f in files:
        groups.setdefault(f["destination"] if per_destination else "", []).append(f)
    for group in groups.values():
        newest = sorted(group, key=lambda f: f["mtime"], reverse=True)
        protected |= {f["name"] for f in newest[:keep]}
    chosen = {f["name"] for f in files if f["name"] not in protected and f["mtime"] < threshold}
    aged = set(chosen)
    excess = sum(f["size"] for f in files) - limit_bytes
    if excess > 0:
        freed = sum(f["size"] for f in files if f["name"] in chosen)
        rest = [f for f in files if f["name"] not in protected and f["name"] not in chosen]
        for f in sorted(rest, key=lambda f: f["mtime"]):
            if freed >= excess:
                break
            chosen.add(f["name"])
            freed += f["size"]
    return protected, aged, chosen


@pytest.mark.parametrize("seed", range(4))
def test_prune_equals_the_sequential_rule(spark, seed):
    rng = random.Random(seed)
    now, mega = 2_000_000_000, 1024 * 1024
    files = []
    for i in range(300):
        # A third of the letters share one second.
        mtime = now - 3 * 86_400 if i % 3 == 0 else now - rng.randint(0, 20 * 86_400)
        files.append(
            {
                "name": f"{rng.randrange(16**8):08x}-{i}",
                "state": rng.choice(["pending", "done"]),
                "mtime": mtime,
                "size": rng.randint(1, 200_000),
                "destination": rng.choice(["a", "b"]),
            }
        )
    files.sort(key=lambda f: (f["state"] != "pending", f["name"]))
    df = spark.createDataFrame(
        [
            (f["name"], f["state"], f["mtime"], f["size"], f["destination"], "s", "r", "{}")
            for f in files
        ],
        DEAD_LETTERS,
    )
    limit = rng.choice([0, 5, 12, 500])
    per = seed % 2 == 0
    plan, stats = prune_dlq(df, 7, now, True, True, limit, 6, per, True)
    protected, aged, chosen = prune_by_hand(files, now - 7 * 86_400, limit * mega, 6, per)
    rows = plan.collect()
    assert {r.name for r in rows if r.protected} == protected
    assert {r.name for r in rows if r.by_age} == aged
    assert {r.name for r in rows if r.selected} == chosen
    assert {r.name for r in rows if r.new_state == "pruned"} == chosen
    s = stats.first()
    assert (s.scanned, s.selected, s.moved) == (300, len(chosen), len(chosen))
    assert s.skipped == 300 - len(chosen) - len(protected)
    assert s.selected_by_size == len(chosen) - len(aged)


def test_prune_dry_run(spark):
    now = 2_000_000_000
    day = 86_400
    df = spark.createDataFrame(
        [
            ("x", "done", now - 10 * day, 5, "w", "s", "r", "{}"),
            ("y", "done", now - day, 5, "w", "s", "r", "{}"),
            ("z", "pending", now - 10 * day, 5, "w", "s", "r", "{}"),
        ],
        DEAD_LETTERS,
    )
    _, stats = prune_dlq(df, 7, now)
    row = stats.first()
    assert (row.scanned, row.selected, row.moved) == (2, 1, 0)
    with pytest.raises(ValueError):
        prune_dlq(df, 0, now)


def letters(spark):
    meta = json.dumps({"engine": {"name": "e"}, "provenance": {"run_origin": "bad", "task_id": "t", "x": 1}})
    rows = [(f"n{i}", "pending", 0, 1, "w", "s" if i else None, "r", meta) for i in range(4)]
    rows.append(("n1", "done", 0, 1, "w", "s", "r", meta))
    return spark.createDataFrame(rows, DEAD_LETTERS)


def test_replay_provenance(spark):
    df = spark.createDataFrame(
        [('{"a":1,"provenance":{"run_origin":"resume","execution_mode":"odd","task_id":5}}',)],
        "m string",
    )
    got = json.loads(df.select(replay_run_meta(F.col("m")).alias("v")).first().v)
    assert got == {"a": 1, "provenance": {"run_origin": "resume", "delivery_origin": "replay"}}


def test_replay_twice_is_once(spark):
    store = letters(spark)
    selected = replay_select(store)
    answers = spark.createDataFrame([("n1", True), ("n2", False), ("n3", True)], "name string, ok boolean")
    after, stats = replay_apply(store, selected, answers)
    s = stats.first()
    assert (s.total, s.succeeded, s.failed, s.moved_to_done, s.status) == (4, 2, 2, 2, "failed")
    again, _ = replay_apply(after, replay_select(after), answers.filter("name = 'none'"))
    count = lambda df: sorted((r.name, r.state) for r in df.collect())
    assert count(again) == count(after)
    _, dry = replay_apply(store, selected, answers, dry_run=True)
    d = dry.first()
    assert (d.attempted, d.succeeded, d.failed, d.status) == (4, 0, 1, "observed")
    assert [r.name for r in replay_select(store, 2).orderBy("name").collect()] == ["n0", "n1"]


def test_replay_store_sends_each_payload_once(spark):
    stored = spark.createDataFrame(
        [("s", "text", "[1]", None, False)],
        "sha256 string, normalized_text string, elements_json string, record_lines string, is_records boolean",
    )

    def send(payloads):
        assert "payload_json" in payloads.columns
        return payloads.select("name", F.lit(True).alias("ok"))

    after, stats = replay_store(letters(spark), stored, "/o", send)
    s = stats.first()
    assert (s.total, s.succeeded, s.failed) == (4, 3, 1)
    assert after.filter("state = 'pending'").count() == 1


def test_large_elements_are_counted(spark):
    """A list larger than one variant may be, and one string longer than a parser's default."""

    def listed(length, times):
        text = F.concat(F.lit('{"text":"'), F.repeat(F.col("x"), length), F.lit('"}'))
        return F.concat(F.lit("["), F.array_join(F.array_repeat(text, times), ","), F.lit("]"))

    stored = spark.createDataFrame([(i, "x") for i in range(6)], "k int, x string").select(
        "k",
        F.when(F.col("k") < 5, "whole").alias("normalized_text"),
        F.when(F.col("k") == 0, listed(1_000_000, 140))
        .when(F.col("k") == 1, listed(20_500_000, 1))
        .when(F.col("k") == 2, '[1,{"a":[2]},null,"b",1e400] x')
        .when(F.col("k") == 3, '[1,{"a":[2]},null,"b",1e400]')
        .when(F.col("k") == 4, "[1],[2]")
        .alias("elements_json"),
        F.when(
            F.col("k") == 5,
            F.concat(F.lit('{"data":{"t":"'), F.repeat(F.col("x"), 20_500_000), F.lit('"}}')),
        ).alias("record_lines"),
        (F.col("k") == 5).alias("is_records"),
    )
    sent = replay_text(stored).withColumn("chars", F.length("replay_text"))
    got = {r.k: (r.chars, r.replay_count, r.reason) for r in sent.drop("x", "replay_text").collect()}
    assert got == {
        0: (5, 140, None),
        1: (5, 1, None),
        2: (None, None, "invalid_elements_json"),
        3: (5, 5, None),
        4: (None, None, "invalid_elements_json"),
        5: (20_500_009, 1, None),
    }
    seen = evidence_from_stored(stored).select("k", "elements_count", "records_status").collect()
    assert {r.k: r.elements_count for r in seen} == {0: 140, 1: 1, 2: None, 3: 5, 4: None, 5: None}
    assert {r.records_status for r in seen} == {None, "available"}


def task(name, bucket, failures=0, orphans=0, claimed=None):
    return (name, bucket, "{}", failures, orphans, claimed, 1.0, 2.0, [])


def state_of(df):
    return {r.task_id: (r.bucket, r.failure_count, r.orphan_count) for r in df.collect()}


def test_acks_and_recovery(spark):
    df = spark.createDataFrame(
        [
            task("ok", "inflight"),
            task("fail1", "inflight", 1),
            task("fail2", "inflight", 2),
            task("orphan", "inflight", 0, 1, 5.0),
            task("idle", "pending"),
        ],
        TASK_STATE,
    )
    acks = spark.createDataFrame(
        [("ok", 2, "failure"), ("ok", 1, "success"), ("fail1", 1, "failure"),
         ("fail2", 1, "failure"), ("idle", 1, "success")],
        "task_id string, at long, ack string",
    )
    got = state_of(apply_acks(df, acks, F.lit(9.0)))
    assert got["ok"] == ("done", 0, 0)
    assert got["fail1"] == ("pending", 2, 0) and got["fail2"] == ("poison", 3, 0)
    assert got["idle"] == ("pending", 0, 0) and got["orphan"] == ("inflight", 0, 1)
    assert state_of(recover_stale(df, 5, 10.0))["orphan"] == ("poison", 0, 2)
    assert state_of(recover_stale(df, 6, 10.0))["orphan"] == ("inflight", 0, 1)


def test_enqueue_and_requeue(spark):
    df = spark.createDataFrame(
        [task("a", "poison", 3, 1), task("b", "done"), task("c", "inflight", 1, 0, 4.0)], TASK_STATE
    )
    new = spark.createDataFrame(
        [("a", "{}", 1), ("n", "{}", 2), ("n", "{}", 3)], "task_id string, task_json string, seq long"
    )
    after, rejected = enqueue(df, new, F.lit(7))
    assert state_of(after)["n"] == ("pending", 0, 0) and after.count() == 4
    assert sorted((r.task_id, r.seq) for r in rejected.collect()) == [("a", 1), ("n", 3)]
    asked = spark.createDataFrame(
        [("a", "poison"), ("b", "done"), ("c", "poison"), ("zz", "poison")],
        "task_id string, source_bucket string",
    )
    moved, results = requeue(df, asked, F.lit(8.0))
    assert state_of(moved)["a"] == ("pending", 3, 1) and state_of(moved)["c"][0] == "inflight"
    assert {r.task_id: r.result for r in results.collect()} == {
        "a": "moved_to_pending",
        "b": "source_bucket_not_recoverable",
        "c": "task_not_found_in_source_bucket",
        "zz": "task_not_found_in_source_bucket",
    }
    told = {r.task_id: r for r in explain_tasks(moved).collect()}
    assert told["a"].governance_labels == ["orphaned", "requeued"]
    assert told["a"].governance_problem == "orphaned"
    assert told["a"].recovery_audit_support == "persisted_in_history"
    listed, summary = inspect_tasks(moved, "pending", 1)
    row = summary.first()
    assert listed.count() == 1 and (row.pending, row.listed_tasks) == (1, 1)
    assert row.recovery_audit_support == "persisted_in_history"


def test_repeated_requests_move_a_task_once(spark):
    df = spark.createDataFrame(
        [task("a", "poison", 3, 1), task("b", "inflight", 1, 0, 4.0), task("c", "done")], TASK_STATE
    )
    asked = spark.createDataFrame(
        [("a", "poison"), ("a", "poison"), ("a", "inflight"), ("b", "poison"), ("c", "done"), ("x", "poison")],
        "task_id string, source_bucket string",
    )
    after, results = requeue(df, asked, F.lit(8.0))
    assert sorted((r.task_id, r.bucket) for r in after.collect()) == [
        ("a", "pending"),
        ("b", "inflight"),
        ("c", "done"),
    ]
    assert {(r.task_id, r.source_bucket): r.result for r in results.collect()} == {
        ("a", "poison"): "moved_to_pending",
        ("a", "inflight"): "task_not_found_in_source_bucket",
        ("b", "poison"): "task_not_found_in_source_bucket",
        ("c", "done"): "source_bucket_not_recoverable",
        ("x", "poison"): "task_not_found_in_source_bucket",
    }


def test_audit_looks_at_string_values(spark):
    def found(token, record):
        payload = json.dumps(
            {"content_evidence": {"normalized_text_preview": "", "records_preview": [record]}}
        )
        payloads = spark.createDataFrame([("d", payload)], "delivery_identity string, payload_json string")
        expected = spark.createDataFrame(
            [("d", "s", "r", "it", token)],
            "delivery_identity string, sha256 string, run_id string, flow string, token string",
        )
        return audit_payloads(payloads, expected, "token").first().token_pass

    record = {"code": "x", "deep": [{"n": 5, "t": ['say "hi": ok']}]}
    assert found('"hi"', record) and found("x", record) and found("hi\": o", record)
    assert not found("code", record) and not found("deep", record) and not found("{", record)
    assert not found("5", record)
