"""Streams with state: fan-out receipts with timers, evidence matched over two streams."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from millrace.catalog.streams import stream_of
from millrace.operators.audit import verify_evidence
from millrace.operators.receipts import fanout
from millrace.streaming.evidence import stream_evidence
from millrace.streaming.fanout import stream_fanout

CHILD = (
    "doc string, destination string, ok boolean, attempts int, retryable boolean, "
    "failure_kind string, error_code string, expected int, at timestamp"
)


def land(spark, folder, number, rows, schema):
    """One more file of a landed table."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder / f"{number:03}"))


def run(stream, out, checkpoint):
    (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", str(out)).option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True).start().awaitTermination()
    )


def read_stream(spark, folder, schema):
    return (
        spark.readStream.schema(schema).option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", "1").parquet(str(folder))
    )


def child(spark_rows, doc, destination, ok, at, expected=2, **details):
    facts = [details.get(c) for c in ("attempts", "retryable", "failure_kind", "error_code")]
    spark_rows.append((doc, destination, ok, *facts, expected, at))


def test_deliveries_close_by_answers_or_by_time(spark, tmp_path):
    """Late, missing, repeated and surplus children; the stream is restarted in between."""
    at = lambda minute: datetime.datetime(2026, 1, 1, minute // 60, minute % 60)
    first, second, third, last = [], [], [], []
    child(first, "both", "a", True, at(0), attempts=2)
    child(first, "failed", "a", False, at(0), attempts=3, retryable=True, failure_kind="timeout")
    child(first, "one", "a", True, at(1))
    child(first, "again", "a", False, at(1), attempts=1)
    child(second, "both", "b", True, at(5), attempts=1)
    child(second, "failed", "b", False, at(5), retryable=True, failure_kind="connection")
    child(second, "again", "a", True, at(6), attempts=4)
    child(third, "both", "c", False, at(8))  # already closed
    child(third, "again", "b", True, at(9))
    child(last, "clock", "a", True, at(600), expected=1)
    source, out, progress = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    for number, rows in enumerate((first, second)):
        land(spark, source, number, rows, CHILD)
    run(stream_fanout(read_stream(spark, source, CHILD), ["doc"]), out, progress)
    early = {r.doc for r in spark.read.parquet(str(out)).collect()}
    assert early == {"both", "failed"}
    for number, rows in enumerate((third, last), 2):
        land(spark, source, number, rows, CHILD)
    run(stream_fanout(read_stream(spark, source, CHILD), ["doc"]), out, progress)
    rows = spark.read.parquet(str(out)).collect()
    got = {r.doc: r for r in rows}
    assert len(rows) == len(got) == 5
    assert (got["both"].status, got["both"].ok, got["both"].attempts) == ("complete", True, 2)
    f = got["failed"]
    assert (f.ok, f.failed_children, f.retryable, f.failure_kind) == (False, 2, True, None)
    assert (got["again"].ok, got["again"].attempts, got["again"].child_count) == (True, 4, 2)
    one = got["one"]
    assert (one.status, one.ok, one.missing, one.child_count) == ("timed_out", False, 1, 1)


def test_complete_deliveries_equal_the_batch(spark, tmp_path):
    rng = random.Random(5)
    rows, at = [], datetime.datetime(2026, 1, 1)
    for doc in range(40):
        for destination in "abc":
            child(
                rows, f"d{doc}", destination, rng.random() < 0.6, at, expected=3, attempts=rng.randrange(4),
                retryable=rng.choice([True, False]), failure_kind=rng.choice(["timeout", "constraint"]),
            )
    rng.shuffle(rows)
    for number in range(3):
        land(spark, tmp_path / "in", number, rows[number::3], CHILD)
    run(stream_fanout(read_stream(spark, tmp_path / "in", CHILD), ["doc"]), tmp_path / "out", tmp_path / "cp")
    got = spark.read.parquet(str(tmp_path / "out"))
    want = fanout(spark.createDataFrame(rows, CHILD), ["doc"]).drop("destination")
    columns = ["doc", "ok", "child_count", "ok_children", "failed_children", "attempts", "retryable", "failure_kind", "error_code"]
    pick = lambda df: sorted(map(str, df.select(*[F.col(c).cast("string") for c in columns]).collect()))
    assert pick(got) == pick(want) and {r.status for r in got.collect()} == {"complete"}


@pytest.mark.parametrize("seed", [1, 2])
def test_evidence_streams_equal_the_batch(spark, tmp_path, seed):
    """Found references come at once, missing ones when the watermarks have passed."""
    rng = random.Random(seed)
    schema_a = "action string, evidence_ref string, expected_at timestamp"
    schema_e = "evidence_ref string, present_at timestamp"
    base = datetime.datetime(2026, 1, 1)
    minutes = lambda n: base + datetime.timedelta(minutes=n)
    actions = [(f"a{i}", f"r{i % 50}", minutes(rng.randrange(40))) for i in range(120)]
    evidence = [(f"r{i}", minutes(rng.randrange(40))) for i in range(50) if i % 3]
    a, e = tmp_path / "a", tmp_path / "e"
    for number in range(2):
        land(spark, a, number, actions[number::2], schema_a)
        land(spark, e, number, evidence[number::2], schema_e)
    # A later row on both sides moves the watermarks past all others.
    for number in (2, 3):
        land(spark, a, number, [("clock", "clock", minutes(10_000 * number))], schema_a)
        land(spark, e, number, [("clock", minutes(10_000 * number))], schema_e)
    stream = stream_evidence(read_stream(spark, a, schema_a), read_stream(spark, e, schema_e))
    run(stream, tmp_path / "out", tmp_path / "cp")
    got = spark.read.parquet(str(tmp_path / "out")).filter("action <> 'clock'")
    missing, _ = verify_evidence(
        spark.createDataFrame(actions, schema_a), spark.createDataFrame(evidence, schema_e), ["action"]
    )
    assert got.count() == len(actions)
    assert {r.action for r in got.filter("NOT found").collect()} == {r.action for r in missing.collect()}


def test_state_is_dropped(spark, tmp_path):
    """After the watermarks have passed no rows are kept."""
    schema_a = "action string, evidence_ref string, expected_at timestamp"
    schema_e = "evidence_ref string, present_at timestamp"
    base = datetime.datetime(2026, 1, 1)
    days = lambda n: base + datetime.timedelta(days=n)
    for number in range(5):
        land(spark, tmp_path / "a", number, [(f"a{number}", f"r{number}", days(number))], schema_a)
        land(spark, tmp_path / "e", number, [(f"r{number}", days(number))], schema_e)
    stream = stream_evidence(
        read_stream(spark, tmp_path / "a", schema_a), read_stream(spark, tmp_path / "e", schema_e)
    )
    query = (
        stream.writeStream.format("memory").queryName("dropped").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    kept = [op["numRowsTotal"] for op in query.lastProgress["stateOperators"]]
    assert kept and max(kept) <= 2


def test_a_table_streams_as_one_file_or_as_a_folder_of_files(spark, tmp_path):
    rows = spark.range(10).select("id", F.concat(F.lit("t"), "id").alias("text"))
    for form, parts in (("file", 1), ("folder", 3)):
        folder = tmp_path / form
        rows.repartition(parts).write.parquet(str(folder / "documents.parquet"))
        if parts == 1:  # as a single file
            (part,) = (folder / "documents.parquet").glob("part-*.parquet")
            folder = tmp_path / "single"
            folder.mkdir()
            (folder / "documents.parquet").write_bytes(part.read_bytes())
        out = tmp_path / f"{form}-out"
        run(stream_of(spark, str(folder), "documents"), out, tmp_path / f"{form}-cp")
        assert sorted(r.id for r in spark.read.parquet(str(out)).collect()) == list(range(10))


def test_deliveries_of_one_bucket_keep_apart(spark, tmp_path):
    """Null and timestamp keys, different times to close, receipts over two batches."""
    schema = CHILD.replace("doc string", "doc long, seen timestamp")
    seen = datetime.datetime(2026, 1, 1, 0, 0, 0, 123456)
    at = lambda minute: datetime.datetime(2026, 1, 1, minute // 60, minute % 60)
    first, second, third = [], [], []
    for doc in [None, *range(60)]:
        n = -1 if doc is None else doc
        for part, name in ((first, "a"), (second, "b")):
            if name == "a" or n % 3:
                details = (1 + n % 4, n % 2 == 0, "timeout", None)
                part.append((doc, seen, name, n % 5 > 0, *details, 2, at(max(n, 0) if name == "a" else 60)))
    third.append((100, seen, "a", True, None, None, None, None, 1, at(100)))
    last = [(101, seen, "a", True, None, None, None, None, 1, at(600))]
    source, out, progress = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    for number, rows in enumerate((first, second, third, last)):
        land(spark, source, number, rows, schema)
        stream = stream_fanout(
            read_stream(spark, source, schema), ["doc", "seen"], delay="2 hours", buckets=1
        )
        run(stream, out, progress)
    rows = {r.doc: r for r in spark.read.parquet(str(out)).collect()}
    assert spark.read.parquet(str(out)).count() == len(rows) == 63
    assert {r.seen for r in rows.values()} == {seen}
    children = spark.createDataFrame(first + second, schema)
    for parent in fanout(children, ["doc", "seen"]).collect():
        got = rows[parent.doc]
        complete = parent.child_count == 2
        assert got.status == ("complete" if complete else "timed_out")
        assert got.ok == (parent.ok and complete)
        for c in ("child_count", "failed_children", "attempts", "retryable", "failure_kind"):
            assert got[c] == parent[c]
