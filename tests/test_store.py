from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators.store import compact_keyed, known_shas, read_keyed, write_keyed
from millrace.streaming import intake
from millrace.streaming.intake import stream_documents


def sha(value):
    return hashlib.sha256(str(value).encode()).hexdigest()


def rows(spark, values, tag):
    return spark.createDataFrame([(sha(v), v, tag) for v in values], "sha256 string, v int, tag string")


def folders(out, table):
    return sorted(p.relative_to(out / table).as_posix() for p in (out / table).glob("bucket=*/batch=*"))


def scanned(df):
    """Buckets that the plan reads files of."""
    return {f.split("bucket=")[1].split("/")[0] for f in df.inputFiles() if "bucket=" in f}


def test_random_batches_against_a_dictionary(spark, tmp_path):
    rng = random.Random(2)
    want = {}
    for n in range(12):
        values = rng.sample(range(60), rng.randrange(1, 25))
        # Every batch is written twice, as after a lost driver.
        for _ in range(2):
            write_keyed(rows(spark, values, f"t{n}"), str(tmp_path), "t", f"{n:04}")
        want |= {v: f"t{n}" for v in values}
        if n % 5 == 4:
            compact_keyed(spark, str(tmp_path), "t", before=f"{n:04}", apart=1)
        got = read_keyed(spark, str(tmp_path), "t")
        assert got.columns == ["sha256", "v", "tag", "batch"]
        assert {r.v: r.tag for r in got.collect()} == want and got.count() == len(want)
    asked = rows(spark, [3, 7, 1000], "asked")
    found = read_keyed(spark, str(tmp_path), "t", asked).collect()
    assert {r.v: r.tag for r in found} == {v: want[v] for v in (3, 7) if v in want}


def test_only_the_buckets_asked_for_are_read(spark, tmp_path):
    out = str(tmp_path)
    for n in range(3):
        write_keyed(rows(spark, range(400), f"t{n}"), out, "t", f"b{n}", digits=2)
    wanted = [sha(5), sha(17)]
    one = read_keyed(spark, out, "t", wanted)
    assert {r.v for r in one.collect()} == {5, 17}
    assert scanned(one) == {f"b{s[:2]}" for s in wanted}
    several = read_keyed(spark, out, "t", rows(spark, [5, 17, 99999], "x"))
    assert {(r.v, r.tag) for r in several.collect()} == {(5, "t2"), (17, "t2")}
    assert scanned(several) <= {f"b{sha(v)[:2]}" for v in (5, 17, 99999)}
    known = known_shas(spark, out, "t", rows(spark, [5, 17, 99999], "x"), before="b2")
    assert {r.sha256 for r in known.collect()} == set(wanted)
    assert scanned(known) <= {f"b{sha(v)[:2]}" for v in (5, 17, 99999)}
    assert known_shas(spark, out, "t", rows(spark, [5], "x"), before="b0").collect() == []
    assert read_keyed(spark, out, "t", ["nothere"]).collect() == []


def test_one_batch_needs_no_grouping(spark, tmp_path):
    write_keyed(rows(spark, range(50), "a"), str(tmp_path), "t", "b0")
    write_keyed(rows(spark, range(50), "b"), str(tmp_path), "t", "b1")
    assert compact_keyed(spark, str(tmp_path), "t", before="b9", apart=1) == 16
    plan = read_keyed(spark, str(tmp_path), "t")._jdf.queryExecution().toString()
    assert "Aggregate" not in plan and "Join" not in plan
    assert {name.split("/")[1] for name in folders(tmp_path, "t")} == {"batch=nb1"}


def test_compaction_leaves_batches_that_may_run_again(spark, tmp_path):
    for n in range(6):
        write_keyed(rows(spark, [n, 50], f"t{n}"), str(tmp_path), "t", f"b{n}", digits=1 if n == 0 else 3)
    compact_keyed(spark, str(tmp_path), "t", before="b5", apart=1)
    write_keyed(rows(spark, [5, 51], "again"), str(tmp_path), "t", "b5")
    got = {r.v: r.tag for r in read_keyed(spark, str(tmp_path), "t").collect()}
    assert {v: got[v] for v in range(6)} == {**{v: f"t{v}" for v in range(5)}, 5: "again"}
    assert got[51] == "again"
    # The number of digits that a table began with holds.
    assert all(len(name.split("/")[0]) == len("bucket=b0") for name in folders(tmp_path, "t"))


def test_null_shas_and_missing_tables(spark, tmp_path):
    df = spark.createDataFrame([(None, 1), (sha(1), 2)], "sha256 string, v int")
    write_keyed(df, str(tmp_path), "t", "b0")
    assert {r.v for r in read_keyed(spark, str(tmp_path), "t").collect()} == {1, 2}
    assert known_shas(spark, str(tmp_path), "none", df, before="z").count() == 0
    with pytest.raises(AnalysisException):
        read_keyed(spark, str(tmp_path), "none")


def test_a_batch_costs_the_same_after_many(spark, tmp_path, monkeypatch):
    """Folders of the run metadata stay bounded while micro-batches go on."""
    monkeypatch.setattr(intake, "COMPACT_EVERY", 3)
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    run = {"run_id": "r", "pipeline_version": "p", "timestamp_utc": "2026-01-01T00:00:00Z"}
    schema = "uri string, filename string, text string"
    seen = []
    for n in range(7):
        texts = [(f"/{n}/{i}", f"{i}.txt", f"text {i % 5 + n}") for i in range(8)]
        spark.createDataFrame(texts, schema).coalesce(1).write.parquet(str(source / f"p{n}"))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(source))
        stream_documents(stream, str(out), str(tmp_path / "cp"), run).awaitTermination()
        counts = {}
        for name in folders(out, "run_meta"):
            counts[name.split("/")[0]] = counts.get(name.split("/")[0], 0) + 1
        seen.append(max(counts.values()))
    stored = read_keyed(spark, str(out), "run_meta")
    assert stored.count() == stored.select("sha256").distinct().count() == 11
    assert max(seen) <= 3 + 8
    texts = read_keyed(spark, str(out), "results").select(F.col("normalized_text")).collect()
    assert sorted(r[0] for r in texts) == sorted(f"text {i}" for i in range(11))


def test_small_files_have_small_filters(spark, tmp_path):
    write_keyed(rows(spark, range(50), "a"), str(tmp_path), "t", "b1")
    files = list((tmp_path / "t").rglob("*.parquet"))
    assert files and max(f.stat().st_size for f in files) < 200_000


def test_dealt_rows_are_not_moved_again(spark, tmp_path):
    """Three batches of rows that were dealt once: the rows and the buckets of moved ones."""
    from millrace.operators.store import deal_keyed
    from millrace.session import stored

    given = rows(spark, range(300), "a").union(
        spark.createDataFrame([(None, 1, "none")] * 2, "sha256 string, v int, tag string")
    )
    once = stored(deal_keyed(given.repartition(7)), "zstd")
    for n in range(3):
        write_keyed(once.filter(F.col("v") >= n), str(tmp_path), "dealt", f"b{n}", dealt=True)
        write_keyed(given.filter(F.col("v") >= n), str(tmp_path), "moved", f"b{n}")
    assert folders(tmp_path, "dealt") == folders(tmp_path, "moved")
    columns = ["sha256", "v", "tag", "batch"]
    got, want = (
        sorted(map(str, read_keyed(spark, str(tmp_path), t).select(columns).collect())) for t in ("dealt", "moved")
    )
    assert got == want and len(got) >= 300
