"""Objects that are published whole, and landed pages followed through them."""

from __future__ import annotations

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.session import KEEP_LAST_KEY
from millrace.sources.landed import landed_pages, page_key, paged_tables, stream_pages
from millrace.sources.objects import (
    publish_objects,
    read_objects,
    stage_objects,
    write_objects,
)
from millrace.sources.records import read_paged


def objects(spark, rows):
    return spark.createDataFrame(rows, "object_key string, body string")


def seen(spark, folder):
    return {r.object_key: bytes(r.body).decode() for r in read_objects(spark, folder).collect()}


def test_one_object_for_each_key_and_the_last_write_stays(spark, tmp_path):
    folder = str(tmp_path)
    first = [(f"in/{n % 7}/sha{n}:r.json", f"body {n}" * n) for n in range(200)]
    receipts = write_objects(objects(spark, first).repartition(5), folder)
    assert receipts.count() == 200
    second = [(f"in/{n % 7}/sha{n}:r.json", "new") for n in range(0, 200, 3)] + [("z", None)]
    write_objects(objects(spark, second), "file:" + folder)
    want = dict(first) | {k: b or "" for k, b in second}
    assert seen(spark, folder) == want
    assert (tmp_path / "in/1/sha1:r.json").read_text() == "body 1"
    assert os.listdir(tmp_path / "_staged") == []


def test_repeated_keys_of_one_write_leave_one_whole_body(spark, tmp_path):
    bodies = [f"body {n}" for n in range(40)]
    receipts = write_objects(objects(spark, [("k", b) for b in bodies]).repartition(8), str(tmp_path))
    best = max(bodies, key=lambda b: __import__("hashlib").sha256(b.encode()).hexdigest())
    assert seen(spark, str(tmp_path)) == {"k": best}
    assert receipts.collect()[0].size == len(best)


@pytest.mark.parametrize("key", [None, "", "a//b", "../up", "_staged/x", "a/."])
def test_bad_keys_refuse_the_whole_write(spark, tmp_path, key):
    rows = objects(spark, [("good", "x"), (key, "y")]).coalesce(1)
    with pytest.raises(Exception, match="not a key"):
        write_objects(rows, str(tmp_path))
    assert not (tmp_path / "good").exists()


def test_failed_write_leaves_the_objects_as_they_were(spark, tmp_path):
    folder = str(tmp_path)
    write_objects(objects(spark, [("a", "old"), ("b", "old")]), folder)
    broken = objects(spark, [("a", "new"), ("b", "new")]).withColumn(
        "body", F.when(F.col("object_key") == "b", F.raise_error(F.lit("killed"))).otherwise(F.col("body"))
    )
    with pytest.raises(Exception, match="killed"):
        write_objects(broken, folder)
    assert seen(spark, folder) == {"a": "old", "b": "old"}


def test_publishing_goes_on_after_a_stop_and_may_run_again(spark, tmp_path):
    folder = str(tmp_path)
    write = stage_objects(objects(spark, [(f"k{n}", f"v{n}") for n in range(20)]), folder)
    assert not (tmp_path / "k0").exists()
    # A task that died had moved some objects; a stray attempt never committed.
    staged = tmp_path / "_staged" / write
    moved = sorted(staged.glob("objects/*/*"))[0]
    number = moved.read_text()[1:]
    moved.rename(tmp_path / f"k{number}")
    (staged / "objects" / "stray").mkdir()
    (staged / "objects" / "stray" / "000000000").write_text("half")
    (staged / "open" / "stray.parquet").write_bytes(b"PAR1")
    assert publish_objects(spark, folder, write).count() == 20
    assert publish_objects(spark, folder, write).count() == 20
    assert seen(spark, folder) == {f"k{n}": f"v{n}" for n in range(20)}
    with pytest.raises(ValueError, match="not committed"):
        publish_objects(spark, folder, "never")


def test_no_rows_publish_nothing(spark, tmp_path):
    assert write_objects(objects(spark, []), str(tmp_path)).count() == 0
    assert read_objects(spark, str(tmp_path)).count() == 0


def chain(source, sizes, cursors=None):
    """Pages of a source as (source, page_number, asked, body)."""
    pages, asked = [], None
    for n, size in enumerate(sizes, 1):
        following = None if n == len(sizes) else (cursors or {}).get(n, f"{source}-{n}")
        records = [{"n": n, "i": i} for i in range(size)]
        pages.append((source, n, asked, json.dumps({"records": records, "next_cursor": following})))
        asked = following
    return pages


def land(spark, folder, pages):
    rows = spark.createDataFrame(pages, "source string, page_number long, asked string, body string")
    key = page_key(F.col("source"), F.col("page_number"), F.col("asked"))
    write_objects(rows.select(key.alias("object_key"), "body"), folder)


def rows_of(tables):
    spark_rows = {}
    for name in ("records", "states", "logs", "errors"):
        table = getattr(tables, name)
        spark_rows[name] = sorted(map(str, table.select(*sorted(table.columns)).collect()))
    return spark_rows


def tables_of(spark, pages):
    return paged_tables(pages, F.lit("https://api/x"), F.lit("s"))


@pytest.mark.parametrize("per_task", [1, 4, 64])
def test_landed_pages_equal_the_paged_read(spark, tmp_path, per_task):
    spark.conf.set(KEEP_LAST_KEY, "true")
    pages = (
        chain("one/two three", [3, 0, 2, 5, 1, 1, 4])
        + chain("b+é", [2])
        + chain("loop", [1] * 9, {2: "same", 6: "same"})
    )
    land(spark, str(tmp_path), pages)
    read = landed_pages(spark, str(tmp_path), per_task)
    got = rows_of(tables_of(spark, read))
    plain = spark.createDataFrame(
        pages, "source string, page_number long, asked string, body string"
    ).withColumns({"source_url": F.lit("https://api/x"), "stream": F.lit("s")})
    want = rows_of(read_paged(plain, ["source"]))
    assert got["records"] == want["records"]
    assert got["states"] == want["states"]
    assert got["logs"] == want["logs"]
    assert len(got["errors"]) == 1 and "cursor_did_not_advance" in got["errors"][0]


def test_pages_that_do_not_follow_are_problems(spark, tmp_path):
    spark.conf.set(KEEP_LAST_KEY, "true")
    broken = chain("swapped", [1, 1, 1, 1])
    broken[2] = ("swapped", 3, "another", broken[2][3])
    gap = [p for p in chain("gap", [1, 1, 1, 1]) if p[1] != 3]
    behind = chain("behind", [1, 1]) + [("behind", 3, "x", '{"records":[],"next_cursor":null}')]
    text = [("text", 1, None, "no json"), ("text", 2, "t", '{"records":[],"next_cursor":null}')]
    twice = chain("twice", [1, 1]) + [("twice", 1, "other", "{}")]
    land(spark, str(tmp_path), broken + gap + behind + text + twice)
    read = landed_pages(spark, str(tmp_path), 2)
    found = {(r.source, r.page_number): r.problem for r in read.filter("problem is not null").collect()}
    wrong = "page_does_not_answer_cursor"
    assert found.pop(("twice", 2)) == "page_number_repeated"
    # Whichever of two pages with one number comes first, the source is refused.
    found = {k: v for k, v in found.items() if k[0] != "twice"}
    assert found == {("swapped", 3): wrong, ("behind", 3): wrong, ("text", 2): wrong}
    pages = {(r.source, r.page_number) for r in read.collect()}
    assert {p for p in pages if p[0] == "gap"} == {("gap", 1), ("gap", 2)}
    tables = tables_of(spark, read)
    assert {r.source for r in tables.errors.collect()} == {"swapped", "behind", "text", "twice"}
    assert {r.source for r in tables.records.collect()} == {"gap"}


def test_no_pages(spark, tmp_path):
    assert landed_pages(spark, str(tmp_path / "none")).count() == 0


def run(stream, out: Path) -> None:
    (
        stream.writeStream.format("parquet")
        .option("path", str(out / "rows"))
        .option("checkpointLocation", str(out / "progress"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def test_restarted_stream_reads_every_page_once(spark, tmp_path):
    folder, out = str(tmp_path / "landed"), tmp_path / "out"
    a, b = chain("a", [2] * 9), chain("b", [1] * 4)
    loop = chain("loop", [1] * 8, {2: "same", 4: "same"})
    for part in (a[:3] + b[:2] + loop[:3], a[3:4], a[4:] + b[2:] + loop[3:], []):
        if part:
            land(spark, folder, part)
        run(stream_pages(spark, folder, 2), out)
    rows = spark.read.parquet(str(out / "rows"))
    assert rows.count() == rows.select("source", "page_number").distinct().count()
    bodies = {(r.source, r.page_number): (r.body, r.problem) for r in rows.collect()}
    assert {k: v for k, v in bodies.items() if k[0] != "loop"} == {
        (p[0], p[1]): (p[3], None) for p in a + b
    }
    # The fifth page of the loop answers the cursor that the third one answered.
    assert max(n for s, n in bodies if s == "loop") == 5
    assert bodies["loop", 5][1] == "cursor_did_not_advance"


def test_too_many_sources_are_refused(spark, tmp_path):
    land(spark, str(tmp_path / "landed"), chain("a", [1]) + chain("b", [1]))
    with pytest.raises(Exception, match="maxSources"):
        run(stream_pages(spark, str(tmp_path / "landed"), max_sources=1), tmp_path / "out")
