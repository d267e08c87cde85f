from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.functions.folding import joined_text_facts
from millrace.operators.delivery import PREVIEW_CHARS, row_evidence


def expected(rows, separator, shown, skip_empty):
    groups = defaultdict(list)
    for a, b, at, text in rows:
        groups[a, b].append((at, text))
    out = {}
    for key, members in groups.items():
        texts = [t for _, t in sorted(members, key=lambda m: m[0]) if t is not None]
        text = separator.join(t for t in texts if t or not skip_empty)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out[key] = (len(members), len(text), sha, text[:shown])
    return out


@pytest.mark.parametrize("skip_empty", [False, True])
@pytest.mark.parametrize("separator", ["\n", "\n\n", ""])
def test_random_rows(spark, skip_empty, separator):
    """A third of the rows share one key, keys and texts may be null, texts may be empty."""
    rng = random.Random(len(separator))
    places = rng.sample(range(10**6), 3000)
    rows = [
        (
            "hot" if i % 3 == 0 else rng.choice(["a", "b", None]),
            1 if i % 3 == 0 else rng.choice([1, 2, None]),
            at,
            rng.choice([None, "", "ß日", "x" * rng.randrange(30), "line\nbreak"]),
        )
        for i, at in enumerate(places)
    ]
    df = spark.createDataFrame(rows, "a string, b int, at long, text string").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        facts = joined_text_facts(df, ["a", "b"], "at", "text", separator, 100, skip_empty)
        got = {(r.a, r.b): tuple(r)[2:] for r in facts.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == expected(rows, separator, 100, skip_empty)


def test_a_text_larger_than_a_column_of_one_row_batch(spark):
    """Many long pieces; no step holds more than a batch of them."""
    rows = spark.range(400).select(
        F.lit("k").alias("k"),
        F.col("id").alias("turn"),
        F.repeat(F.concat(F.col("id").cast("string"), F.lit("y")), 50_000).alias("text"),
    )
    got = row_evidence(rows.orderBy(F.rand(3)), ["k"], "turn", "\n").first()
    digest, chars = hashlib.sha256(), 0
    for i in range(400):
        piece = ("\n" if i else "") + f"{i}y" * 50_000
        digest.update(piece.encode())
        chars += len(piece)
    assert got.normalized_text_sha256 == digest.hexdigest()
    assert (got.normalized_text_len, got.elements_count) == (chars, 400)
    assert got.normalized_text_preview == ("0y" * 50_000)[:PREVIEW_CHARS]
    assert got.normalized_text_truncated


def test_order_may_be_a_struct_and_tables_empty(spark):
    df = spark.createDataFrame([(1, (1, 5), "b"), (1, (0, 9), "a")], "k int, ord struct<x:int,y:int>, text string")
    assert joined_text_facts(df, ["k"], "ord", "text", "-", 9).first().preview == "a-b"
    assert joined_text_facts(df.limit(0), ["k"], "ord", "text", "-", 9).collect() == []


def test_plan_gathers_nothing(spark):
    df = spark.createDataFrame([(1, 2, "b")], "k int, o int, text string")
    plan = row_evidence(df, ["k"], "o", "\n")._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "MapInArrow" in plan
