from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.functions import ordering


def rows(seed: int) -> list[tuple]:
    """A third of the rows share one key, and one key is null."""
    rng = random.Random(seed)
    order = rng.sample(range(10_000), 900)
    keys = ["hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None]) for i in range(900)]
    return [(k, o, rng.randint(0, 50)) for k, o in zip(keys, order, strict=True)]


def expected(data: list[tuple]) -> dict:
    groups = defaultdict(list)
    for key, order, value in data:
        groups[key].append((order, value))
    out = {}
    for key, members in groups.items():
        total, previous = 0, -1
        for index, (order, value) in enumerate(sorted(members)):
            out[(key, order)] = (index, total, previous)
            total += value
            previous = value
    return out


@pytest.mark.parametrize("slice_by", [None, "div"])
@pytest.mark.parametrize("seed", [1, 2])
def test_group_work_equals_brute_force(spark, slice_by, seed, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_SLICE", 100)
    data = rows(seed)
    df = spark.createDataFrame(data, "k string, o long, v long").repartition(5)
    by = None if slice_by is None else F.floor(F.col("o") / 700)
    got = ordering.group_index(df, ["k"], ["o"], "i", by)
    got = ordering.sum_before(got, ["k"], ["o"], "v", "s", by)
    got = ordering.previous_value(got, ["k"], ["o"], "v", "p", by, first=F.lit(-1).cast("long"))
    result = {(r.k, r.o): (r.i, r.s, r.p) for r in got.collect()}
    assert result == expected(data)


def test_whole_table_index(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("o"))
    got = ordering.group_index(df, [], ["o"], "i").collect()
    assert all(r.i == r.o for r in got) and len(got) == 1000


def test_null_previous_value_is_kept(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "o long, v string")
    got = ordering.previous_value(
        df, [], ["o"], "v", "p", F.col("o"), first=F.lit("start")
    ).collect()
    assert {r.o: r.p for r in got} == {1: "start", 2: "a", 3: None}


@pytest.mark.parametrize("slice_by", [None, "div"])
def test_totals_of_the_group(spark, slice_by, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_SLICE", 100)
    data = rows(3)
    df = spark.createDataFrame(data, "k string, o long, v long").repartition(5)
    by = None if slice_by is None else F.floor(F.col("o") / 700)
    got = ordering.sum_before(df, ["k"], ["o"], "v", "s", by, totals={"all": "v"}).collect()
    whole = defaultdict(int)
    for key, _, value in data:
        whole[key] += value
    assert len(got) == len(data) and all(r["all"] == whole[r.k] for r in got)
