from __future__ import annotations

import random

import pytest

from millrace.operators.ancestry import checkpoint_ancestry
from millrace.operators.merge import merge_rows, merged_rows
from millrace.session import stored

SCHEMA = "identity_key string, value int, delivered_at_utc string"


def files(out):
    return {p: p.stat().st_mtime_ns for p in out.rglob("*.parquet")}


def test_random_upserts_against_a_dictionary(spark, tmp_path):
    rng = random.Random(1)
    out, want = tmp_path / "t", {}
    for n in range(5):
        rows = [(f"k{rng.randrange(60)}", rng.randrange(1000), f"{n}{rng.randrange(10)}") for _ in range(30)]
        for _ in range(2):  # run again
            merge_rows(spark, str(out), spark.createDataFrame(rows, SCHEMA), buckets=8)
        for key in {r[0] for r in rows}:
            want[key] = max((r[2], r[1]) for r in rows if r[0] == key)
        got = {r.identity_key: (r.delivered_at_utc, r.value) for r in merged_rows(spark, str(out)).collect()}
        assert got == want and merged_rows(spark, str(out)).count() == len(want)


def test_a_small_upsert_rewrites_its_buckets_only(spark, tmp_path):
    out = tmp_path / "t"
    rows = [(f"k{i}", i, "1") for i in range(2000)]
    assert len(merge_rows(spark, str(out), spark.createDataFrame(rows, SCHEMA), buckets=200)) == 200
    before = files(out)
    few = [("k7", -1, "2"), ("k8", -1, "2")]
    touched = merge_rows(spark, str(out), spark.createDataFrame(few, SCHEMA))
    after = files(out)
    assert 1 <= len(touched) <= 2
    same = [p for p in before if after.get(p) == before[p]]
    assert len(same) == 200 - len(touched)
    assert merged_rows(spark, str(out)).count() == 2000
    assert merged_rows(spark, str(out)).filter("value = -1").count() == 2
    assert merge_rows(spark, str(out), spark.createDataFrame([], SCHEMA)) == []


def ancestry_by_hand(entries):
    up = {}
    for key, parent, resumed in entries:
        before = parent if parent is not None else resumed
        if key not in up or (before is not None and (up[key] is None or before < up[key])):
            up[key] = before
    out = {}
    for key in up:
        at, steps, seen = key, 0, set()
        while at not in seen and up[at] is not None and up[at] in up:
            seen.add(at)
            at, steps = up[at], steps + 1
        if at in seen:
            out[key] = (None, None, "cycle")
        else:
            out[key] = (at, steps, "whole" if up[at] is None else "broken")
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ancestry_against_a_walk(spark, seed):
    rng = random.Random(seed)
    entries = []
    for i in range(400):
        kind = rng.random()
        parent = f"c{rng.randrange(max(1, i))}" if kind < 0.7 and i else None
        resumed = rng.choice([None, f"c{rng.randrange(400)}", "gone"]) if kind > 0.6 else None
        entries.append((f"c{i}", parent, resumed))
    # A long chain, with everybody resumed from its end, and a cycle.
    entries += [(f"l{i}", f"l{i - 1}" if i else None, None) for i in range(100)]
    entries += [(f"h{i}", None, "l99") for i in range(100)]
    entries += [(f"y{i}", f"y{(i + 1) % 7}", None) for i in range(7)] + [("z", None, "y3")]
    schema = (
        "checkpoint_identity_key string, parent_checkpoint_identity_key string, "
        "resumed_from_checkpoint_identity_key string"
    )
    rows = checkpoint_ancestry(spark.createDataFrame(entries, schema)).collect()
    got = {r.checkpoint_identity_key: (r.root, r.depth, r.ancestry) for r in rows}
    assert len(rows) == len(got) and got == ancestry_by_hand(entries)


def test_no_entries(spark):
    schema = (
        "checkpoint_identity_key string, parent_checkpoint_identity_key string, "
        "resumed_from_checkpoint_identity_key string"
    )
    assert checkpoint_ancestry(spark.createDataFrame([], schema)).collect() == []


def test_rounds_of_ancestry_follow_the_longest_chain(spark, monkeypatch):
    """Short cycles and what leads to them take few rounds, however many entries there are."""
    entries = [(f"a{i}", None, None) for i in range(5000)]
    for size in (1, 2, 3, 5, 8):
        entries += [(f"s{size}-{i}", f"s{size}-{(i + 1) % size}", None) for i in range(size)]
        # Keys that are less than all of the cycle lead to it, some from far away.
        entries += [(f"b{size}-{i}", f"b{size}-{i - 1}" if i else f"s{size}-0", None) for i in range(9)]
    written = []
    monkeypatch.setattr("millrace.operators.ancestry.stored", lambda df: written.append(1) or stored(df))
    schema = (
        "checkpoint_identity_key string, parent_checkpoint_identity_key string, "
        "resumed_from_checkpoint_identity_key string"
    )
    rows = checkpoint_ancestry(spark.createDataFrame(entries, schema)).collect()
    got = {r.checkpoint_identity_key: (r.root, r.depth, r.ancestry) for r in rows}
    assert len(rows) == len(got) and got == ancestry_by_hand(entries)
    assert len(written) <= 11
