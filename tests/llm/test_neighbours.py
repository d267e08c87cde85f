from __future__ import annotations

import math

import numpy as np
import pytest

from millrace.llm.neighbours import nearest

SCHEMA = "vec_id long, embedding array<float>, score string"


def by_hand(vectors, k):
    out = {}
    for q, x in vectors.items():
        if q % 20 == 0:
            scores = [(-float(np.dot(x, y)), i) for i, y in vectors.items() if i != q]
            out[q] = sorted(scores)[:k]
    return out


@pytest.mark.parametrize("scale", [False, True])
def test_recall(spark, scale):
    """Also for vectors of very different length, where the longest are nearest."""
    rng = np.random.default_rng(3)
    table = rng.standard_normal((3000, 32)).astype(np.float32)
    if scale:
        table *= rng.uniform(0.2, 3, (3000, 1)).astype(np.float32)
    rows = [(i, [float(v) for v in x], "own") for i, x in enumerate(table)]
    found = nearest(spark.createDataFrame(rows, SCHEMA), shard_rows=1000, least_shards=2).collect()
    vectors = {i: np.array(x, dtype=np.float64) for i, x, _ in rows}
    want, hits = by_hand(vectors, 20), 0
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert math.isclose(r.score, float(vectors[r.query_id] @ vectors[r.vec_id]), abs_tol=1e-12)
    assert got.keys() == want.keys()
    for q, own in got.items():
        assert len(own) == 20 and own == sorted(own)
        hits += len({i for _, i in own} & {i for _, i in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_copies_and_rows_that_take_no_part(spark):
    same, other = [1.0, 0.0], [0.5, 0.5]
    rows = [(i, same, "") for i in range(100)] + [(i, other, "") for i in (100, 101, 101)]
    rows += [(200, None, ""), (220, [0.0, 0.0], ""), (240, [1.0, None], ""), (None, same, "")]
    rows += [(260, [1.0, float("nan")], ""), (280, [float("inf"), 1.0], ""), (300, [], "")]
    rows += [(320, [1.0, 2.0, 3.0], "")]
    found = nearest(spark.createDataFrame(rows, SCHEMA), k=3).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    first = [(1, 0, 1.0), (2, 1, 1.0), (3, 2, 1.0)]
    assert got == {
        0: [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0)],
        **{q: first for q in (20, 40, 60, 80)},
        100: [(1, 0, 0.5), (2, 1, 0.5), (3, 2, 0.5)],
    }
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest(empty).count() == 0


def test_few_candidates(spark):
    rows = [(i, [float(i + 1), 1.0], "") for i in range(5)]
    found = nearest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(found, key=lambda r: r["rank"])] == [
        (1, 4), (2, 3), (3, 2), (4, 1)
    ]


def test_many_ties(spark):
    """More different vectors than asked for share the last score: the smallest ids win."""
    dimension = 60
    rows = [(20, [1.0] * dimension, "")]
    # Far more vectors of two ones than k, each with the same score.
    pairs = [(a, b) for a in range(dimension) for b in range(a)][:900]
    order = np.random.default_rng(5).permutation(len(pairs))
    for place, n in enumerate(order.tolist()):
        vector = [0.0] * dimension
        vector[pairs[n][0]] = vector[pairs[n][1]] = 1.0
        rows.append((21 + place + place // 19, vector, ""))
    found = nearest(spark.createDataFrame(rows, SCHEMA), k=20, wanted=1000.0).filter("query_id = 20")
    want = sorted((-sum(v), i) for i, v, _ in rows if i != 20)[:20]
    got = [(-r.score, r.vec_id) for r in found.orderBy("rank").collect()]
    assert got == want
