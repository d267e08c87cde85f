from __future__ import annotations

import math

import numpy as np
import pytest

from millrace.llm.whitening import fit_whitening, scaled_rows, whiten

SCHEMA = "vec_id long, embedding array<float>, component string, n int"


@pytest.fixture
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, "own", 7) for i, v in rows], SCHEMA)

    return make


def by_hand(rows, components=4):
    """Scaled vectors, distinct vectors, mean, eigenvalues and eigenvectors by numpy."""
    x = {i: np.floor(256 * np.float32(v).astype(np.float64)).astype(np.int64) for i, v in rows}
    fit = np.array(sorted({tuple(v.tolist()) for v in x.values()}))
    mean = fit.sum(axis=0) / len(fit)
    centred = fit - mean
    values, axes = np.linalg.eigh(centred.T @ centred / len(fit))
    return x, fit, mean, values[::-1][:components], axes[:, ::-1][:, :components], values.sum()


def check(rows, out, components=4):
    x, fit, mean, values, axes, trace = by_hand(rows, components)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    got = out.collect()
    assert len(got) == len(rows) * len(values)
    signs = {}
    for r in got:
        k = r.component - 1
        want = (x[r.vec_id] - mean) @ axes[:, k] / math.sqrt(values[k])
        if k not in signs and abs(want) > 1e-3:
            signs[k] = math.copysign(1, want * r.whitened)
        assert r.whitened * signs.get(k, 1) == pytest.approx(want, abs=1e-8)
        assert r.n == n
        assert int(r.deviation) == sum((n * int(c) - s) ** 2 for c, s in zip(x[r.vec_id], sums, strict=True))
        assert r.explained == pytest.approx(values[k] / trace, rel=1e-9)
        assert r.identity_error < 1e-10
    assert len({r.identity_error for r in got}) == 1


@pytest.mark.parametrize("dimension", [2, 5, 40])
def test_random_vectors(vectors, dimension):
    random = np.random.default_rng(dimension)
    scales = np.linspace(2, 0.3, dimension)
    rows = [(i, (random.standard_normal(dimension) * scales).tolist()) for i in range(150)]
    check(rows, whiten(vectors(rows)), min(4, dimension))


def test_close_eigenvalues(vectors):
    random = np.random.default_rng(3)
    rows = [(i, random.standard_normal(48).tolist()) for i in range(400)]
    model = fit_whitening(scaled_rows(vectors(rows), "vec_id", "embedding", 256), 4)
    assert model.residuals.max() <= 1e-11 * model.variances[0]
    check(rows, whiten(vectors(rows)))


def test_rows_that_take_no_part_and_copies(vectors):
    random = np.random.default_rng(5)
    own = [(i, random.standard_normal(6).tolist()) for i in range(60)]
    copies = [(100 + i, own[0][1]) for i in range(200)]
    odd = [
        (1000, None),
        (1001, [0.1, None, 0.2, 0.3, 0.4, 0.5]),
        (1002, [0.1, math.nan, 0.2, 0.3, 0.4, 0.5]),
        (1003, [0.1, math.inf, 0.2, 0.3, 0.4, 0.5]),
        (1004, [0.1, 0.2]),
        (1005, []),
    ]
    check([*own, *copies], whiten(vectors([*own, *odd, *copies])))


def test_null_and_repeated_ids(vectors):
    random = np.random.default_rng(6)
    rows = [(i, random.standard_normal(5).tolist()) for i in range(30)]
    out = whiten(vectors([*rows, (None, rows[0][1]), (0, rows[1][1])])).collect()
    assert sum(r.vec_id is None for r in out) == 4 and sum(r.vec_id == 0 for r in out) == 8


def test_less_variance_than_components(vectors):
    # All vectors on one line: one component.
    rows = [(i, [i / 256, 2 * i / 256, 0.0, -0.0, 1.0, 0.5]) for i in range(20)]
    out = whiten(vectors(rows)).collect()
    assert {r.component for r in out} == {1} and len(out) == 20
    assert out[0].explained == pytest.approx(1.0)
    assert out[0].identity_error < 1e-10


def test_nothing_to_fit(vectors):
    assert whiten(vectors([])).collect() == []
    assert whiten(vectors([(1, None)])).collect() == []
    assert whiten(vectors([(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect() == []
    assert whiten(vectors([(1, []), (2, [])])).collect() == []


def test_large_entries(vectors):
    rows = [(i, [1e12 * (i % 7), -3e13 * (i % 3), 0.5 * i]) for i in range(40)]
    out = whiten(vectors(rows), components=2).collect()
    x, fit, *_ = by_hand(rows)
    sums = [sum(int(c) for c in column) for column in fit.T]
    for r in out:
        exact = sum((len(fit) * int(c) - s) ** 2 for c, s in zip(x[r.vec_id], sums, strict=True))
        assert r.deviation == exact


def test_query(spark, vectors, tmp_path):
    from millrace.llm.queries import op13_whitening

    random = np.random.default_rng(7)
    rows = [(i, random.standard_normal(8).tolist()) for i in range(50)]
    vectors(rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    out = op13_whitening(spark, str(tmp_path))
    assert dict(out.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    check(rows, out)
