"""Whitening of vectors by Chebyshev-filtered subspace iteration.

The covariance ``V`` of the distinct vectors is never formed.  A *pass* multiplies it
with a few columns ``Q``: every task sums ``(X - mean)' ((X - mean) Q)`` over its vectors
and Spark adds the sums up by row, so that a matrix of dimension times columns reaches
the driver, whatever the number of vectors.

A few Lanczos steps bound the spectrum.  Then a block of more columns than wanted is
filtered by a Chebyshev polynomial of ``V``, one pass for each degree of its recurrence:
between the lower bound and the block's smallest Ritz value, the unwanted spectrum, the
polynomial stays small, above it grows fast.  QR and a Rayleigh-Ritz step follow.  This is
repeated until the residuals of the wanted pairs are within ``CERTIFIED`` of the largest
eigenvalue and no longer fall, that is, up to the rounding of doubles.

Entries are scaled and rounded down to whole numbers, so counts and sums are exact.  Rows
take part if their vector is not null and holds no null or non-finite entry.  Where vectors
differ in length, those of the commonest length (of equally common ones the longest) take
part.  Rows with a null or repeated id, and equal vectors, give their own results; equal
vectors count once in the fit.  Components without variance are left out, so a
constant table, a single vector or no vector gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stored

#: Columns of the block beside the wanted ones, passes of a filter, of the first bounds.
GUARDS, DEGREE, BOUND_STEPS = 20, 8, 10
#: Residuals accepted, and variances that count as none, against the largest eigenvalue.
CERTIFIED, NO_VARIANCE = 1e-11, 1e-12
MOST_ROUNDS = 200
SEED = 13
WIDTHS = ("<i2", "<i4", "<i8")


@dataclass
class Whitening:
    """A fitted transform; ``axes`` has a unit eigenvector in each column."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    trace: float
    residuals: np.ndarray
    passes: int
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def scaled_rows(vectors: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """``id`` and ``x`` (whole numbers) of the rows that take part."""
    source = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").alias("v"))
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < math.inf))
    rows = source.filter(F.col("v").isNotNull()).filter(sound)
    whole = F.transform("v", lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    rows = rows.select("id", whole.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n"))
    commonest = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return rows.filter(F.size("x") == (commonest.length if commonest else -1))


def _matrix(batch: pa.RecordBatch, column: int = 0) -> np.ndarray:
    """The vectors of a batch as rows of whole numbers."""
    lists = batch.column(column)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(lists), -1)


def _blocked(fit: DataFrame) -> DataFrame:
    """The vectors in blocks: a row holds many as one array of the narrowest whole numbers.

    Every pass reads all vectors, and a block is read without looking at its entries.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            low, high = x.min(initial=0), x.max(initial=0)
            kind = next(
                k for k in WIDTHS if np.iinfo(k).min <= low and high <= np.iinfo(k).max
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(x)], pa.int64()), pa.array([kind]), pa.array([x.astype(kind).tobytes()], pa.binary())],
                names=["vectors", "kind", "data"],
            )

    return fit.mapInArrow(run, "vectors long, kind string, data binary")


def _blocks(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for row in batch.to_pylist():
        yield np.frombuffer(row["data"], row["kind"]).reshape(row["vectors"], -1)


def _summed(fit: DataFrame, part: Callable[[np.ndarray], np.ndarray], shape) -> np.ndarray:
    """Sum over all vectors of a matrix that ``part`` makes of some of them."""
    rows, columns = shape
    names = [f"c{j}" for j in range(columns)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for x in _blocks(batch):
                total += part(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(rows, dtype=np.int32)), *map(pa.array, total.T.copy())],
            names=["i", *names],
        )

    schema = ", ".join(["i int", *[f"{c} double" for c in names]])
    added = fit.mapInArrow(run, schema).groupBy("i").agg(*[F.sum(c).alias(c) for c in names])
    out = np.zeros(shape)
    for row in added.collect():
        out[row.i] = row[1:]
    return out


def _whole_sums(fit: DataFrame, dimension: int) -> list[int]:
    """Exact sum of every dimension."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dimension
        for batch in batches:
            for x in _blocks(batch):
                wide = np.abs(x.astype(np.float64)).max() * len(x) >= 2.0**62
                own = x.astype(object) if wide else x.astype(np.int64)
                total = [t + int(s) for t, s in zip(total, own.sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dimension), pa.int32()), pa.array(map(str, total), pa.string())],
            names=["i", "s"],
        )

    parts = fit.mapInArrow(run, "i int, s string")
    added = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = {r.i: int(r.s) for r in added.collect()}
    return [found[i] for i in range(dimension)]


class _Covariance:
    """Multiplies the covariance of the fit list with columns, one pass at a time."""

    def __init__(self, fit: DataFrame, n: int, mean: np.ndarray) -> None:
        self.fit, self.n, self.mean, self.passes = fit, n, mean, 0

    def __call__(self, columns: np.ndarray) -> np.ndarray:
        mean = self.mean

        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ columns)

        self.passes += 1
        return _summed(self.fit, part, columns.shape) / self.n

    def trace(self) -> float:
        mean = self.mean
        squares = _summed(self.fit, lambda x: np.array([[((x - mean) ** 2).sum()]]), (1, 1))
        return float(squares[0, 0]) / self.n


def _bounds(covariance: _Covariance, dimension: int, random) -> tuple[float, float]:
    """A lower and an upper bound of the spectrum, by Lanczos steps."""
    basis = np.zeros((dimension, 0))
    vector = random.standard_normal(dimension)
    diagonal: list[float] = []
    beside: list[float] = []
    rest = 0.0
    for _ in range(min(BOUND_STEPS, dimension)):
        vector = vector / np.linalg.norm(vector)
        basis = np.column_stack([basis, vector])
        image = covariance(vector[:, None])[:, 0]
        diagonal.append(float(vector @ image))
        for _ in range(2):
            image = image - basis @ (basis.T @ image)
        rest = float(np.linalg.norm(image))
        beside.append(rest)
        if rest <= 1e-9 * max(abs(d) for d in diagonal):
            break
        vector = image
    small = np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1)
    found = np.linalg.eigvalsh(small)
    return max(0.0, float(found[0]) - rest), float(found[-1]) + rest


def _filtered(covariance, block, image, low: float, cut: float, top: float) -> np.ndarray:
    """The block after a Chebyshev polynomial that is small between ``low`` and ``cut``.

    ``image`` is the covariance times the block; growth is scaled to one at ``top``.
    """
    centre, half = (cut + low) / 2, max((cut - low) / 2, 1e-3 * top)
    first = half / max(top - centre, half)
    scale = first
    before, now = block, (image - centre * block) * (first / half)
    for _ in range(1, DEGREE):
        following = 1 / (2 / first - scale)
        grown = (covariance(now) - centre * now) * (2 * following / half)
        before, now = now, grown - scale * following * before
        scale = following
    return now


def _certified_pairs(covariance: _Covariance, dimension: int, wanted: int):
    """Eigenvalues, eigenvectors and residuals of the ``wanted`` largest."""
    random = np.random.default_rng(SEED)
    width = min(dimension, wanted + GUARDS)
    low, _ = _bounds(covariance, dimension, random)
    block, best = random.standard_normal((dimension, width)), None
    for _ in range(MOST_ROUNDS):
        block, _ = np.linalg.qr(block)
        image = covariance(block)
        small = block.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        top = max(float(values[0]), 0.0)
        if top == 0.0:
            return values[:0], block[:, :0], values[:0]
        residuals = np.linalg.norm(image - block * values, axis=0)[:wanted]
        worst = float(residuals.max())
        if best is None or worst < best[0]:
            settled = best is not None and worst > best[0] / 2
            best = (worst, values[:wanted], block[:, :wanted], residuals)
        else:
            settled = True
        if best[0] <= CERTIFIED * top and (settled or width == dimension):
            return best[1:]
        low = min(low, float(values[-1]))
        block = _filtered(covariance, block, image, low, float(values[-1]), top)
    raise ArithmeticError(f"residual {best[0]} was not certified in {MOST_ROUNDS} rounds")


def _facing(axes: np.ndarray) -> np.ndarray:
    """Each axis with its largest entry (the first of equals) above zero."""
    places = np.argmax(np.abs(axes) > np.abs(axes).max(axis=0) * (1 - 1e-9), axis=0)
    return axes * np.sign(axes[places, np.arange(axes.shape[1])])


def fit_whitening(rows: DataFrame, components: int) -> Whitening | None:
    """Fit on the distinct vectors of ``rows`` (``x``); none where there is nothing to fit."""
    distinct = rows.select("x").distinct()
    fit = stored(_blocked(distinct))
    counted = fit.agg(
        F.sum("vectors").alias("n"),
        F.max(F.octet_length("data") / F.col("vectors")).alias("bytes"),
    ).first()
    if not counted.bytes:
        return None
    n = counted.n
    dimension = next(_blocks(fit.limit(1).toArrow().to_batches()[0])).shape[1]
    sums = _whole_sums(fit, dimension)
    mean = np.array([s / n for s in sums])
    covariance = _Covariance(fit, n, mean)
    wanted = min(components, dimension)
    variances, axes, residuals = _certified_pairs(covariance, dimension, wanted)
    kept = variances > NO_VARIANCE * dimension * max(variances, default=0.0)
    model = Whitening(
        n, sums, _facing(axes[:, kept]), variances[kept], covariance.trace(), residuals[kept],
        covariance.passes,
    )
    if kept.any():
        model.identity_error = _identity_error(fit, model)
    return model


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    return (x - model.mean) @ model.axes / np.sqrt(model.variances)


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity."""
    k = len(model.variances)
    mean = _summed(fit, lambda x: _projected(x, model).sum(axis=0)[None, :], (1, k)) / model.n

    def part(x: np.ndarray) -> np.ndarray:
        centred = _projected(x, model) - mean
        return centred.T @ centred

    return float(np.abs(_summed(fit, part, (k, k)) / model.n - np.eye(k)).max())


def _deviations(x: np.ndarray, model: Whitening) -> pa.Array:
    """Sum over dimensions of ``(n x - S)^2``, exact; null beyond 38 digits."""
    reach = np.abs(x.astype(np.float64)).max(initial=0.0) * model.n
    reach += max(abs(s) for s in model.sums)
    kind = pa.decimal128(38, 0)
    if reach < 2.0**31 and reach * reach * x.shape[1] < 2.0**62:
        apart = x * model.n - np.array(model.sums, dtype=np.int64)
        return pa.array((apart * apart).sum(axis=1), pa.int64()).cast(kind)
    apart = x.astype(object) * model.n - np.array(model.sums, dtype=object)
    exact = [int(v) for v in (apart * apart).sum(axis=1)]
    return pa.array([str(v) if v < 10**38 else None for v in exact], pa.string()).cast(kind)


def whiten_rows(rows: DataFrame, model: Whitening) -> DataFrame:
    """``id``, ``component`` (from 1), ``deviation`` and ``whitened`` of every row."""
    k = len(model.variances)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch, 1)
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    _deviations(x, model).take(pa.array(each)),
                    pa.array(_projected(x, model).ravel()),
                ],
                names=["id", "component", "deviation", "whitened"],
            )

    made = "component int, deviation decimal(38,0), whitened double"
    return rows.select("id", "x").mapInArrow(run, f"id {kind}, {made}")


def whiten(
    vectors: DataFrame,
    components: int = 4,
    id_column: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """A row for every vector and component: the whitened entry and the fit's measures.

    ``id_column``, ``component`` from 1, ``n`` (vectors of the fit), ``deviation``
    (decimal, null beyond 38 digits), ``whitened``, ``explained`` (share of the whole
    variance) and ``identity_error``.  Entries become ``floor(scale * entry)``.
    """
    rows = scaled_rows(vectors, id_column, vector, scale)
    model = fit_whitening(rows, components)
    if model is None or not len(model.variances):
        rows, shares, n, error = rows.limit(0), [0.0], 0, 0.0
        model = model or Whitening(1, [], np.zeros((0, 0)), np.zeros(0), 0.0, np.zeros(0), 0)
    else:
        shares = [float(v) / model.trace for v in model.variances]
        n, error = model.n, model.identity_error
    explained = F.get(F.array(*[F.lit(s) for s in shares]), F.col("component") - 1)
    return whiten_rows(rows, model).select(
        F.col("id").alias(id_column),
        "component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(error).alias("identity_error"),
    )
