"""Nearest vectors by inner product, with a forest of hash prefixes.

A tree is a random sequence of hyperplanes.  It gives every vector a long string of
sign bits, and the tree is the sorted array of these strings.  A query descends to the
vectors that share its longest prefix: a binary search for the bounds of each prefix.
It then ascends in all trees at the same time, one bit at a step, until the prefixes
hold as many vectors as asked for; what they hold are its candidates.  Inner products
are made an angle with one more coordinate, the root of what a vector lacks to the
longest norm, so longer vectors are nearer.

Vectors are dealt to ``least_shards`` shards, or to as many as keep them at about
``shard_rows``, which fill a task's memory.  Every vector is moved once.  A task reads a
shard's vectors, grows its forest once, and answers the queries as they stream past in
batches; it gives at most ``k`` rows for a query.  Equal vectors are one entry with its
``k + 1`` smallest ids, more than any query needs, so a vector that very many rows share
costs no more than another.

Vectors that are null, zero, or hold a null or non-finite component take no part, nor
do rows without an id.  Rows that repeat an id count once, with the smallest vector.
A query's candidates have its own dimension.  However many candidates tie with the last
score, those of the smallest ids are kept.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TREES = 128
DEPTH = 24
SEED = 20
#: Inner products held at a time.
SCORES = 1 << 22


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``id`` and ``vector`` (doubles) of the rows that take part, one for each id."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    rows = (
        vectors.select(F.col(id_column).cast("long").alias("id"), values.alias("vector"))
        .filter(F.col("id").isNotNull() & F.col("vector").isNotNull())
        .filter(sound & F.exists("vector", lambda x: x != 0))
    )
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


class Forest:
    """Sorted arrays of the sign strings of one shard's vectors."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> None:
        self.vectors, self.trees, self.depth = vectors, trees, depth
        norms = np.sqrt((vectors**2).sum(axis=1))
        lacking = np.sqrt(np.maximum(norms.max() ** 2 - norms**2, 0.0))
        longer = np.concatenate([vectors, lacking[:, None]], axis=1)
        random = np.random.default_rng(SEED)
        self.planes = random.standard_normal((longer.shape[1], trees * depth)).astype(np.float32)
        strings = self.strings(longer)
        self.order = np.argsort(strings, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def strings(self, longer: np.ndarray) -> np.ndarray:
        """Sign strings as integers, a row for each tree."""
        weights = 1 << np.arange(self.depth - 1, -1, -1, dtype=np.int32)
        out = np.empty((self.trees, len(longer)), dtype=np.int32)
        own = longer.astype(np.float32)
        for tree in range(self.trees):
            planes = self.planes[:, tree * self.depth : (tree + 1) * self.depth]
            out[tree] = (own @ planes > 0) @ weights
        return out

    def candidates(self, queries: np.ndarray, wanted: int) -> np.ndarray:
        """For every query a mask of the vectors that its prefixes hold."""
        norms = np.sqrt((queries**2).sum(axis=1))
        longer = np.concatenate([queries / norms[:, None], np.zeros((len(queries), 1))], axis=1)
        strings = self.strings(longer)
        low = np.empty((self.trees, self.depth + 1, len(queries)), dtype=np.int32)
        high = np.empty_like(low)
        for tree in range(self.trees):
            for level in range(self.depth + 1):
                rest = self.depth - level
                prefix = strings[tree] >> rest << rest
                low[tree, level] = np.searchsorted(self.sorted[tree], prefix)
                high[tree, level] = np.searchsorted(self.sorted[tree], prefix + (1 << rest))
        held = (high - low).sum(axis=0)
        enough = held >= min(wanted, self.trees * len(self.vectors))
        # The deepest level that holds enough; the empty prefix holds everything.
        level = self.depth - np.argmax(enough[::-1], axis=0)
        found = np.zeros((len(queries), len(self.vectors)), dtype=bool)
        for q in range(len(queries)):
            row = found[q]
            for tree in range(self.trees):
                row[self.order[tree, low[tree, level[q], q] : high[tree, level[q], q]]] = True
        return found


class _Shard:
    """The entries of a shard as they arrive, and its forest once they are all there."""

    def __init__(self, k: int, wanted: float) -> None:
        self.k, self.wanted = k, wanted
        self.parts: list[np.ndarray] = []
        self.ids: list[list[int]] = []
        self.forest: Forest | None = None

    def add(self, vectors: np.ndarray, ids: pa.Array) -> None:
        self.parts.append(vectors)
        self.ids += [sorted(x) for x in ids.to_pylist()]

    def answers(self, queries: np.ndarray, ids: list[int]) -> Iterator[tuple[int, int, float]]:
        """The nearest ``k`` of the shard for every query."""
        if not self.ids:
            return
        if self.forest is None:
            self.forest = Forest(np.concatenate(self.parts))
            self.parts.clear()
            self.longest = np.sqrt((self.forest.vectors**2).sum(axis=1).max())
        vectors, forest = self.forest.vectors, self.forest
        # An entry is held at most once by each tree, a query's own one by all of them: this
        # is enough for k others, or for all there are.
        enough = max(int(self.wanted * len(vectors)) + forest.trees, forest.trees * (self.k + 1))
        step = max(1, SCORES // len(vectors))
        for at in range(0, len(queries), step):
            block = queries[at : at + step]
            found = forest.candidates(block, enough)
            # With candidates this dense a product of all, masked, beats gathering them.
            scores = np.where(found, block @ vectors.T, -np.inf)
            # One more than k, as one entry may be the query's own.  Sums of another order
            # may differ in the last digits: all that may tie with the last are scored anew.
            most = min(len(vectors), self.k + 1)
            last = -np.partition(-scores, most - 1, axis=1)[:, most - 1]
            sizes = np.sqrt((block**2).sum(axis=1)) * self.longest
            least = last - 4 * block.shape[1] * np.finfo(np.float64).eps * sizes
            for q, query_id in enumerate(ids[at : at + step]):
                own = np.flatnonzero(found[q] & ~(scores[q] < least[q]))
                exact = (vectors[own] * block[q]).sum(axis=1)
                rows = heapq.nsmallest(
                    self.k,
                    (
                        (-score, i)
                        for entry, score in zip(own.tolist(), exact.tolist(), strict=True)
                        for i in self.ids[entry]
                        if i != query_id
                    ),
                )
                yield from ((query_id, i, -score) for score, i in rows)


def _search(
    batches: Iterable[pa.RecordBatch], k: int, wanted: float
) -> Iterator[pa.RecordBatch]:
    """Answers of all shards of a task, whose rows are sorted: entries, then queries."""
    current, shard = None, None
    for batch in batches:
        keys = [batch.column(i).to_pylist() for i in range(3)]
        rows = list(zip(*keys, strict=True))
        out: list[tuple[int, int, float]] = []
        first = 0
        while first < len(rows):
            dimension, number, is_query = rows[first]
            last = first
            while last < len(rows) and rows[last] == rows[first]:
                last += 1
            if (dimension, number) != current:
                current, shard = (dimension, number), _Shard(k, wanted)
            own = batch.slice(first, last - first)
            values = own.column(5).flatten().to_numpy(zero_copy_only=False)
            vectors = values.reshape(-1, dimension).astype(np.float64)
            if is_query:
                out += shard.answers(vectors, own.column(3).to_pylist())
            else:
                shard.add(vectors, own.column(4))
            first = last
        if out:
            columns = zip(*out, strict=True)
            kinds = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["query_id", "vec_id", "score"],
            )


def nearest(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    id_column: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = 262_144,
    least_shards: int = 16,
    wanted: float = 1.0,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest found for each query.

    Queries are the rows whose id is divisible by ``every``, candidates all others.  A
    query ascends until the prefixes of a shard's trees hold ``wanted`` times as many
    vectors as the shard, counting one for each tree that it is found in and leaving out
    itself.
    """
    rows = usable(vectors, id_column, vector)
    by_id = Window.partitionBy("vector").orderBy("id")
    entries = (
        rows.withColumn("place", F.row_number().over(by_id))
        .filter(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.collect_list("id").alias("ids"))
    )
    shards = max(least_shards, math.ceil(rows.count() / shard_rows))
    dealt = entries.select(
        F.size("vector").alias("dimension"),
        F.pmod(F.xxhash64("vector"), F.lit(shards)).alias("shard"),
        F.lit(False).alias("is_query"),
        F.array_min("ids").alias("id"),
        "ids",
        "vector",
    )
    asked = rows.filter(F.col("id") % every == 0).select(
        F.size("vector").alias("dimension"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        F.lit(True).alias("is_query"),
        "id",
        F.array().cast("array<long>").alias("ids"),
        "vector",
    )

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search(batches, k, wanted)

    # The order of rows that arrive by the network must not change the results.
    ordered = (
        dealt.union(asked)
        .repartition("dimension", "shard")
        .sortWithinPartitions("dimension", "shard", "is_query", "id")
    )
    found = ordered.mapInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
