"""Near-duplicate texts by SimHash fingerprints, found with BK-trees.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word
shingles.  Texts whose fingerprints differ in few bits are linked, and linked
texts form a component.

Search.  Equal fingerprints are one node.  The bits are cut into blocks, more than
``radius`` of them; two fingerprints that differ in at most ``radius`` bits agree in all
blocks but ``radius`` at least.  So the fingerprints that agree in a *band*, a choice of that
many blocks, form a *shard*, and every link lies inside a shard.  The more fingerprints there
are, the more blocks are taken (``block_count``): a band then has more bits, and shards stay
small.  Each shard gets a BK-tree: children hang under their integer Hamming
distance to the parent, and a search follows only the edges within the radius of
its own distance.  The shuffle brings a shard's tree and its searches together;
collecting the trees for a broadcast would pass all fingerprints through the
driver.  A shard larger than ``shard_limit`` is cut into parts, and every pair of
parts is a task of its own, so no task holds more than two parts.

A task gives one link for each fingerprint that it joins to others (a spanning
forest of its links), not all pairs.  Components are joined over all shards by
``components.connect``.

Texts: null counts as empty.  A text without words has the fingerprint zero and is
linked like any other.  Rows with a null or repeated id take part like others; the
component of a group whose ids are all null is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.components import connect
from millrace.llm.rows import drop_rows
from millrace.llm.textblocks import Block, lowered, map_texts, spaced_words, spaces, sums
from millrace.session import cut_lineage

SEED = 42
BITS = 64
#: For each byte value its eight bits, each in a byte of a 64-bit counter.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_SPREAD = np.ascontiguousarray(_SPREAD).view(np.uint64).ravel()
_FULL = 255


def _majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Bits set in over half the hashes between neighbouring bounds.

    Eight counters of a byte each are added at once, over at most 255 hashes; the
    parts are then added up with room to spare.
    """
    counts = np.diff(bounds)
    text_of = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(hashes)) - bounds[:-1][text_of]
    parts = np.flatnonzero(within % _FULL == 0)
    lanes = _SPREAD[hashes.view(np.uint8).reshape(-1, 8)]
    partial_sums = np.add.reduceat(lanes, parts, axis=0) if len(parts) else lanes
    bits = partial_sums.view(np.uint8).reshape(-1, BITS).astype(np.int64)
    totals = sums(bits, np.searchsorted(parts, bounds))
    ones = totals * 2 > counts[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()


def _block_fingerprints(block: Block, shingle: int) -> np.ndarray:
    data = lowered(block.data)
    words = spaced_words(data, block)
    first = words.first_of_text()
    # Words side by side with one blank between them.
    lengths = words.ends - words.starts
    at = np.concatenate([[0], np.cumsum(lengths + 1)])
    joined = np.full(int(at[-1]), 0x20, dtype=np.uint8)
    slots = np.ones(int(at[-1]), dtype=bool)
    slots[at[1:] - 1] = False
    joined[slots] = data[~spaces(data)]
    starts, ends = at[:-1], at[:-1] + lengths
    # The whole sequence is the only shingle of a text with fewer words.
    count = np.where(words.count >= shingle, words.count - shingle + 1, words.count > 0)
    bounds = np.concatenate([[0], np.cumsum(count)])
    text_of = np.repeat(np.arange(len(count)), count)
    head = first[:-1][text_of] + np.arange(bounds[-1]) - bounds[:-1][text_of]
    tail = np.minimum(head + shingle, first[1:][text_of]) - 1
    whole = joined.tobytes()
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[head].tolist(), ends[tail].tolist(), strict=True)
    hashes = np.fromiter(
        (digest(whole[s:e], SEED) for s, e in pairs), dtype=np.uint64, count=int(bounds[-1])
    )
    return _majority(hashes, bounds)


def _fingerprint_batches(batches, text, keep, shingle, schema):
    def results(block: Block) -> list[pa.Array]:
        return [pa.array(_block_fingerprints(block, shingle).view(np.int64))]

    return map_texts(batches, text, keep, results, schema)


def fingerprints(
    docs: DataFrame, keep: list[str], text: str = "text", shingle: int = 3, out: str = "simhash"
) -> DataFrame:
    """``keep`` columns and the signed 64-bit fingerprint of every whole text."""
    keep = [c for c in keep if c != out]
    source = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    kept = docs.select(*keep)
    made = kept.withColumn(out, F.lit(0).cast("long")).schema
    made[out].nullable = True
    run = partial(
        _fingerprint_batches,
        text="__text",
        keep=keep,
        shingle=shingle,
        schema=to_arrow_schema(made),
    )
    return source.mapInArrow(run, made)


class BKTree:
    """Integers under Hamming distance; a child's key is its distance to its parent."""

    def __init__(self, radius: int) -> None:
        self.radius = radius
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        new = len(self.values) - 1
        node = 0
        while new:
            distance = (self.values[node] ^ value).bit_count()
            child = self.children[node].setdefault(distance, new)
            if child == new:
                return
            node = child

    def near(self, value: int) -> Iterator[int]:
        """Places of all values within the radius."""
        stack = [0] if self.values else []
        radius = self.radius
        while stack:
            node = stack.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                yield node
            for edge, child in self.children[node].items():
                if -radius <= edge - distance <= radius:
                    stack.append(child)


def _forest(left: list[int], right: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Links that join what lies within the radius, one for each joined value.

    ``right`` is empty for the links inside ``left``; otherwise links lead from
    ``right`` to ``left``.
    """
    tree = BKTree(radius)
    root = list(range(len(left) + len(right)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def join(place: int, value: int) -> Iterator[tuple[int, int]]:
        for other in tree.near(value):
            a, b = find(place), find(other)
            if a != b:
                root[max(a, b)] = min(a, b)
                yield value, tree.values[other]

    for place, value in enumerate(left):
        if not right:
            yield from join(place, value)
        tree.add(value)
    for place, value in enumerate(right):
        yield from join(len(left) + place, value)


def _shard_links(frames: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Links of the shards of a partition, whose rows come ordered by shard."""
    key, sides, found = None, ([], []), []

    def finish() -> None:
        left, right = sides
        if key is not None and (key[2] == key[3] or right):
            found.extend(_forest(left, right, radius))

    def flush() -> pd.DataFrame:
        # Signed and unsigned 64-bit values have the same bits.
        table = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        found.clear()
        return pd.DataFrame({"a": table[:, 0], "b": table[:, 1]})

    for frame in frames:
        values = frame["fp"].to_numpy().view(np.uint64).tolist()
        columns = [frame[c].tolist() for c in ("band", "value", "part_a", "part_b", "part")]
        for value, *own, part in zip(values, *columns, strict=True):
            if own != key:
                finish()
                key, sides = own, ([], [])
            sides[0 if part == key[2] else 1].append(value)
        if found:
            yield flush()
    finish()
    yield flush()


def block_count(nodes: int, radius: int, shard_limit: int) -> int:
    """Blocks of bits: as few as make shards of evenly spread fingerprints fit the limit.

    With a radius of three: four blocks (4 bands of 16 bits) up to some 10**8 fingerprints,
    five (10 bands of 25 bits) up to 10**11, six (20 bands of 32 bits) up to 10**13.
    """
    blocks = radius + 1
    while blocks < 2 * radius and nodes > shard_limit << (BITS * (blocks - radius) // blocks):
        blocks += 1
    return blocks


def band_masks(blocks: int, radius: int) -> list[int]:
    """The bits of each choice of ``blocks - radius`` blocks, as signed 64-bit numbers."""
    bounds = [BITS * i // blocks for i in range(blocks + 1)]
    own = [(1 << high) - (1 << low) for low, high in pairwise(bounds)]
    masks = [sum(chosen) for chosen in combinations(own, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(nodes: DataFrame, radius: int = 3, shard_limit: int = 4096) -> DataFrame:
    """Links (``a``, ``b``) that span everything within ``radius`` bits.

    ``nodes`` has the distinct fingerprints in ``fp``.  No link between different
    components is lost; links inside a component need not all be named.
    """
    blocks = block_count(nodes.count(), radius, shard_limit)
    keys = [
        F.struct(
            F.lit(number).alias("band"), F.col("fp").bitwiseAND(F.lit(mask)).alias("value")
        )
        for number, mask in enumerate(band_masks(blocks, radius))
    ]
    banded = nodes.select("fp", F.inline(F.array(*keys)))
    shards = banded.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / F.lit(shard_limit)).cast("int")
    placed = (
        banded.join(shards, ["band", "value"])
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    )
    numbers = F.sequence(F.lit(0), F.col("parts") - 1)
    tiles = placed.select(
        "fp", "band", "value", "part", F.explode(numbers).alias("other")
    ).select(
        "fp",
        "band",
        "value",
        F.least("part", "other").alias("part_a"),
        F.greatest("part", "other").alias("part_b"),
        "part",
    )
    tile = ["band", "value", "part_a", "part_b"]
    dealt = tiles.repartition(*tile).sortWithinPartitions(*tile, "part", "fp")
    return dealt.mapInPandas(partial(_shard_links, radius=radius), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    radius: int = 3,
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (the id), ``simhash``, ``root`` and ``component_id`` for every row.

    ``root`` is the component's smallest fingerprint and ``component_id`` the smallest id
    that links lead to.  Fingerprints are made
    once and written, without the texts.
    """
    keep = keep or [id_column]
    marked = cut_lineage(fingerprints(docs, keep, text, shingle))
    smallest = F.min(id_column).alias("smallest")
    nodes = cut_lineage(marked.groupBy(F.col("simhash").alias("fp")).agg(smallest))
    joined = connect(links(nodes.select("fp"), radius))
    # Only linked fingerprints need a look-up; the others are their own component.
    rooted = nodes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    named = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    roots = rooted.select("fp", "root").join(named, "root")
    return marked.join(roots.withColumnRenamed("fp", "simhash"), "simhash").select(
        *keep, "simhash", "root", "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    radius: int = 3,
) -> DataFrame:
    """``docs`` with one row of every component, that with the smallest id.

    Only keys are moved to find the rows; of rows that share the smallest id the one
    whose text has the smallest digest stays.
    """
    digest = F.sha2(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary"), 256)
    keyed = docs.select(F.col(f"`{id_column}`").alias("id"), digest.alias("digest"), F.col(f"`{text}`").alias("text"))
    found = near_duplicates(keyed, "id", "text", shingle, radius, ["id", "digest"])
    rows = cut_lineage(found.select("id", "digest", "root"))
    member = F.struct("id", "digest")
    shared = rows.groupBy("root").agg(F.min(member).alias("first"), F.count("*").alias("n")).filter("n > 1")
    touched = (
        rows.join(shared, "root")
        .groupBy("id", "digest")
        .agg(F.max(F.col("first") == member).alias("stays"), F.count("*").alias("n"))
        .filter("not stays or n > 1")
        .drop("n")
    )
    return drop_rows(docs, {"id": F.col(f"`{id_column}`"), "digest": digest}, touched, few=True)


def hex_digits(column: str = "simhash"):
    """A fingerprint as 16 lowercase hexadecimal digits."""
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")
