from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from millrace.llm.components import connect
from millrace.llm.simhash import (
    BKTree,
    _block_fingerprints,
    band_masks,
    block_count,
    drop_near_duplicates,
    links,
    near_duplicates,
)
from millrace.llm.textblocks import blocks


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def by_hand(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    count = max(len(words) - shingle + 1, 1 if words else 0)
    grams = [" ".join(words[i : i + shingle]) for i in range(count)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, pairs):
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def test_fingerprints():
    rng = random.Random(2)
    texts = [None, "", " \n", "One", "one TWO", "a\x0bb\x1cc d"]
    texts += ["".join(rng.choices("aB é\t\n  ", k=rng.randrange(80))) for _ in range(300)]
    texts.append(" ".join(rng.choices(["x", "yy", "Zzz"], k=4000)))
    for limit in (10, 1000, 1 << 20):
        got = [
            int(x)
            for block in blocks(pa.array(texts, pa.string()), limit)
            for x in _block_fingerprints(block, 3)
        ]
        assert got == [by_hand(t) for t in texts]


def test_tree_finds_all_in_the_radius():
    rng = random.Random(4)
    values = [rng.getrandbits(12) for _ in range(400)]
    tree = BKTree(2)
    for value in values:
        tree.add(value)
    for value in range(0, 4096, 37):
        near = sorted(tree.values[i] for i in tree.near(value))
        assert near == sorted(v for v in values if (v ^ value).bit_count() <= 2)


def test_blocks_grow_with_the_fingerprints():
    assert [block_count(n, 3, 4096) for n in (0, 10**8, 10**10, 10**12)] == [4, 4, 5, 6]
    rng = random.Random(3)
    for blocks, bands in ((4, 4), (5, 10), (6, 20)):
        masks = band_masks(blocks, 3)
        assert len(masks) == len(set(masks)) == bands
        assert min((m & (2**64 - 1)).bit_count() for m in masks) >= 64 * (blocks - 3) // blocks - 3
        for _ in range(300):
            a = b = rng.getrandbits(64)
            for _ in range(3):
                b ^= 1 << rng.randrange(64)
            assert any((a & m) == (b & m) for m in masks)


@pytest.mark.parametrize(("limit", "blocks"), [(3, None), (4096, None), (4096, 5), (5, 6)])
def test_links_join_what_is_near(spark, limit, blocks, monkeypatch):
    """Also where shards are cut into parts of a few fingerprints, and with more blocks."""
    if blocks:
        monkeypatch.setattr("millrace.llm.simhash.block_count", lambda *_: blocks)
    rng = random.Random(6)
    seeds = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    values = set(seeds)
    for _ in range(400):
        value = rng.choice(sorted(values))
        for _ in range(rng.randrange(5)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    signed = np.array(sorted(values), dtype=np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = links(nodes, 3, limit)
    pairs = [
        (a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    ]
    want = roots(signed, pairs)
    assert roots(signed, [(r.a, r.b) for r in found.collect()]) == want
    linked = {x for pair in pairs for x in pair}
    assert {r.node: r.root for r in connect(found).collect()} == {v: want[v] for v in linked}


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 260)] + [(3, 3)]
    found = connect(spark.createDataFrame(pairs, "a long, b long")).collect()
    got = {r.node: r.root for r in found}
    want = roots({x for p in pairs[:-1] for x in p}, pairs[:-1])
    assert got == want and len(found) == len(got)
    assert connect(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    prints = [by_hand(t) for _, t in rows]
    pairs = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if (prints[a] ^ prints[b]).bit_count() <= 3
    ]
    root = roots(range(len(rows)), pairs)
    groups = {}
    for place in range(len(rows)):
        groups.setdefault(root[place], []).append(rows[place])
    want, stay = Counter(), Counter()
    for place, (i, _) in enumerate(rows):
        known = [x for x, _ in groups[root[place]] if x is not None]
        want[(i, prints[place], min(known) if known else None)] += 1
    found = near_duplicates(odd).select("doc_id", "simhash", "component_id").collect()
    assert Counter((r.doc_id, r.simhash & (2**64 - 1), r.component_id) for r in found) == want

    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    stay = Counter(by_hand(r.text) for r in kept.collect())
    assert len(groups) == kept.count() == sum(stay.values())
    for members in groups.values():
        assert sum(stay[by_hand(t)] for t in {t for _, t in members}) >= 1
    assert drop_near_duplicates(odd.limit(0)).count() == 0
