from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm.sharding import GROUP_PARTS, LARGE_DRAWS, _slim, _subdivide, assign_shards


def by_hand(rows, shards):
    """Shard and slot of (id, text) rows, as tuples that also tell size and crc32.

    So few rows are all drawn, so every text of four rows is a large group.
    """
    slim = []
    for i, text in rows:
        data = (text or "").encode()
        slim.append((hashlib.md5(data).hexdigest(), i is not None, i or 0, len(data) + 1, zlib.crc32(data)))
    slim.sort()
    share = sum(r[3] for r in slim) / shards
    group, number = defaultdict(int), defaultdict(int)
    for row in slim:
        group[row[0]] += row[3]
        number[row[0]] += 1
    large = [d for d in group if group[d] * GROUP_PARTS > share or number[d] >= LARGE_DRAWS]
    used, laid = [0.0] * shards, {}
    for digest in sorted(large, key=lambda d: (-group[d], d)):
        emptiest = used.index(min(used))
        if used[emptiest] + group[digest] <= share * (1 + 1 / GROUP_PARTS):
            laid[digest] = emptiest
            used[emptiest] += group[digest]
    rooms = [max(0.0, share - u) for u in used]
    scale = (share * shards - sum(used)) / sum(rooms) if sum(rooms) else 0
    ends = list(itertools.accumulate(room * scale for room in rooms[:-1]))
    out, begin, first, filled = [], 0, {}, defaultdict(int)
    for digest, known, i, size, crc in slim:
        if digest in laid:
            continue
        first.setdefault(digest, begin)
        whole = digest not in large
        middle = 2 * first[digest] + group[digest] if whole else 2 * begin + size
        shard = sum(2 * end <= middle for end in ends)
        out.append((i if known else None, size, crc, shard, filled[shard]))
        filled[shard] += 1
        begin += size
    for digest, known, i, size, crc in slim:
        if digest in laid:
            shard = laid[digest]
            out.append((i if known else None, size, crc, shard, filled[shard]))
            filled[shard] += 1
    return out


@pytest.mark.parametrize("limit", [40, 250_000])
def test_places(spark, limit):
    """Also where ranges with over 40 rows are subdivided."""
    rng = random.Random(1)
    rows = [(i, "hot text " * 3) for i in range(900)]
    rows += [(i, "warm") for i in range(900, 960)]
    rows += [(i, "x" * rng.randrange(200)) for i in range(960, 2500)]
    rows += [(i, f"text {i} " * rng.randrange(1, 30)) for i in range(2500, 3200)]
    rows += [(None, None), (None, "é"), (5, "hot text " * 3)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = [tuple(r) for r in assign_shards(docs, 8, range_limit=limit).collect()]
    assert sorted(got, key=str) == sorted(by_hand(rows, 8), key=str)
    bytes_of = defaultdict(int)
    for _, size, _, shard, _ in got:
        bytes_of[shard] += size
    assert max(bytes_of.values()) < 1.05 * min(bytes_of.values())


def test_odd_rows(odd):
    got = [tuple(r) for r in assign_shards(odd, 3).collect()]
    want = by_hand([(r.doc_id, r.text) for r in odd.collect()], 3)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert assign_shards(odd.limit(0), 3).count() == 0
    one = assign_shards(odd.limit(1), 8).collect()
    assert len(one) == 1 and one[0].slot == 0


def shards_of_groups(got):
    out = defaultdict(set)
    for r in got:
        out[r.text_crc32].add(r.shard)
    return out


def test_groups_stay_whole_while_they_fit_a_shard(spark):
    """Groups of up to a shard's bytes are whole, larger ones are cut, and sizes are near equal."""
    texts = ["a" * 99] * 300 + ["b" * 99] * 700 + ["c" * 99] * 900 + ["d" * 99] * 2500
    rows = list(enumerate([*texts, *[f"own {i} " + "x" * 91 for i in range(3600)]]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = assign_shards(docs, 8, range_limit=500).collect()
    bytes_of = defaultdict(int)
    for r in got:
        bytes_of[r.shard] += r.size
    assert max(bytes_of.values()) < 1.02 * min(bytes_of.values())
    spread = shards_of_groups(got)
    whole, cut = (zlib.crc32(t.encode()) for t in ("c" * 99, "d" * 99))
    assert len(spread[whole]) == 1 and len(spread[cut]) >= 3
    assert [len(spread[zlib.crc32((c * 99).encode())]) for c in "ab"] == [1, 1]
    for shard in range(8):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))


def test_many_rows_of_few_bytes_are_subdivided(spark):
    """A third of all rows are empty: whole in one shard, in ranges of bounded rows."""
    rows = [(i, "") for i in range(1500)] + [(i, f"text {i} " * 40) for i in range(1500, 4500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    limit = 200
    plain = assign_shards(docs, 8, range_limit=limit).collect()
    assert sorted(map(tuple, plain)) == sorted(by_hand(rows, 8))
    assert len({r.shard for r in plain if r.size == 1}) == 1
    slim = _slim(docs, "doc_id", "text").withColumn("range", F.lit(0))
    summary = slim.groupBy("range").agg(F.count("*").alias("rows"))
    empty = hashlib.md5(b"").hexdigest()
    parts = _subdivide(slim, summary, [empty], limit).groupBy("sub").count().collect()
    assert max(r["count"] for r in parts) < 3 * limit
