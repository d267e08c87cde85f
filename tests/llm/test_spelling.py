from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm.spelling import PositionIndex, group_variants, near_words, vocabulary

CAPITALS = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words_by_hand(rows):
    found = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(CAPITALS)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            at = h % len(run)
            found[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    """Exactly one letter inserted, deleted or replaced, by the definition."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def groups_by_hand(words):
    near = defaultdict(list)
    for a in words:
        near[a] = [b for b in words if is_near(a, b)]
    best = {a: min(bs, key=lambda b: (-words[b], b)) for a, bs in near.items() if bs}
    form = {a: b for a, b in best.items() if words[b] >= 10 * words[a]}
    out = set()
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        f = form.get(word)
        out.add((word, f, root, n, len(near[word]), words.get(f)))
    return out


def grouped(spark, words, **options):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = group_variants(df, **options).collect()
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows]


def variants(rng, count, letters="abcdé", least=7, most=11):
    words = set()
    while len(words) < count:
        word = "".join(rng.choices(letters, k=rng.randint(least, most)))
        for _ in range(rng.randint(1, 6)):
            words.add(word)
            at = rng.randrange(len(word))
            word = rng.choice(
                [
                    word[:at] + rng.choice(letters) + word[at:],
                    word[:at] + rng.choice(letters) + word[at + 1 :],
                    word[:at] + word[at + 1 :] if len(word) > least else word,
                    word + rng.choice(letters),
                ]
            )
    return {w: int(10 ** rng.uniform(0.3, 4)) for w in words}


@pytest.mark.parametrize("shard_words", [4096, 8])
def test_random_words(spark, shard_words):
    words = variants(random.Random(1), 700)
    got = grouped(spark, words, shard_words=shard_words)
    assert len(got) == len(words) and set(got) == groups_by_hand(words)


def test_index_finds_each_pair_once():
    rng = random.Random(4)
    words = sorted(variants(rng, 300, "ab", 7, 8))
    words = [w for w in words if len(w) in (7, 8)]
    index = PositionIndex(words, 7)
    short = np.flatnonzero(~index.long)
    found = Counter()
    for lo, hi in ((0, 2), (2, 3), (3, 7)):
        one, other = index.near(short, lo, hi)
        found.update(zip(one.tolist(), other.tolist(), strict=True))
    want = {
        (i, j)
        for i, a in enumerate(words)
        if len(a) == 7
        for j, b in enumerate(words)
        if is_near(a, b)
    }
    assert set(found) == want and set(found.values()) <= {1}


def test_one_half_shared_by_all(spark):
    # All words agree in one half, so that half is halved again.
    rng = random.Random(5)
    ends = {"".join(rng.choices("abc", k=4)) for _ in range(70)}
    words = {"commonbegin" + e: rng.randint(2, 900) for e in ends}
    words |= {e + "commonend": rng.randint(2, 900) for e in ends}
    assert set(grouped(spark, words, shard_words=10)) == groups_by_hand(words)


def test_ties_and_chains(spark):
    words = {"aaaaaaa": 3, "aaaaaab": 30, "aaaaaac": 30, "aaaaabb": 300, "aaaabbb": 3000, "aaaabbbb": 30000}
    got = {r[0]: r for r in grouped(spark, words)}
    assert got["aaaaaaa"] == ("aaaaaaa", "aaaaaab", "aaaabbbb", 3, 2, 30)
    assert got["aaaabbbb"] == ("aaaabbbb", None, "aaaabbbb", 30000, 1, None)


def test_very_long_words(spark):
    base = "ab" * 20_000
    words = {base: 50, base + "c": 2, "x" + base: 5, base[:9000] + "z" + base[9001:]: 3, base[1:]: 7}
    assert set(grouped(spark, words)) == groups_by_hand(words)


def test_vocabulary(spark, odd):
    docs = odd.withColumnRenamed("score", "word").withColumnRenamed("size", "n")
    docs = docs.union(docs).unionByName(
        docs.selectExpr(
            "doc_id + 100 AS doc_id", "'Überraschung ÜBERRASCHUNG strasse×weiß Œuvres' AS text",
            "lang", "source", "n_chars", "word", "n",
        )
    )
    got = {r.word: r.n for r in vocabulary(docs).collect()}
    assert got == words_by_hand((r.doc_id, r.text) for r in docs.collect())
    # Only A to Z are lower-cased; the multiplication sign is among the letters.
    assert {"Überraschung", "strasse×weiß"} <= set(got)


def test_query(spark, table, tmp_path):
    from millrace.llm.queries import op12_spelling

    rng = random.Random(8)
    words = list(variants(rng, 120))
    texts = [" ".join(rng.choices(words, weights=[1 + 300 * (i % 9 == 0) for i in range(len(words))], k=60)) for _ in range(80)]
    rows = [(i if i % 7 else None, t, "a", "en") for i, t in enumerate(texts)]
    rows += [(1, None, None, None), (2, "", None, None)]
    table(rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = op12_spelling(spark, str(tmp_path))
    got = [tuple(r) for r in out.collect()]
    assert set(got) == groups_by_hand(words_by_hand((r[0], r[1]) for r in rows))
    assert len(set(got)) == len(got)


def test_no_words(spark, odd):
    assert group_variants(vocabulary(odd.limit(0))).collect() == []
    one = spark.createDataFrame([("onlyone", 5)], "word string, n long")
    assert near_words(one).collect() == []
