from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import exact_dedup
from millrace.llm.exact_dedup import drop_copies, exact_groups, sha256_hex


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def by_hand(rows, digest):
    groups = defaultdict(list)
    for i, text in rows:
        groups[lower(text)].append(i)
    out = Counter()
    for content, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        kept = False
        for i in ids:
            own = i == keep and not kept
            kept |= own
            out[(i, keep, len(ids), own, digest(content))] += 1
    return out


def sha(content):
    return hashlib.sha256(content.encode()).hexdigest()


@pytest.mark.parametrize("weak", [False, True])
def test_groups(odd, weak):
    """With a digest that many texts share the whole texts still tell them apart."""
    column = (lambda c: F.length(c).cast("string")) if weak else sha256_hex
    own = (lambda c: str(len(c))) if weak else sha
    got = Counter(map(tuple, exact_groups(odd, digest=column, salts=3).collect()))
    assert got == by_hand([(r.doc_id, r.text) for r in odd.collect()], own)


@pytest.mark.parametrize("parts", [1, 1000])
def test_a_large_group(spark, monkeypatch, parts):
    """Whether its digest counts as hot or not."""
    monkeypatch.setattr(exact_dedup, "HOT_PARTS", parts)
    docs = spark.range(0, 6000, numPartitions=13).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "Many copies").otherwise(F.col("id").cast("string")).alias("text"),
    )
    rows = exact_groups(docs, salts=4).filter("group_size > 1").collect()
    assert {(r.keep_id, r.group_size) for r in rows} == {(5997, 2000)}
    assert [r.doc_id for r in rows if r.kept] == [5997]


def test_rows_that_stay(odd):
    kept = drop_copies(odd)
    assert kept.columns == odd.columns
    got = Counter((r.doc_id, lower(r.text)) for r in kept.collect())
    want = Counter()
    groups = defaultdict(list)
    for r in odd.collect():
        groups[lower(r.text)].append(r.doc_id)
    for content, ids in groups.items():
        known = [i for i in ids if i is not None]
        want[(max(known) if known else None, content)] += 1
    assert got == want
    assert drop_copies(odd.limit(0)).count() == 0
    assert exact_groups(odd.limit(0)).count() == 0
