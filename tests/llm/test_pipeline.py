from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm.quality import score_quality, train_quality

from .test_exact_dedup import lower
from .test_mixing import by_hand as mix_by_hand
from .test_mixing import words
from .test_simhash import by_hand as fingerprint

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables not found")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage."""
    place = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, FOLDER)
        result.write.parquet(str(place / name))
        written = spark.read.parquet(str(place / name))
        out[name] = (docs, written)
        docs = written
    return out


def test_columns(stages):
    for name, (before, after) in stages.items():
        if name != "encode":
            assert after.columns == before.columns


def test_quality(spark, stages):
    before, after = stages["quality"]
    model = train_quality(before, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scores = score_quality(before, model, ["doc_id"]).collect()
    good = {r.doc_id for r in scores if r.score >= 0.3}
    assert Counter(rows_of(after)) == Counter(r for r in rows_of(before) if r[0] in good)


def test_exact_dedup(stages):
    before, after = stages["exact_dedup"]
    largest = {}
    for r in before.collect():
        largest[lower(r.text)] = max(largest.get(lower(r.text), -1), r.doc_id)
    keep = set(largest.values())
    assert Counter(rows_of(after)) == Counter(r for r in rows_of(before) if r[0] in keep)


def test_near_dedup(stages):
    before, after = stages["near_dedup"]
    rows = before.collect()
    prints = [fingerprint(r.text) for r in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    smallest = defaultdict(lambda: 1 << 60)
    for r, g in zip(rows, group, strict=True):
        smallest[g] = min(smallest[g], r.doc_id)
    keep = set(smallest.values())
    assert Counter(rows_of(after)) == Counter(tuple(r) for r in rows if r.doc_id in keep)


def test_mix(stages):
    before, after = stages["mix"]
    rows = [(r.doc_id, r.text, r.source, r.lang) for r in before.collect()]
    want = Counter()
    for (i, size, _, _, epochs, part), n in mix_by_hand(rows).items():
        if size:
            want[i] += (epochs + (part > 0)) * n
    assert Counter(r.doc_id for r in after.collect()) == +want
    assert abs(sum(words(r.text) for r in after.collect()) - sum(words(r[1]) for r in rows)) <= 20


def test_encode(stages):
    before, after = stages["encode"]
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    want = Counter()
    for r in before.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        packed = np.array(ids, dtype="<u4").tobytes()
        want[(r.doc_id, r.lang, r.source, len(ids), hashlib.sha256(packed).hexdigest())] += 1
    got = Counter(
        (r.doc_id, r.lang, r.source, r.n_tokens, hashlib.sha256(bytes(r.ids)).hexdigest())
        for r in after.collect()
    )
    assert got == want


def test_run(spark, stages):
    got = Counter((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == Counter((r.doc_id, r.n_tokens) for r in stages["encode"][1].collect())


def test_odd_rows(spark, odd, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    empty = tmp_path / "none"
    odd.limit(0).write.parquet(str(empty / "documents.parquet"))
    labels.limit(0).write.parquet(str(empty / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_columns_of_any_name(spark, odd):
    """Names with dots, blanks and backticks, and names that helpers use, go through."""
    names = ["m.x", "a b", "back`tick", "__k_id", "__stays", "__docs", "__n", "__key"]
    docs = odd
    for i, name in enumerate(names):
        docs = docs.withColumn(name, (odd.n_chars + i).cast("string"))
    for name, stage in corpus_pipeline.STAGES[1:3]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        plain = Counter(map(str, stage(spark, odd, FOLDER).collect()))
        assert Counter(map(str, out.select(*odd.columns).collect())) == plain
