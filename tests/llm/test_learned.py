"""Language and quality: accuracy on held-out rows, and odd rows."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm.language import predict_language, presence, train_language
from millrace.llm.quality import keep_good, score_quality, train_quality
from millrace.llm.queries import op6_language_id, op8_quality
from millrace.llm.samples import held_out, training_sample
from millrace.llm.textblocks import blocks

FOLDER = Path("/root/testdata/sf0.01")
given = pytest.mark.skipif(not FOLDER.exists(), reason="given tables not found")


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_split(odd):
    for row in odd.select("doc_id", held_out("doc_id").alias("out")).collect():
        assert row.out == is_held_out(row.doc_id)


def test_sample_is_bounded(spark):
    rows = [(i, "hot" if i % 3 else "rare") for i in range(3000)] + [(1, "hot"), (None, "hot"), (7, None)]
    table = spark.createDataFrame(rows, "doc_id long, lang string")
    sample = training_sample(table, "doc_id", "lang", 50).collect()
    assert len(sample) == 100 and not any(is_held_out(r.doc_id) for r in sample)


def test_sample_counts_ids_not_rows(spark):
    """A label whose rows repeat few ids keeps these, and a repeated id is learned once."""
    ids = [i for i in range(4000) if not is_held_out(i)][:400]
    rows = [(i, "often") for i in ids[:200] for _ in range(40)]
    rows += [(ids[200 + k], f"once{k}") for k in range(40) for _ in range(10_000)]
    table = spark.createDataFrame(rows, "doc_id long, lang string")
    sample = training_sample(table, "doc_id", "lang", 50).collect()
    found = [r.lang for r in sample]
    assert len(set(found)) == 41 and found.count("often") == 50 and len(found) == 90


def test_repeated_rows_are_learned_once(spark):
    rows = [(i, f"word{i % 7} text number {i}", "ab"[i % 2], i % 2) for i in range(200)]
    schema = "doc_id long, text string, lang string, quality int"
    docs = spark.createDataFrame(rows, schema)
    more = spark.createDataFrame(rows + [r for r in rows[:20] for _ in range(30)], schema)
    labels = docs.select("doc_id", "quality")
    one, two = (train_quality(d.select("doc_id", "text"), labels) for d in (docs, more))
    assert (one.weights == two.weights).all()
    learned = train_language(more.union(docs.limit(9).withColumn("text", F.lit(None).cast("string"))))
    assert learned.rows == sum(not is_held_out(i) for i in range(200))


@given
def test_language(spark):
    rows = op6_language_id(spark, str(FOLDER)).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    out = [r for r in rows if r.held_out]
    assert {r.doc_id for r in out} == {i for i in docs if is_held_out(i)}
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


@given
def test_quality(spark):
    rows = {r.doc_id: r for r in op8_quality(spark, str(FOLDER)).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    out = [r for r in labels if is_held_out(r.doc_id)]
    assert sum(rows[r.doc_id].predicted == r.quality for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())


def test_odd_rows(spark, odd):
    model = train_language(odd)
    docs = odd.withColumn("lang_pred", F.lit("own"))
    rows = predict_language(docs, model, ["doc_id", "lang_pred", "n_chars"]).collect()
    assert len(rows) == odd.count()
    for r in rows:
        # In this table only texts without a letter have fewer than three characters or none.
        assert (r.lang_pred == "und") == (r.n_chars == 0 or r.doc_id == 7)
        assert r.lang_pred in {"en", "de", "es", "fr", "und"} and 0 <= r.score <= 1
    labels = spark.createDataFrame(
        [(1, 1, None), (2, 0, 1), (2, 0, 1), (3, None, 1), (None, 1, 1), (5, 1, 0), (9, 7, 0)],
        "doc_id long, quality int, toxic int",
    )
    quality = train_quality(odd, labels)
    scored = score_quality(odd, quality, ["doc_id", "score", "size"]).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    kept = keep_good(odd, quality, 0.0)
    assert kept.columns == odd.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, odd.collect()))


def test_no_rows(odd, spark):
    none = odd.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = train_language(none)
    assert predict_language(none, model, ["doc_id"]).count() == 0
    assert {r.lang_pred for r in predict_language(odd, model, ["doc_id"]).collect()} == {"und"}
    quality = train_quality(none, labels)
    assert score_quality(none, quality, ["doc_id"]).count() == 0
    assert {r.score for r in score_quality(odd, quality, ["doc_id"]).collect()} == {0.5}


def test_scores_do_not_depend_on_the_neighbours():
    """A text's score is the same alone and among others, whatever the blocks."""
    from millrace.llm.quality import BITS, QualityModel

    rng = np.random.default_rng(1)
    model = QualityModel(rng.standard_normal((1 << BITS) + 1).astype(np.float32))
    texts = ["One two two", "", "THREE!! four### 55", "é é É", None, "a" * 50 + " b", "..."] * 3
    alone = [model.score(b)[0] for t in texts for b in blocks(pa.array([t], pa.string()))]
    for limit in (1, 30, 1000):
        got = [s for b in blocks(pa.array(texts, pa.string()), limit) for s in model.score(b)]
        assert np.allclose(got, alone, atol=1e-9)


SAMPLES = {
    "en": "the cat sat on the mat and the dog ran after it",
    "de": "der Hund läuft über die Wiese und die Katze schläft",
    "fr": "le chat dort sur la chaise et le chien court après",
}


def labelled(count):
    """(id, text, language): random words of one language each, with odd signs between."""
    rng = random.Random(12)
    out = []
    for i in range(count):
        name = sorted(SAMPLES)[i % 3]
        words = rng.choices(SAMPLES[name].split(), k=rng.randrange(2, 14))
        out.append((i, rng.choice([" ", " - ", "\n", "42 "]).join(words), name))
    return out


def plain_places(text):
    """Places of a text's n-grams, by the definition: one string after the other."""
    folded = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    folded = re.sub(" +", " ", folded)
    out = set()
    for size in (2, 3, 4):
        for at in range(len(folded) - size + 1):
            gram = 0
            for c in folded[at : at + size]:
                gram = (gram * 0x9E3779B1 + ord(c)) % 2**32
            place = gram * ((size * 2 + 0x85EBCA6B) % 2**32) % 2**32
            place ^= place >> 15
            out.add((place * 0xC2B2AE35 % 2**32) >> 16)
    return out


def test_language_equals_the_plain_kernel_method(spark):
    """Presence sets and kernels of Python sets, Nyström map and ridge by the formulas."""
    rows = labelled(240)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train_language(docs, landmarks=30, per_language=60, ridge=0.1)
    sample = {
        r.doc_id: r.order for r in training_sample(docs.select("doc_id", "lang"), "doc_id", "lang", 60).collect()
    }
    known = sorted((sample[i], lang, plain_places(text)) for i, text, lang in rows if i in sample)
    assert model.rows == len(known)

    def kernel(a, b):
        return len(a & b) / math.sqrt(max(1, len(a)) * max(1, len(b)))

    marks = [p for name in sorted(SAMPLES) for _, _, p in [k for k in known if k[1] == name][:10]]
    among = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(among)
    used = values > values[-1] * 1e-6
    root = vectors[:, used] / np.sqrt(values[used])

    def mapped(places):
        return np.array([kernel(places, m) for m in marks]) @ root

    z = np.array([mapped(p) for *_, p in known])
    target = np.array([[1.0 if lang == n else -1.0 for n in sorted(SAMPLES)] for _, lang, _ in known])
    weights = np.linalg.solve(z.T @ z + 0.1 * np.eye(z.shape[1]), z.T @ target)
    texts = [text for _, text, _ in rows[:60]] + ["", "x", "die cat après"]
    want = np.array([mapped(plain_places(t)) @ weights for t in texts])
    got = []
    for block in blocks(pa.array(texts, pa.string())):
        got += [m for _, found, _ in presence(block, model.fold) for m in model.margins(found)]
    assert model.names == sorted(SAMPLES)
    assert np.allclose(got, want, atol=2e-3)


def test_more_labels_than_landmarks(spark):
    """A label column of many values costs a row of weights each, and is refused beyond a bound."""
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} word" * 3, f"l{i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train_language(docs, landmarks=20)
    assert len(model.names) == sum(not is_held_out(i) for i in range(600))
    assert model.matrices[0].shape[1] <= 20 and model.matrices[1].shape[1] == len(model.names)
    found = predict_language(docs, model, ["doc_id"]).collect()
    assert {r.lang_pred for r in found} <= set(model.names)


def test_too_many_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr("millrace.llm.language.MAX_LANGUAGES", 2)
    docs = spark.createDataFrame(labelled(30), "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        train_language(docs)


def plain_features(text):
    """Feature numbers of a text with their counts, token by token in Python integers."""
    mask, base = 2**64 - 1, 0x9E3779B97F4A7C15 | 1

    def mixed(v):
        for _ in range(2):
            v = ((v ^ (v >> 32)) * 0xD6E8FEB86659FD93) & mask
        return v ^ (v >> 32)

    data = text.encode()
    tokens = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^\x20\x09-\x0D0-9A-Za-z\x80-\xff]+", data)
    hashes, shapes, before = [], [], None
    for token in tokens:
        low = token.translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
        h = mixed(sum((c + 1) * pow(base, k, 2**64) for k, c in enumerate(low)) & mask)
        is_word = bool(re.match(rb"[0-9A-Za-z\x80-\xff]", token))
        capitals = sum(65 <= c <= 90 for c in token)
        letters = sum(65 <= c <= 90 or 97 <= c <= 122 for c in token)
        shape = 0 if capitals == 0 else 3
        if capitals == 1 and 65 <= token[0] <= 90:
            shape = 1
        if capitals > 1 and capitals == letters:
            shape = 2
        if all(48 <= c <= 57 for c in token):
            shape = 4
        if is_word:
            shape = shape + 8 * (before == h) + 1
            before = h
        hashes.append(h)
        shapes.append(mixed(((shape if is_word else h) + 77) & mask))
    out = Counter()
    for spelling, most in ((hashes, 2), (shapes, 3)):
        for n in range(1, most + 1):
            for at in range(len(spelling) - n + 1):
                gram = spelling[at]
                for more in spelling[at + 1 : at + n]:
                    gram = mixed((gram * 3 + more) & mask)
                out[gram >> 46] += 1
    return out


def test_quality_equals_the_plain_rule(spark):
    """Features token by token, and the published update for each coordinate in a dictionary."""
    rng = random.Random(3)
    texts = [
        (" ".join(rng.choices(["Good", "plain", "words", "here.", "42"], k=9)), 1)
        if i % 2
        else ("!! " + " ".join(rng.choices(["SPAM", "spam", "buy", "NOW!!", "é"], k=7)), 0)
        for i in range(120)
    ] + [("", 1), (" \t", 0)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, (_, q) in enumerate(texts)], "doc_id long, quality int")
    model = train_quality(docs, labels, shares=2, epochs=2, per_class=1000)
    sample = training_sample(labels, "doc_id", "quality", 1000).collect()
    alpha, beta, l1, l2 = 0.3, 1.0, 0.02, 0.1

    def weight(z, n, at):
        if abs(z[at]) <= l1:
            return 0.0
        return (math.copysign(l1, z[at]) - z[at]) / ((beta + math.sqrt(n[at])) / alpha + l2)

    def example(text):
        found = plain_features(text)
        total = max(1, sum(found.values()))
        return {**{at: 16.0 * times / total for at, times in found.items()}, "one": 1.0}

    parts = []
    for share in range(2):
        own = sorted((r.order, r.doc_id) for r in sample if r.order % 2 == share)
        z, n = defaultdict(float), defaultdict(float)
        for _ in range(2):
            for _, i in own:
                text, label = texts[i]
                x = example(text)
                w = {at: weight(z, n, at) for at in x}
                p = 1 / (1 + math.exp(-sum(w[at] * v for at, v in x.items())))
                for at, v in x.items():
                    g = (p - label) * v
                    step = (math.sqrt(n[at] + g * g) - math.sqrt(n[at])) / alpha
                    z[at] += g - step * w[at]
                    n[at] += g * g
        parts.append((len(own), {at: weight(z, n, at) for at in z}))
    rows = sum(k for k, _ in parts)
    want = defaultdict(float)
    for k, weights in parts:
        for at, w in weights.items():
            want[at] += w * k / rows
    # All labelled rows are in the sample, so the intercept needs no correction.
    for text, _ in [*texts, ("Unseen words! 7", 0)]:
        margin = sum(want[at] * v for at, v in example(text).items())
        for block in blocks(pa.array([text], pa.string())):
            assert model.score(block)[0] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-5)
