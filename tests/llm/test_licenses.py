from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from millrace.llm.licenses import PHRASES, Template, license_digest, scan_licenses

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(text):
    words, places, labels = split(text), [], set()
    for phrase in PHRASES:
        own = phrase.words
        found = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += found
        labels |= {phrase.label} if found else set()
    edges = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), *edges, ",".join(sorted(labels))


def digest(docs):
    return license_digest(scan_licenses(docs)).collect()


def test_phrases(spark):
    rng = random.Random(9)
    bits = ["gnu", "general", "public", "license", "GNU", "Apache", "cc", "BY", "mit", "x", "é", "cc-by"]
    texts = [None, "", "cc", "cc by", "cc\nby cc by", "a cc by-nc cc by", "MIT License MIT license"]
    texts += [" ".join(rng.choices(bits, k=rng.randrange(60))) for _ in range(400)]
    texts += ["gnu general public license " * 3000, "CC BY", "CC BY"]
    docs = spark.createDataFrame(
        [(i if i % 5 else i // 2, t, "x") for i, t in enumerate(texts)] + [(None, "cc by", "x")],
        "doc_id long, text string, template string",
    )
    got = Counter(
        (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
        for r in digest(docs)
    )
    assert got == Counter((r.doc_id, *by_hand(r.text)) for r in docs.collect())


@pytest.mark.parametrize(
    ("text", "labels", "score"),
    [
        ("x Licensed under the Apache License, Version 2.0. y", "apache,apache-notice", 1.0),
        ("Licensed, as said, under the Apache License, Version 2.0", "apache,apache-notice", 1.0),
        ("Permission is hereby granted, free of charge, to any person getting a copy of this "
         "software and the associated documentation files", "mit-notice", None),
        ("Redistribution of source", "", 0.0),
        ("CC BY-NC 4.0", "cc-by", 1.0),
    ],
)
def test_notices(spark, text, labels, score):
    row = digest(spark.createDataFrame([(1, text)], "doc_id long, text string"))[0]
    assert row.labels == labels
    assert score is None and 0.5 <= row.score < 1 or row.score == score


def test_notices_in_long_spans(spark):
    """Template words repeated at a small distance chain up, and the notice is still found."""
    again = " The MIT License." * 3
    docs = spark.createDataFrame(
        [
            (1, "Released under the MIT License." + again),
            (2, "The MIT License. " * 4 + "Released under the MIT License." + again),
            (3, "The MIT License. " * 2000),
            (4, "Released under the MIT License." + again * 5 + " Released under, the MIT License." + again),
            (5, "Released, so, under the MIT License." + again),
        ],
        "doc_id long, text string",
    )
    got = {
        r.doc_id: [(s.start, s.stop, s.cover) for s in r.spans if s.label == "mit-notice"]
        for r in scan_licenses(docs).collect()
    }
    assert got[1] == [(0, 5, 1.0)] and got[2] == [(12, 17, 1.0)] and got[3] == []
    assert got[4] == [(0, 5, 1.0), (50, 55, 1.0)]
    assert [s[2] for s in got[5]] == [0.75]


def test_spans(spark):
    notice = Template("own", "one two three four five six", 0.6)
    words = ["a", "one", "two", "NEW", "three", "four", "five", "six", "b", "one", "two", "c"]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    spans = scan_licenses(docs, phrases=(), notices=(notice,)).first().spans
    assert [(s.label, s.start, s.stop, s.cover) for s in spans] == [("own", 1, 8, 0.8)]


def test_odd_rows(odd):
    rows = digest(odd)
    assert Counter((r.doc_id, r.n_words) for r in rows) == Counter(
        (r.doc_id, len(split(r.text))) for r in odd.collect()
    )
    assert digest(odd.limit(0)) == []
