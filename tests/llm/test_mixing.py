from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from millrace.llm.mixing import mixed_documents, take

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return len(SPLIT.findall(text or ""))


def aims(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing out the excess until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] >= most * sizes[s]}
        if not over:
            target |= {s: unit * weight[s] for s in open_}
            break
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= over
    return target


def sizes_of(rows):
    sizes = defaultdict(int)
    for _, text, source, _ in rows:
        sizes[source] += words(text)
    return sizes


def key(i, text):
    inner = hashlib.md5((text or "").encode()).hexdigest()
    return hashlib.md5(f"0:{'' if i is None else i}:{inner}".encode()).hexdigest()


def by_hand(rows):
    sizes = sizes_of(rows)
    target, out = aims(sizes), []
    for source, size in sizes.items():
        budget = round(target[source])
        epochs, rest = divmod(budget, size) if size else (0, 0)
        own = [(key(i, t), i, t) for i, t, s, _ in rows if s == source]
        for _, i, text in sorted(own, key=lambda r: r[0]):
            part = max(0, min(words(text), rest))
            rest -= part
            out.append((i, words(text), size, round(target[source], 6), epochs, part))
    return Counter(out)


def got(docs):
    return Counter(
        (r.doc_id, r["size"], r.source_size, round(r.target, 6), r.epochs, r.part)
        for r in take(docs).collect()
    )


@pytest.fixture
def corpus():
    rng = random.Random(8)
    names = ["hot"] * 60 + ["é", "b", "zz", None, "", "B", "tiny"]
    rows = [
        (i, "  ".join(["w"] * rng.randrange(40)) + "\n", rng.choice(names), "en") for i in range(1500)
    ]
    return [*rows, (2000, "only one", "a", "en"), (2001, None, "empty", "en")]


def test_taken_words(table, corpus):
    rows = got(table(corpus))
    assert rows == by_hand(corpus)
    taken = Counter()
    for r, n in rows.items():
        taken[r[2:4]] += (r[1] * r[4] + r[5]) * n
    sources = Counter((s, round(aims(sizes_of(corpus))[n], 6)) for n, s in sizes_of(corpus).items())
    for (size, goal), n in sources.items():
        assert abs(taken[(size, goal)] - goal * n) <= n / 2
    assert all(r[1] * r[4] + r[5] <= 3 * r[1] for r in rows)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text, r.source, r.lang) for r in odd.collect()]
    assert got(odd) == by_hand(rows)
    assert take(odd.limit(0)).count() == 0
    assert mixed_documents(odd.limit(0)).count() == 0


def test_the_mix(table, corpus):
    docs = table(corpus)
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    want = Counter()
    texts = {i: t for i, t, _, _ in corpus}
    for (i, size, _, _, epochs, part), n in by_hand(corpus).items():
        if not size:
            continue
        text = texts[i]
        want[(i, text)] += epochs * n
        if part == size:
            want[(i, text)] += n
        elif part:
            want[(i, text[: [m.end() for m in SPLIT.finditer(text)][part - 1]])] += n
    assert Counter((r.doc_id, r.text) for r in mixed.collect()) == +want
