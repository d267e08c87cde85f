from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm.packing import Packer, Piece, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(rows, texts, library, size, id_column="doc_id"):
    """Every id of every document lies in one piece and sequences are laid without gaps."""
    want = defaultdict(list)
    for name, text in texts:
        want[name].append([*library.encode(text or "", add_special_tokens=False).ids, 1])
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[getattr(r, id_column)].append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size
    assert set(pieces) == set(want)
    for name, lists in want.items():
        # Rows that repeat an id: take the pieces of each document off the same list.
        left = pieces[name]
        for ids in lists:
            at = 0
            while at < len(ids):
                fits = [
                    r
                    for r in left
                    if r.start == at
                    and r.doc_tokens == len(ids)
                    and r.ids_crc32
                    == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
                ]
                assert fits
                left.remove(fits[0])
                at += fits[0].length
            assert at == len(ids)
        assert not left
    lengths = [sum(r.length for r in own) for own in sequences.values()]
    return sorted(n for n in lengths if n < size)


@pytest.mark.parametrize("windows", [1, 3, 32])
def test_packer(windows):
    rng = random.Random(windows)
    packer, out, want = Packer(64, windows), [], {}
    for name in range(500):
        length = rng.choice([1, 2, 5, 30, 40, 63, 64, 65, 200, 0])
        want[name] = list(range(length))
        out += packer.place(Piece((name, length), 0, np.arange(length, dtype=np.uint32)))
        assert len(packer.open) <= windows
        assert all(w.length < 64 for w in packer.open.values())
        assert sorted(packer.room) == packer.room
    assert all(w.length == 64 for w in out)
    closed = list(packer.close())
    short = [w.length for w in closed if w.length < 64]
    assert all(n & (n - 1) == 0 for n in short) and sorted(set(short)) == sorted(short)
    got = defaultdict(list)
    for window in [*out, *closed]:
        for p in window.pieces:
            got[p.document[0]] += p.ids.tolist()
            assert p.ids[0] == p.start
    assert {n: sorted(got[n]) for n in want} == want


def test_best_fit_and_fullest():
    packer = Packer(10, 2)

    def place(name, n):
        return [
            [(p.document[0], p.start, len(p.ids)) for p in w.pieces]
            for w in packer.place(Piece((name, n), 0, np.arange(n, dtype=np.uint32)))
        ]

    assert place("a", 4) == place("b", 7) == []
    # The window with the least room that is enough.
    assert place("c", 2) == []
    assert [w.length for w in packer.rest()] == [9, 4]
    # None fits: the fullest goes out, filled up with the document's first id.
    assert place("d", 8) == [[("b", 0, 7), ("c", 0, 2), ("d", 0, 1)]]
    assert [(w.length, len(w.pieces)) for w in packer.rest()] == [(7, 1), (4, 1)]


def test_rows(odd, library):
    docs = odd.withColumnRenamed("score", "sequence_id").withColumnRenamed("size", "open")
    rows = pack(docs, PATH, size=256, windows=4).collect()
    short = check(rows, [(r.doc_id, r.text) for r in docs.collect()], library, 256)
    assert all(n & (n - 1) == 0 for n in short) and len(set(short)) == len(short)


def test_many_tasks_are_merged_in_rounds(spark, table, library):
    rng = random.Random(9)
    texts = [(i, " ".join(rng.choices(["a", "word", "längst", "12"], k=rng.randrange(90)))) for i in range(600)]
    docs = table([(i, t, "s", "en") for i, t in texts]).repartition(70)
    rows = pack(docs, PATH, size=128, windows=3, with_ids=True).collect()
    short = check(rows, texts, library, 128)
    assert all(n & (n - 1) == 0 for n in short) and len(set(short)) == len(short)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    # Pieces of rounds beyond the first are there, each with numbers of its own step.
    assert len({r.sequence_id >> 56 for r in rows}) >= 3


def test_equal_and_empty_texts(table, library):
    texts = [(i % 3, "") for i in range(300)] + [(None, None)] * 50 + [(7, "same text")] * 100
    docs = table([(i, t, None, None) for i, t in texts])
    rows = pack(docs, PATH, size=64, windows=2).collect()
    short = check(rows, texts, library, 64)
    assert len(set(short)) == len(short)


def test_no_rows(odd):
    assert pack(odd.limit(0), PATH).collect() == []


def test_query(spark, odd, library, tmp_path):
    from millrace.llm.queries import op11_packing

    odd.write.parquet(str(tmp_path / "documents.parquet"))
    out = op11_packing(spark, str(tmp_path))
    assert dict(out.dtypes) == dict.fromkeys(
        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"], "bigint"
    )
    check(out.collect(), [(r.doc_id, r.text) for r in odd.collect()], library, 2048)
