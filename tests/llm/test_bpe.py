from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from millrace.llm.bpe import Encoder, Vocabulary, decode_ids, encode_texts
from millrace.llm.textblocks import blocks

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encoded(texts, vocabulary, limit=2 << 20):
    encoder = Encoder(vocabulary)
    numbered = [encoder.words(b) for b in blocks(pa.array(texts, pa.string()), limit)]
    encoder.settle()
    out = []
    for numbers, count in numbered:
        ids, bounds = encoder.ids_of(numbers, count)
        out += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out


def test_random_texts_match_the_library(vocabulary, library):
    rng = random.Random(3)
    letters = list("aab 'slmretvdSLT\n\t  é ß1½日!.") + ["<|endoftext|>", "'ll", "the", "\u3000"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(4000)]
    texts += ["", "a" * 5000, " " * 300, "ab" * 3000, "<|endoftext|>" * 3, "<|endoftext|"]
    got = encoded(texts, vocabulary, limit=500)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got == want
    for text, ids in zip(texts, got, strict=True):
        assert decode_ids(np.array(ids, dtype=np.int64), vocabulary) == text


def test_every_character(vocabulary, library):
    points = [*range(1, 0xD800), *range(0xE000, 0x10000), *range(0x1F000, 0x20000)]
    texts = [f"a{chr(c)}b {chr(c)}1" for c in points]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoded(texts, vocabulary) == want


def test_bytes_that_are_no_text(vocabulary, library):
    ids = encoded(["é日"], vocabulary)[0]
    for part in (ids[:1], ids[1:], ids[::-1]):
        want = library.decode(part, skip_special_tokens=False)
        assert decode_ids(np.array(part, dtype=np.int64), vocabulary) == want
    with pytest.raises(ValueError):
        decode_ids(np.array([10**6]), vocabulary)


def test_short_words_merge_in_few_rounds(vocabulary, library, monkeypatch):
    """Thousands of ranks occur, yet no more lookups than the longest word has bytes."""
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("etaoinshrdlucmf", k=rng.randrange(1, 20))) for _ in range(20_000)})
    looked_up = []
    plain = np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda *a, **k: looked_up.append(1) or plain(*a, **k))
    got = encoded([" ".join(words)], vocabulary)
    assert len(looked_up) < 64
    monkeypatch.undo()
    assert got == [library.encode(" ".join(words), add_special_tokens=False).ids]


def test_words_of_all_lengths(vocabulary, library):
    """Words around the length from which they are merged by rank, mixed with short ones."""
    rng = random.Random(9)
    sizes = [1, 2, 3, 5, 8, 62, 63, 64, 65, 66, 130, 400]
    texts = [
        "".join(rng.choices(letters, k=rng.choice(sizes)))
        for letters in ("a", "ab", "etaoin", "!", "!-", "éß", "日本")
        for _ in range(60)
    ]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoded(texts, vocabulary) == want
    assert encoded([" ".join(texts)], vocabulary) == [library.encode(" ".join(texts), add_special_tokens=False).ids]


def test_rows(odd, library):
    docs = odd.withColumnRenamed("score", "n_tokens")
    rows = encode_texts(docs, PATH, ["doc_id", "n_tokens", "size"], decoded=True).collect()
    texts = [r.text for r in docs.collect()]
    assert len(rows) == len(texts)
    for row, text in zip(rows, texts, strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(row.ids, dtype="<u4").tolist() == want
        assert (row.n_tokens, row.decoded, row.size) == (len(want), text or "", 7)


def test_digests_of_the_query(spark, odd, library, tmp_path):
    from millrace.llm.queries import op3_bpe

    odd.write.parquet(str(tmp_path / "documents.parquet"))
    rows = op3_bpe(spark, str(tmp_path)).collect()
    want = []
    for r in odd.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, dtype="<u4").tobytes()
        want.append(
            (
                r.doc_id,
                len(ids),
                hashlib.sha256(packed).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_no_rows(odd):
    assert encode_texts(odd.limit(0), PATH, ["doc_id"]).count() == 0
