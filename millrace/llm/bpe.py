"""Byte-level BPE encoding and decoding with a given vocabulary.

The distinct words of a batch of texts are merged together.  Short ones go in rounds:
a round merges the lowest pair of every word, wherever it stands in the word, and takes
the finished words out, so there are as many rounds as the word that takes most has
merges, however many ranks occur.

Encoding of long words keeps a *pair occurrence index*.  The words
are laid out in one array of symbols with links to the neighbours; the index maps
every mergeable pair to all its positions in that array.  The pairs that occur are
the active ranks.  They are applied in ascending order: all positions of the lowest
rank are merged at once, and the pairs that the merged symbols form with their
neighbours are put into the lists of their own ranks.  A pair with a merged symbol
always has a higher rank than the merge that made the symbol, so one pass is exact.

The vocabulary file is read on the driver and its tables (a few MB, whatever the
corpus) are broadcast.  Everything else is local to a batch of texts: nothing is
shuffled and a lost task is simply run again.

Texts: null counts as empty and gives no tokens.  Added tokens of the vocabulary
that occur in a text become their own ids, as in the tokenizers library.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.textblocks import Block, blocks

SPACE, LETTER, NUMBER, OTHER = range(4)
#: Cached words of a task; reaching the limit only empties the cache.
CACHED_WORDS = 400_000
#: New words that are merged at once; more only take more memory.
MERGED_WORDS = 120_000
#: Bytes of the longest word that is merged in rounds.
ROUND_BYTES = 64
_NO_RANK = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in shown}
    for number, b in enumerate(b for b in range(256) if b not in names):
        names[b] = chr(256 + number)
    return [names[b] for b in range(256)]


def character_classes() -> np.ndarray:
    """Class of every code point: space, letter, number or other."""
    classes = np.full(0x110000, OTHER, dtype=np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for found in regex.finditer(pattern, points):
            classes[[ord(c) for c in found[0]]] = kind
    return classes


@dataclass
class Vocabulary:
    """Tables of a byte-level BPE vocabulary."""

    initial: np.ndarray  # id of each byte
    pairs: np.ndarray  # keys of mergeable pairs, ascending
    ranks: np.ndarray  # rank of each of them
    lefts: np.ndarray  # by rank: left id, right id and merged id
    rights: np.ndarray
    merged: np.ndarray
    added: dict[str, int]
    spelling: np.ndarray  # bytes of all ids, one after the other
    spelled: np.ndarray  # their bounds
    classes: np.ndarray

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, names = content["model"], byte_symbols()
        ids = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        lefts = np.array([ids[a] for a, _ in pairs], dtype=np.int64)
        rights = np.array([ids[b] for _, b in pairs], dtype=np.int64)
        merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        made = np.full(len(ids) + len(content["added_tokens"]) + 1, -1, dtype=np.int64)
        made[merged] = np.arange(len(pairs))
        if (np.maximum(made[lefts], made[rights]) >= np.arange(len(pairs))).any():
            raise ValueError("a merge uses a symbol that is made later")
        keys = lefts << 32 | rights
        order = np.argsort(keys)
        byte_of = {name: b for b, name in enumerate(names)}
        added = {t["content"]: t["id"] for t in content["added_tokens"]}
        texts = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
        texts |= {i: token.encode() for token, i in added.items()}
        ordered = [texts.get(i, b"") for i in range(max(texts) + 1)]
        return cls(
            initial=np.array([ids[n] for n in names], dtype=np.int64),
            pairs=keys[order],
            ranks=order,
            lefts=lefts,
            rights=rights,
            merged=merged,
            added=added,
            spelling=np.frombuffer(b"".join(ordered), dtype=np.uint8),
            spelled=np.concatenate([[0], np.cumsum([len(x) for x in ordered])]),
            classes=character_classes(),
        )


def split_words(block: Block, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Byte bounds of the words of a block and the number of words in each text.

    The usual byte-level pattern: contractions; runs of letters, of numbers or of
    other characters, each with one blank before it; runs of space, whose last
    character stands alone where something follows.
    """
    data = block.data
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    size = len(points)
    if not size:
        return np.zeros(1, dtype=np.int64), np.zeros(len(block), dtype=np.int64)
    lead = (data & 0xC0) != 0x80
    at_byte = np.concatenate([np.flatnonzero(lead), [len(data)]])
    texts = np.searchsorted(at_byte, block.offsets)
    kind = vocabulary.classes[points]

    edge = np.zeros(size + 1, dtype=bool)  # a text or an added token begins here
    edge[texts] = True
    special = []
    whole = data.tobytes()
    for token in vocabulary.added:
        name = token.encode()
        at = whole.find(name)
        while at >= 0:
            first, last = np.searchsorted(at_byte, [at, at + len(name)])
            if not edge[first + 1 : last].any():
                special.append((first, last))
                at += len(name) - 1
            at = whole.find(name, at + 1)
    for first, last in special:
        edge[[first, last]] = True

    begins = np.zeros(size + 1, dtype=bool)
    begins[0] = begins[size] = True
    begins[1:size] = kind[1:] != kind[:-1]
    begins |= edge
    # Spaces before something else in the same text.
    last_space = np.zeros(size, dtype=bool)
    last_space[:-1] = (kind[:-1] == SPACE) & begins[1:size] & ~edge[1:size]
    run_start = begins.copy()
    begins[:size] |= last_space
    blank = np.flatnonzero(last_space & (points == 0x20))
    begins[blank + 1] = False
    # Contractions: an apostrophe that stands alone, and the letters after it.
    quote = np.flatnonzero(points[:-1] == 0x27)
    quote = quote[run_start[quote] & run_start[quote + 1] & begins[quote] & ~edge[quote + 1]]
    quote = quote[kind[quote + 1] == LETTER]
    if len(quote):
        padded = np.concatenate([points, [0, 0]])
        one, two = padded[quote + 1], padded[quote + 2]
        joined = ~begins[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quote), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b)) & joined
        begins[quote[short | long] + 1] = False
        begins[quote[short] + 2] = True
        begins[quote[long] + 3] = True
    for first, last in special:
        begins[first + 1 : last] = False
    starts = np.flatnonzero(begins)
    return at_byte[starts], np.diff(np.searchsorted(starts, texts))


def _by_rank(ranks: np.ndarray, positions: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(ranks, kind="stable")
    ranks, positions = ranks[order], positions[order]
    cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
    heads = ranks[np.concatenate([[0], cuts])] if len(ranks) else []
    if len(ranks):
        yield from zip(heads.tolist(), np.split(positions, cuts), strict=True)


def _pair_ranks(left: np.ndarray, right: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Rank of every pair; ``_NO_RANK`` where it is not merged."""
    keys = left.astype(np.int64) << 32 | right
    place = np.searchsorted(vocabulary.pairs, keys)
    place[place == len(vocabulary.pairs)] = 0
    return np.where(vocabulary.pairs[place] == keys, vocabulary.ranks[place], _NO_RANK).astype(np.int32)


def _merge_in_rounds(
    symbols: np.ndarray, bounds: np.ndarray, vocabulary: Vocabulary
) -> tuple[np.ndarray, np.ndarray]:
    """``merge_words`` by rounds that merge the lowest pair of every word."""
    lengths = np.diff(bounds)
    number = np.flatnonzero(lengths)  # the words that are still merged
    sizes = lengths[number]
    token = symbols.astype(np.int32)
    ranks = np.full(len(token), _NO_RANK, dtype=np.int32)
    ranks[:-1] = _pair_ranks(token[:-1], token[1:], vocabulary)
    ranks[np.cumsum(sizes) - 1] = _NO_RANK
    ended, ids = [], []
    while len(number):
        lowest = np.minimum.reduceat(ranks, np.cumsum(sizes) - sizes)
        going = lowest != _NO_RANK
        if not going.all():
            inside = np.repeat(going, sizes)
            ended.append((number[~going], sizes[~going]))
            ids.append(token[~inside])
            number, sizes, lowest = number[going], sizes[going], lowest[going]
            token, ranks = token[inside], ranks[inside]
            if not len(number):
                break
        at = np.flatnonzero(ranks == np.repeat(lowest, sizes))
        # Of pairs that overlap, the first, third, ... are merged.
        order = np.arange(len(at))
        follows = np.concatenate([[False], at[1:] == at[:-1] + 1])
        at = at[(order - np.maximum.accumulate(np.where(follows, 0, order))) % 2 == 0]
        token[at] = vocabulary.merged[ranks[at]]
        ends = np.cumsum(sizes)
        kept = np.ones(len(token), dtype=bool)
        kept[at + 1] = False
        sizes = sizes - np.diff(np.searchsorted(at, np.concatenate([[0], ends])))
        at -= np.arange(len(at))
        token, ranks = token[kept], ranks[kept]
        last = np.zeros(len(token), dtype=bool)
        last[np.cumsum(sizes) - 1] = True
        near = np.concatenate([at, at[at > 0] - 1])
        near = near[~last[near]]
        ranks[near] = _pair_ranks(token[near], token[near + 1], vocabulary)
        ranks[at[last[at]]] = _NO_RANK
    made = np.zeros(len(lengths), dtype=np.int64)
    for words, left in ended:
        made[words] = left
    edges = np.concatenate([[0], np.cumsum(made)])
    out = np.empty(edges[-1], dtype=np.int32)
    for (words, left), own in zip(ended, ids, strict=True):
        out[_gather(edges[words], left)] = own
    return out, edges


def merge_words(
    symbols: np.ndarray, bounds: np.ndarray, vocabulary: Vocabulary
) -> tuple[np.ndarray, np.ndarray]:
    """Merge the symbols of all words; returns the ids and the words' new bounds."""
    lengths = np.diff(bounds)
    long = lengths > ROUND_BYTES
    edges = np.zeros(len(bounds), dtype=np.int64)
    parts = []
    for chosen, merge in ((~long, _merge_in_rounds), (long, _merge_by_rank)):
        words = np.flatnonzero(chosen)
        if len(words):
            own = np.concatenate([[0], np.cumsum(lengths[words])])
            ids, made = merge(symbols[_gather(bounds[words], lengths[words])], own, vocabulary)
            edges[words + 1] = np.diff(made)
            parts.append((words, ids))
    edges = np.cumsum(edges)
    out = np.empty(edges[-1], dtype=np.int32)
    for words, ids in parts:
        out[_gather(edges[words], edges[words + 1] - edges[words])] = ids
    return out, edges


def _merge_by_rank(
    symbols: np.ndarray, bounds: np.ndarray, vocabulary: Vocabulary
) -> tuple[np.ndarray, np.ndarray]:
    """``merge_words`` by an index of the places of every pair."""
    size = len(symbols)
    token = np.append(symbols, -2).astype(np.int32)
    after = np.arange(1, size + 2, dtype=np.int32)
    before = np.arange(-1, size, dtype=np.int32)
    after[bounds[1:] - 1] = size
    before[bounds[:-1]] = -1
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def enter(positions: np.ndarray) -> None:
        """Put positions into the lists of the pairs that start there."""
        keys = token[positions].astype(np.int64) << 32 | token[after[positions]]
        place = np.searchsorted(vocabulary.pairs, keys)
        place[place == len(vocabulary.pairs)] = 0
        known = vocabulary.pairs[place] == keys
        for rank, own in _by_rank(vocabulary.ranks[place[known]], positions[known]):
            if rank not in index:
                index[rank] = []
                heapq.heappush(active, rank)
            index[rank].append(own)

    enter(np.flatnonzero(after[:size] < size))
    while active:
        rank = heapq.heappop(active)
        lists = index.pop(rank)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        left, right = vocabulary.lefts[rank], vocabulary.rights[rank]
        at = at[(token[at] == left) & (token[after[at]] == right)]
        if left == right and len(at) > 1:
            # Of pairs that overlap, the first, third, ... are merged.
            follows = np.concatenate([[False], after[at[:-1]] == at[1:]])
            order = np.arange(len(at))
            start = np.maximum.accumulate(np.where(follows, 0, order))
            at = at[(order - start) % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        token[at] = vocabulary.merged[rank]
        token[gone] = -1
        after[at] = after[gone]
        has_next = after[at] < size
        before[after[at[has_next]]] = at[has_next]
        previous = before[at]
        enter(np.unique(np.concatenate([at[has_next], previous[previous >= 0]])))
    left = token[:size] >= 0
    return token[:size][left], np.concatenate([[0], np.cumsum(left)])[bounds]


def _gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of all spans, one after the other."""
    total = int(counts.sum())
    skipped = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else counts
    return np.repeat(starts - skipped, counts) + np.arange(total)


class _Numbers(dict):
    """Number of every word; a new one gets the next and is noted in ``fresh``."""

    def __init__(self) -> None:
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


class Encoder:
    """Encodes blocks of texts; words met before are looked up."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.known = _Numbers()
        self.fresh = self.known.fresh
        self.ids = np.zeros(0, dtype=np.int64)
        self.bounds = np.zeros(1, dtype=np.int64)
        for token, number in self.vocabulary.added.items():
            self.known[token.encode()] = len(self.known)
            self.ids = np.append(self.ids, number)
            self.bounds = np.append(self.bounds, len(self.ids))

    def words(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Number of every word of a block, and the words' count in each text."""
        bounds, count = split_words(block, self.vocabulary)
        whole, edges = block.data.tobytes(), bounds.tolist()
        words = [whole[a:b] for a, b in pairwise(edges)]
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))
        if len(self.fresh) > MERGED_WORDS:
            self.settle()
        return numbers, count

    def settle(self) -> None:
        """Merge the words that were not met before."""
        if not self.fresh:
            return
        data = np.frombuffer(b"".join(self.fresh), dtype=np.uint8)
        lengths = np.array([len(w) for w in self.fresh])
        edges = np.concatenate([[0], np.cumsum(lengths)])
        ids, bounds = merge_words(self.vocabulary.initial[data], edges, self.vocabulary)
        self.bounds = np.concatenate([self.bounds, bounds[1:] + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])
        self.fresh.clear()

    def ids_of(self, numbers: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, and the bounds of each text's ids."""
        sizes = np.diff(self.bounds)[numbers]
        ids = self.ids[_gather(self.bounds[numbers], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        texts = np.concatenate([[0], np.cumsum(count)])
        return ids, ends[texts]


def decode_ids(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """Text of a sequence of ids; bytes that are no UTF-8 become U+FFFD."""
    if len(ids) and int(ids.max()) >= len(vocabulary.spelled) - 1:
        raise ValueError("an id is outside the vocabulary")
    sizes = np.diff(vocabulary.spelled)[ids]
    spelled = vocabulary.spelling[_gather(vocabulary.spelled[ids], sizes)]
    return spelled.tobytes().decode("utf-8", "replace")


def _encode_batches(
    batches: Iterable[pa.RecordBatch], vocabulary, keep: int, decoded: bool, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    tables = vocabulary.value
    encoder = Encoder(tables)
    for batch in batches:
        texts = batch.column(keep)
        numbered = [(b.first, b.last, *encoder.words(b)) for b in blocks(texts)]
        encoder.settle()
        for first, last, numbers, count in numbered:
            ids, bounds = encoder.ids_of(numbers, count)
            own = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            made = [
                pa.array([x.astype("<u4").tobytes() for x in own], pa.binary()),
                pa.array(np.diff(bounds), pa.int64()),
            ]
            if decoded:
                made.append(pa.array([decode_ids(x, tables) for x in own], pa.string()))
            kept = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [*[kept.column(i) for i in range(keep)], *made], schema=schema
            )
        if len(encoder.known) > CACHED_WORDS:
            encoder.forget()


def encode_texts(
    docs: DataFrame,
    vocabulary_path: str,
    keep: list[str],
    text: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """``keep`` columns, ``ids`` and ``n_tokens``; with ``decoded`` also the text again.

    ``ids`` holds the token ids as little-endian unsigned 32-bit integers.  Kept columns
    with the name of a made one give way to it.
    """
    made = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    if decoded:
        made.append(T.StructField("decoded", T.StringType()))
    keep = [c for c in keep if c not in {f.name for f in made}]
    schema = T.StructType([*docs.select(*keep).schema.fields, *made])
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path))
    run = partial(
        _encode_batches,
        vocabulary=vocabulary,
        keep=len(keep),
        decoded=decoded,
        schema=to_arrow_schema(schema),
    )
    source = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    return source.mapInArrow(run, schema)
