"""Grouping of spelling variants with a bit-sliced position index.

Words that differ by one inserted, deleted or replaced letter are near.  A shard of the
vocabulary is indexed by bitsets, one for each position and letter: bit ``i`` is set where
word ``i`` has that letter there.  All words of a shard are looked up at the same time.
While a word's letters are walked, word-parallel recurrences keep the set of words that
agree so far (zero errors) and two sets with one error, one for a replaced letter and one,
read at shifted positions, for a letter more.  An error is entered at the first letter that
differs, so every pair is found at one place.

Two near words, the shorter with ``m`` letters, differ inside one half of their positions
and agree in the other.  Words therefore meet by the half that agrees: each gives an entry
for both halves, as the shorter and as the longer word.  Halves that more than
``shard_words`` words share are halved again, down to one position, where the alphabet
bounds what remains; so no key holds the vocabulary, whatever its words look like, and
nothing is left out.  Entries of one length and region are dealt to shards by hash.

What a shard finds for a word is added up there; no list of pairs leaves it.  Roots are
followed by pointer doubling; each step of a chain is at least ``ratio`` times as frequent.

A null text has no words, a null id is spelled as nothing in ``<id>:<word>``.  Repeated
rows count again.  No words give no rows.  Columns other than the id and the text are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import ascii_lower
from millrace.session import stored

LETTERS = "A-Za-zÀ-ÿ"
#: Words looked up together, and letters that a shard of very long words may have.
BLOCK, SHARD_LETTERS = 128, 4_000_000
_REGION = ["m", "lo", "hi"]
_FOUND = "word string, n_near long, best struct<rarity: long, word: string>"


def vocabulary(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    least_letters: int = 7,
    least_count: int = 2,
    slip: int = 31,
) -> DataFrame:
    """``word`` and ``n``: distinct words with their occurrences.

    Words are runs of letters in lower case (A to Z only).  Where ``slip`` divides the
    CRC-32 ``h`` of ``<id>:<run>``, letter ``h % length`` of the run is left out.
    """
    # A run that gives a word has at least as many letters as the word.
    runs = F.regexp_extract_all(
        F.col(f"`{text}`").cast("string"), F.lit(f"[{LETTERS}]{{{least_letters},}}"), F.lit(0)
    )
    name = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))
    found = docs.select(name.alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", ascii_lower(F.col("run")).alias("run"))
    hashed = found.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(
        F.substring(F.col("run"), F.lit(1), at),
        F.substring(F.col("run"), at + 2, F.length("run")),
    )
    words = hashed.select(F.when(F.col("h") % slip == 0, slipped).otherwise(F.col("run")).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter((F.length("word") >= least_letters) & (F.col("n") >= least_count))


def _halved(entries: DataFrame) -> DataFrame:
    """Two entries for each: the error lies in the first or the second half of its region.

    The key is the hash of what agrees: the letters before and after the region.  Equal
    hashes of other letters only make words meet that are not near.
    """
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi"))
    )
    split = entries.withColumn("half", F.explode(halves)).withColumns(
        {"lo": F.col("half.lo"), "hi": F.col("half.hi")}
    )
    skipped = F.col("hi") + F.when(F.length("word") > F.col("m"), 2).otherwise(1)
    before = F.substring(F.col("word"), F.lit(1), F.col("lo"))
    after = F.substring(F.col("word"), skipped, F.length("word"))
    return split.withColumn("key", F.xxhash64(*_REGION, before, after)).select(
        "word", "n", *_REGION, "key"
    )


def _entries(words: DataFrame, least: int) -> DataFrame:
    """Entries of every word, as the shorter word of a pair and as the longer one."""
    length = F.length("word")
    sizes = F.filter(F.array(length, length - 1), lambda m: m >= least)
    whole = words.withColumn("m", F.explode(sizes)).withColumns(
        {"lo": F.lit(0), "hi": F.col("m")}
    )
    return _halved(whole)


def _spread(entries: DataFrame, shard_words: int) -> DataFrame:
    """Entries whose keys have at most ``shard_words`` words, or a region of one letter."""
    keys = [*_REGION, "key"]
    columns = ["word", "n", *keys]
    done = entries.limit(0)
    while True:
        full = stored(
            entries.groupBy(*keys)
            .agg(F.count("*").alias("words"))
            .filter((F.col("words") > shard_words) & (F.col("hi") - F.col("lo") > 1))
            .select(*keys)
        )
        if full.isEmpty():
            return done.union(entries.select(*columns))
        done = done.union(entries.join(full, keys, "left_anti").select(*columns))
        entries = stored(_halved(entries.join(full, keys, "left_semi")))


class PositionIndex:
    """Bitsets of the words of ``m`` or ``m + 1`` letters by position and letter."""

    def __init__(self, words: list[str], m: int) -> None:
        self.m = m
        width = m + 1
        points = np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(-1, width)
        self.long = points[:, m] > 0
        alphabet, codes = np.unique(points, return_inverse=True)
        self.codes = codes.reshape(points.shape)
        words64 = -(-len(words) // 64)
        self.places = np.zeros((width, len(alphabet)), dtype=np.int64)
        sets = [np.zeros(len(words), dtype=bool)]  # number 0: no word has it
        for position in range(width):
            own = self.codes[:, position]
            for letter in np.unique(own[points[:, position] > 0]).tolist():
                self.places[position, letter] = len(sets)
                sets.append(own == letter)
        self.bits = self._packed(np.array(sets), words64)
        self.is_long = self._packed(self.long[None, :], words64)[0]
        self.all = self._packed(np.ones((1, len(words)), dtype=bool), words64)[0]

    @staticmethod
    def _packed(sets: np.ndarray, words64: int) -> np.ndarray:
        packed = np.zeros((len(sets), words64 * 8), dtype=np.uint8)
        made = np.packbits(sets, axis=1, bitorder="little")
        packed[:, : made.shape[1]] = made
        return packed.view("<u8")

    def near(self, asked: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of an asked word (of ``m`` letters) and a near word that first differ
        between ``lo`` and ``hi`` (excluded; the end of the word counts to the last)."""
        codes, bits, places = self.codes[asked], self.bits, self.places
        same = np.repeat(self.all[None, :], len(asked), axis=0)
        replaced, longer = np.zeros_like(same), np.zeros_like(same)
        for p in range(self.m):
            here = bits[places[p, codes[:, p]]]
            shifted = bits[places[p + 1, codes[:, p]]]
            replaced &= here
            if lo <= p < hi:
                differs = same & ~here
                replaced |= differs
                longer |= differs
            longer &= shifted
            same &= here
        if hi == self.m:
            longer |= same
        found = (replaced & ~self.is_long) | (longer & self.is_long)
        rows, at = np.nonzero(found)
        each = np.unpackbits(found[rows, at].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, bit = np.nonzero(each)
        return asked[rows[which]], at[which] * 64 + bit


def _near_words(key: tuple, table: pa.Table) -> pa.Table:
    """For every word of a shard: its near words there, and the best of them."""
    m, lo, hi = (k.as_py() for k in key[:3])
    table = table.sort_by("word")
    words = table.column("word").to_pylist()
    n = table.column("n").to_numpy()
    index = PositionIndex(words, m)
    near = np.zeros(len(words), dtype=np.int64)
    # Most frequent first; the words are in order, so the first of equals is the smallest.
    by_order = np.argsort(-n, kind="stable")
    order = np.argsort(by_order)
    rank = np.full(len(words), len(words), dtype=np.int64)
    short = np.flatnonzero(~index.long)
    for first in range(0, len(short), BLOCK):
        one, other = index.near(short[first : first + BLOCK], lo, hi)
        # Two words of one length find each other; a longer word is only found.
        longer = index.long[other]
        of = np.concatenate([one, other[longer]])
        to = np.concatenate([other, one[longer]])
        near += np.bincount(of, minlength=len(words))
        np.minimum.at(rank, of, order[to])
    have = np.flatnonzero(near)
    best = by_order[rank[have]]
    return pa.table(
        {
            "word": pa.array([words[i] for i in have.tolist()], pa.string()),
            "n_near": pa.array(near[have], pa.int64()),
            "best": pa.StructArray.from_arrays(
                [
                    pa.array(-n[best], pa.int64()),
                    pa.array([words[i] for i in best.tolist()], pa.string()),
                ],
                names=["rarity", "word"],
            ),
        }
    )


def near_words(words: DataFrame, least_letters: int = 7, shard_words: int = 4096) -> DataFrame:
    """``word``, ``n_near`` and ``best`` (``rarity``, minus its count, and ``word``) of all
    words that have a near word.  ``best`` is the most frequent, of equals the smallest."""
    entries = _spread(_entries(words, least_letters), shard_words)
    room = F.least(F.lit(shard_words), F.greatest(F.lit(64), F.floor(F.lit(SHARD_LETTERS) / F.col("m"))))
    sizes = stored(
        entries.groupBy(*_REGION)
        .agg(F.count("*").alias("entries"))
        .select(*_REGION, F.ceil(F.col("entries") / room).alias("shards"))
    )
    dealt = entries.join(sizes, _REGION).withColumn("shard", F.pmod("key", F.col("shards")))
    found = (
        dealt.select("word", "n", *_REGION, "shard")
        .groupBy(*_REGION, "shard")
        .applyInArrow(_near_words, _FOUND)
    )
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """``word`` and ``root``: where the chain of ``links`` (``word``, ``form``) ends."""
    current = stored(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not current.filter("moved").isEmpty():
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        current = stored(
            current.select("word", "root")
            .join(ahead, "root", "left")
            .select(
                "word",
                F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved"),
            )
        )
    return current.select("word", "root")


def group_variants(words: DataFrame, ratio: int = 10, least_letters: int = 7, **options) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word.

    ``words`` has distinct ``word`` and their counts ``n``.  ``form`` is the most frequent
    near word (of equals the smallest by code point) if it is at least ``ratio`` times as
    frequent; ``root`` the last word that is reached over forms, the word itself if none.
    """
    words = stored(words.select("word", "n"))
    near = near_words(words, least_letters, **options)
    often: Column = -F.col("best.rarity") >= F.col("n") * ratio
    formed = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("best.word")).alias("form"),
            F.when(often, -F.col("best.rarity")).alias("form_n"),
        )
    )
    roots = _roots(formed.filter("form is not null"))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
