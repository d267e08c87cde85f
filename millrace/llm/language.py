"""Language of a text by string kernels.

The kernel of two texts counts the character n-grams (``SIZES`` long, blended) that
both have at least once, divided by the root of the numbers they have.  Letters are
folded to lower case, everything between words to one blank, and n-grams are hashed
to ``2 ** BITS`` places.

Training is one-versus-rest kernel ridge regression in the Nyström features of at most
``landmarks`` texts, dealt evenly to the languages.  It uses at most ``per_language``
labelled documents of each language.  Only the landmarks' n-gram places (8 KB each) come to
the driver; the normal equations are summed up by Spark where the documents are: a matrix of
landmarks by landmarks and a row for each language.  For many languages the model keeps the
landmarks and the ridge weights of each language in the Nyström features, so a language more
costs a few hundred numbers; up to ``MAX_LANGUAGES`` are learned, and a label column with more values is
refused as no column of languages.  Scoring multiplies batches of presence vectors with
both in the task that reads the texts.

A text that is null or has no letter is ``und`` with score 0, and so is every text when
there was nothing to learn from.  Ties go to the language that comes first in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.samples import one_text, training_sample
from millrace.llm.textblocks import Block, map_texts
from millrace.session import stored

BITS = 16
SIZES = (2, 3, 4)
BATCH = 64
#: Labels that are learned at most: 64 MB of weights.
MAX_LANGUAGES = 100_000
_BLANK = 0x20
_MIX = np.uint32(0x9E3779B1)


def folding() -> np.ndarray:
    """For every code point its lower-case letter, or a blank where it is no letter."""
    fold = np.full(0x110000, _BLANK, dtype=np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            fold[point] = ord(c.lower()[0])
    return fold


def presence(block: Block, fold: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For batches of texts: their first number, presence vectors and letter counts."""
    points = np.frombuffer(
        block.data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32
    )
    lead = np.flatnonzero((block.data & 0xC0) != 0x80)
    bounds = np.searchsorted(lead, block.offsets)
    letters = fold[points]
    for first in range(0, len(block), BATCH):
        last = min(first + BATCH, len(block))
        own = letters[bounds[first] : bounds[last]]
        count = np.diff(bounds[first : last + 1])
        text_of = np.repeat(np.arange(last - first, dtype=np.int32), count)
        blank = own == _BLANK
        letter_count = np.bincount(text_of[~blank], minlength=last - first)
        # One blank between words and at both ends of a text.
        run = np.ones(len(own), dtype=bool)
        run[1:] = ~(blank[1:] & blank[:-1] & (text_of[1:] == text_of[:-1]))
        own, text_of = own[run], text_of[run]
        found = np.zeros((last - first, 1 << BITS), dtype=bool)
        gram = own
        for size in range(2, max(SIZES) + 1):
            if len(own) < size:
                break
            gram = gram[:-1] * _MIX + own[size - 1 :]
            if size in SIZES:
                same = text_of[size - 1 :] == text_of[: len(gram)]
                place = gram * np.uint32(size * 2 + 0x85EBCA6B)
                place ^= place >> np.uint32(15)
                place = (place * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)
                found[text_of[: len(gram)][same], place[same]] = True
        yield first, found, letter_count


@dataclass
class LanguageModel:
    """``matrices`` are multiplied with presence vectors one after the other: places by
    Nyström features and features by languages, or for few languages their product."""

    names: list[str]
    matrices: list[np.ndarray]
    fold: np.ndarray
    rows: int = 0  # documents learned from

    def margins(self, found: np.ndarray) -> np.ndarray:
        """One-versus-rest margins of presence vectors."""
        size = np.maximum(found.sum(axis=1), 1)
        out = found.astype(np.float32) / np.sqrt(size, dtype=np.float32)[:, None]
        for matrix in self.matrices:
            out = out @ matrix
        return out

    def predict(self, block: Block) -> tuple[list[str], np.ndarray]:
        best = ["und"] * len(block)
        scores = np.zeros(len(block))
        if not self.names:
            return best, scores
        for first, found, letters in presence(block, self.fold):
            margins = self.margins(found)
            chance = np.exp(4 * (margins - margins.max(axis=1, keepdims=True)))
            chance /= chance.sum(axis=1, keepdims=True)
            for i in np.flatnonzero(letters):
                choice = int(np.argmax(margins[i]))
                best[first + i] = self.names[choice]
                scores[first + i] = chance[i, choice]
        return best, scores


def _unpacked(rows: list[bytes]) -> np.ndarray:
    return np.unpackbits(
        np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(len(rows), -1), axis=1
    ).astype(np.float32)


def nystroem_map(landmarks: list[bytes]) -> np.ndarray:
    """Places by Nyström features: what a presence vector, divided by the root of its
    size, is multiplied with."""
    chosen = _unpacked(landmarks)
    chosen /= np.sqrt(np.maximum(chosen.sum(axis=1), 1))[:, None]
    values, vectors = np.linalg.eigh((chosen @ chosen.T).astype(np.float64))
    used = values > values[-1] * 1e-6
    return (chosen.T @ (vectors[:, used] / np.sqrt(values[used]))).astype(np.float32)


def _equation_parts(batches, chosen, names):
    """A task's share of the normal equations: rows of the gram matrix by number, and sums of
    the mapped documents by language."""
    matrix = chosen.value
    width = matrix.shape[1]
    gram, sums = np.zeros((width, width)), {}
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            own = batch.slice(at, BATCH)
            places = _unpacked(own.column(1).to_pylist())
            size = np.sqrt(np.maximum(places.sum(axis=1), 1))
            mapped = (places @ matrix / size[:, None]).astype(np.float64)
            gram += mapped.T @ mapped
            for lang, row in zip(own.column(0).to_pylist(), mapped, strict=True):
                sums[lang] = sums.get(lang, 0) + np.append(row, 1.0)
    keys = [(i, None) for i in range(width)] + [(None, lang) for lang in sums]
    rows = [np.append(g, 0.0) for g in gram] + list(sums.values())
    numbers, langs = zip(*keys, strict=True)
    columns = np.array(rows).T.copy()
    yield pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array(langs, pa.string()), *map(pa.array, columns)],
        names=names,
    )


def fit(places: DataFrame, landmarks: int, ridge: float) -> tuple:
    """Languages, Nyström map, ridge weights and number of rows of ``places`` (``lang``,
    ``order``, ``places``)."""
    per_label = Window.partitionBy("lang").orderBy("order", "places")
    labels = places.select("lang").distinct().count()
    if labels > MAX_LANGUAGES:
        raise ValueError(f"{labels} labels are no languages (at most {MAX_LANGUAGES})")
    share = max(1, landmarks // max(1, labels))
    chosen = (
        places.withColumn("rank", F.row_number().over(per_label))
        .filter(F.col("rank") <= share)
        .orderBy("rank", "lang")
        .limit(landmarks)
        .collect()
    )
    if not chosen:
        return [], np.zeros((1 << BITS, 1), np.float32), np.zeros((1, 0), np.float32), 0
    matrix = nystroem_map([r.places for r in sorted(chosen, key=lambda r: (r.lang, r["rank"]))])
    width = matrix.shape[1]
    values = [f"c{i}" for i in range(width + 1)]
    shared = places.sparkSession.sparkContext.broadcast(matrix)
    run = partial(_equation_parts, chosen=shared, names=["i", "lang", *values])
    schema = ", ".join(["i int", "lang string", *[f"{c} double" for c in values]])
    summed = (
        places.select("lang", "places")
        .mapInArrow(run, schema)
        .groupBy("i", "lang")
        .agg(*[F.sum(c).alias(c) for c in values])
        .collect()
    )
    gram, sums = ridge * np.eye(width), {}
    for row in summed:
        if row.i is None:
            sums[row.lang] = np.array(row[2:])
        else:
            gram[row.i] += row[2:-1]
    names = sorted(sums)
    by_language = np.array([sums[n] for n in names])
    # A target is one for its language and minus one for the others.
    aims = 2 * by_language[:, :-1] - by_language[:, :-1].sum(axis=0)
    weights = np.linalg.solve(gram, aims.T).astype(np.float32)
    return names, matrix, weights, int(by_language[:, -1].sum())


def _presence_batches(batches, fold, schema):
    def results(block: Block) -> list[pa.Array]:
        packed = []
        for _, found, _ in presence(block, fold.value):
            packed.extend(np.packbits(x).tobytes() for x in found)
        return [pa.array(packed, pa.binary())]

    return map_texts(batches, "text", ["lang", "order"], results, schema)


def train_language(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    per_language: int = 300,
    landmarks: int = 160,
    ridge: float = 0.1,
) -> LanguageModel:
    """Learn from labelled documents that are not held out, one text for each id.

    Of rows that repeat a sampled id, those with the sampled language count.
    """
    fold = folding()
    shared = docs.sparkSession.sparkContext.broadcast(fold)
    sample = training_sample(docs.select(id_column, language), id_column, language, per_language)
    drawn = docs.select(
        F.col(id_column).alias("id"),
        F.col(language).alias("lang"),
        F.col(text).cast("string").alias("text"),
    ).join(
        F.broadcast(
            sample.select(
                F.col(id_column).alias("id"), F.col(language).alias("lang"), "order"
            )
        ),
        ["id", "lang"],
    )
    rows = one_text(drawn, ["id", "lang", "order"])
    schema = pa.schema(
        [("lang", pa.string()), ("order", pa.int64()), ("places", pa.binary())]
    )
    run = partial(_presence_batches, fold=shared, schema=schema)
    places = stored(
        rows.select("lang", "order", "text").mapInArrow(
            run, "lang string, order long, places binary"
        )
    )
    names, chosen, weights, learned = fit(places, landmarks, ridge)
    few = len(names) <= len(weights)
    matrices = [chosen @ weights] if few else [chosen, weights]
    return LanguageModel(names, matrices, fold, learned)


def _predict_batches(batches, model, text, keep, schema):
    def results(block: Block) -> list[pa.Array]:
        names, scores = model.value.predict(block)
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return map_texts(batches, text, keep, results, schema)


def predict_language(
    docs: DataFrame, model: LanguageModel, keep: list[str], text: str = "text"
) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of every whole text."""
    keep = [c for c in keep if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = (
        docs.select(*keep)
        .withColumn("lang_pred", F.lit(""))
        .withColumn("score", F.lit(0.0))
        .schema
    )
    run = partial(
        _predict_batches, model=shared, text="__text", keep=keep, schema=to_arrow_schema(schema)
    )
    source = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    return source.mapInArrow(run, schema)
