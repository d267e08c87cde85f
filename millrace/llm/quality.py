"""Text quality by logistic regression on hashed word n-grams.

A text is read as words and runs of punctuation, each in two spellings: the token in
lower case and its shape (capitals, digits, a repeat of the word before, the marks
themselves for punctuation).  One to two neighbouring tokens of the first spelling and
one to three of the second are hashed to ``2 ** bits`` features, whose values are
their relative frequencies in the whole text.

Training follows the regularised leader (FTRL-proximal, a learning rate for each
feature) over a sample of at most ``per_class`` labelled documents of each class,
dealt to ``shares`` tasks whose weights are averaged; the rows a task sees are at most
the whole sample, and the driver gets ``shares`` weight vectors.  Classes that the
sample shows more evenly than the labels are put right by the intercept.

Scoring is a sparse dot product in the task that reads the text.  A null text counts
as empty; an empty text has only the intercept.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.samples import held_out, one_text, training_sample
from millrace.llm.textblocks import Block, blocks, lowered, map_texts, runs, spaces, sums

BITS = 18
#: Relative frequencies are small; this puts them near one.
SCALE = 16.0
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xD6E8FEB86659FD93)

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_ASCII_LETTER = _WORD & ~_DIGIT & (np.arange(256) < 0x80)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse, modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for factor in (_BASE, inverse):
        steps = np.full(size + 1, factor, dtype=np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(32))


def _total(mask: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(mask)])


def features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts of a block, and the bounds of each text's."""
    data = block.data
    word = _WORD[data]
    change = np.zeros(len(data), dtype=bool)
    change[1:] = word[1:] != word[:-1]
    tokens = runs(~spaces(data), block, change)
    starts, ends, count = tokens.starts, tokens.ends, tokens.count
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(len(block) + 1, dtype=np.int64)
    up, down = _powers(len(data))
    rolled = np.concatenate(
        [np.zeros(1, dtype=np.uint64), np.cumsum((lowered(data) + np.uint64(1)) * up[:-1])]
    )
    token = _mixed((rolled[ends] - rolled[starts]) * down[starts])
    text_of = np.repeat(np.arange(len(count)), count)

    is_word = word[starts]
    upper, digit = _total(_UPPER[data]), _total(_DIGIT[data])
    letter = _total(_ASCII_LETTER[data])
    capitals = upper[ends] - upper[starts]
    letters = letter[ends] - letter[starts]
    shape = np.where(capitals == 0, 0, 3)
    shape[(capitals == 1) & _UPPER[data[starts]]] = 1
    shape[(capitals > 1) & (capitals == letters)] = 2
    shape[digit[ends] - digit[starts] == ends - starts] = 4
    words = np.flatnonzero(is_word)
    repeated = np.zeros(len(starts), dtype=bool)
    repeated[words[1:]] = (token[words[1:]] == token[words[:-1]]) & (
        text_of[words[1:]] == text_of[words[:-1]]
    )
    shape = np.where(is_word, shape + 8 * repeated + 1, 0).astype(np.uint64)
    shape = _mixed(np.where(is_word, shape, token) + np.uint64(77))

    hashes, owners = [token, shape], [text_of, text_of]
    for spelling, most in ((token, 2), (shape, 3)):
        gram = spelling
        for more in range(1, most):
            same = text_of[more:] == text_of[:-more]
            gram = _mixed(gram[: len(spelling) - more] * np.uint64(3) + spelling[more:])
            hashes.append(gram[same])
            owners.append(text_of[more:][same])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    number = (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int64)[order]
    return number, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(block)))])


@dataclass
class FollowTheLeader:
    """FTRL-proximal state of a logistic regression; the last weight is the intercept."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1

    def __post_init__(self) -> None:
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / rate)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        """One example with different feature numbers ``at``."""
        weight = self.weights(at)
        margin = float(np.clip(weight @ value, -35, 35))
        gradient = (1 / (1 + np.exp(-margin)) - label) * value
        squared = gradient**2
        step = (np.sqrt(self.n[at] + squared) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += gradient - step * weight
        self.n[at] += squared


def _train(frame: pd.DataFrame, epochs: int) -> pd.DataFrame:
    frame = frame.sort_values(["order", "id"], kind="stable")
    labels = frame["label"].tolist()
    examples = []
    column = pa.array(frame["text"].tolist(), pa.string())
    for block in blocks(column):
        number, bounds = features(block)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            at, times = np.unique(number[a:b], return_counts=True)
            value = times * (SCALE / max(1, b - a))
            examples.append((np.append(at, 1 << BITS), np.append(value, 1.0)))
    model = FollowTheLeader()
    for _ in range(epochs):
        for (at, value), label in zip(examples, labels, strict=True):
            model.learn(at, value, label)
    weights = model.weights().astype("<f4").tobytes()
    return pd.DataFrame({"weights": [weights], "rows": [len(labels)]})


@dataclass
class QualityModel:
    weights: np.ndarray

    def score(self, block: Block) -> np.ndarray:
        number, bounds = features(block)
        total = sums(self.weights[number].astype(np.float64), bounds)
        margin = total * (SCALE / np.maximum(1, np.diff(bounds))) + float(self.weights[-1])
        return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    per_class: int = 4000,
    shares: int = 4,
    epochs: int = 3,
) -> QualityModel:
    """Learn label 1 against 0 from labelled documents that are not held out.

    One text is learned for each id, whatever the number of its rows.
    """
    known = labels.filter(F.col(label).isin(0, 1))
    sample = training_sample(known, id_column, label, per_class)
    repeated = (
        docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
        .join(
            F.broadcast(
                sample.select(
                    F.col(id_column).alias("id"),
                    F.col(label).cast("int").alias("label"),
                    "order",
                    F.pmod("order", F.lit(shares)).cast("int").alias("share"),
                )
            ),
            "id",
        )
    )
    rows = one_text(repeated, ["id", "label", "order", "share"]).fillna({"text": ""})

    def train_share(frame: pd.DataFrame) -> pd.DataFrame:
        return _train(frame, epochs)

    trained = rows.groupBy("share").applyInPandas(train_share, "weights binary, rows long")
    parts = trained.collect()
    if not parts:
        return QualityModel(np.zeros((1 << BITS) + 1, dtype=np.float32))
    weights = np.average(
        [np.frombuffer(p.weights, dtype="<f4") for p in parts],
        axis=0,
        weights=[p.rows for p in parts],
    ).astype(np.float32)
    one, zero = F.sum(label).alias("one"), F.sum(1 - F.col(label)).alias("zero")
    all_labels = known.filter(~held_out(id_column)).agg(one, zero).first()
    drawn = sample.agg(one, zero).first()
    if all_labels.one and all_labels.zero and drawn.one and drawn.zero:
        odds = (all_labels.one / all_labels.zero) / (drawn.one / drawn.zero)
        weights[-1] += np.log(odds)
    return QualityModel(weights)


def _score_batches(batches, model, text, keep, schema):
    def results(block: Block) -> list[pa.Array]:
        return [pa.array(model.value.score(block), pa.float64())]

    return map_texts(batches, text, keep, results, schema)


def score_quality(
    docs: DataFrame, model: QualityModel, keep: list[str], text: str = "text", out: str = "score"
) -> DataFrame:
    """``keep`` columns and the probability of label 1 of every whole text."""
    keep = [c for c in keep if c != out]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*keep).withColumn(out, F.lit(0.0)).schema
    run = partial(
        _score_batches, model=shared, text="__text", keep=keep, schema=to_arrow_schema(schema)
    )
    source = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    return source.mapInArrow(run, schema)


def keep_good(
    docs: DataFrame, model: QualityModel, threshold: float, text: str = "text"
) -> DataFrame:
    """The rows, with all their columns, whose score is at least ``threshold``.

    The text itself goes to the scoring task and comes back, so nothing is joined.
    """
    columns = docs.columns
    packed = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    scored = score_quality(packed, model, packed.columns, f"c{columns.index(text)}", "score")
    return scored.filter(F.col("score") >= threshold).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)]
    )
