"""Texts of an Arrow batch as flat byte arrays, and word spans found in them.

Functions that run inside Spark tasks.  A batch is walked in blocks of whole
texts, so the arrays made for a block stay small whatever the batch holds: a
block has at most ``BLOCK_BYTES`` of text, or one text where that is longer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Block:
    """Texts ``first`` to ``last`` (excluded) of a batch: bytes and offsets, from 0."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return self.last - self.first

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of a string column; a null is an empty text."""
    rows = len(column)
    if not rows:
        return
    filled = column.fill_null("").cast(pa.large_string())
    _, offset_buffer, data_buffer = filled.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[filled.offset : filled.offset + rows + 1]
    data = (
        np.frombuffer(data_buffer, dtype=np.uint8)
        if data_buffer is not None
        else np.zeros(0, dtype=np.uint8)
    )
    first = 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        own = offsets[first : last + 1]
        yield Block(first, last, data[own[0] : own[-1]], own - own[0])
        first = last


def map_texts(
    batches: Iterable[pa.RecordBatch],
    text: str,
    keep: list[str],
    results: Callable[[Block], list[pa.Array]],
    schema: pa.Schema,
) -> Iterator[pa.RecordBatch]:
    """For every block: the ``keep`` columns and the arrays that ``results`` gives."""
    for batch in batches:
        for block in blocks(batch.column(text)):
            own = batch.slice(block.first, len(block))
            yield pa.RecordBatch.from_arrays(
                [*[own.column(c) for c in keep], *results(block)], schema=schema
            )


def spaces(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def lowered(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, all other bytes as they are."""
    return _LOWER[data]


@dataclass
class Words:
    """Places of words in a block; ``count`` words in each text."""

    starts: np.ndarray
    ends: np.ndarray
    count: np.ndarray

    def first_of_text(self) -> np.ndarray:
        """Number of the first word of every text, and at the end of all words."""
        return np.concatenate([[0], np.cumsum(self.count)])


def runs(inside: np.ndarray, block: Block, breaks: np.ndarray | None = None) -> Words:
    """Runs of bytes marked in ``inside``; a text's end and ``breaks`` end a run."""
    size = len(inside)
    if not size:
        empty = np.zeros(0, dtype=np.int64)
        return Words(empty, empty, np.zeros(len(block), dtype=np.int64))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = block.offsets[:-1][block.offsets[:-1] < size]
    begins[edges] = inside[edges]
    if breaks is not None:
        begins |= breaks & inside
    starts = np.flatnonzero(begins)
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | begins[1:]
    last = block.offsets[1:][block.offsets[1:] > 0] - 1
    stops[last] = inside[last]
    ends = np.flatnonzero(stops) + 1
    place = np.searchsorted(starts, block.offsets)
    return Words(starts, ends, np.diff(place))


def spaced_words(data: np.ndarray, block: Block) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+``; no byte of a longer character is a space."""
    return runs(~_SPACE[data], block)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring bounds; zero where there are none."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), dtype=values.dtype)
    filled = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(filled):
        out[filled] = np.add.reduceat(values, bounds[:-1][filled], axis=0)
    return out
