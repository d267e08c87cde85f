"""Packing of token sequences into windows, online and in bounded space.

Every task reads its documents once, encodes them and packs as it goes.  It keeps a fixed
number of open windows.  A document (its ids and one end id) longer than a window gives
whole windows first.  What is left goes, uncut, into the open window that it fits best; a
window that is full is emitted.  Where none fits and another window may be opened, it is
opened; otherwise the fullest window is emitted, filled up with the first ids of the
document, and the rest is placed the same way.

The windows that are still open at the end of the tasks are merged: the pieces of
``MERGED_TASKS`` tasks are packed again by one task in the same manner, longest first, and
so on in rounds, until one task has them.  Its open windows are filled up from the emptiest
of them, and the last ids, less than a window, are laid into sequences whose lengths are
powers of two, so nothing is padded.  A round moves at most ``windows`` windows for each
task before it.

What the first step and every round found is written to the checkpoint folder, so a lost
task is run again on the same rows.  Nothing is gathered on the driver.

A null text is empty: its document is the end id alone.  Rows with a null or repeated id
are documents of their own.  No rows give no pieces.  Columns other than the id and the
text are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.bpe import CACHED_WORDS, Encoder, Vocabulary
from millrace.llm.textblocks import blocks
from millrace.session import stored

#: Tasks whose open windows are merged by one task of the next round.
MERGED_TASKS = 8
#: Pieces of a batch that a task gives out.
BATCH_PIECES = 4096


@dataclass(slots=True)
class Piece:
    """Ids of a document from ``start`` on; ``document`` is its id and its length."""

    document: tuple
    start: int
    ids: np.ndarray

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.document, self.start, self.ids[:length]),
            Piece(self.document, self.start + length, self.ids[length:]),
        )


@dataclass(slots=True)
class Window:
    """Pieces laid one after the other."""

    pieces: list[Piece] = field(default_factory=list)
    length: int = 0

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.length += len(piece.ids)


class Packer:
    """Best-fit packing into a fixed number of open windows; emits full ones."""

    def __init__(self, size: int, windows: int) -> None:
        self.size, self.windows = size, windows
        self.open: dict[int, Window] = {}
        self.room: list[tuple[int, int]] = []  # free ids and number of every open window
        self.opened = 0

    def _put(self, number: int, piece: Piece) -> Iterator[Window]:
        """The piece into an open window; the window itself if that fills it."""
        window = self.open[number]
        window.add(piece)
        if window.length == self.size:
            yield self.open.pop(number)
        else:
            insort(self.room, (self.size - window.length, number))

    def place(self, piece: Piece) -> Iterator[Window]:
        while len(piece.ids) >= self.size:
            head, piece = piece.cut(self.size)
            whole = Window()
            whole.add(head)
            yield whole
        # A copy, as a view would keep all ids of a long document while its window is open.
        piece = Piece(piece.document, piece.start, piece.ids.copy())
        while len(piece.ids):
            at = bisect_left(self.room, (len(piece.ids), -1))
            if at < len(self.room):
                _, number = self.room.pop(at)
                yield from self._put(number, piece)
                return
            if len(self.open) < self.windows:
                self.open[self.opened] = Window()
                yield from self._put(self.opened, piece)
                self.opened += 1
                return
            free, fullest = self.room.pop(0)
            head, piece = piece.cut(free)
            yield from self._put(fullest, head)

    def rest(self) -> list[Window]:
        """The open windows, the fullest first."""
        return [self.open[number] for _, number in self.room]

    def close(self) -> Iterator[Window]:
        """Fill up the open windows from the emptiest; the last ids by powers of two."""
        left = self.rest()
        while len(left) > 1:
            first, last = left[0], left[-1]
            while first.length < self.size and last.pieces:
                piece = last.pieces.pop()
                last.length -= len(piece.ids)
                head, piece = piece.cut(self.size - first.length)
                first.add(head)
                if len(piece.ids):
                    last.add(piece)
            if first.length == self.size:
                yield left.pop(0)
            if not last.pieces:
                left.pop()
        pieces = left[0].pieces[::-1] if left else []
        total = left[0].length if left else 0
        while total:
            length = 1 << (total.bit_length() - 1)
            window = Window()
            while window.length < length:
                head, tail = pieces.pop().cut(length - window.length)
                window.add(head)
                if len(tail.ids):
                    pieces.append(tail)
            total -= length
            yield window


class _Rows:
    """Collects windows as rows of pieces."""

    def __init__(self, schema: pa.Schema, first_sequence: int, with_ids: bool) -> None:
        self.schema, self.with_ids = schema, with_ids
        self.sequence = first_sequence
        self.rows: list[tuple] = []

    def add(self, window: Window, is_open: bool) -> None:
        offset = 0
        for p in window.pieces:
            packed = p.ids.astype("<u4").tobytes()
            name, tokens = p.document
            kept = packed if is_open or self.with_ids else None
            self.rows.append(
                (name, p.start, len(p.ids), zlib.crc32(packed), tokens, self.sequence, offset, kept, is_open)
            )
            offset += len(p.ids)
        self.sequence += 1

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if self.rows and len(self.rows) >= least:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)],
                schema=self.schema,
            )
            self.rows.clear()


def _sequence_of(step: int, task: int) -> int:
    """First sequence number of a task: 7 bits of the step, 24 of the task, 32 to count."""
    if task >= 1 << 24:
        raise ValueError("more tasks than a sequence number has room for")
    return step << 56 | task << 32


def _pack_batches(
    batches: Iterable[pa.RecordBatch], vocabulary, end: int, size: int, windows: int,
    with_ids: bool, schema: pa.Schema,
) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(vocabulary.value)
    packer = Packer(size, windows)
    out = _Rows(schema, _sequence_of(0, TaskContext.get().partitionId()), with_ids)
    for batch in batches:
        for block in blocks(batch.column(1)):
            numbers, count = encoder.words(block)
            encoder.settle()
            ids, bounds = encoder.ids_of(numbers, count)
            names = batch.column(0).slice(block.first, len(block)).to_pylist()
            for name, a, b in zip(names, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own = np.empty(b - a + 1, dtype=np.uint32)
                own[:-1], own[-1] = ids[a:b], end
                for window in packer.place(Piece((name, len(own)), 0, own)):
                    out.add(window, False)
            yield from out.batches(BATCH_PIECES)
            if len(encoder.known) > CACHED_WORDS:
                encoder.forget()
    for window in packer.rest():
        out.add(window, True)
    yield from out.batches(1)


def _merge_table(
    key: tuple, table: pa.Table, step: int, last: bool, size: int, windows: int,
    with_ids: bool, schema: pa.Schema,
) -> pa.Table:
    """One group's pieces packed again, longest first."""
    rows = table.select(["id", "doc_tokens", "start", "ids", "sequence_id", "offset"])
    columns = [c.to_pylist() for c in rows.columns]
    pieces = [
        (-len(ids), sequence, offset, Piece((name, tokens), start, np.frombuffer(ids, "<u4")))
        for name, tokens, start, ids, sequence, offset in zip(*columns, strict=True)
    ]
    # A sequence and an offset name one piece: the order does not hang on the network.
    pieces.sort(key=lambda p: p[:3])
    packer = Packer(size, windows)
    out = _Rows(schema, _sequence_of(step, key[0].as_py()), with_ids)
    for *_, piece in pieces:
        for window in packer.place(piece):
            out.add(window, False)
    for window in packer.close() if last else packer.rest():
        out.add(window, not last)
    return pa.Table.from_batches(list(out.batches(1)), schema=schema)


def _merging(step: int, last: bool, options: dict):
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        return _merge_table(key, table, step, last, **options)

    return merge


def pack(
    docs: DataFrame,
    vocabulary_path: str,
    size: int = 2048,
    end: int = 1,
    windows: int = 32,
    id_column: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """A row for every piece of a document in a sequence of at most ``size`` ids.

    ``id_column``, ``start`` (ids of the document before the piece), ``length``,
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers), ``doc_tokens``
    (with the end id), ``sequence_id``, ``offset`` (of the piece in its sequence) and, with
    ``with_ids``, ``ids``.  The pieces of a sequence lie side by side from offset 0.
    """
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    source = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")
    )
    schema = T.StructType(
        [
            T.StructField("id", source.schema["id"].dataType),
            *[T.StructField(n, T.LongType()) for n in names],
            T.StructField("ids", T.BinaryType()),
            T.StructField("open", T.BooleanType()),
        ]
    )
    options = {
        "size": size,
        "windows": windows,
        "with_ids": with_ids,
        "schema": to_arrow_schema(schema),
    }
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path))
    run = partial(_pack_batches, vocabulary=vocabulary, end=end, **options)
    found = stored(source.mapInArrow(run, schema))
    done = found.filter(~F.col("open"))
    # The task number of a sequence: what stands above the 32 bits that count.
    task = F.shiftright(F.col("sequence_id"), 32).bitwiseAND(F.lit((1 << 24) - 1))
    left, step = found.filter("open"), 0
    while True:
        groups = left.agg(F.max(task).alias("most")).first().most
        if groups is None:
            break
        step += 1
        last = groups < MERGED_TASKS

        grouped = left.withColumn("group", F.floor(task / MERGED_TASKS)).groupBy("group")
        merged = stored(grouped.applyInArrow(_merging(step, last, options), schema))
        done = done.union(merged.filter(~F.col("open")))
        left = merged.filter("open")
        if last:
            break
    made = [*names, "ids"] if with_ids else names
    return done.select(F.col("id").alias(id_column), *made)
