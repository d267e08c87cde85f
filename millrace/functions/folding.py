"""Texts that exist only as ordered rows, described without putting them together.

A digest of a text needs its bytes in order, so the rows of one text pass through one
task.  They are sorted by Spark, which spills, and folded as they stream by in Arrow
batches: the task holds one batch, a digest and a preview, however long the text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

FACTS = T.StructType(
    [
        T.StructField("rows", T.LongType()),
        T.StructField("chars", T.LongType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("preview", T.StringType()),
    ]
)


class _Fold:
    """The text so far of one key."""

    def __init__(self, separator: str, shown: int) -> None:
        self.separator, self.shown = separator, shown
        self.rows = self.chars = 0
        self.joined = False
        self.digest = hashlib.sha256()
        self.preview = ""

    def add(self, texts: pa.Array, rows: int) -> None:
        self.rows += rows
        if not len(texts):
            return
        piece = self.separator.join(texts.to_pylist())
        if self.joined:
            piece = self.separator + piece
        self.joined = True
        self.chars += len(piece)
        self.digest.update(piece.encode())
        if len(self.preview) < self.shown:
            self.preview += piece[: self.shown - len(self.preview)]

    def facts(self) -> list:
        return [self.rows, self.chars, self.digest.hexdigest(), self.preview]


def _runs(batch: pa.RecordBatch, keys: int) -> list[int]:
    """Where rows of another key begin, and the end of the batch."""
    cuts = {0, batch.num_rows}
    for i in range(keys):
        column = batch.column(i)
        before, after = column.slice(0, len(column) - 1), column.slice(1)
        # A difference, or a null beside a value.
        changed = pc.fill_null(pc.not_equal(before, after), False)
        changed = pc.or_(changed, pc.xor(pc.is_null(before), pc.is_null(after)))
        cuts.update((i + 1 for i in pc.indices_nonzero(changed).to_pylist()))
    return sorted(cuts)


def joined_text_facts(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    text: str,
    separator: str,
    shown: int,
    skip_empty: bool = False,
) -> DataFrame:
    """For every key: ``rows``, and ``chars``, ``sha256`` and ``preview`` of its joined text.

    The text is the ``text`` of the key's rows in ``order``, which should be total, with
    ``separator`` between them; rows whose text is null, and with ``skip_empty`` empty
    ones, count as rows but are no part of it.  ``preview`` has its first ``shown``
    characters.  Null keys are a key.
    """
    schema = T.StructType([*rows.select(*keys).schema.fields, *FACTS.fields])
    arrow = to_arrow_schema(schema)
    width = len(keys)

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        done: list[list] = []

        def given() -> pa.RecordBatch:
            columns = zip(*done, strict=True)
            made = [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
            return pa.RecordBatch.from_arrays(made, schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = _runs(batch, width)
            for first, last in zip(cuts, cuts[1:]):  # noqa: B905
                own = batch.slice(first, last - first)
                key = [own.column(i)[0].as_py() for i in range(width)]
                if state is None or key != current:
                    if state is not None:
                        done.append([*current, *state.facts()])
                    current, state = key, _Fold(separator, shown)
                texts = own.column(width).drop_null()
                if skip_empty:
                    texts = texts.filter(pc.not_equal(texts, ""))
                state.add(texts, own.num_rows)
            if done:
                yield given()
                done.clear()
        if state is not None:
            done.append([*current, *state.facts()])
            yield given()

    slim = rows.select(*keys, F.col(order).alias("__order"), F.col(text).alias("__text"))
    ordered = slim.repartition(*keys).sortWithinPartitions(*keys, "__order")
    return ordered.select(*keys, "__text").mapInArrow(fold, schema)
