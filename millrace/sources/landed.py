"""Paged responses that a fetcher landed in shared storage, as a batch and a stream source.

A page is one file, named by its source, its number and the cursor that it answers
(``page_key``).  Planning reads names only: the driver sees no page.  The pages of a source
are cut into blocks for many tasks; a task follows ``next_cursor`` through its block and
one page before it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)
from pyspark.sql.types import StructType

from millrace.sources import storage
from millrace.sources.records import read_paged
from millrace.sources.tables import RecordTables

SCHEMA = "source string, page_number long, body string, problem string"
_ARROW = pa.schema(
    [
        ("source", pa.string()),
        ("page_number", pa.int64()),
        ("body", pa.string()),
        ("problem", pa.string()),
    ]
)
PAGES_PER_TASK = 64
#: A stream keeps one number for each source in its offset.
MAX_SOURCES = 10_000
_DIGITS = 12


def page_key(source: Column, page_number: Column, asked: Column) -> Column:
    """Object key of a page; ``asked`` is the cursor that it answers, null for the first."""
    number = F.lpad(page_number.cast("string"), _DIGITS, "0")
    cursor = F.sha2(F.coalesce(asked, F.lit("")), 256)
    return F.concat(F.url_encode(source), F.lit("/"), number, F.lit("-"), cursor, F.lit(".json"))


def _digest(cursor: str) -> str:
    return hashlib.sha256(cursor.encode()).hexdigest()


def _number(name: str) -> int:
    return int(name[:_DIGITS])


def _asked(name: str) -> str:
    return name[_DIGITS + 1 :].removesuffix(".json")


@dataclass
class Block(InputPartition):
    """Pages of one source in order, with the page before them; ``problem`` is the last one's."""

    folder: str
    before: str | None
    names: Sequence[str]
    problem: str | None = None


def _next_cursor(body: bytes) -> object:
    """What a page names as its next; None for the last one and for what is no response."""
    try:
        page = json.loads(body)
    except ValueError:
        return None
    return page.get("next_cursor") if isinstance(page, dict) else None


def _read(root: str, block: Block) -> Iterator[pa.RecordBatch]:
    """The pages of a block, one in memory at a time."""
    files, path = storage.opened(root)
    source = unquote_plus(block.folder)

    def named(body: bytes) -> str | None:
        cursor = _next_cursor(body)
        return _digest(cursor) if isinstance(cursor, str) and cursor else None

    expected = _digest("")
    if block.before is not None:
        expected = named(storage.content(files, f"{path}/{block.folder}/{block.before}"))
    for position, name in enumerate(block.names):
        body = storage.content(files, f"{path}/{block.folder}/{name}")
        problem = None if expected == _asked(name) else "page_does_not_answer_cursor"
        if block.problem is not None and position == len(block.names) - 1:
            problem = block.problem
        try:
            text = body.decode()
        except UnicodeDecodeError:
            text, problem = None, problem or "page_not_utf8"
        row = [[source], [_number(name)], [text], [problem]]
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(row, _ARROW)], schema=_ARROW)
        expected = named(body)


def _pages(root: str, folder: str) -> tuple[list[str], str | None]:
    """Names of a source's pages as far as they can be followed, and the last one's problem.

    A page that answers a cursor which an earlier page answered ends the source.  A missing
    number ends it for now.  Of two pages with one number the first by name is followed, and
    the source has a problem.  Landed pages are not changed afterwards.
    """
    files, path = storage.opened(root)
    names = [
        n for n in storage.names_in(files, f"{path}/{folder}", storage.fs.FileType.File)
        if n.endswith(".json") and n[:_DIGITS].isdigit()
    ]
    followed: list[str] = []
    answered: set[str] = set()
    problem = None
    for name in names:
        if _number(name) > len(followed) + 1:
            break
        if _number(name) < len(followed) + 1:
            problem = "page_number_repeated"
            continue
        followed.append(name)
        if _asked(name) in answered:
            return followed, "cursor_did_not_advance"
        answered.add(_asked(name))
    return followed, problem


def _sources(root: str) -> list[str]:
    files, path = storage.opened(root)
    folders = storage.names_in(files, path, storage.fs.FileType.Directory)
    return [f for f in folders if not f.startswith(("_", "."))]


def _blocks(
    root: str, folder: str, per_task: int, start: int = 0, end: int | None = None
) -> list[Block]:
    names, problem = _pages(root, folder)
    stop = len(names) if end is None else end
    blocks = []
    for first in range(start, stop, per_task):
        last = min(first + per_task, stop)
        before = names[first - 1] if first else None
        ends = problem if last == len(names) else None
        blocks.append(Block(folder, before, tuple(names[first:last]), ends))
    return blocks


class _BatchReader(DataSourceReader):
    def __init__(self, root: str, per_task: int) -> None:
        self.root, self.per_task = root, per_task

    def partitions(self) -> Sequence[InputPartition]:
        blocks = [b for s in _sources(self.root) for b in _blocks(self.root, s, self.per_task)]
        return blocks or [Block("", None, ())]

    def read(self, partition: Block) -> Iterator[pa.RecordBatch]:
        return _read(self.root, partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are the number of pages read of each source."""

    def __init__(self, root: str, per_task: int, max_sources: int) -> None:
        self.root, self.per_task, self.max_sources = root, per_task, max_sources

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        sources = _sources(self.root)
        if len(sources) > self.max_sources:
            raise ValueError(
                f"{len(sources)} sources are more than maxSources; read their folders by several streams"
            )
        return {s: len(_pages(self.root, s)[0]) for s in sources}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [
            block
            for source, stop in sorted(end.items())
            for block in _blocks(self.root, source, self.per_task, start.get(source, 0), stop)
        ]

    def read(self, partition: Block) -> Iterator[pa.RecordBatch]:
        return _read(self.root, partition)


class LandedPages(DataSource):
    """Format ``landed_pages``: options ``path``, ``pagesPerTask`` and ``maxSources``."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return SCHEMA

    def _settings(self) -> tuple[str, int]:
        return self.options["path"], int(self.options.get("pagesPerTask", PAGES_PER_TASK))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _BatchReader(*self._settings())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(*self._settings(), int(self.options.get("maxSources", MAX_SOURCES)))


def landed_pages(spark: SparkSession, folder: str, pages_per_task: int = PAGES_PER_TASK) -> DataFrame:
    """Every landed page: source, page_number, body and problem (null for a good page)."""
    spark.dataSource.register(LandedPages)
    reader = spark.read.format("landed_pages").option("pagesPerTask", str(pages_per_task))
    return reader.option("path", folder).load()


def stream_pages(
    spark: SparkSession,
    folder: str,
    pages_per_task: int = PAGES_PER_TASK,
    max_sources: int = MAX_SOURCES,
) -> DataFrame:
    """Pages as they land, each once; a restarted query goes on behind its last offset."""
    spark.dataSource.register(LandedPages)
    reader = spark.readStream.format("landed_pages").option("pagesPerTask", str(pages_per_task))
    return reader.option("maxSources", str(max_sources)).option("path", folder).load()


def paged_tables(pages: DataFrame, source_url: Column, stream: Column) -> RecordTables:
    """Records, states and logs of pages as ``read_paged`` gives them.

    A page with a problem rejects its whole source; the first problem of a source is its error.
    """
    named = pages.withColumns({"source_url": source_url, "stream": stream})
    return read_paged(named, ["source"], fault="problem")
