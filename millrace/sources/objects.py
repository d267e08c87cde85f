"""One object for each delivery, written aside and published whole.

A task writes its objects and a list of them below ``_staged/<write>/``.  Its commit message
names the attempt only, so what passes through the driver does not grow with the objects.
When all tasks have committed, a second job moves the staged objects of the committed
attempts to their keys.  A killed task, a lost executor or a failed write therefore leaves
no half object under a key, and ``publish_objects`` may be run again after a failure.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from millrace.sources import storage

STAGED = "_staged"
PUBLISHED = "_published"
_LISTED = pa.schema(
    [
        ("object_key", pa.string()),
        ("size", pa.int64()),
        ("sha256", pa.string()),
        ("attempt", pa.string()),
        ("number", pa.int64()),
    ]
)
RECEIPTS = "object_key string, size long, sha256 string, `write` string"


def check_key(key: str | None) -> str:
    """The key, where it names one object below the folder."""
    parts = (key or "").split("/")
    if any(p in ("", ".", "..") for p in parts) or parts[0] in (STAGED, PUBLISHED):
        raise ValueError(f"not a key of an object: {key!r}")
    return key


@dataclass
class StagedAttempt(WriterCommitMessage):
    attempt: str


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, write: str) -> None:
        self.folder, self.write_id = folder, write

    def _place(self) -> tuple[object, str]:
        files, root = storage.opened(self.folder)
        return files, f"{root}/{STAGED}/{self.write_id}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> StagedAttempt:
        files, place = self._place()
        attempt = uuid.uuid4().hex
        objects, lists = f"{place}/objects/{attempt}", f"{place}/lists"
        for folder in (objects, lists, f"{place}/open"):
            files.create_dir(folder, recursive=True)
        listing = f"{place}/open/{attempt}.parquet"
        count = 0
        with pq.ParquetWriter(listing, _LISTED, filesystem=files) as writer:
            for batch in iterator:
                rows = []
                for key, body in zip(batch.column(0), batch.column(1), strict=True):
                    value = body.as_py() or ""
                    data = value.encode() if isinstance(value, str) else value
                    name = f"{objects}/{count:09d}"
                    storage.put(files, name, data)
                    digest = hashlib.sha256(data).hexdigest()
                    rows.append((check_key(key.as_py()), len(data), digest, attempt, count))
                    count += 1
                columns = list(zip(*rows, strict=True)) or [[] for _ in _LISTED]
                writer.write_table(
                    pa.table([pa.array(c, f.type) for c, f in zip(columns, _LISTED)], schema=_LISTED)
                )
        # A list is seen when it is whole.
        files.move(listing, f"{lists}/{attempt}.parquet")
        return StagedAttempt(attempt)

    def commit(self, messages: list[StagedAttempt | None]) -> None:
        files, place = self._place()
        files.create_dir(place, recursive=True)
        attempts = [m.attempt for m in messages if m is not None]
        storage.put(files, f"{place}/open-commit", json.dumps(attempts).encode())
        files.move(f"{place}/open-commit", f"{place}/committed")

    def abort(self, messages: list[StagedAttempt | None]) -> None:
        files, place = self._place()
        if storage.fs.FileType.NotFound != files.get_file_info(place).type:
            files.delete_dir(place)


class StagedObjects(DataSource):
    """Sink of rows (key, body); options ``path`` and ``write``."""

    @classmethod
    def name(cls) -> str:
        return "staged_objects"

    def schema(self) -> str:
        return "object_key string, body string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], self.options["write"])


def stage_objects(rows: DataFrame, folder: str, key: str = "object_key", body: str = "body") -> str:
    """Write objects aside; the name of the write, for ``publish_objects``."""
    spark = rows.sparkSession
    spark.dataSource.register(StagedObjects)
    write = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    picked = rows.select(F.col(key).alias("object_key"), F.col(body).alias("body"))
    (
        picked.write.format("staged_objects")
        .mode("append")
        .option("path", folder)
        .option("write", write)
        .save()
    )
    return write


def publish_objects(spark: SparkSession, folder: str, write: str) -> DataFrame:
    """Move the objects of a committed write to their keys and return their receipts.

    An object replaces the one that had its key.  Of rows that repeat a key in one write the
    body with the largest sha256 stays.  Receipts (object_key, size, sha256, write) stay below
    ``_published``; a write that was published before gives its receipts again.
    """
    files, root = storage.opened(folder)
    place, receipts = f"{root}/{STAGED}/{write}", f"{folder.rstrip('/')}/{PUBLISHED}/write={write}"
    if files.get_file_info(f"{place}/committed").type == storage.fs.FileType.NotFound:
        if storage.names_in(files, f"{root}/{PUBLISHED}/write={write}", storage.fs.FileType.File):
            return _receipts(spark, folder).filter(F.col("write") == write)
        raise ValueError(f"write {write} was not committed")
    attempts = json.loads(storage.content(files, f"{place}/committed"))
    committed = spark.createDataFrame([(a,) for a in attempts], "attempt string")
    lists = f"{folder.rstrip('/')}/{STAGED}/{write}/lists"
    listed = spark.read.schema(
        "object_key string, size long, sha256 string, attempt string, number long"
    ).parquet(lists)
    ours = listed.join(committed, "attempt", "left_semi")
    winners = ours.groupBy("object_key").agg(
        F.max(F.struct("sha256", "attempt", "number", "size")).alias("w")
    ).select("object_key", "w.size", "w.sha256", "w.attempt", "w.number")

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = storage.opened(folder)
        made = None
        for batch in batches:
            for row in batch.to_pylist():
                staged = f"{root}/{STAGED}/{write}/objects/{row['attempt']}/{row['number']:09d}"
                target = f"{root}/{row['object_key']}"
                parent = target.rpartition("/")[0]
                if parent != made:
                    files.create_dir(parent, recursive=True)
                    made = parent
                storage.replace(files, staged, target)
            yield batch.select(["object_key", "size", "sha256"])

    moved = winners.mapInArrow(move, "object_key string, size long, sha256 string")
    moved.write.mode("overwrite").parquet(receipts)
    files.delete_dir(place)
    return _receipts(spark, folder).filter(F.col("write") == write)


def write_objects(rows: DataFrame, folder: str, key: str = "object_key", body: str = "body") -> DataFrame:
    """Write one object for each row and return the receipts; keys overwrite.

    A null body is an empty object; a null or empty key, or one that leaves the folder,
    refuses the whole write.
    """
    return publish_objects(rows.sparkSession, folder, stage_objects(rows, folder, key, body))


def _receipts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(RECEIPTS).parquet(f"{folder.rstrip('/')}/{PUBLISHED}")


def read_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Key and body (binary) of every object, as its last write left it.

    Keys come from the receipts, bodies from the objects themselves, read by many tasks.
    """
    keys = _receipts(spark, folder).select("object_key").distinct()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = storage.opened(folder)
        for batch in batches:
            for key in batch.column(0).to_pylist():
                body = storage.content(files, f"{root}/{key}")
                yield pa.record_batch({"object_key": [key], "body": pa.array([body], pa.binary())})

    return keys.mapInArrow(read, "object_key string, body binary")
