"""The three tables every record read produces, plus the rejected inputs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class RecordTables:
    """Records, states and logs of one read, each with its own running index.

    ``errors`` holds one row per rejected input and is ``None`` when the reader
    has nothing to reject.  A reader that meets all three kinds in one pass also
    gives them as one table, ``merged``: kind (record, state or log), index,
    stream, data, emitted_at, level and message.
    """

    records: DataFrame
    states: DataFrame
    logs: DataFrame
    errors: DataFrame | None = None
    merged: DataFrame | None = None
