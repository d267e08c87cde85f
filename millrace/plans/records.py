"""Record ingest: elements, checkpoints and resume of one or many reads."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from millrace.operators.checkpoints import build_checkpoints, resume_filter
from millrace.operators.elements import elements_from_records
from millrace.sources.tables import RecordTables


@dataclass(frozen=True)
class RecordIngest:
    tables: RecordTables
    elements: DataFrame
    checkpoints: DataFrame


def ingest_records(tables: RecordTables, tasks: DataFrame, keys: Sequence[str]) -> RecordIngest:
    """Elements and checkpoints of a read; ``tasks`` names the work each key belongs to."""
    return RecordIngest(
        tables=tables,
        elements=elements_from_records(tables, keys),
        checkpoints=build_checkpoints(tables.records, tables.states, tasks, keys),
    )


def resume_records(
    tables: RecordTables, selection: DataFrame, tasks: DataFrame, keys: Sequence[str]
) -> tuple[RecordIngest, DataFrame]:
    """The same ingest after a selected checkpoint, and the requests that are blocked."""
    records, states, blocked = resume_filter(tables.records, tables.states, selection, keys)
    no_logs = tables.logs.limit(0)
    resumed = RecordTables(records=records, states=states, logs=no_logs)
    return ingest_records(resumed, tasks, keys), blocked
