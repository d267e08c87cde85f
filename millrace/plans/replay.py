"""Sending dead letters again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.deadletters import replay_apply, replay_select
from millrace.operators.delivery import build_payloads, evidence_from_stored
from millrace.session import cut_lineage


def replay_store(
    dlq: DataFrame,
    stored: DataFrame,
    out_root: str,
    send: Callable[[DataFrame], DataFrame],
    limit: int | None = None,
    dry_run: bool = False,
    move_done: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Rebuild the payloads of pending letters, send them and fold the receipts.

    ``stored`` has the stored artifacts by ``sha256``.  ``send`` turns payload rows
    into receipts (``name``, ``ok``); it has side effects, so its result is written
    once and read from there.
    """
    selected = cut_lineage(replay_select(dlq, limit))
    if dry_run:
        receipts = selected.select("name", F.lit(None).cast("boolean").alias("ok")).limit(0)
        return replay_apply(dlq, selected, receipts, move_done, dry_run=True)
    ready = selected.filter("valid").select(
        "name",
        "sha256",
        "run_id",
        "run_meta",
        F.get_json_object("run_meta", "$.engine.name").alias("engine_name"),
    )
    evidence = evidence_from_stored(stored)
    receipts = cut_lineage(send(build_payloads(ready, evidence, out_root)))
    return replay_apply(dlq, selected, receipts, move_done)
