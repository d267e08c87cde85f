"""Where chains of checkpoints begin, over resumed runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stored


def _closed(rows: DataFrame, cycle: Column) -> DataFrame:
    """Open rows that are on a cycle have no root and are not followed further."""
    on = F.coalesce(cycle, F.lit(False))
    return rows.select(
        "key",
        F.when(~on, F.col("to")).alias("to"),
        F.when(~on, F.col("steps")).alias("steps"),
        (F.col("open") & ~on).alias("open"),
        F.when(on, "cycle").otherwise(F.col("ancestry")).alias("ancestry"),
        "least",
    )


def checkpoint_ancestry(
    entries: DataFrame,
    key: str = "checkpoint_identity_key",
    parent: str = "parent_checkpoint_identity_key",
    resumed_from: str = "resumed_from_checkpoint_identity_key",
) -> DataFrame:
    """``key``, ``root``, ``depth`` and ``ancestry`` of every checkpoint.

    An entry follows the one before it in its run; the first of a resumed run follows the
    entry that the run was resumed from.  ``root`` is where the chain begins and ``depth``
    the steps to it.  ``ancestry`` is ``whole``, ``broken`` where the chain ends at an entry
    that names an unknown one (which is its root), or ``cycle`` (no root).  Rows that repeat
    a key count once, with the smallest key before them.

    Pointers are doubled: after a round every open entry points twice as far, so the rounds
    are the logarithm of the longest chain or cycle; every round is written.  An open entry
    keeps the smallest key of the steps that it has made.  The entry of a cycle that finds
    its own key there has been around; so have all that found the same, and what leads to
    them is closed as it points at them.
    """
    before = F.coalesce(F.col(parent), F.col(resumed_from))
    nodes = entries.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.min(before).alias("up"))
    known = nodes.select(F.col("key").alias("up"), F.lit(True).alias("there"))
    start = nodes.join(known, "up", "left").select(
        "key",
        F.when(F.col("there"), F.col("up")).otherwise(F.col("key")).alias("to"),
        F.coalesce("there", F.lit(False)).cast("long").alias("steps"),
        F.coalesce("there", F.lit(False)).alias("open"),
        F.when(F.col("up").isNull() | F.col("there"), "whole").otherwise("broken").alias("ancestry"),
        F.when(F.col("there"), F.col("up")).alias("least"),
    )
    current = stored(start)
    done = current.filter("NOT open")
    left = current.filter("open")
    while not left.isEmpty():
        ahead = current.select(
            F.col("key").alias("to"),
            F.col("to").alias("next"),
            F.col("steps").alias("more"),
            F.col("open").alias("still"),
            F.col("ancestry").alias("found"),
            F.col("least").alias("less"),
        )
        moved = stored(
            left.join(ahead, "to").select(
                "key",
                F.col("next").alias("to"),
                (F.col("steps") + F.col("more")).alias("steps"),
                F.col("still").alias("open"),
                F.col("found").alias("ancestry"),
                F.least("least", "less").alias("least"),
            )
        )
        around = moved.filter("open AND least = key").select("least", F.lit(True).alias("round"))
        if not around.isEmpty():
            moved = stored(_closed(moved.join(around, "least", "left"), F.col("open") & F.col("round")))
        done = done.union(moved.filter("NOT open"))
        left = moved.filter("open")
        # Finished entries are looked up by those that point at them.
        current = done.union(left)
    return done.select(
        F.col("key").alias(key),
        F.col("to").alias("root"),
        F.col("steps").alias("depth"),
        "ancestry",
    )
