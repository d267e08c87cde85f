"""Evidence that arrives as a stream, matched with the actions that name it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_evidence(
    expected: DataFrame,
    present: DataFrame,
    ref: str = "evidence_ref",
    expected_at: str = "expected_at",
    present_at: str = "present_at",
    delay: str = "10 minutes",
    within: str = "1 hour",
) -> DataFrame:
    """Every expected reference with ``found``, once it is known.

    An outer join of two streams: evidence counts if its time lies within ``within`` of the
    action's, before or after.  A reference whose evidence came is given at once; one without
    when both watermarks (``delay`` behind the newest row) have passed the last moment for
    it, and then its state is dropped.  Repeated evidence repeats the row; drop duplicates of
    the key and the reference where that matters.
    """
    left = expected.withWatermark(expected_at, delay)
    right = present.select(
        F.col(ref).alias("__ref"), F.col(present_at).alias("__at")
    ).withWatermark("__at", delay)
    close = F.expr(
        f"__at BETWEEN {expected_at} - INTERVAL {within} AND {expected_at} + INTERVAL {within}"
    )
    joined = left.join(right, (F.col(ref) == F.col("__ref")) & close, "leftOuter")
    return joined.select(*expected.columns, F.col("__ref").isNotNull().alias("found"))
