"""Ordered work over groups of any size.

A window over one large group runs in one task.  The functions here cut every
group into *slices* along the order, summarise each slice with a grouped
aggregate, combine the summaries (a table of one row per group and slice) and
give every row the part that came before its slice.  Only rows of one slice ever
meet in one task.

``slice_by`` is a column that never decreases along the order and whose slices
are known to be small, such as ``key div 1000000`` for a unique integer key.
Without it the rows are counted, range-partitioned on the full order into slices of about
``ROWS_PER_SLICE`` rows and written once with the partition number, which is the slice.
``order`` should be a total order: rows that agree in it stay in one slice.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stored

SLICE = "__slice"
ROWS_PER_SLICE = 1_000_000


def sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_by: Column | None
) -> DataFrame:
    if slice_by is not None:
        return df.withColumn(SLICE, slice_by)
    slices = max(1, math.ceil(df.count() / ROWS_PER_SLICE))
    ranged = df.repartitionByRange(slices, *[F.col(c) for c in (*keys, *order)])
    return stored(ranged.withColumn(SLICE, F.spark_partition_id()))


def _join_slices(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe join of rows with one summary row per group and slice."""
    on = [*keys, SLICE]
    renamed = summary.select(
        *[F.col(c).alias(f"__s_{c}") for c in on],
        *[F.col(c) for c in summary.columns if c not in on],
    )
    matched = [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in on]
    return rows.join(renamed, matched, "left").drop(*[f"__s_{c}" for c in on])


def group_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    slice_by: Column | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in its group."""
    rows = sliced(df, keys, order, slice_by)
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    summary = (
        rows.groupBy(*keys, SLICE)
        .agg(F.count(F.lit(1)).alias("__o_n"))
        .withColumn("__o_before", F.coalesce(F.sum("__o_n").over(before), F.lit(0)))
        .drop("__o_n")
    )
    local = Window.partitionBy(*keys, SLICE).orderBy(*order)
    return (
        _join_slices(rows, summary, keys)
        .withColumn(out, F.col("__o_before") + F.row_number().over(local) - 1)
        .drop("__o_before", SLICE)
    )


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    slice_by: Column | None = None,
    first: Column | None = None,
) -> DataFrame:
    """Add the value of the row before in the group; ``first`` for the first row."""
    rows = sliced(df, keys, order, slice_by)
    at_end = F.max(F.struct(*[F.col(c) for c in order], F.col(value).alias("__v")))
    behind = Window.partitionBy(*keys).orderBy(SLICE)
    summary = (
        rows.groupBy(*keys, SLICE)
        .agg(at_end.alias("__o_last"))
        .withColumn("__o_has", F.row_number().over(behind) > 1)
        .withColumn("__o_carry", F.lag("__o_last").over(behind)["__v"])
        .drop("__o_last")
    )
    local = Window.partitionBy(*keys, SLICE).orderBy(*order)
    start = first if first is not None else F.lit(None)
    return (
        _join_slices(rows, summary, keys)
        .withColumn(
            out,
            F.when(F.row_number().over(local) > 1, F.lag(value).over(local))
            .when(F.col("__o_has"), F.col("__o_carry"))
            .otherwise(start),
        )
        .drop("__o_has", "__o_carry", SLICE)
    )


def sum_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    slice_by: Column | None = None,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add the sum of ``value`` over the rows before this one in the group.

    ``totals`` names columns to add and the columns whose sum over the whole group they
    get; they come from the same slice summaries.
    """
    rows = sliced(df, keys, order, slice_by)
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*keys)
    summary = (
        rows.groupBy(*keys, SLICE)
        .agg(
            F.sum(value).alias("__o_n"),
            *[F.sum(c).alias(f"__o_t_{name}") for name, c in (totals or {}).items()],
        )
        .withColumn("__o_before", F.coalesce(F.sum("__o_n").over(before), F.lit(0)))
        .withColumns(
            {name: F.coalesce(F.sum(f"__o_t_{name}").over(group), F.lit(0)) for name in totals or {}}
        )
        .drop("__o_n", *[f"__o_t_{name}" for name in totals or {}])
    )
    local = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        _join_slices(rows, summary, keys)
        .withColumn(out, F.col("__o_before") + F.coalesce(F.sum(value).over(local), F.lit(0)))
        .drop("__o_before", SLICE)
    )
