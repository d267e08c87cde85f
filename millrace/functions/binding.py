"""Evaluating a costly expression once.

The optimizer copies an expression to every place that uses its column, filters
included.  That is free for cheap expressions and not for parsed documents.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def evaluate_once(
    df: DataFrame, keep: Sequence[str], computed: Mapping[str, Column]
) -> DataFrame:
    """Select ``keep`` and ``computed`` so that later filters use the computed values.

    The values go through a generator of one row, which filters cannot pass.
    """
    values = F.struct(*[c.alias(name) for name, c in computed.items()])
    return df.select(*keep, F.inline(F.array(values)))
