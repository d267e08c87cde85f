"""Small helpers on whole rows of documents."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stored

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, every other character as it is."""
    return F.when(
        text.rlike("[^\\x00-\\x7F]"), F.translate(text, _CAPITALS, _CAPITALS.lower())
    ).otherwise(F.lower(text))


def quoted(name: str) -> str:
    """A column's name as it is written in an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def free_prefix(columns: Iterable[str]) -> str:
    """Underscores that no column begins with, for columns that are added for a while."""
    prefix = "__"
    while any(c.startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def drop_rows(
    docs: DataFrame, keys: Mapping[str, Column], touched: DataFrame, few: bool = False
) -> DataFrame:
    """The rows of ``docs`` that ``touched`` lets stay, with the columns of ``docs``.

    ``keys`` are expressions on ``docs``.  ``touched`` has a column for each of their
    names and ``stays``: rows whose key is marked false go, of those marked true one
    stays, and rows whose key is not in it stay.  Null keys match.  ``touched`` names
    only what is to be changed.  With ``few`` it is expected to be small against ``docs``
    and Spark broadcasts it below its size limit; otherwise both sides are merged by key
    at every size.  Columns of ``docs`` may have any names.
    """
    own = free_prefix(docs.columns)
    columns = [F.col(f"{own}docs.{quoted(c)}").alias(c) for c in docs.columns]
    keyed = docs.select("*", *[c.alias(f"{own}k_{n}") for n, c in keys.items()]).alias(f"{own}docs")
    other = stored(
        touched.select(
            *[F.col(n).alias(f"{own}t_{n}") for n in keys], F.col("stays").alias(f"{own}stays")
        )
    )
    if not few:
        other = other.hint("merge")
    same = [F.col(f"{own}k_{n}").eqNullSafe(F.col(f"{own}t_{n}")) for n in keys]
    untouched = keyed.join(other, same, "left_anti").select(*columns)
    repeated = keyed.join(other.filter(F.col(f"{own}stays")), same, "left_semi")
    order = [
        F.col(quoted(c)) for c, kind in docs.dtypes if "map" not in kind and "variant" not in kind
    ]
    names = [F.col(f"{own}k_{n}") for n in keys]
    first = Window.partitionBy(*names).orderBy(*(order or names))
    one = (
        repeated.withColumn(f"{own}n", F.row_number().over(first))
        .filter(F.col(f"{own}n") == 1)
        .select(*[F.col(quoted(c)) for c in docs.columns])
    )
    return untouched.union(one)
