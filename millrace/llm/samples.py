"""The fixed split of labelled documents and bounded samples for training."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stored

FOLDS = 5


def held_out(id_column: str) -> Column:
    """True where crc32 of the id as text leaves no remainder; a null id is not held out."""
    text = F.col(id_column).cast("string").cast("binary")
    return F.coalesce(F.crc32(text) % FOLDS == 0, F.lit(False))


_HASHES = 1 << 62


def training_sample(labelled: DataFrame, id_column: str, label: str, per_class: int) -> DataFrame:
    """At most ``per_class`` ids of each label, by the order of a hash of the id.

    ``labelled`` has the columns ``id_column`` and ``label`` only, so no text is moved.
    Different ids are counted by label first.  Only hashes below the share that gives
    somewhat more than ``per_class`` ids are ranked, so no task ranks a whole label.
    Held-out ids, null ids and null labels are left out, and an id counts once, however
    many rows repeat it.
    """
    rows = (
        labelled.filter(
            F.col(id_column).isNotNull() & F.col(label).isNotNull() & ~held_out(id_column)
        )
        .select(id_column, label)
        .withColumn("order", F.pmod(F.xxhash64(id_column), F.lit(_HASHES)))
    )
    wanted = per_class + 6 * math.sqrt(per_class) + 20
    ids = rows.select(id_column, label).distinct()
    counts = stored(ids.groupBy(label).agg((F.lit(wanted) / F.count("*")).alias("share")))
    few = rows.join(counts, label).filter(F.col("order") < F.col("share") * _HASHES).distinct()
    first = Window.partitionBy(label).orderBy("order", id_column)
    return (
        few.withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= per_class)
        .groupBy(id_column)
        .agg(F.max(label).alias(label), F.min("order").alias("order"))
    )


def one_text(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row for each value of ``keys``: of repeated rows the text of the least digest.

    A null text stays only where there is no other.
    """
    value = F.col(text)
    least = F.struct(value.isNull(), F.md5(value), value.alias("text"))
    return rows.groupBy(*keys).agg(F.min(least)["text"].alias(text))
