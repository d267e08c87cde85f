"""Mixing sources to target weights.

Every document gets a hash-random key.  Each source is put in the order of the keys
and taken up to its target number of words: whole epochs first, then the documents up
to the place where the running number of words reaches the rest of the target, where
the last document is cut at the exact word.

The order is cut into slices by the leading digits of the key, as many as keep a slice at
about ``SLICE_ROWS`` rows.  Words are summed by source and slice (combined before the
shuffle); a running sum over a source's slices finds the one slice that the cut falls
in.  All other documents are decided from their slice alone, where they are read.  Of the
cut slices the documents are written once and their equal keys counted; only the counts are
sorted, and the documents take their places from them.

Targets: sources in code point order, null last, have the given weights in turn and
share the words of the whole corpus.  No target is above ``most`` times its source's
size; what is cut off goes to the other sources by weight until none is above.

Size is the number of words (``[^\\x20\\x09-\\x0D]+``) of the whole text; null has none.
Documents without words are never taken.  Equal keys are ordered by id and then by size;
rows that also agree in these are interchangeable.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut_lineage, stored

WORD = "[^\\x20\\x09-\\x0D]+"
#: Most rows of a slice, about, digits of a slice's name at least, and parts in which the
#: rows of one key are counted.
SLICE_ROWS, LEAST_DIGITS, SALTS = 250_000, 3, 256
MADE = ("size", "source_size", "target", "epochs", "part")


def _text(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Adds ``target`` to a table of ``source`` and ``source_size``.

    Sources are filled in the order in which they reach their limit, which needs one
    ordered pass over the table of sources (one row each, whatever their documents).
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    numbered = (
        sizes.withColumn("place", place)
        .withColumn(
            "weight",
            F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("place") % len(weights)),
        )
        .withColumn("limit", F.col("source_size") * F.lit(float(most)))
    )
    filling = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(
        F.sum("limit").over(before), F.lit(0.0)
    )
    level = left / F.sum("weight").over(onward)
    free = F.col("level") * F.col("weight") < F.col("limit")
    return (
        numbered.withColumn("level", level)
        .withColumn("common", F.max(F.when(free, F.col("level"))).over(everything))
        .withColumn(
            "target",
            F.when(free, F.col("common") * F.col("weight")).otherwise(F.col("limit")),
        )
        .select("source", "source_size", "target")
    )


def _taken(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    most: float = 3.0,
    seed: int = 0,
) -> DataFrame:
    """Each document in ``__doc`` and what the mix takes of it."""
    name = F.concat_ws(
        ":", F.lit(str(seed)), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")),
        F.md5(_text(text).cast("binary")),
    )
    digits = max(LEAST_DIGITS, math.ceil(math.log(max(1, docs.count() / SLICE_ROWS), 16)))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"),
        F.col(f"`{source}`").cast("string").alias("__source"),
        F.md5(name.cast("binary")).alias("__key"),
    ).withColumn("__slice", F.substring("__key", 1, digits))
    words = F.regexp_count(_text(text), F.lit(WORD)).cast("long")
    sums = cut_lineage(
        docs.select(
            F.col(f"`{source}`").cast("string").alias("source"),
            F.substring(F.md5(name.cast("binary")), 1, digits).alias("slice"),
            words.alias("size"),
        )
        .groupBy("source", "slice")
        .agg(F.sum("size").alias("words"))
    )
    sizes = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    aims = targets(sizes, weights, most).withColumn("budget", F.round("target").cast("long"))
    filled = F.col("source_size") > 0
    aims = aims.withColumn(
        "epochs", F.when(filled, F.expr("budget div source_size")).otherwise(F.lit(0))
    ).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    before = (
        Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    running = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    reached = (
        running.join(
            aims.select(F.col("source").alias("of"), "rest"),
            F.col("source").eqNullSafe(F.col("of")),
        )
        .filter("before < rest")
        .groupBy("of")
        .agg(F.max(F.struct("slice", "before")).alias("cut"))
    )
    # Written as a file of known size, so that a small table of sources is broadcast and
    # the documents stay where they are.
    cuts = stored(
        aims.join(reached, F.col("source").eqNullSafe(F.col("of")), "left").select(
            F.col("source").alias("__of"),
            "source_size",
            "target",
            "epochs",
            F.col("rest").alias("__rest"),
            F.coalesce("cut.slice", F.lit("")).alias("__cut"),
            F.coalesce("cut.before", F.lit(0)).alias("__before"),
        )
    )
    placed = keyed.join(cuts, F.col("__source").eqNullSafe(F.col("__of")))
    size = F.regexp_count(
        F.coalesce(F.col(f"__doc.`{text}`").cast("string"), F.lit("")), F.lit(WORD)
    ).cast("long")
    decided = (
        placed.filter("__slice <> __cut")
        .withColumn("size", size)
        .withColumn("part", F.when(F.expr("__slice < __cut"), F.col("size")).otherwise(F.lit(0)))
    )
    # Written, so that a row keeps its salt.
    in_cut = stored(
        placed.filter("__slice = __cut")
        .withColumn("size", size)
        .withColumns(
            {
                "__id": F.col(f"__doc.`{id_column}`"),
                "__salt": F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)),
            }
        )
    )
    place = ["__of", "__key", "__id", "size", "__salt"]
    counted = in_cut.groupBy(*place).agg(F.count("*").alias("__n"))
    order = (
        Window.partitionBy("__of")
        .orderBy(*place[1:])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    running = counted.withColumn(
        "__sum", F.coalesce(F.sum(F.col("__n") * F.col("size")).over(order), F.lit(0))
    ).select(*[F.col(c).alias(f"__c{c}") for c in place], "__sum")
    # Rows that agree in all of these are interchangeable.
    copy = F.row_number().over(Window.partitionBy(*place).orderBy(F.lit(0))) - 1
    left = F.col("__rest") - F.col("__before") - F.col("__sum") - F.col("__copy") * F.col("size")
    sorted_part = (
        in_cut.withColumn("__copy", copy)
        .join(running, [F.col(c).eqNullSafe(F.col(f"__c{c}")) for c in place])
        .withColumn("part", F.greatest(F.lit(0), F.least("size", left)))
    )
    out = ["__doc", *MADE[:-1], F.col("part").cast("long")]
    return decided.select(*out).union(sorted_part.select(*out))


def take(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``epochs`` and ``part``.

    A document is taken ``epochs`` times whole, and once more for its first ``part``
    words.  Columns of ``docs`` with one of these names give way to them.
    """
    columns = [F.col(f"__doc.`{c}`").alias(c) for c in docs.columns if c not in MADE]
    return _taken(docs, **options).select(*columns, *MADE)


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: a row for every time a document is taken, columns as in ``docs``.

    A document's last, partial taking holds its first ``part`` words, with the space
    between them as it was.
    """
    taken = _taken(docs, text=text, **options)
    partial = (F.col("part") > 0).cast("int")
    copies = F.sequence(F.lit(1), (F.col("epochs") + partial).cast("int"))
    rows = taken.filter((F.col("epochs") + partial > 0) & (F.col("size") > 0)).withColumn(
        "__copy", F.explode(copies)
    )
    whole = F.col(f"__doc.`{text}`")
    ends = F.split(whole, "(?<=[^\\x20\\x09-\\x0D])(?=[\\x20\\x09-\\x0D])")
    head = F.array_join(F.slice(ends, 1, F.col("part").cast("int")), "")
    cut = (F.col("__copy") > F.col("epochs")) & (F.col("part") < F.col("size"))
    return rows.select(
        *[
            F.when(cut, head).otherwise(whole).alias(c)
            if c == text
            else F.col(f"__doc.`{c}`").alias(c)
            for c in docs.columns
        ]
    )
