"""Sharding by sampled splitters, with sizes near equal.

Records are ordered by the digest of their text, so that equal texts are neighbours,
and then by id.  A size-weighted sample of these keys gives quantile boundaries, which
cut the order into ranges; ranges with too many rows are subdivided by a sample of
their own.  Prefix sums over the ranges, and inside each range, give every record its
exact place in the order and in the bytes, and with them its shard and slot.

A group of equal texts stays in one shard.  Small groups do so by their place in the order:
a boundary never falls inside them.  Groups with more than ``1 / GROUP_PARTS`` of a shard's
bytes, or with so many rows that a sample meets them, are *large*.  They are laid into the
emptiest shards first, the largest first, and the ordered rest fills what is left.  A large
group that no longer fits a shard's share, and so could only stay whole by making a shard
too big, is cut: its records take their places in the order one by one.  The rows of large
groups are subdivided by id, so that no task holds a whole one.

Only keys, sizes and ids are moved.  The driver gets the first sample (about
``RANGES * OVERSAMPLE`` keys by size and as many by rows, at any size), the sums of the large
groups among them, and a few numbers for each shard.

A null text has no bytes (size 1).  Null ids come first in their group; records that
agree in text and id are interchangeable.  No rows give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.rows import quoted
from millrace.session import cut_lineage

RANGES = 256
OVERSAMPLE = 64
GROUP_PARTS = 100
#: Draws of one text that make it worth summing up its group.
LARGE_DRAWS = 4


def _key(id_column: Column, integral: bool) -> Column:
    """Text that sorts like (digest, id); a null id comes first."""
    if integral:
        flipped = id_column.cast("long").bitwiseXOR(F.lit(-(1 << 63)))
        tail = F.lpad(F.hex(flipped), 16, "0")
    else:
        tail = id_column.cast("string")
    return F.concat("digest", F.coalesce(tail, F.lit("")))


def _slim(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).cast("binary")
    integral = dict(docs.dtypes)[id_column] in ("tinyint", "smallint", "int", "bigint")
    return docs.select(
        F.col(quoted(id_column)).alias("id"),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(whole).alias("text_crc32"),
        F.md5(whole).alias("digest"),
    ).withColumn("key", _key(F.col("id"), integral))


def _chance(*of: str) -> Column:
    return F.pmod(F.xxhash64(*of), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _draws(rate: Column) -> Column:
    """Times a record is drawn: its size times the rate, rounded up or down by a hash."""
    return F.floor(F.col("size") * rate + _chance("key", "size"))


def _splitter(large: list[str]) -> Column:
    """A boundary inside a large group names a record, any other the group's begin."""
    inside = F.col("digest").isin(large) if large else F.lit(False)
    return F.when(inside, F.col("key")).otherwise(F.col("digest"))


def _not_above(splitters: Column) -> Column:
    """Number of ``splitters`` (an ascending array) that are not above the key."""
    return F.size(F.filter(splitters, lambda s: s <= F.col("key")))


def _place_among(bounds: list, value: Column, kind: str) -> Column:
    """Number of ``bounds`` (ascending) that are not above ``value``, in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(2, math.isqrt(len(bounds)))

    def listed(values: list) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")

    def not_above(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= value))

    fine = F.array(*[listed(bounds[i : i + step - 1]) for i in range(0, len(bounds) + 1, step)])
    group = not_above(listed(bounds[step - 1 :: step]))
    return group * step + not_above(F.get(fine, group))


def _subdivide(ranged: DataFrame, summary: DataFrame, large: list[str], limit: int) -> DataFrame:
    """Add ``sub``, the number of the part inside ranges with more than ``limit`` rows.

    Parts have about as many rows, so records are drawn without regard to their size.
    """
    overfull = summary.filter(F.col("rows") > limit).select(
        "range",
        F.ceil(F.col("rows") / limit).alias("parts"),
        (F.ceil(F.col("rows") / limit) * OVERSAMPLE / F.col("rows")).alias("rate"),
    )
    sampled = (
        ranged.join(overfull, "range")
        .filter(_chance("key", "size") < F.col("rate"))
        .select("range", "parts", _splitter(large).alias("at"))
        .groupBy("range")
        .agg(F.max("parts").alias("parts"), F.sort_array(F.collect_list("at")).alias("keys"))
    )
    cuts = sampled.select(
        "range",
        F.array_distinct(
            F.transform(
                F.sequence(F.lit(1), F.col("parts") - 1),
                lambda i: F.get("keys", F.floor(i * F.size("keys") / F.col("parts")).cast("int")),
            )
        ).alias("cuts"),
    )
    return ranged.join(cuts, "range", "left").withColumn(
        "sub", F.when(F.col("cuts").isNotNull(), _not_above(F.col("cuts"))).otherwise(0)
    ).drop("cuts")


def assign_shards(
    docs: DataFrame,
    shards: int,
    id_column: str = "doc_id",
    text: str = "text",
    range_limit: int = 250_000,
) -> DataFrame:
    """One row per document: ``id_column``, ``size``, ``text_crc32``, ``shard``, ``slot``.

    ``shard`` runs from 0 to ``shards - 1`` and ``slot`` from 0 without gaps in each.
    """
    slim = cut_lineage(_slim(docs, id_column, text))
    total = slim.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    whole, drawn_keys = total.bytes or 1, RANGES * OVERSAMPLE
    share = whole / shards

    by_size = F.least(_draws(F.lit(drawn_keys / whole)), F.lit(drawn_keys))
    by_row = (_chance("size", "key") < drawn_keys / max(1, total.rows)).cast("int")
    drawn = (
        slim.withColumns({"times": by_size, "met": by_row})
        .filter("times > 0 OR met > 0")
        .select("digest", "key", "times", "met")
        .collect()
    )
    sized, met = Counter(), Counter()
    for row in drawn:
        sized[row.digest] += row.times
        met[row.digest] += row.met
    often = [d for d in sized if sized[d] >= LARGE_DRAWS or met[d] >= LARGE_DRAWS]
    large = {
        r.digest: r.bytes
        for r in slim.filter(F.col("digest").isin(often))
        .groupBy("digest")
        .agg(F.sum("size").alias("bytes"))
        .collect()
        if r.bytes * GROUP_PARTS > share or met[r.digest] >= LARGE_DRAWS
    } if often else {}
    laid, rooms = _lay_groups(large, share, shards)
    names = sorted(large)
    points = sorted(
        (row.key if row.digest in large else row.digest) for row in drawn for _ in range(row.times)
    )
    chosen = sorted({points[i * len(points) // RANGES] for i in range(1, RANGES)} if points else ())

    ranged = slim.withColumn("range", _place_among(chosen, F.col("key"), "string"))
    counted = ranged.groupBy("range").agg(F.count("*").alias("rows"))
    parts = _subdivide(ranged, counted, names, range_limit)
    # Records of groups that are laid elsewhere take no place in the ordered rest.
    is_laid = F.col("digest").isin(sorted(laid)) if laid else F.lit(False)
    parts = parts.withColumn("laid", is_laid).withColumns(
        {
            "own": F.when(F.col("laid"), 0).otherwise(F.col("size")).cast("long"),
            "one": F.when(F.col("laid"), 0).otherwise(1).cast("long"),
        }
    )
    summary = parts.groupBy("range", "sub").agg(
        F.sum("own").alias("bytes"), F.sum("one").alias("ones"), F.count("*").alias("rows")
    )
    # One row for each range, so a few thousand at most here.
    before = Window.orderBy("range", "sub").rowsBetween(Window.unboundedPreceding, -1)
    placed = summary.select(
        "range",
        "sub",
        *[
            F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before")
            for c in ("bytes", "ones", "rows")
        ],
    )
    inside = Window.partitionBy("range", "sub").orderBy("digest", "key")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("range", "sub", "digest")
    begin = F.col("bytes_before") + F.coalesce(F.sum("own").over(earlier), F.lit(0))
    ones = F.col("ones_before") + F.coalesce(F.sum("one").over(earlier), F.lit(0))
    rows_before = F.col("rows_before") + F.row_number().over(inside) - 1
    cut = [d for d in names if d not in laid]
    is_cut = F.col("digest").isin(cut) if cut else F.lit(False)
    # Twice the middle of what moves as one: the record, or its group of equal texts.
    twice = F.when(is_cut, 2 * F.col("begin") + F.col("own")).otherwise(
        2 * F.min("begin").over(group) + F.sum("own").over(group)
    )
    bounds = [2 * room for room in accumulate(rooms[:-1])]
    ordered = cut_lineage(
        parts.join(placed, ["range", "sub"])
        .withColumns({"begin": begin, "ones": ones, "rows": rows_before})
        .withColumn("middle", twice.cast("double"))
        .withColumn("number", _place_among(bounds, F.col("middle"), "double").cast("int"))
        .select(
            "id",
            "size",
            "text_crc32",
            F.when(F.col("laid"), F.col("digest")).alias("laid"),
            F.when(~F.col("laid"), F.col("number")).alias("shard"),
            # The place among records of the same kind: ordered ones, or those laid.
            F.when(F.col("laid"), F.col("rows") - F.col("ones")).otherwise(F.col("ones")).alias("place"),
        )
    )
    # A row for each shard and each group that is laid.
    firsts_and_counts = (F.min("place").alias("place"), F.count("*").alias("rows"))
    kept = ordered.groupBy("shard", "laid").agg(*firsts_and_counts).collect()
    filled = {r.shard: r.rows for r in kept if r.laid is None}
    firsts = {r.shard: r.place for r in kept if r.laid is None}
    # By the name of a group that is laid (32 digits), or the number of a shard.
    shifts = [(str(s), s, -firsts.get(s, 0)) for s in range(shards)]
    for r in sorted((r for r in kept if r.laid is not None), key=lambda r: r.laid):
        shard = laid[r.laid]
        shifts.append((r.laid, shard, filled.get(shard, 0) - r.place))
        filled[shard] = filled.get(shard, 0) + r.rows
    named = F.array(
        *[
            F.struct(
                F.lit(name).alias("of"), F.lit(to).alias("to"), F.lit(n).cast("long").alias("shift")
            )
            for name, to, n in shifts
        ]
    )
    moves = slim.sparkSession.range(1).select(F.inline(named))
    return (
        ordered.withColumn("of", F.coalesce("laid", F.col("shard").cast("string")))
        .join(moves, "of")
        .select(
            F.col("id").alias(id_column),
            "size",
            "text_crc32",
            F.col("to").alias("shard"),
            (F.col("place") + F.col("shift")).alias("slot"),
        )
    )


def _lay_groups(
    large: dict[str, int], share: float, shards: int
) -> tuple[dict[str, int], list[float]]:
    """The shard of every large group that fits one, and the room that is left in each.

    The largest group goes first into the emptiest shard (of equal ones the first), if
    the shard then holds at most its share, give or take ``1 / GROUP_PARTS``.
    """
    laid: dict[str, int] = {}
    used = [0.0] * shards
    for digest in sorted(large, key=lambda d: (-large[d], d)):
        emptiest = min(range(shards), key=lambda s: (used[s], s))
        if used[emptiest] + large[digest] <= share * (1 + 1 / GROUP_PARTS):
            laid[digest] = emptiest
            used[emptiest] += large[digest]
    rooms = [max(0.0, share - u) for u in used]
    rest = share * shards - sum(used)
    scale = rest / sum(rooms) if sum(rooms) else 0.0
    return laid, [room * scale for room in rooms]
