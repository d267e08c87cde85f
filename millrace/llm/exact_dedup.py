"""Exact duplicates, combined in steps that no group of copies can overload.

1. Copies inside a partition are combined where they are read (the map side of the
   next step's aggregate).
2. The local winners of a text are dealt to tasks by digest and salt, and merged.  The
   salt is the partition they come from for *hot* digests and the same for all others.
   Hot is a digest with more than one in ``HOT_PARTS`` of all rows, so there are fewer
   than ``HOT_PARTS`` of them, and they are found by counting digests alone.
3. The salts' winners of hot digests, ``salts`` rows each at most, are merged by digest.

Every step groups by digest and by the whole normalised text, so texts are equal only
where their full content is.  Whole texts are moved once.  The winners are written
without their texts; the rows then find their winner by digest.  Should two texts ever
share a digest, the rows of that digest are joined once more by their whole text.

Null texts count as empty.  A null id is smaller than any other; a group whose ids are
all null keeps a null id.  Rows that repeat id and text are copies: one of them is kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import ascii_lower, drop_rows
from millrace.session import cut_lineage, stored

Digest = Callable[[Column], Column]


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def normalised(text: str) -> Column:
    return ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit("")))


#: A digest is hot above this part of all rows.
HOT_PARTS = 1000


def _contents(docs: DataFrame, id_column: str, text: str, digest: Digest) -> DataFrame:
    rows = docs.select(F.col(id_column).alias("id"), normalised(text).alias("content"))
    return rows.withColumn("digest", digest(F.col("content")))


def winners(
    docs: DataFrame, id_column: str, text: str, digest: Digest, salts: int
) -> DataFrame:
    """``digest``, ``keep_id`` and ``group_size`` of every different text, without the text."""
    counts = docs.select(digest(normalised(text)).alias("digest")).groupBy("digest").count()
    counts = stored(counts)
    rows = counts.agg(F.sum("count").alias("rows")).first().rows or 0
    hot = counts.filter(F.col("count") * HOT_PARTS > rows).filter("count > 1").select("digest")
    salt = F.when(F.col("hot"), 1 + F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(0)
    # Fewer than HOT_PARTS rows.
    marked = F.broadcast(hot.withColumn("hot", F.lit(True)))
    salted = stored(
        _contents(docs, id_column, text, digest)
        .join(marked, "digest", "left")
        .withColumn("salt", salt)
        .groupBy("digest", "salt", "content")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        .withColumn("content", F.when(F.col("salt") > 0, F.col("content")))
    )
    merged = (
        salted.filter("salt > 0")
        .groupBy("digest", "content")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )
    return salted.filter("salt = 0").select("digest", "keep_id", "group_size").unionByName(
        merged.drop("content")
    )


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    digest: Digest = sha256_hex,
    salts: int = 64,
) -> DataFrame:
    """One row per document: ``id_column``, ``keep_id``, ``group_size``, ``kept``, ``digest``."""
    classes = winners(docs, id_column, text, digest, salts)
    by_digest = cut_lineage(
        classes.groupBy("digest")
        .agg(
            F.count("*").alias("classes"),
            F.max("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size"),
        )
    )
    members = docs.select(
        F.col(id_column).alias("id"), digest(normalised(text)).alias("digest")
    )
    slim = members.groupBy("id", "digest").agg(F.count("*").alias("copies"))
    single = slim.join(by_digest.filter("classes = 1").drop("classes"), "digest")
    if not by_digest.filter("classes > 1").isEmpty():
        shared = by_digest.filter("classes > 1").select("digest")
        whole = (
            _contents(docs, id_column, text, digest)
            .join(shared, "digest", "left_semi")
            .groupBy("id", "digest", "content")
            .agg(F.count("*").alias("copies"))
        )
        kept = whole.groupBy("digest", "content").agg(
            F.max("id").alias("keep_id"), F.sum("copies").alias("group_size")
        )
        single = single.unionByName(whole.join(kept, ["digest", "content"]).drop("content"))
    numbered = single.select(
        "id",
        "digest",
        "keep_id",
        "group_size",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    )
    return numbered.select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "digest",
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every group of equal texts, that with the largest id."""
    groups = exact_groups(docs, id_column, text)
    touched = (
        groups.filter("group_size > 1")
        .groupBy(F.col(id_column).alias("id"), "digest")
        .agg(F.max("kept").alias("stays"), F.count("*").alias("n"))
        .filter("n > 1 or not stays")
        .drop("n")
    )
    keys = {"id": F.col(f"`{id_column}`"), "digest": sha256_hex(normalised(text))}
    return drop_rows(docs, keys, touched)
