"""Connected components of a table of links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage


def _with_smallest(links: DataFrame, both: bool) -> DataFrame:
    """Each link's larger end ``u`` ... pointed at the smallest neighbour of ``u``."""
    ends = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        ends = ends.union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    lowest = ends.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return ends.join(lowest, "u")


def _ordered(links: DataFrame) -> DataFrame:
    return (
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def connect(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of all linked nodes.

    ``links`` has two comparable columns ``a`` and ``b``; loops and repeats do no
    harm.  Large-star links every larger neighbour of a node to the node's smallest
    neighbour, small-star does the same with the smaller ones; they alternate until
    nothing changes, which takes about as many rounds as the logarithm of the
    longest path.  A round is two joins on the node with a minimum that is combined
    before the shuffle, so a node with very many links is never gathered in one
    group.  Each round is written to the checkpoint folder, and only a count and a
    sum of hashes come to the driver.
    """
    current = cut_lineage(_ordered(links))
    before = None
    while True:
        large = _with_smallest(current, both=True).filter("v > u")
        current = _ordered(large.select(F.col("v").alias("a"), F.col("m").alias("b")))
        small = _with_smallest(current, both=False)
        stars = small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            small.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        current = cut_lineage(_ordered(stars))
        state = current.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s"),
        ).first()
        if state == before:
            break
        before = state
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
