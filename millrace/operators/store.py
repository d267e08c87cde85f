"""Artifact tables kept by content.

A table lies in folders ``bucket=b<first digits of the sha>/batch=n<name>``.  A batch
replaces only its own folders, so a job that is run again leaves the same rows; readers
take the newest batch of each sha, which gives replace-per-sha.  A sha leads to its bucket,
so a reader that asks for some shas lists and reads their buckets only.  In a file the rows
are sorted by sha and the sha has a Bloom filter, so a filter on single shas skips what does
not hold them.

Every batch adds a folder to the buckets that it touches.  ``compact_keyed`` makes one
batch of the older ones, so a bucket has a bounded number of them and reading it costs no
more after many batches than after few.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import file_system, stored

#: Hexadecimal digits of a new table's buckets: 16 buckets.  Each digit more makes sixteen
#: times as many; a bucket's batch should still fill a file.
DIGITS = 1
#: Batches of a bucket that are left apart.
APART = 8
#: Texts and their elements are written once a batch and are most of what a sink writes.
CODEC = "zstd"
_NO_SHA = "bnone"


def _root(path: str, table: str) -> str:
    return f"{path.rstrip('/')}/{table}"


def _bucket(sha: Column, digits: int) -> Column:
    return F.coalesce(F.concat(F.lit("b"), F.substring(sha, 1, digits)), F.lit(_NO_SHA))


def _layout(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Names of the batches of every bucket, ascending; folder names only."""
    files, path = file_system(spark, f"{root}/bucket=*/batch=*")
    found: dict[str, list[str]] = {}
    for status in files.globStatus(path) or []:
        bucket, batch = status.getPath().toString().rsplit("/", 2)[1:]
        found.setdefault(bucket.removeprefix("bucket="), []).append(batch.removeprefix("batch=n"))
    return {bucket: sorted(batches) for bucket, batches in found.items()}


def _digits(layout: Mapping[str, object], wanted: int = DIGITS) -> int:
    """Digits of an existing table's buckets, or the wanted ones of a new table."""
    return next((len(b) - 1 for b in layout if b != _NO_SHA), wanted)


def _rows(spark: SparkSession, root: str, layout: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows of the given buckets and batches, with the name of their batch."""
    paths = [f"{root}/bucket={b}/batch=n{n}" for b, names in layout.items() for n in names]
    rows = spark.read.option("basePath", root).parquet(*paths)
    return rows.withColumn("batch", F.substring(F.col("batch"), 2, 1 << 20))


def _asked_buckets(asked: DataFrame | Sequence[str], sha: str, digits: int) -> set[str]:
    """Buckets of the shas that are asked for: as many names as there are buckets at most."""
    if isinstance(asked, DataFrame):
        found = asked.select(_bucket(F.col(sha), digits).alias("b")).distinct().collect()
        return {r.b for r in found}
    return {f"b{s[:digits]}" for s in asked}


def _only(rows: DataFrame, asked: DataFrame | Sequence[str], sha: str) -> DataFrame:
    if isinstance(asked, DataFrame):
        return rows.join(asked.select(sha).distinct(), sha, "left_semi")
    return rows.filter(F.col(sha).isin(*asked))


def deal_keyed(df: DataFrame, sha: str = "sha256", digits: int = DIGITS) -> DataFrame:
    """Rows dealt to tasks as files of buckets are written: rows of a bucket in few tasks."""
    # A bucket may be written by several tasks; Spark puts small ones together.
    return df.repartition(F.coalesce(F.substring(F.col(sha), 1, digits + 1), F.lit(_NO_SHA)))


def write_keyed(
    df: DataFrame,
    path: str,
    table: str,
    batch: str,
    sha: str = "sha256",
    digits: int = DIGITS,
    dealt: bool = False,
) -> None:
    """Write the rows of a batch into their buckets; a batch of the same name is replaced
    there.  A table keeps the number of digits that it began with.

    Rows that were ``dealt`` (``deal_keyed``) are not moved again; others said to be so only
    make more files.
    """
    root = _root(path, table)
    digits = _digits(_layout(df.sparkSession, root), digits)
    placed = df if dealt else deal_keyed(df, sha, digits)
    keyed = placed.withColumns({"bucket": _bucket(F.col(sha), digits), "batch": F.lit(f"n{batch}")})
    (
        keyed.sortWithinPartitions("bucket", "batch", sha)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .option(f"parquet.bloom.filter.enabled#{sha}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .partitionBy("bucket", "batch")
        .parquet(root)
    )


def _newest(rows: DataFrame, sha: str) -> DataFrame:
    """Rows of the newest batch of each sha.

    Contents that a later batch replaced are few, so the rows are filtered by a small table
    and are not moved.
    """
    batches = rows.groupBy(sha, "batch").agg(F.count(F.lit(1)).alias("__n"))
    replaced = (
        batches.withColumn("__newest", F.max("batch").over(Window.partitionBy(sha)))
        .filter(F.col("batch") < F.col("__newest"))
        .select(sha, "batch")
    )
    return rows.join(stored(replaced), [sha, "batch"], "left_anti")


def read_keyed(
    spark: SparkSession,
    path: str,
    table: str,
    asked: DataFrame | Sequence[str] | None = None,
    sha: str = "sha256",
) -> DataFrame:
    """The newest stored rows of each sha, or of the shas in ``asked``.

    Only the buckets of these shas are listed and read, and shas are grouped only in buckets
    of more than one batch.
    """
    root = _root(path, table)
    layout = _layout(spark, root)
    if not layout:
        spark.read.parquet(root)  # says what is missing
    if asked is None:
        wanted = layout
    else:
        buckets = _asked_buckets(asked, sha, _digits(layout))
        # Where no bucket is there, an existing one gives the columns.
        wanted = {b: n for b, n in layout.items() if b in buckets} or dict([next(iter(layout.items()))])
    single = {b: n for b, n in wanted.items() if len(n) == 1}
    several = {b: n for b, n in wanted.items() if len(n) > 1}
    out = None
    for part, many in ((single, False), (several, True)):
        if part:
            rows = _rows(spark, root, part)
            rows = rows if asked is None else _only(rows, asked, sha)
            rows = _newest(rows, sha) if many else rows
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.drop("bucket")


def known_shas(
    spark: SparkSession, path: str, table: str, asked: DataFrame, before: str, sha: str = "sha256"
) -> DataFrame:
    """Which of the asked shas a batch named below ``before`` has stored."""
    root = _root(path, table)
    layout = _layout(spark, root)
    buckets = _asked_buckets(asked, sha, _digits(layout)) if layout else set()
    wanted = {b: [n for n in names if n < before] for b, names in layout.items() if b in buckets}
    if not any(wanted.values()):
        return asked.select(sha).limit(0)
    return _only(_rows(spark, root, wanted).select(sha), asked, sha).distinct()


def compact_keyed(
    spark: SparkSession, path: str, table: str, before: str, apart: int = APART, sha: str = "sha256"
) -> int:
    """Make one batch of the batches named below ``before`` in buckets with more than
    ``apart`` of them; returns the number of buckets.

    The newest of these names holds the newest rows of all, then the older folders go.  A
    job that is lost between leaves rows twice, of which readers take the newest.  Batches
    that may still be written again have to be at or above ``before``.
    """
    root = _root(path, table)
    old = {b: [n for n in names if n < before] for b, names in _layout(spark, root).items()}
    full = {b: names for b, names in old.items() if len(names) > apart}
    if not full:
        return 0
    last = F.create_map(*[F.lit(x) for b, names in full.items() for x in (b, f"n{names[-1]}")])
    newest = _newest(_rows(spark, root, full), sha).withColumn("batch", last[F.col("bucket")])
    columns = [c for c in newest.columns if c not in ("bucket", "batch")]
    (
        newest.select(*columns, "bucket", "batch")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "batch", sha)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .option(f"parquet.bloom.filter.enabled#{sha}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .partitionBy("bucket", "batch")
        .parquet(root)
    )
    for bucket, names in full.items():
        for name in names[:-1]:
            files, folder = file_system(spark, f"{root}/bucket={bucket}/batch=n{name}")
            files.delete(folder, True)
    return len(full)
