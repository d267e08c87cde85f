"""Which documents are processed, and how."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNSUPPORTED_TYPE = "ZE-UNS-UNSUPPORTED-TYPE"

# The document kind of every supported file extension.
KIND_BY_EXTENSION = {
    ".txt": "text",
    ".text": "text",
    ".log": "text",
    ".html": "html",
    ".htm": "html",
    ".xml": "xml",
    ".eml": "email",
    ".msg": "msg",
    ".json": "json",
    ".md": "md",
    ".markdown": "md",
    ".pdf": "pdf",
    ".png": "image",
    ".jpg": "image",
    ".jpeg": "image",
    ".tiff": "image",
    ".tif": "image",
    ".bmp": "image",
    ".heic": "image",
    ".csv": "csv",
    ".tsv": "tsv",
    ".xlsx": "xlsx",
    ".xls": "xlsx",
    ".ndjson": "ndjson",
    ".jsonl": "ndjson",
    ".doc": "doc",
    ".docx": "docx",
    ".ppt": "ppt",
    ".pptx": "pptx",
    ".rtf": "rtf",
    ".rst": "rst",
    ".epub": "epub",
    ".odt": "odt",
    ".org": "org",
}


def kind_of(extension: Column) -> Column:
    pairs = [F.lit(x) for pair in KIND_BY_EXTENSION.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.lower(extension))


def route_by_extension(inputs: DataFrame, extension: str = "extension") -> DataFrame:
    """Add ``kind`` and, for an unknown extension, ``error_code``."""
    return inputs.withColumn("kind", kind_of(F.col(extension))).withColumn(
        "error_code", F.when(F.col("kind").isNull(), F.lit(UNSUPPORTED_TYPE))
    )


def effective_strategy(df: DataFrame, kind: str = "kind", strategy: str = "strategy") -> DataFrame:
    """Add ``effective_strategy``: only pdf and image take one, and no image is fast."""
    asked = F.col(strategy)
    return df.withColumn(
        "effective_strategy",
        F.when((F.col(kind) == "image") & (asked == "fast"), "auto").when(
            F.col(kind).isin("pdf", "image"), asked
        ),
    )


def plan_intake(
    inputs: DataFrame,
    existing: DataFrame,
    skip_existing: bool = True,
    force: bool = False,
    uri: str = "uri",
    sha: str = "sha256",
) -> DataFrame:
    """Add ``decision``: ``process`` or ``skipped_existing``.

    Content that already has run metadata is skipped whatever its outcome was,
    and of several equal contents only the first by ``uri`` is processed.  A
    popular content is reduced to its first copy before any join, and the join
    back runs on content and uri together, so copies spread over all tasks.
    """
    if force or not skip_existing:
        return inputs.withColumn("decision", F.lit("process"))
    firsts = inputs.groupBy(sha).agg(F.min(uri).alias(uri))
    known = existing.select(F.col(sha).alias("__known")).distinct()
    fresh = firsts.join(known, firsts[sha] == known["__known"], "left_anti").select(
        F.col(sha).alias("__sha"), F.col(uri).alias("__uri"), F.lit(True).alias("__fresh")
    )
    return (
        inputs.join(
            fresh, (F.col(sha) == F.col("__sha")) & (F.col(uri) == F.col("__uri")), "left"
        )
        .withColumn(
            "decision", F.when(F.col("__fresh"), "process").otherwise("skipped_existing")
        )
        .drop("__sha", "__uri", "__fresh")
    )
