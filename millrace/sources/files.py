"""File listing."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import identity, textrules


def expand_braces(pattern: str) -> list[str]:
    """Expand one ``{a,b}`` group."""
    found = re.search(r"\{(.*)\}", pattern)
    if found is None:
        return [pattern]
    head, tail = pattern[: found.start()], pattern[found.end() :]
    return [f"{head}{option}{tail}" for option in found.group(1).split(",")]


def path_regex(pattern: str) -> str:
    """Regex for a relative path pattern; ``**`` spans any number of folders."""
    out = []
    segments = pattern.split("/")
    for position, segment in enumerate(segments):
        last = position == len(segments) - 1
        if segment == "**":
            out.append(".*" if last else "(?:[^/]+/)*")
            continue
        piece = ""
        for token in re.findall(r"\[[^\]]+\]|.", segment):
            if token == "*":
                piece += "[^/]*"
            elif token == "?":
                piece += "[^/]"
            elif len(token) > 1:
                piece += token.replace("[!", "[^")
            else:
                piece += re.escape(token)
        out.append(piece if last else piece + "/")
    return "^" + "".join(out) + "$"


def scan_files(
    spark: SparkSession, path: str, pattern: str = "**/*", with_sha: bool = False
) -> DataFrame:
    """One row per file under ``path`` that matches ``pattern``.

    File contents are read only when the content sha is asked for.  Spark's
    listing leaves out names that begin with a dot or an underscore.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    )
    uri = F.regexp_replace("path", r"^file:/*", "/")
    name = textrules.base_name(uri)
    files = listing.withColumn("uri", uri)
    if not os.path.isfile(path):
        root = os.path.abspath(path) if os.path.exists(path) else path.rstrip("/")
        inside = F.col("uri").startswith(f"{root}/")
        relative = F.when(inside, F.col("uri").substr(F.lit(len(root) + 2), F.length("uri")))
        wanted = "|".join(f"(?:{path_regex(p)})" for p in expand_braces(pattern))
        files = files.filter(relative.rlike(wanted))
    columns = [
        F.col("uri"),
        F.lit("local_file").alias("source"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(
            "discovered_at_utc"
        ),
        name.alias("filename"),
        F.lower(textrules.suffix_of(name)).alias("extension"),
        F.col("length").alias("size_bytes"),
    ]
    if with_sha:
        columns.append(F.sha2(F.col("content"), 256).alias("sha256"))
    return files.select(*columns)


def content_sha(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("sha256", identity.sha256_of(F.col(text)))
