"""Allow and block lists for URLs, matched in a trie.

The trie's first levels are host labels from the last to the first, so a rule for a
host also stands for its subdomains; below a host come the segments of the path.  A
search descends along a URL's labels and from every host node it meets along the
URL's path.  Of the rules met the longest wins, counted in characters of ``host/path``; of
equally long ones block wins over allow, then the longer host.

The rules are a parameter of bounded size (``MAX_RULES``, checked); the trie is built
from them on the driver and broadcast.  URLs are judged where they are read.

Kept columns named like a result give way to it.  A null URL and one without ``://`` have
an empty host and path, which no rule fits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 1_000_000
VERDICTS = ("allow", "block")


@dataclass
class PathNode:
    """Whole segments lead on; ``ends`` has rules whose last segment is only begun."""

    segments: dict[str, PathNode] = field(default_factory=dict)
    ends: dict[str, tuple[str, str]] = field(default_factory=dict)

    def add(self, path: str, entry: tuple[str, str]) -> None:
        *whole, last = path.split("/")
        node = self
        for segment in whole:
            node = node.segments.setdefault(segment, PathNode())
        if entry[1] == "block" or last not in node.ends:
            node.ends[last] = entry

    def longest(self, path: str) -> tuple[str, str] | None:
        """Entry of the longest rule path that ``path`` starts with."""
        best, node = None, self
        for segment in path.split("/"):
            fitting = [end for end in node.ends if segment.startswith(end)]
            if fitting:
                best = node.ends[max(fitting, key=len)]
            node = node.segments.get(segment)
            if node is None:
                break
        return best


@dataclass
class HostNode:
    labels: dict[str, HostNode] = field(default_factory=dict)
    paths: PathNode | None = None


def build_trie(rules: Sequence[tuple[str, str]]) -> HostNode:
    """Trie of (verdict, ``host/path``) rules."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules cannot be broadcast")
    root = HostNode()
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        if verdict not in VERDICTS or not host or not slash:
            raise ValueError(f"not a rule: {verdict} {rule}")
        node = root
        for label in reversed(host.lower().split(".")):
            node = node.labels.setdefault(label, HostNode())
        node.paths = node.paths or PathNode()
        node.paths.add(slash + path, (rule, verdict))
    return root


def match(trie: HostNode, host: str, path: str) -> tuple[str, str] | None:
    """The winning rule and its verdict, or nothing."""
    best, rank, node = None, (0, False), trie
    for label in reversed(host.split(".")):
        node = node.labels.get(label)
        if node is None:
            break
        if node.paths is not None:
            found = node.paths.longest(path)
            # Hosts are met from the shortest to the longest.
            if found and (len(found[0]), found[1] == "block") >= rank:
                best, rank = found, (len(found[0]), found[1] == "block")
    return best


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host with A to Z in lower case, and path; both empty without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, capitals, capitals.lower()), path


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    keep: Sequence[str],
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``keep`` columns, ``host``, ``path``, ``rule`` and ``verdict`` of every URL.

    A URL that no rule fits gets the ``default`` verdict and a null rule.
    """
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judged(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in frames:
            found = [
                match(trie.value, h, p) or (None, default)
                for h, p in zip(hosts, paths, strict=True)
            ]
            yield pd.DataFrame(found, columns=["rule", "verdict"])

    host, path = url_parts(F.col(url))
    keep = [c for c in keep if c not in ("host", "path", "rule", "verdict")]
    split = pages.select(*keep, host.alias("host"), path.alias("path"))
    marked = split.withColumn("__found", judged("host", "path"))
    return marked.select(
        *keep,
        "host",
        "path",
        F.col("__found.rule").alias("rule"),
        F.col("__found.verdict").alias("verdict"),
    )
