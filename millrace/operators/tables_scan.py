"""Scans whose terms and rules are tables.

A list of thousands of terms cannot be an expression.  Here a term is found by one of its
q-grams: the rarest of them is its key, lines are taken apart into their different q-grams,
and an equi-join brings lines and terms together that share a key.  Only these pairs are
compared.  Path rules are joined in the same way, by the literal begin or end of their
patterns or by a q-gram of a literal inside.  No plan grows with the number of terms or
rules; a small table is broadcast by Spark's own size check, a large one is shuffled by key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import textrules
from millrace.functions.binding import evaluate_once, let
from millrace.operators.audit import (
    FALSE_POSITIVES,
    LINES_AFTER,
    LINES_BEFORE,
    NEGATIVE_MARKERS,
    OWNERS,
    ContextRules,
    any_of,
    classified_hits,
    context_kind,
)
from millrace.session import stored

GRAM = 3
#: One document in so many gives the q-gram counts by which keys are chosen.  They decide
#: only how many pairs are compared.
COUNTED_SHARE = 16
_TERM_FIELDS = ("term", "category", "severity", "reason", "blocked_in")


def grams(text: Column, size: int) -> Column:
    """The different substrings of ``size`` characters, found in one pass over the text."""
    found = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))
    return F.array_distinct(found)


def _lines(docs: DataFrame, path: str, text: str) -> DataFrame:
    """``path``, ``line`` (from 1) and ``lowered`` of every line."""
    lines = docs.select(
        F.col(path).alias("path"), F.posexplode(textrules.lines_of(F.col(text))).alias("i", "l")
    )
    return lines.select("path", (F.col("i") + 1).alias("line"), F.lower("l").alias("lowered"))


def _term_keys(terms: DataFrame, lines: DataFrame) -> DataFrame:
    """``needle`` and ``key``: the rarest q-gram of every term (of equals the smallest).

    A term shorter than a q-gram is its own key.
    """
    needle = F.col("needle")
    parts = F.when(F.length(needle) >= GRAM, grams(needle, GRAM)).otherwise(F.array(needle))
    own = terms.select("needle").distinct().select("needle", F.explode(parts).alias("key"))
    drawn = lines.filter(F.pmod(F.xxhash64("path"), F.lit(COUNTED_SHARE)) == 0)
    counts = (
        drawn.select(F.explode(grams(F.col("lowered"), GRAM)).alias("key"))
        .join(own.select("key").distinct(), "key", "left_semi")
        .groupBy("key")
        .agg(F.count("*").alias("n"))
    )
    ranked = own.join(counts, "key", "left").select(
        "needle", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key").alias("k")
    )
    return ranked.groupBy("needle").agg(F.min("k.key").alias("any"), F.min("k").alias("k")).select(
        "needle", F.col("k.key").alias("key")
    )


def term_hits(
    docs: DataFrame, terms: DataFrame, path: str = "path", text: str = "text"
) -> DataFrame:
    """``path``, ``line`` and ``needle``: which lower-cased terms stand on which lines.

    ``terms`` has ``term``.  Empty terms and null texts give nothing.
    """
    lines = _lines(docs, path, text)
    needles = terms.select(F.lower("term").alias("needle")).filter("needle <> ''")
    keys = stored(_term_keys(needles, lines))
    short = [r.n for r in keys.select(F.length("key").alias("n")).distinct().collect() if r.n < GRAM]
    parts = F.concat(*[grams(F.col("lowered"), n) for n in sorted([*short, GRAM])])
    near = lines.select("path", "line", "lowered", F.explode(parts).alias("key")).join(keys, "key")
    return near.filter(F.col("lowered").contains(F.col("needle"))).select("path", "line", "needle")


def term_scan(
    docs: DataFrame,
    terms: DataFrame,
    path: str = "path",
    text: str = "text",
    rules: ContextRules | None = None,
    owners: Mapping[str, str] = OWNERS,
    excuses: Mapping[str, Sequence[str]] = FALSE_POSITIVES,
) -> DataFrame:
    """The hits of ``audit.denylist_scan`` for a table of terms.

    ``terms`` has ``term``, ``category``, ``severity``, ``reason`` and ``blocked_in``
    (array of text); ``path`` names one document.  The lines around a hit are looked at
    only where there is one.
    """
    hits = stored(term_hits(docs, terms, path, text))
    described = terms.select(
        F.lower("term").alias("needle"), F.struct(*_TERM_FIELDS).alias("t")
    )
    at = hits.select("path", "line").distinct().groupBy("path").agg(
        F.collect_list("line").alias("__at")
    )
    lines, wording = F.col("__lines"), F.col("__wording")
    # Only an excuse that holds a line break itself is looked for in the joined lines.
    spanning = {name for name, options in excuses.items() if any("\n" in o for o in options)}

    def says(line: Column) -> Column:
        """What a line says that matters to its neighbours; no marker spans lines."""
        return let(
            F.lower(line),
            lambda low: F.struct(
                any_of(low, NEGATIVE_MARKERS, "contains").alias("negative"),
                F.array(*[any_of(low, options, "contains") for options in excuses.values()]).alias("excused"),
            ),
        )

    def around(line: Column) -> Column:
        first = F.greatest(line - LINES_BEFORE, F.lit(1))
        count = line - first + 1 + LINES_AFTER

        def excused(near: Column, number: int, name: str) -> Column:
            if name in spanning:
                joined = F.lower(F.array_join(F.slice(lines, first, count), "\n"))
                return any_of(joined, excuses[name], "contains")
            return F.exists(near, lambda w: w["excused"][number])

        return let(
            F.slice(wording, first, count),
            lambda near: F.struct(
                line.alias("line"),
                F.exists(near, lambda w: w["negative"]).alias("negative"),
                F.filter(
                    F.array(
                        *[
                            F.when(excused(near, number, name), F.lit(name))
                            for number, name in enumerate(excuses)
                        ]
                    ).cast("array<string>"),
                    lambda name: name.isNotNull(),
                ).alias("excused"),
                F.trim(F.get(lines, line - 1)).alias("text"),
            ),
        )

    found_in = (
        docs.select(F.col(path).alias("path"), F.col(text).alias("__text"))
        .join(at, "path")
        .withColumn("__lines", textrules.lines_of(F.col("__text")))
    )
    worded = evaluate_once(found_in, ["path", "__at", "__lines"], {"__wording": F.transform(lines, says)})
    near = evaluate_once(
        worded,
        ["path"],
        {
            "context_kind": context_kind(F.col("path"), rules or ContextRules()),
            "__near": F.transform("__at", around),
        },
    ).select("path", "context_kind", F.explode("__near").alias("n"))
    joined = (
        hits.join(described, "needle")
        .join(near.withColumn("line", F.col("n.line")), ["path", "line"])
        .filter(~F.array_contains("n.excused", F.col("t.term")))
    )
    shaped = joined.select(
        "path",
        "context_kind",
        F.struct(
            F.col("line").cast("int").alias("line"),
            *[F.col(f"t.{c}").alias(c) for c in _TERM_FIELDS],
            F.col("n.negative").alias("negative"),
            F.col("n.text").alias("text"),
        ).alias("h"),
    )
    return classified_hits(shaped, owners)


def _glob_tokens(pattern: Column) -> Column:
    return F.regexp_extract_all(pattern, F.lit(r"(?s)\[[^\]]+\]|."), F.lit(0))


def glob_regex_of(pattern: Column) -> Column:
    """Regex of a column of shell patterns in which ``*`` also matches slashes."""

    def piece(token: Column) -> Column:
        return (
            F.when(token == "*", ".*")
            .when(token == "?", ".")
            .when(F.length(token) > 1, F.regexp_replace(token, r"^\[!", "[^"))
            .when(token.rlike(r"[\\^$.|+(){}\[\]]"), F.concat(F.lit("\\"), token))
            .otherwise(token)
        )

    return F.concat(F.lit("(?s)^"), F.array_join(F.transform(_glob_tokens(pattern), piece), ""), F.lit("\\z"))


_WILD = r"\[[^\]]+\]|[*?]"


def _pattern_key(pattern: Column) -> Column:
    """What a path must have to match: its begin, its end or a q-gram; ``any`` for none."""
    literals = F.split(pattern, _WILD)
    begin, end = F.get(literals, F.lit(0)), F.element_at(literals, -1)
    longest = F.element_at(
        F.array_sort(F.transform(literals, lambda x: F.struct(F.length(x).alias("n"), x.alias("x")))), -1
    )["x"]

    def key(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.length(value).alias("size"), value.alias("key"))

    return (
        F.when(~pattern.rlike(_WILD), key("whole", pattern))
        .when(F.length(begin) >= GRAM, key("begin", begin))
        .when(F.length(end) >= GRAM, key("end", end))
        .when(F.length(longest) >= GRAM, key("gram", F.substring(longest, F.lit(1), F.lit(GRAM))))
        .otherwise(key("any", F.lit("")))
    )


def rule_scan(
    paths: DataFrame,
    rules: DataFrame,
    path: str = "path",
    runtime_prefixes: Sequence[str] = ("packages/", "tools/"),
) -> DataFrame:
    """The rows of ``audit.path_rule_scan`` for a table of rules.

    ``rules`` has ``rule_id``, ``path_patterns`` (array of text), ``required_review``,
    ``allowed_scope`` and ``owner_hint``.  A pattern without a literal of three characters
    is compared with every path.
    """
    patterns = stored(
        rules.select("rule_id", F.explode(F.array_distinct("path_patterns")).alias("pattern"))
        .withColumn("k", _pattern_key(F.col("pattern")))
        .select("rule_id", "k.*", glob_regex_of(F.col("pattern")).alias("regex"))
    )
    # At most a kind for each length of a literal.
    kinds = [(r.kind, r.size) for r in patterns.select("kind", "size").distinct().collect()]
    where = F.col("path")

    def keys(kind: str, size: int) -> Column:
        if kind == "whole":
            values = F.array(where)
        elif kind == "begin":
            values = F.array(F.substring(where, 1, size))
        elif kind == "end":
            values = F.array(F.substring(where, -size, size))
        elif kind == "gram":
            values = grams(where, GRAM)
        else:
            values = F.array(F.lit(""))
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("key")))

    offered = F.array_distinct(F.concat(*[keys(kind, size) for kind, size in sorted(kinds)])) if kinds else (
        F.array().cast("array<struct<kind:string,key:string>>")
    )
    asked = paths.select(F.col(path).alias("path")).select("path", F.inline(offered))
    matched = (
        asked.join(patterns, ["kind", "key"])
        .filter(F.rlike("path", F.col("regex")))
        .select("path", "rule_id")
        .distinct()
    )
    counted = paths.groupBy(F.col(path).alias("path")).agg(F.count("*").alias("copies"))
    allowed = F.col("allowed_scope").isin("boundary_docs_only", "tooling_only")
    classification = (
        F.when(allowed, "boundary_tooling")
        .when(any_of(where, runtime_prefixes, "startswith"), "blocked_runtime")
        .otherwise("review_required")
    )
    facts = rules.select("rule_id", "required_review", "owner_hint", "allowed_scope")
    return (
        matched.join(facts, "rule_id")
        .join(counted, "path")
        .select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy"))
        .select(
            "path",
            "rule_id",
            classification.alias("classification"),
            "required_review",
            "owner_hint",
            "allowed_scope",
        )
    )
