from __future__ import annotations

import fnmatch
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators.audit import PathRule, Term, denylist_scan, path_rule_scan
from millrace.operators.tables_scan import glob_regex_of, rule_scan, term_hits, term_scan

TERM_SCHEMA = "term string, category string, severity string, reason string, blocked_in array<string>"


def test_ten_thousand_terms_against_every_line(spark):
    """Terms of one letter up, signs, other alphabets and copies that differ in case."""
    rng = random.Random(6)
    letters = "abcdeé ß.*日"
    terms = {"".join(rng.choices(letters, k=rng.choice([1, 2, 3, 4, 6, 9]))) for _ in range(10_000)}
    texts = [
        (f"p{i}", "\n".join("".join(rng.choices(letters + "ABC", k=rng.randrange(40))) for _ in range(9)))
        for i in range(150)
    ] + [("null", None), ("empty", "")]
    terms = sorted(terms) + ["ABC", "abc", ""]
    docs = spark.createDataFrame(texts, "path string, text string").repartition(5)
    table = spark.createDataFrame([(t,) for t in terms], "term string")
    got = [tuple(r) for r in term_hits(docs, table).collect()]
    needles = {t.lower() for t in terms} - {""}
    want = {
        (path, n, needle)
        for path, text in texts
        for n, line in enumerate((text or "").split("\n"), 1)
        for needle in needles
        if needle in line.lower()
    }
    assert len(got) == len(set(got)) and set(got) == want
    plan = term_hits(docs, table)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    few = term_hits(docs, table.limit(5))._jdf.queryExecution().optimizedPlan().toString()
    assert len(few) == pytest.approx(len(plan.split("== Optimized Logical Plan ==")[1].split("== Physical")[0]), rel=0.5)


def test_same_hits_as_the_compiled_scan(spark):
    rng = random.Random(8)
    words = ["billing", "checkout", "not", "must not", "state", "Subscription", "saas", "plain", "excluded"]
    lines = [" ".join(rng.choices(words, k=rng.randrange(6))) for _ in range(400)]
    docs = spark.createDataFrame(
        [
            (f"{rng.choice(['docs/', 'packages/a/src/', 'tests/', 'packages/a/src/sources/', ''])}f{i}.md", "\n".join(lines[i : i + 12]))
            for i in range(0, 400, 10)
        ],
        "path string, text string",
    )
    terms = [
        Term("billing", "c1", "blocker", ("runtime",), "r1"),
        Term("checkout", "c2", "major", ("packages", "connector"), "r2"),
        Term("subscription", "c3", "minor", (), "r3"),
        Term("a", "c4", "minor", ("core_contract",), "r4"),
    ]
    table = spark.createDataFrame(
        [(t.term, t.category, t.severity, t.reason, list(t.blocked_in)) for t in terms], TERM_SCHEMA
    )
    want = denylist_scan(docs, terms)
    got = term_scan(docs, table)
    assert got.columns == want.columns
    rows = sorted(map(str, want.collect()))
    assert sorted(map(str, got.collect())) == rows and len(rows) > 100


PATTERNS = [
    "packages/*", "*.py", "docs/**/x?.md", "*secret*", "a[0-9]b*", "*[!a-z]", "*", "?", "exact/name.txt",
    "*a*b", "", "[ab]*/", "x.y", "*+(1)*", "tools/[!x]*.sh",
]


def paths_of(rng, count):
    parts = ["packages", "docs", "secret", "a1b", "x1.md", ".py", "/", "/", "tools", "exact/name.txt", "x.y", "A", "+(1)", ".sh", "é"]
    return ["".join(rng.choices(parts, k=rng.randrange(1, 6))) for _ in range(count)]


def plain_match(path, pattern):
    return re.match(fnmatch.translate(pattern), path) is not None


def test_glob_column_equals_the_standard_library(spark):
    rng = random.Random(2)
    paths = paths_of(rng, 120)
    pairs = [(p, g) for p in paths for g in PATTERNS if g]
    df = spark.createDataFrame(pairs, "p string, g string").withColumn("r", glob_regex_of(F.col("g")))
    for row in df.select("p", "g", F.rlike("p", F.col("r")).alias("hit")).collect():
        assert row.hit == plain_match(row.p, row.g), row


def test_five_thousand_rules(spark):
    rng = random.Random(4)
    paths = paths_of(rng, 200) + ["packages/x.py"] * 3
    rules = [
        (f"r{i}", [g for g in rng.sample(PATTERNS, 2) if g] + [f"{rng.choice(paths)[: rng.randrange(1, 9)]}*"])
        for i in range(5_000)
    ]
    schema = "rule_id string, path_patterns array<string>, required_review boolean, allowed_scope string, owner_hint string"
    table = spark.createDataFrame([(i, g, True, "nowhere", "o") for i, g in rules], schema)
    df = spark.createDataFrame([(p,) for p in paths], "path string").repartition(3)
    found = rule_scan(df, table)
    got = found.groupBy("path", "rule_id").count().collect()
    want = {
        (p, i): paths.count(p) for p in set(paths) for i, globs in rules if any(plain_match(p, g) for g in globs)
    }
    assert {(r.path, r.rule_id): r["count"] for r in got} == want
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_same_rows_as_the_compiled_rules(spark):
    rules = [
        PathRule("a", ("packages/*", "*.py"), True, "boundary_docs_only", "x"),
        PathRule("b", ("*[0-9]*",), False, "nowhere", "y"),
        PathRule("c", ("tools/*",), True, "tooling_only", "z"),
    ]
    df = spark.createDataFrame([(p,) for p in paths_of(random.Random(9), 150)], "path string")
    schema = "rule_id string, path_patterns array<string>, required_review boolean, allowed_scope string, owner_hint string"
    table = spark.createDataFrame(
        [(r.rule_id, list(r.path_patterns), r.required_review, r.allowed_scope, r.owner_hint) for r in rules], schema
    )
    want = path_rule_scan(df, rules)
    got = rule_scan(df, table).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert rule_scan(df.limit(0), table).count() == rule_scan(df, table.limit(0)).count() == 0


def test_wording_is_read_once_a_line(spark):
    """Lines are not joined again for every hit; an excuse that holds a line break still counts."""
    docs = spark.createDataFrame([("a.md", "a billing\nx"), ("b.md", "a billing\ny")], "path string, text string")
    terms = spark.createDataFrame([("billing", "c", "minor", "r", ["runtime"])], TERM_SCHEMA)
    got = term_scan(docs, terms)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert got.count() == 2 and "__wording" in plan and "array_join" not in plan
    spanning = term_scan(docs, terms, excuses={"billing": ("billing\nx",)})
    assert [r.path for r in spanning.collect()] == ["b.md"]
