from __future__ import annotations

import html
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.partition import decode_entities, md_elements


def decoded(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", decode_entities(F.col("t")).alias("d")).collect()
    return [r.d for r in sorted(rows)]


def test_references_equal_the_standard_library(spark):
    """Names with and without a semicolon, unknown ones, numbers and remapped controls."""
    rng = random.Random(7)
    pieces = [
        "&amp", "&amp;", "&copy 2020", "&notit;", "&notin;", "&not", "&unknown;", "&", "&;", "&#", "&#x", "&x",
        "&#150;", "&#128;", "&#x80", "&#65", "&#x41;b", "&#0;", "&#xD800;", "&#1114112;", "&#99999999999;",
        "&ampamp;", "&lt&gt", "&Aacute", "&aacutex", "&hellip;", "&hellip", "&frac12 ", "&nbsp;", "é", " text ",
        "&amp;lt;", "&NotEqualTilde;", "&#xe9;", "&#XE9",
    ]
    texts = pieces + ["".join(rng.choices(pieces, k=rng.randrange(1, 6))) for _ in range(400)]
    assert decoded(spark, texts) == [html.unescape(t) for t in texts]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("* x\n  y\n* z", [("ListItem", "x y"), ("ListItem", "z")]),
        ("1. one\nlazy\n\nplain", [("ListItem", "one lazy"), ("NarrativeText", "plain")]),
        ("- a\n# Head\n- b\n\tmore\n  lines", [("ListItem", "a"), ("Title", "Head"), ("ListItem", "b more lines")]),
        ("text\n- item\n  more", [("NarrativeText", "text"), ("ListItem", "item more")]),
    ],
)
def test_list_items_go_on(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string").select(md_elements(F.col("t")).alias("e"))
    assert [(e.type, e.text) for e in df.first().e] == want
