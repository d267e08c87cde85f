from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from millrace.functions import identity, textrules
from millrace.functions import jsontext as J

TEXTS = [
    '{"b":1.0,"a":"x:y, z 1.0,","c":[1,2.5,-3.00,null,true]}',
    '{"a":{"z":"é\\n\\"q\\"","y":100.0},"k":[{"p":1},{"p":1.0}]}',
    '{"t":"v1.0","n":10.05}',
    "[]",
    '"😀"',
    "{}",
]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text", TEXTS)
def test_canonical_and_spaced_match_json_dumps(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(
        J.canonical(F.col("t")).alias("c"),
        J.spaced(J.canonical(F.col("t"))).alias("s"),
        J.ascii_only(J.canonical(F.col("t"))).alias("a"),
    ).first()
    value = json.loads(text)
    compact = {"sort_keys": True, "separators": (",", ":")}
    assert row.c == json.dumps(value, ensure_ascii=False, **compact)
    assert row.s == json.dumps(value, ensure_ascii=False, sort_keys=True)
    assert row.a == json.dumps(value, **compact)


@pytest.mark.parametrize(
    "text", ["", "{", '{"a":1}}', '{"a":1}]', "1 2", '1,"x"', '{"a":1}x', "nul"]
)
def test_malformed_texts_do_not_parse(spark, text):
    assert one(spark, J.canonical(F.lit(text))) is None


def test_long_text_with_many_escapes(spark):
    text = json.dumps({"k": 'a\n,:"' * 50_000, "z": 1.0})
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(J.spaced(J.canonical(F.col("t"))).alias("v")).first().v
    assert got == json.dumps(json.loads(text), ensure_ascii=False, sort_keys=True)


def test_types_at_paths(spark):
    df = spark.createDataFrame(
        [('{"s":"x","e":"","i":3,"f":3.0,"b":true,"n":null,"o":{},"l":[1]}',)], "t string"
    )
    v = J.parse(F.col("t"))
    row = df.select(
        J.string_at(v, "$.s").alias("s"),
        J.string_at(v, "$.i").alias("not_string"),
        J.string_at(v, "$.f").alias("float_is_no_string"),
        J.filled_string_at(v, "$.e").alias("empty"),
        J.integer_at(v, "$.i").alias("i"),
        J.integer_at(v, "$.f").alias("float_is_no_int"),
        J.integer_at(v, "$.b").alias("bool_is_no_int"),
        J.absent(v, "$.n").alias("null_absent"),
        J.absent(v, "$.zz").alias("missing_absent"),
        J.absent(v, "$.s").alias("present"),
        J.is_object(v, "$.o").alias("o"),
        J.is_object(v, "$.l").alias("list_is_no_object"),
        J.is_list(v, "$.l").alias("l"),
    ).first()
    assert (row.s, row.i, row.o, row.l) == ("x", 3, True, True)
    assert row.not_string is None and row.float_is_no_string is None and row.empty is None
    assert row.float_is_no_int is None and row.bool_is_no_int is None
    assert row.null_absent and row.missing_absent and not row.present
    assert not row.list_is_no_object


@pytest.mark.parametrize("value", ['a"b', "[x]", "", None, "é\t"])
def test_quote(spark, value):
    df = spark.createDataFrame([(value,)], "t string")
    got = df.select(J.quote(F.col("t")).alias("v")).first().v
    assert json.loads(got) == value


def test_identity_keys(spark):
    sha = "ab" * 32
    assert one(spark, identity.object_uuid(F.lit(sha))) == str(uuid.uuid5(uuid.NAMESPACE_DNS, sha))
    task = {"kind": "it", "pipeline_version": "p-é", "sha256": sha}
    compact = {"sort_keys": True, "separators": (",", ":")}
    key = identity.task_key(F.lit("it"), F.lit("p-é"), F.lit(sha))
    assert one(spark, key) == json.dumps(task, **compact)
    progress = {"cursor": "ü", "n": 1.0}
    full = {
        "kind": "it",
        "task": task,
        "stream": None,
        "progress_kind": "cursor_v1",
        "progress": progress,
    }
    got = identity.checkpoint_key(
        key,
        F.lit(None).cast("string"),
        F.lit("cursor_v1"),
        J.canonical(F.lit(json.dumps(progress, ensure_ascii=False))),
    )
    assert one(spark, got) == json.dumps(full, **compact)
    assert one(spark, identity.delivery_key(F.lit("s"), F.lit("r"))) == "s:r"


@pytest.mark.parametrize(
    "text", ["a\nb", "a\r\nb\r\n", "\n\na", "a\x0bb c\x85", "one", "a\r\r\n"]
)
def test_lines_match_splitlines(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(textrules.lines_of(F.col("t")).alias("v")).first().v == text.splitlines()


@pytest.mark.parametrize(
    ("path", "name", "suffix"),
    [
        ("/a/b.txt", "b.txt", ".txt"),
        ("/a/b/", "b", ""),
        ("/a/.bashrc", ".bashrc", ""),
        ("x.tar.gz", "x.tar.gz", ".gz"),
        ("/a/b/.", "b", ""),
        ("", "", ""),
    ],
)
def test_names(spark, path, name, suffix):
    got = textrules.base_name(F.lit(path))
    assert one(spark, got) == name
    assert one(spark, textrules.suffix_of(got)) == suffix


def test_slug(spark):
    assert one(spark, textrules.slug(F.lit(" web hook/é "))) == "web_hook_"
    assert one(spark, textrules.slug(F.lit("  "))) == "unknown"
    assert len(one(spark, textrules.slug(F.lit("x" * 200)))) == 80
