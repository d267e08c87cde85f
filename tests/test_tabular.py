from __future__ import annotations

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.sources.tabular import SEPARATORS, delimited_records, partition_tabular

SCHEMA = "a string, b string, c string"


def one_task_read(spark, path, kind):
    """Rows in file order as Spark's reader of whole files gives them."""
    rows = spark.read.schema(SCHEMA).csv(
        path, header=True, sep=SEPARATORS[kind], multiLine=True, quote='"', escape='"'
    )
    return [tuple(r) for r in rows.coalesce(1).collect()]


def values(rows):
    return [tuple(json.loads(r.text).values()) for r in rows]


@pytest.fixture
def small_blocks(spark):
    """Files are cut into blocks of a few dozen bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for name, size in zip(names, ("61", "1"), strict=True):
        spark.conf.set(name, size)
    yield
    for name in names:
        spark.conf.unset(name)


def written(tmp_path, text, name="f.csv"):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


@pytest.mark.parametrize("kind", ["csv", "tsv"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_random_files(spark, small_blocks, tmp_path, kind, end):
    """Quoted breaks, doubled quotes and separators; same rows as the read by one task."""
    rng = random.Random(end + kind)
    pieces = ["x", '"', "\n", ",", "\t", "ß日", '""', "\n\n", "word", ' "', "\n\"\n"]
    rows = [["".join(rng.choices(pieces, k=rng.randrange(7))) or "-" for _ in "abc"] for _ in range(150)]
    out = io.StringIO()
    writer = csv.writer(out, delimiter=SEPARATORS[kind], lineterminator=end)
    writer.writerows([["a", "b", "c"], *rows])
    path = written(tmp_path, out.getvalue())
    got = partition_tabular(spark, path, kind, SCHEMA).orderBy("ord").collect()
    assert [r.ord for r in got] == list(range(len(rows)))
    assert values(got) == one_task_read(spark, path, kind) == [tuple(r) for r in rows]
    assert got[7].element_id == f"{got[7].uri}:7" and got[7].type == "TableRow"


ODD = {
    "quotes inside values": 'a,b,c\nx"y,z"",w\n1,"q""r",3\n',
    "text behind a closing quote": 'a,b,c\n"x"y,"z" ,w\n1,2,3\n',
    "no line break at the end": 'a,b,c\n1,"2\n2",3',
    "empty lines": 'a,b,c\n\n1,2,3\n\n\n4,"\n\n",6\n\n',
    "short and long rows": 'a,b,c\n1\n1,2\n1,2,3,4\n"1",""\n',
    "only a header": "a,b,c\n",
    "nothing": "",
    "one long value": 'a,b,c\n1,"' + "line\n" * 300 + '",3\n4,5,6\n',
    "quoted header": '"a","b\nb",c\n1,2,3\n',
}


@pytest.mark.parametrize("name", ODD)
def test_odd_files(spark, small_blocks, tmp_path, name):
    path = written(tmp_path, ODD[name])
    got = partition_tabular(spark, path, "csv", SCHEMA).orderBy("ord").collect()
    assert values(got) == one_task_read(spark, path, "csv")


def test_an_open_quote_runs_to_the_end_of_its_file(spark, small_blocks, tmp_path):
    written(tmp_path, 'a,b,c\n1,"2,3\n4,5,6\n', "x.csv")
    written(tmp_path, "a,b,c\n7,8,9\n", "y.csv")
    records = delimited_records(spark, str(tmp_path), "csv").collect()
    got = {(r.uri.rsplit("/", 1)[1], r.number): r.record for r in records}
    assert got == {
        ("x.csv", 0): "a,b,c", ("x.csv", 1): '1,"2,3\n4,5,6\n'.rstrip("\n"),
        ("y.csv", 0): "a,b,c", ("y.csv", 1): "7,8,9",
    }


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.col("id").alias("a"),
        F.concat(F.lit('line\n"quoted", '), F.repeat(F.lit("y"), 40)).alias("b"),
        F.lit(None).cast("string").alias("c"),
    )
    place = str(tmp_path / "big")
    rows.coalesce(1).write.csv(place, header=True, quote='"', escape='"')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        records = delimited_records(spark, place, "csv")
        assert spark.read.text(place).rdd.getNumPartitions() > 8
        assert records.count() == 40_001
        elements = partition_tabular(spark, place, "csv", "a long, b string, c string")
        checked = elements.select("ord", F.from_json("text", "a long, b string").alias("r"))
        bad = checked.filter((F.col("ord") != F.col("r.a")) | ~F.col("r.b").startswith('line\n"quoted", yy'))
        assert bad.count() == 0 and elements.select("uri").distinct().count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_schema_is_found_from_the_header(spark, tmp_path):
    path = written(tmp_path, 'x,"y\nz"\n1,2\n')
    assert values(partition_tabular(spark, path, "csv").collect()) == [("1", "2")]


def test_json_documents_and_lines(spark, tmp_path):
    whole = written(tmp_path, json.dumps([{"a": "1", "b": "x\ny"}, {"a": "2"}], indent=2), "w.json")
    got = partition_tabular(spark, whole, "json", SCHEMA).orderBy("ord").collect()
    assert values(got) == [("1", "x\ny", None), ("2", None, None)]
    lines = written(tmp_path, '{"a":"1"}\n{"a":"2"}\n', "l.json")
    assert [r.ord for r in partition_tabular(spark, lines, "ndjson", SCHEMA).orderBy("ord").collect()] == [0, 1]
