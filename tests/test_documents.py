from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from millrace.catalog.files import scanned
from millrace.operators.audit import (
    ContextRules,
    Term,
    denylist_scan,
    glob_regex,
    scan_summary,
    verify_evidence,
)
from millrace.operators.metadata import normalize_metadata
from millrace.operators.partition import explode_elements, partition_documents
from millrace.operators.routing import plan_intake
from millrace.operators.sinks import read_artifacts, write_rows
from millrace.operators.store import write_keyed
from millrace.sources.fetched import fetched_metadata, wiki_filename
from millrace.sources.files import expand_braces, path_regex, scan_files
from millrace.sources.specs import source_identity
from millrace.sources.tabular import partition_tabular
from millrace.streaming.intake import stream_dedup, stream_dlq, stream_intake


def elements(spark, kind, text):
    df = spark.createDataFrame([("s", text)], "sha256 string, text string")
    rows = explode_elements(partition_documents(df, kind), "sha256").orderBy("ord").collect()
    return [(r.type, r.text) for r in rows]


def test_text(spark):
    assert elements(spark, "text", "Title\n\n- item one\n 12) two \r\nA sentence.\n") == [
        ("Title", "Title"),
        ("ListItem", "- item one"),
        ("ListItem", "12) two"),
        ("NarrativeText", "A sentence."),
    ]
    assert elements(spark, "text", "") == []


def test_html(spark):
    page = (
        "<html><head><title>no</title><style>p{}</style></head><body><nav><a>menu</a></nav>"
        '<!-- <p>gone</p> --><script>var t="</p>";</script><h1 class="x">A &amp; B</h1>'
        "<p>One <b>two</b>\nthree&nbsp;four<br>five &#233;&#x1F600; &amp;lt;</p>"
        "<ul><li>x</li><li><p>y</p></li></ul></body></html>"
    )
    assert elements(spark, "html", page) == [
        ("Title", "A & B"),
        ("NarrativeText", "One two three four"),
        ("NarrativeText", "five é😀 &lt;"),
        ("ListItem", "x"),
        ("ListItem", "y"),
    ]


def test_markdown(spark):
    text = "# Head #\nline one\nline two\n\n* a\n* b\n```py\n# not a head\n```\n1. c\n"
    assert elements(spark, "md", text) == [
        ("Title", "Head"),
        ("NarrativeText", "line one line two"),
        ("ListItem", "a"),
        ("ListItem", "b"),
        ("CodeSnippet", "# not a head"),
        ("ListItem", "c"),
    ]


def test_plan_intake(spark):
    rows = [("u3", "x"), ("u1", "x"), ("u2", "y"), ("u4", "z")]
    inputs = spark.createDataFrame(rows, "uri string, sha256 string")
    known = spark.createDataFrame([("z",), ("z",)], "sha256 string")
    got = {r.uri: r.decision for r in plan_intake(inputs, known).collect()}
    assert got == {
        "u1": "process",
        "u2": "process",
        "u3": "skipped_existing",
        "u4": "skipped_existing",
    }
    forced = plan_intake(inputs, known, force=True)
    assert {r.decision for r in forced.collect()} == {"process"}


def test_metadata(spark):
    points = [[1146.5523, 450.4698], [2341.0949, 450.4698], [2341.0949, 495.2769]]
    good = {
        "file_directory": "/secret",
        "is_extracted": "true",
        "coordinates": {"points": points, "system": "PixelSpace"},
        "page": 1.0,
    }
    bad = {"is_extracted": "perhaps", "coordinates": {"points": []}}
    df = spark.createDataFrame([(json.dumps(good),), (json.dumps(bad),)], "metadata string")
    first, second = normalize_metadata(df).collect()
    kept = json.loads(first.metadata)
    assert "file_directory" not in kept and kept["is_extracted"] is True
    assert kept["bbox"] == {
        "x_min": 1146.5523,
        "y_min": 450.4698,
        "x_max": 2341.0949,
        "y_max": 495.2769,
    }
    assert '"page":1.0' in first.metadata and first.metadata_warnings == []
    assert second.metadata_warnings == ["is_extracted_not_a_boolean", "coordinates_without_a_box"]


def elements_of(spark, text, kind):
    df = spark.createDataFrame([("s", text)], "sha256 string, text string")
    return [(e.type, e.text) for e in partition_documents(df, kind).first().elements]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<ul><li><p>x</p></li><li>y</li></ul><p>z z.</p>",
         [("ListItem", "x"), ("ListItem", "y"), ("NarrativeText", "z z.")]),
        ("<h1></h1><p>plain</p><h2><b>T</b></h2>", [("NarrativeText", "plain"), ("Title", "T")]),
        ("<p>a</p><script>if (a > b) {", [("NarrativeText", "a")]),
        ("<p>a</p><!-- b <p>c</p>", [("NarrativeText", "a")]),
        ('<p>a <img alt="x > y" src=z>b</p>', [("NarrativeText", "a b")]),
        ("<pre>one\n  two</pre><p>a\nb</p>",
         [("NarrativeText", "one"), ("NarrativeText", "two"), ("NarrativeText", "a b")]),
        ("<p>&eacute;&trade;&middot;&#1048576;&#x10FFFF;&#X41;&amp;lt;&nosuch; &#0;&#xD800; a&b</p>",
         [("NarrativeText", "é™·\U00100000\U0010ffffA&lt;&nosuch; \ufffd\ufffd a&b")]),
        ("a < b and <i>c</i>", [("NarrativeText", "a < b and c")]),
    ],
)
def test_html_details(spark, html, want):
    assert elements_of(spark, html, "html") == want


def test_md_details(spark):
    text = (
        "Head\n====\n\nSub\n---\n\n> quoted\n> more\n\n| a | b |\n|---|:-:|\n| 1 | 2 |\n\n"
        "- item\n\n```\nx | y\n```\nlast *line*\n"
    )
    assert elements_of(spark, text, "md") == [
        ("Title", "Head"),
        ("Title", "Sub"),
        ("NarrativeText", "quoted more"),
        ("Table", "a b\n1 2"),
        ("ListItem", "item"),
        ("CodeSnippet", "x | y"),
        ("NarrativeText", "last *line*"),
    ]


def test_scan_files(spark, tmp_path):
    for name in ("a.TXT", "sub/b.md", "sub/deep/c.txt", "d.csv"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(name)
    every = scan_files(spark, str(tmp_path)).collect()
    assert {(r.filename, r.extension) for r in every} == {
        ("a.TXT", ".txt"),
        ("b.md", ".md"),
        ("c.txt", ".txt"),
        ("d.csv", ".csv"),
    }
    some = scan_files(spark, str(tmp_path), "**/*.{md,txt}", with_sha=True).collect()
    assert sorted(r.filename for r in some) == ["b.md", "c.txt"]
    assert all(len(r.sha256) == 64 for r in some)
    assert [r.filename for r in scan_files(spark, str(tmp_path), "*.csv").collect()] == ["d.csv"]
    single = scan_files(spark, str(tmp_path / "d.csv"), "*.md").collect()
    assert [r.filename for r in single] == ["d.csv"]
    assert expand_braces("x{a,b}y") == ["xay", "xby"]
    assert path_regex("**/*.md") == r"^(?:[^/]+/)*[^/]*\.md$"


@pytest.mark.parametrize(
    ("kind", "body"),
    [
        ("csv", "a,b\n1,x\n2,y\n"),
        ("tsv", "a\tb\n1\tx\n2\ty\n"),
        ("ndjson", '{"a":"1","b":"x"}\n{"a":"2","b":"y"}\n'),
        ("json", '[{"a":"1","b":"x"},\n{"a":"2","b":"y"}]'),
        ("xml", "<t><row><a>1</a><b>x</b></row><row><a>2</a><b>y</b></row></t>"),
    ],
)
def test_tabular(spark, tmp_path, kind, body):
    path = tmp_path / f"f.{kind}"
    path.write_text(body)
    rows = partition_tabular(spark, str(path), kind, "a string, b string").orderBy("ord").collect()
    assert [r.text for r in rows] == ['{"a":"1","b":"x"}', '{"a":"2","b":"y"}']
    assert len({r.element_id for r in rows}) == 2


def test_scan_below_a_repeated_root(spark, tmp_path):
    root = tmp_path / "in"
    inner = root / str(root).lstrip("/")
    inner.mkdir(parents=True)
    (inner / "deep.csv").write_text("x")
    (root / "top.csv").write_text("x")
    assert [r.filename for r in scan_files(spark, str(root), "*.csv").collect()] == ["top.csv"]
    assert scan_files(spark, str(root), "**/*.csv").count() == 2


def test_tabular_rows_are_numbered_by_file(spark, tmp_path):
    for i in range(24):
        (tmp_path / f"f{i:02d}.csv").write_text('x,y\n1,"l1\nl2 ""q"""\n2,\n')
    rows = partition_tabular(spark, str(tmp_path), "csv", "x string, y string").collect()
    assert sorted(r.element_id.rsplit("/", 1)[1] for r in rows) == sorted(
        f"f{i:02d}.csv:{n}" for i in range(24) for n in range(2)
    )
    assert {(r.ord, r.text) for r in rows} == {
        (0, '{"x":"1","y":"l1\\nl2 \\"q\\""}'),
        (1, '{"x":"2","y":null}'),
    }


def test_tabular_numbers_run_over_splits(spark, tmp_path):
    (tmp_path / "f.ndjson").write_text("".join('{"n":"%06d"}\n' % i for i in range(4000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = partition_tabular(spark, str(tmp_path), "ndjson", "n string")
        assert df.select(F.spark_partition_id()).distinct().count() >= 1
        got = {r.ord: r.text for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {i: '{"n":"%06d"}' % i for i in range(4000)}


def test_fetched_names(spark):
    rows = [
        ("https://h/a%20b/c%2Bd?x=1", None, "text/html; x"),
        ("https://h/", None, "application/pdf"),
        ("https://h", None, None),
        ("https://h/x.y", "attachment; filename*=UTF-8''%C3%A9.txt", None),
        ("https://h/a+b", None, "image/png"),
    ]
    df = spark.createDataFrame(rows, "url string, cd string, ct string")
    got = fetched_metadata(df, "ct", url="url", disposition="cd").collect()
    assert [r.filename for r in got] == ["c+d.html", "downloaded.pdf", "downloaded", "é.txt", "a+b"]
    assert got[0].mime_type == "text/html"


def test_identity_ignores_credentials(spark):
    def spec(password, brokers):
        return json.dumps(
            {
                "source": {
                    "kind": "kafka_partition_offset_v1",
                    "stream": "s",
                    "connection_name": "c",
                    "brokers": brokers,
                    "password": password,
                    "topic": "t",
                    "partition": 0,
                    "batch_size": 1,
                }
            }
        )

    df = spark.createDataFrame([(spec("a", ["x:1", "y:2"]),), (spec("b", ["y:2", "x:1"]),)], "t string")
    assert len({r.source_sha256 for r in source_identity(df, "t").collect()}) == 1


def test_denylist_context(spark):
    text = "\n".join(["a billing term", "1", "2", "3", "4", "5", "6", "billing", "x", "must not"])
    docs = spark.createDataFrame(
        [("packages/p/src/m.py", text), ("docs/n.md", "Billing\nuse checkout\nactions/checkout")],
        "path string, text string",
    )
    terms = [
        Term("billing", "money", "blocker", ("packages",)),
        Term("checkout", "money", "major"),
    ]
    hits = denylist_scan(docs, terms, rules=ContextRules()).collect()
    got = {(r.path, r.line, r.term): r.classification for r in hits}
    assert got == {
        ("packages/p/src/m.py", 1, "billing"): "blocked",
        ("packages/p/src/m.py", 8, "billing"): "review_required",
        ("docs/n.md", 1, "billing"): "review_required",
    }
    total = scan_summary(denylist_scan(docs, terms), docs).first()
    assert (total.scanned_files, total.blocked_hits, total.overall) == (2, 1, "fail")
    assert glob_regex("a/*.[!x]?") == r"(?s)^a/.*\.[^x].$"


def test_verify_evidence(spark):
    expected = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, evidence_ref long")
    present = spark.createDataFrame([(1,), (1,)], "evidence_ref long")
    missing, verdict = verify_evidence(expected, present, ["k"])
    assert [(r.k, r.evidence_ref) for r in missing.collect()] == [("a", 2)]
    got = {r.k: (r.verification_result, r.checked_evidence_count) for r in verdict.collect()}
    assert got == {"a": ("failed", 2), "b": ("passed", 1)}


def test_artifact_batches_replace_by_sha(spark, tmp_path):
    out = str(tmp_path / "out")
    first = spark.createDataFrame([("x", 1), ("y", 1)], "sha256 string, v int")
    write_keyed(first, out, "t", "0001")
    write_keyed(first, out, "t", "0001")
    write_keyed(spark.createDataFrame([("x", 2)], "sha256 string, v int"), out, "t", "0002")
    rows = read_artifacts(spark, out, "t").collect()
    assert sorted((r.sha256, r.v) for r in rows) == [("x", 2), ("y", 1)]
    write_rows(first, str(tmp_path / "rows"))
    assert spark.read.json(str(tmp_path / "rows")).count() == 2


RUN = {"run_id": "r", "pipeline_version": "p", "timestamp_utc": "2026-01-01T00:00:00Z"}


def test_stream_intake_skips_what_it_knows(spark, tmp_path):
    source, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()
    (source / "a.txt").write_text("one\ntwo")
    (source / "b.txt").write_text("one\ntwo")
    stream_intake(spark, str(source), out, progress, RUN).awaitTermination()
    assert read_artifacts(spark, out, "payloads").count() == 1
    (source / "c.txt").write_text("one\ntwo")
    (source / "d.txt").write_text("three")
    stream_intake(spark, str(source), out, progress, RUN).awaitTermination()
    stored = spark.read.parquet(f"{out}/run_meta")
    assert stored.count() == stored.select("sha256").distinct().count() == 2
    results = read_artifacts(spark, out, "results")
    assert sorted(r.normalized_text for r in results.collect()) == ["one\n\ntwo", "three"]


def test_stream_dlq_and_dedup(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", True, 1), ("b", False, 2), ("a", True, 3)], "k string, ok boolean, s long"
    ).withColumn("at", F.timestamp_seconds("s"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    stream_dlq(stream, out, str(tmp_path / "cp")).awaitTermination()
    assert [r.k for r in spark.read.parquet(f"{out}/dlq").collect()] == ["b"]
    assert spark.read.parquet(f"{out}/delivered").count() == 2
    query = (
        stream_dedup(stream, ["k"], "at", "1 hour")
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "first"))
        .option("checkpointLocation", str(tmp_path / "cp2"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "first")).collect()) == ["a", "b"]


def test_scan_files_query_lists_a_file_for_every_supplier(spark, tmp_path):
    rows = [(n, None if n == 9 else f"S{n}", n % 3) for n in range(12)]
    suppliers = spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey int")
    suppliers.write.parquet(str(tmp_path / "supplier.parquet"))
    got = {r.folder: r.sha256 for r in scanned(spark, str(tmp_path)).collect()}
    texts = {str(key): f"{name or ''}\n" for key, name, _ in rows}
    assert got == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in texts.items()}


def test_wiki_filename_trims_dashes_at_both_ends_only(spark):
    rows = [(1, "  Ab--C, d! "), (2, "...\n"), (3, ""), (4, None), (5, "É x")]
    df = spark.createDataFrame(rows, "id long, t string")
    got = [r.f for r in df.select(wiki_filename(F.col("t"), F.col("id")).alias("f")).collect()]
    page = "confluence-page-{}.html".format
    assert got == ["ab-c-d.html", page(2), page(3), page(4), "x.html"]
