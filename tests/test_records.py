from __future__ import annotations

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators.checkpoints import (
    build_checkpoints,
    checkpoint_compat,
    read_checkpoint_entries,
    progress_kind,
    resume_filter,
)
from millrace.operators.elements import elements_from_records, normalized_text
from millrace.operators.sinks import log_lines, record_lines
from millrace.sources.connectors import log_reader_options
from millrace.sources.incremental import check_cursor, read_incremental, read_offsets
from millrace.sources.normalize import json_value, normalize_values
from millrace.sources.records import read_messages, read_paged, read_record_list
from millrace.sources.tables import RecordTables

FOLDER = "/root/testdata/sf0.001"
given_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables not found")


def docs(spark, *values):
    rows = [(i, v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "doc long, text string")


def generated_messages(rng, count):
    """Messages of mixed kinds in random order, with values of every JSON type."""
    values = [None, True, 0, -7, 1.5, "", "ß → \"q\"", [1, [2]], {"z": 1, "a": {"k": None}}]
    out = []
    for _ in range(count):
        kind = rng.choice(["RECORD", "RECORD", "STATE", "LOG"])
        data = {f"f{i}": rng.choice(values) for i in rng.sample(range(9), rng.randint(0, 4))}
        if kind == "RECORD":
            body = {"stream": "gauges", "data": data}
            if rng.random() < 0.7:
                body["emitted_at"] = rng.choice([None, f"t{rng.randrange(50):03}"])
        elif kind == "STATE":
            body = {"data": data}
        else:
            body = {"level": rng.choice(["LOW", "HIGH"]), "message": f"m {rng.random()}"}
        out.append({"type": kind, kind.lower(): body})
    return out


def test_random_messages_against_a_plain_split(spark):
    rng = random.Random(21)
    wholes = [generated_messages(rng, rng.randrange(60)) for _ in range(12)]
    tables = read_messages(docs(spark, *[{"messages": m} for m in wholes]), "doc", "text")
    assert tables.errors.count() == 0
    want, texts = {}, {}
    for number, messages in enumerate(wholes):
        own = [[m for m in messages if m["type"] == k] for k in ("RECORD", "STATE", "LOG")]
        stream = "gauges" if own[0] else "it"
        texts[number] = []
        for kind, listed in zip(("Record", "State", "Log"), own, strict=True):
            for i, m in enumerate(listed):
                body = m[kind.upper().lower()]
                text = body.get("message") or json.dumps(
                    body.get("data"), sort_keys=True, ensure_ascii=False
                )
                name = f"{stream}:{kind.lower()}:{i}"
                want[number, name] = (f"Structured{kind}", text, body.get("emitted_at"))
                texts[number].append(text)
    separate = RecordTables(tables.records, tables.states, tables.logs)
    for read in (tables, separate):
        elements = elements_from_records(read, ["doc"])
        rows = elements.collect()
        assert len(rows) == len(want)
        for r in rows:
            emitted = json.loads(r.metadata).get("emitted_at")
            assert (r.type, r.text, emitted) == want[r.doc, r.element_id]
        joined = {
            r.doc: r.normalized_text
            for r in normalized_text(elements, ["doc"], "\n", False).collect()
        }
        assert joined == {n: "\n".join(t) for n, t in texts.items() if t}


def test_elements_without_a_stream(spark):
    only_log = {"messages": [{"type": "LOG", "log": {"level": "I", "message": "m"}}]}
    tables = read_messages(docs(spark, only_log), "doc", "text")
    assert elements_from_records(tables, ["doc"]).first().element_id == "it:log:0"


@given_tables
def test_lines_of_given_rows(spark):
    """Record and log lines of table rows, read back as JSON and compared field by field."""
    parts = spark.read.parquet(f"{FOLDER}/part.parquet").selectExpr(
        "p_partkey AS record_index", "p_brand AS stream", "p_type AS emitted_at",
        "to_json(struct(p_name, p_size)) AS data",
    )
    lines = {r.ord: r.line for r in record_lines(parts).collect()}
    rows = parts.collect()
    assert len(lines) == len(rows) > 0
    for r in rows:
        fields = {"data": json.loads(r.data), "emitted_at": r.emitted_at}
        fields |= {"record_index": r.record_index, "stream": r.stream}
        text = json.dumps(fields, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert lines[r.record_index] == text
    logs = parts.selectExpr("record_index AS log_index", "stream AS level", "data AS message")
    for r in log_lines(logs).collect():
        whole = json.loads(r.line)
        assert list(whole) == ["level", "log_index", "message"] and whole["log_index"] == r.ord


BAD = [
    ("{", "malformed_json"),
    ([1], "document_not_an_object"),
    ({"messages": {}}, "messages_not_a_list"),
    ({"messages": [3]}, "message_not_an_object"),
    ({"messages": [{"type": "X"}]}, "unsupported_message_type"),
    ({"messages": [{"type": "RECORD"}]}, "record_not_an_object"),
    (
        {"messages": [{"type": "RECORD", "record": {"stream": 5, "data": {}}}]},
        "record_stream_not_a_filled_string",
    ),
    (
        {"messages": [{"type": "RECORD", "record": {"stream": "s", "data": []}}]},
        "record_data_not_an_object",
    ),
    (
        {"messages": [{"type": "RECORD", "record": {"stream": "s", "data": {}, "emitted_at": 1.0}}]},
        "record_emitted_at_not_a_string",
    ),
    ({"messages": [{"type": "STATE", "state": {"data": None}}]}, "state_data_not_an_object"),
    (
        {"messages": [{"type": "LOG", "log": {"level": "", "message": "m"}}]},
        "log_level_not_a_filled_string",
    ),
]


GOOD = {"messages": [{"type": "RECORD", "record": {"stream": "s", "data": {}}}]}


def test_bad_messages_reject_their_document(spark):
    tables = read_messages(docs(spark, *[b for b, _ in BAD], GOOD), "doc", "text")
    errors = {r.doc: r.problem for r in tables.errors.collect()}
    assert errors == {i: problem for i, (_, problem) in enumerate(BAD)}
    assert [r.doc for r in tables.records.collect()] == [len(BAD)]


def test_record_list(spark):
    good = {"stream": "s", "records": [{"data": {"a": 1}, "emitted_at": "x"}, {"data": {}}]}
    bad = {"stream": "", "records": []}
    tables = read_record_list(docs(spark, good, bad), "doc", "text")
    rows = tables.records.orderBy("record_index").collect()
    assert [(r.data, r.emitted_at) for r in rows] == [('{"a":1}', "x"), ("{}", None)]
    assert tables.errors.first().problem == "stream_not_a_filled_string"
    assert tables.states.count() == tables.logs.count() == 0


def test_pages(spark):
    bodies = [
        ("s", 1, {"records": [{"a": 1}, {"a": 2}], "next_cursor": "n1"}),
        ("s", 2, {"records": [], "next_cursor": "n2"}),
        ("s", 3, {"records": [{"a": 3}], "next_cursor": None}),
        ("t", 1, {"records": [7], "next_cursor": None}),
    ]
    pages = spark.createDataFrame(
        [(k, n, json.dumps(b), "u", "x") for k, n, b in bodies],
        "k string, page_number long, body string, source_url string, stream string",
    )
    tables = read_paged(pages, ["k"])
    rows = tables.records.orderBy("record_index").collect()
    assert [(r.record_index, r.data, r.emitted_at) for r in rows] == [
        (0, '{"a":1}', None),
        (1, '{"a":2}', None),
        (2, '{"a":3}', None),
    ]
    logs = [r.message for r in tables.logs.orderBy("log_index").collect()]
    assert logs[-1] == "source exhausted after page=3" and len(logs) == 4
    assert [(r.k, r.problem) for r in tables.errors.collect()] == [("t", "record_not_an_object")]


ORIGIN = {"connection_name": "c", "schema": "s", "table": "t"}


@pytest.mark.parametrize(("count", "start"), [(0, None), (10, None), (11, "00003"), (5, "99999")])
def test_incremental_read_follows_the_batch_loop(spark, count, start):
    data = [(f"{i:05d}", i * 1.5) for i in range(count)]
    df = spark.createDataFrame(data, "id string, v double")
    tables = read_incremental(df, ["id", "v"], "id", start, 5, "st", ORIGIN)
    wanted = [r for r in data if start is None or r[0] > start]
    messages, batches = [], []
    for n, at in enumerate(range(0, len(wanted), 5), start=1):
        batch = wanted[at : at + 5]
        batches.append((batch[-1][0], len(batch)))
        messages.append(f"fetched batch={n} rows={len(batch)} cursor={batch[-1][0]}")
    messages.append(f"source exhausted after batch={len(batches) + 1}")
    states = [json.loads(r.data) for r in tables.states.orderBy("state_index").collect()]
    assert [(s["cursor"], s["row_count"]) for s in states] == batches
    assert [r.message for r in tables.logs.orderBy("log_index").collect()] == messages
    records = tables.records.orderBy("record_index").collect()
    assert [r.emitted_at for r in records] == [r[0] for r in wanted]
    assert [json.loads(r.data)["v"] for r in records] == [r[1] for r in wanted]


def test_document_store_state_names(spark):
    df = spark.createDataFrame([("a", 1)], "id string, v long")
    origin = {"connection_name": "c", "database": "d", "collection": "k"}
    tables = read_incremental(df, ["id", "v"], "id", None, 5, "st", origin, documents=True)
    state = json.loads(tables.states.first().data)
    assert state["document_count"] == 1 and state["cursor_field"] == "id"
    assert tables.logs.orderBy("log_index").first().message.startswith("fetched batch=1 documents=1")


def test_cursor_violations(spark):
    df = spark.createDataFrame(
        [(1, "b"), (2, "b"), (3, None), (4, "c"), (5, "a")], "n long, c string"
    )
    got = check_cursor(df, "c", "b", [], ["n"]).orderBy("n").collect()
    assert [(r.n, r.problem) for r in got] == [
        (1, "cursor_did_not_advance"),
        (2, "cursor_did_not_advance"),
        (3, "cursor_not_a_filled_string"),
        (5, "cursor_did_not_advance"),
    ]


def test_offsets(spark):
    log = [("t", 0, o, '{"n":%d}' % o) for o in range(6)] + [("t", 1, 0, "[]"), ("t", 1, 1, "{}")]
    df = spark.createDataFrame(log, "topic string, partition int, offset long, value string")
    tables = read_offsets(df, 2, "s", "c", offset_start=1)
    rows = tables.records.filter("partition = 0").orderBy("record_index").collect()
    assert [r.emitted_at for r in rows] == [f"{o:020d}" for o in (2, 3, 4, 5)]
    every = read_offsets(df, 2, "s", "c")
    assert [(r.partition, r.problem) for r in every.errors.collect()] == [
        (1, "value_not_a_json_object")
    ]
    for part in (every.records, every.states, every.logs):
        assert {r.partition for r in part.collect()} == {0}
    assert every.records.count() == 6
    late = read_offsets(df, 2, "s", "c", offset_start=5)
    assert late.records.count() == 0
    assert {(r.partition, r.message) for r in late.logs.collect()} == {
        (0, "source exhausted after batch=1"),
        (1, "source exhausted after batch=1"),
    }
    options = log_reader_options(["b:2", "a:1"], "t", {0: None, 1: 4})
    assert json.loads(options["startingOffsets"]) == {"t": {"0": -2, "1": 5}}
    assert options["kafka.bootstrap.servers"] == "a:1,b:2"


def test_bad_offsets_withhold_their_partition(spark):
    log = [("t", 0, -1, "{}"), ("t", 0, 2, "{}"), ("t", 1, 3, "{}"), ("t", 1, 3, "[]")]
    log += [("t", 2, None, "{}"), ("t", 3, 1, "{}"), ("t", 3, 7, None), ("t", 4, 1, "{}")]
    df = spark.createDataFrame(log, "topic string, partition int, offset long, value string")
    tables = read_offsets(df, 2, "s", "c", contract={"read_model": "m", "a": 1})
    assert {(r.partition, r.offset, r.problem) for r in tables.errors.collect()} == {
        (0, -1, "offset_negative"),
        (1, 3, "offset_did_not_advance"),
        (2, None, "offset_missing"),
        (3, 7, "value_not_a_json_object"),
    }
    assert [r.partition for r in tables.records.collect()] == [4]
    state = json.loads(tables.states.first().data)
    assert state["source_operational_contract"] == {"read_model": "m", "a": 1}


@pytest.mark.parametrize("bad", [None, "", "a"])
def test_bad_cursors_withhold_the_read(spark, bad):
    df = spark.createDataFrame([("a", 1), ("b", 2), (bad, 3)], "id string, v long")
    tables = read_incremental(df, ["id", "v"], "id", None, 5, "st", ORIGIN)
    problem = "cursor_did_not_advance" if bad else "cursor_not_a_filled_string"
    assert [(r.cursor, r.problem) for r in tables.errors.collect()] == [(bad, problem)]
    for part in (tables.records, tables.states, tables.logs):
        assert part.count() == 0


def test_normalize_values(spark):
    df = spark.sql(
        "select timestamp_ntz'2026-01-02 03:04:05.5' a, date'2026-01-02' b, "
        "cast(0 as decimal(12,10)) c, array(cast(1.50 as decimal(4,2))) d, "
        "map('z', date'2026-01-02', 'a', null) e, timestamp'2026-01-02 03:04:05Z' f"
    )
    normal = normalize_values(df)
    row = normal.select(*[json_value(normal, c).alias(c) for c in df.columns]).first()
    assert row.asDict() == {
        "a": '"2026-01-02T03:04:05.500000"',
        "b": '"2026-01-02"',
        "c": '"0.0000000000"',
        "d": '["1.50"]',
        "e": '{"a":null,"z":"2026-01-02"}',
        "f": '"2026-01-02T03:04:05+00:00"',
    }
    with pytest.raises(TypeError):
        normalize_values(spark.sql("select map(1, 'x') m"))
    with pytest.raises(TypeError):
        normalize_values(spark.sql("select cast('x' as binary) m"))


def test_progress_kinds(spark):
    cases = {
        '{"cursor":"a","token":"b"}': "cursor_v1",
        '{"cursor":"","page_token":"b"}': "token_v1",
        '{"page_number":3}': "page_v1",
        '{"page_number":3.0}': "state_dict_v1",
        '{"page":true}': "state_dict_v1",
        "{}": "state_dict_v1",
    }
    df = spark.createDataFrame([(k,) for k in cases], "data string")
    assert {r.data: r.progress_kind for r in progress_kind(df).collect()} == cases


def test_checkpoint_chain_and_resume_cover_everything(spark):
    n = 40
    records = spark.range(n).select(
        F.lit("d").alias("doc"),
        F.lit("s").alias("stream"),
        F.col("id").alias("record_index"),
        F.lit("{}").alias("data"),
        F.lpad(F.col("id").cast("string"), 4, "0").alias("emitted_at"),
    )
    states = records.filter("(record_index + 1) % 10 = 0").select(
        "doc",
        "stream",
        F.floor(F.col("record_index") / 10).alias("state_index"),
        F.concat(F.lit('{"cursor":"'), "emitted_at", F.lit('"}')).alias("data"),
    )
    tasks = spark.createDataFrame([("d", "p", "x")], "doc string, pipeline_version string, sha256 string")
    chain = build_checkpoints(records, states, tasks, ["doc"]).orderBy("checkpoint_index").collect()
    assert chain[0].parent_checkpoint_identity_key is None
    for before, after in zip(chain, chain[1:], strict=False):
        assert after.parent_checkpoint_identity_key == before.checkpoint_identity_key
    for entry in chain:
        cursor = json.loads(entry.progress)["cursor"]
        selection = spark.createDataFrame(
            [("d", cursor, None)], "doc string, exclusive_after_cursor string, issue_code string"
        )
        rest, later, blocked = resume_filter(records, states, selection, ["doc"])
        done = records.filter(F.col("emitted_at") <= cursor).count()
        assert done + rest.count() == n
        assert later.count() == len(chain) - 1 - entry.checkpoint_index
        assert blocked.count() == 0


def test_a_record_without_emit_time_blocks(spark):
    records = spark.createDataFrame(
        [("d", 0, None), ("d", 1, "9"), ("e", 0, "9")],
        "doc string, record_index long, emitted_at string",
    )
    states = spark.createDataFrame([], "doc string, state_index long, data string")
    selection = spark.createDataFrame(
        [("d", "1", None), ("e", "1", None)],
        "doc string, exclusive_after_cursor string, issue_code string",
    )
    rest, _, blocked = resume_filter(records, states, selection, ["doc"])
    assert [r.doc for r in rest.collect()] == ["e"]
    assert [(r.doc, r.issue_code) for r in blocked.collect()] == [
        ("d", "missing_record_emitted_at")
    ]


def test_checkpoint_compat_of_a_full_artifact(spark):
    artifact = {
        "schema_version": 1,
        "flow_kind": "it",
        "stream": "s",
        "task_identity_key": "t",
        "provenance": {
            "task_identity_key": "t",
            "run_origin": "resume",
            "delivery_origin": "primary",
            "execution_mode": "batch",
            "resumed_from_checkpoint_identity_key": "c",
            "resume": {
                "checkpoint_identity_key": "c",
                "progress_kind": "cursor_v1",
                "continuation": {"exclusive_after_cursor": "x"},
            },
        },
        "checkpoints": [],
    }
    broken = json.loads(json.dumps(artifact))
    broken["provenance"]["resume"]["continuation"]["exclusive_after_cursor"] = ""
    rows = checkpoint_compat(docs(spark, artifact, broken), "text").orderBy("doc").collect()
    assert [(r.status, r.reason) for r in rows] == [
        ("supported", None),
        ("malformed", "resume_cursor_not_a_filled_string"),
    ]


def test_checkpoint_artifact_of_a_long_read(spark):
    """An artifact larger than one variant may be is checked and read whole."""
    entry = F.concat(
        F.lit('{"checkpoint_index":1,"checkpoint_identity_key":"c","progress":{"cursor":"'),
        F.repeat(F.col("x"), 1_000_000),
        F.lit('"}}'),
    )
    head = '{"schema_version":1,"flow_kind":"it","stream":"s","task_identity_key":"t","checkpoints":'
    df = spark.createDataFrame([(0, "x"), (1, "x"), (2, "x"), (3, "x")], "k int, x string").select(
        "k",
        F.when(
            F.col("k") == 0,
            F.concat(F.lit(head + "["), F.array_join(F.array_repeat(entry, 140), ","), F.lit("]}")),
        )
        .when(F.col("k") == 1, '{"checkpoints":{},' + head[1:-15] + "}")
        .when(F.col("k") == 2, F.concat(F.lit(head), F.repeat(F.col("x"), 135_000_000)))
        .when(F.col("k") == 3, head + "[null]}")
        .alias("text"),
    )
    got = {r.k: (r.status, r.reason) for r in checkpoint_compat(df, "text").drop("text").collect()}
    assert got == {
        0: ("supported", None),
        1: ("malformed", "checkpoints_not_a_list"),
        2: ("malformed", "entry_too_large_or_not_a_json_object"),
        3: ("malformed", "entry_not_an_object"),
    }
    entries = read_checkpoint_entries(df.filter("k = 0"), "k", "text").select(
        "position", "stream", F.length("progress").alias("chars"), "progress_kind"
    )
    rows = entries.collect()
    assert [r.position for r in rows] == list(range(140))
    assert {(r.stream, r.chars, r.progress_kind) for r in rows} == {("s", 1_000_013, "cursor_v1")}


def test_large_documents(spark):
    """A document larger than one variant may be, of many messages, is read whole."""
    record = '{"type":"RECORD","record":{"stream":"s","data":{"n":%d,"t":"' + "x" * 1000 + '"}}}'
    whole = '{"messages":[' + ",".join(record % i for i in range(21_000)) + "]}"
    assert len(whole) > 20 << 20
    listed = whole.replace('"messages"', '"stream":"s","records"')
    df = spark.createDataFrame([(1, whole, listed)], "k int, m string, r string")
    tables = read_messages(df, "k", "m")
    assert tables.errors.count() == 0 and tables.records.count() == 21_000
    last = tables.records.filter("record_index = 20999").first()
    assert json.loads(last.data)["n"] == 20_999
    items = '{"stream":"s","records":[' + ",".join(
        '{"data":{"n":%d,"t":"%s"}}' % (i, "y" * 500) for i in range(40_000)
    ) + "]}"
    many = read_record_list(spark.createDataFrame([(1, items)], "k int, r string"), "k", "r")
    assert many.errors.count() == 0 and many.records.count() == 40_000


def test_repeated_keys_and_large_numbers(spark):
    number = "1" * 41
    data = f'{{"a":1,"b":{number},"c":-2.5e400,"d":1.0,"a":{{"x":1,"x":2}}}}'
    text = f'{{"messages":[1],"messages":[{{"type":"RECORD","record":{{"stream":"s","data":{data}}}}}]}}'
    df = spark.createDataFrame([(1, text)], "k int, m string")
    tables = read_messages(df, "k", "m")
    assert tables.records.first().data == f'{{"a":{{"x":2}},"b":{number},"c":-2.5e400,"d":1.0}}'


def test_reasons_of_bad_documents(spark):
    texts = ["[1]", "{", '{"messages":{}}', "7", "null", '{"messages":[]} x', "{'messages':[]}"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, m string")
    got = {r.k: r.problem for r in read_messages(df, "k", "m").errors.collect()}
    assert got == {
        0: "document_not_an_object",
        1: "malformed_json",
        2: "messages_not_a_list",
        3: "document_not_an_object",
        4: "document_not_an_object",
        5: "malformed_json",
        6: "malformed_json",
    }


def test_strings_of_any_length(spark):
    """A string of 25 million characters goes through every reader, at any depth."""
    long = "x" * 25_000_000
    record = json.dumps({"n": 1, "deep": [{"t": long}]})
    whole = f'{{"messages":[{{"type":"RECORD","record":{{"stream":"s","data":{record}}}}}]}}'
    listed = f'{{"stream":"s","records":[{{"data":{record}}}]}}'
    page = f'{{"records":[{record}],"next_cursor":null}}'
    df = spark.createDataFrame(
        [(1, whole, listed, page, record)], "k int, m string, r string, p string, v string"
    )
    pages = df.selectExpr("k", "1 AS page_number", "'u' AS source_url", "'s' AS stream", "p AS body")
    log = df.selectExpr("'t' AS topic", "0 AS partition", "5L AS offset", "v AS value")
    for tables in (
        read_messages(df, "k", "m"),
        read_record_list(df, "k", "r"),
        read_paged(pages, ["k"]),
        read_offsets(log, 10, "s", "c"),
    ):
        assert tables.errors.count() == 0
        sizes = tables.records.select(
            F.length("data").alias("n"), F.substring("data", 1, 20).alias("head")
        ).collect()
        assert [(r.n, r.head) for r in sizes] == [(25_000_025, '{"deep":[{"t":"xxxxx')]


def test_an_item_beyond_a_variant_has_its_own_reason(spark):
    rows = spark.createDataFrame([(1,)], "k int")
    text = F.concat(
        F.lit('{"messages":[{"type":"STATE","state":{"data":{"t":"'),
        F.repeat(F.lit("x" * 1000), 140_000),
        F.lit('"}}}]}'),
    )
    errors = read_messages(rows.withColumn("m", text), "k", "m").errors.collect()
    assert [r.problem for r in errors] == ["item_too_large_or_malformed_json"]
