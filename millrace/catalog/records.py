"""Queries over record reads, checkpoints and source specifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import Catalog, pick, sql_pick, table
from millrace.catalog.fixtures import event_offsets
from millrace.functions import identity
from millrace.functions import jsontext as J
from millrace.operators.ancestry import checkpoint_ancestry
from millrace.operators.checkpoints import (
    build_checkpoints,
    checkpoint_compat,
    progress_kind,
    read_checkpoint_entries,
    resume_filter,
    resume_provenance,
    select_resume,
)
from millrace.operators.delivery import record_evidence
from millrace.operators.elements import elements_from_records
from millrace.operators.sinks import log_lines, record_lines
from millrace.plans.records import RecordIngest, ingest_records
from millrace.session import stored
from millrace.sources.incremental import check_cursor, read_incremental, read_offsets
from millrace.sources.normalize import json_value, normalize_values
from millrace.sources.records import read_messages, read_paged, read_record_list
from millrace.sources.specs import classify_source_spec, source_identity
from millrace.sources.tables import RecordTables

catalog = Catalog()

BATCH = 500
START = "00000000000000000099"
COLUMNS = ("cursor", "o_custkey", "o_orderstatus", "o_orderdate")
ORIGIN = {"connection_name": "main", "schema": "public", "table": "orders"}
OFFSET_BATCH = 7


def order_read(spark: SparkSession, folder: str) -> RecordTables:
    """Orders by their zero-padded key, from a start value on."""
    orders = table(spark, folder, "orders").withColumn(
        "cursor", F.lpad(F.col("o_orderkey").cast("string"), 20, "0")
    )
    # A unique key cut to its leading digits: at most a million rows in a slice.
    return read_incremental(
        orders, COLUMNS, "cursor", START, BATCH, "orders", ORIGIN,
        slice_by=F.col("cursor").substr(1, 14),
    )


_ORDERS_SQL = f"""SELECT *, row_number() OVER (ORDER BY cursor) - 1 AS i
 FROM (SELECT lpad(CAST(o_orderkey AS VARCHAR), 20, '0') AS cursor, * FROM orders)
 WHERE cursor > '{START}'"""
_BATCHES_SQL = f"""SELECT i // {BATCH} AS b, max(cursor) AS cursor, count(*) AS n
 FROM ({_ORDERS_SQL}) GROUP BY 1"""


@catalog.add(
    "incremental_records",
    f"""SELECT 'orders' AS stream, i AS record_index, '{{"cursor":"' || cursor || '","o_custkey":' ||
 o_custkey || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') ||
 '","o_orderstatus":"' || o_orderstatus || '"}}' AS data, cursor AS emitted_at FROM ({_ORDERS_SQL})""",
)
def incremental_records(spark: SparkSession, folder: str) -> DataFrame:
    return order_read(spark, folder).records


@catalog.add(
    "incremental_states",
    f"""SELECT 'orders' AS stream, b AS state_index,
 '{{"columns":["cursor","o_custkey","o_orderstatus","o_orderdate"],"connection_name":"main",' ||
 '"cursor":"' || cursor || '","cursor_column":"cursor","read_direction":"asc","row_count":' || n ||
 ',"schema":"public","table":"orders"}}' AS data FROM ({_BATCHES_SQL})""",
)
def incremental_states(spark: SparkSession, folder: str) -> DataFrame:
    return order_read(spark, folder).states


@catalog.add(
    "incremental_logs",
    f"""SELECT 'orders' AS stream, b AS log_index, 'INFO' AS level,
 'fetched batch=' || (b + 1) || ' rows=' || n || ' cursor=' || cursor AS message FROM ({_BATCHES_SQL})
UNION ALL SELECT 'orders', coalesce(max(b), -1) + 1, 'INFO',
 'source exhausted after batch=' || (coalesce(max(b), -1) + 2) FROM ({_BATCHES_SQL})""",
)
def incremental_logs(spark: SparkSession, folder: str) -> DataFrame:
    return order_read(spark, folder).logs


@catalog.add(
    "incremental_errors",
    """SELECT 'orders' AS stream, cursor, 'cursor_did_not_advance' AS problem
FROM (SELECT strftime(o_orderdate, '%Y-%m-%d') AS cursor FROM orders)
GROUP BY cursor HAVING count(*) > 1
UNION ALL SELECT 'refused', CAST(o_orderkey AS VARCHAR), 'delivered' FROM orders WHERE o_orderkey < 0""",
)
def incremental_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates repeat, so the read is refused: its records would show as delivered."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("cursor")
    )
    read = read_incremental(
        orders, ["cursor", "o_orderkey"], "cursor", None, BATCH, "orders", ORIGIN,
        slice_by=F.col("cursor").substr(1, 7),
    )
    delivered = read.records.select(
        F.lit("refused").alias("stream"),
        F.col("emitted_at").alias("cursor"),
        F.lit("delivered").alias("problem"),
    )
    return read.errors.unionByName(delivered)


@catalog.add(
    "cursor_violations",
    """SELECT o_orderkey, cursor, previous_cursor, 'cursor_did_not_advance' AS problem
FROM (SELECT o_orderkey, cursor, coalesce(lag(cursor) OVER (ORDER BY o_orderkey), '1997-01-01')
  AS previous_cursor
 FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS cursor FROM orders))
WHERE cursor <= previous_cursor""",
)
def cursor_violations(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("cursor")
    )
    return check_cursor(
        orders, "cursor", "1997-01-01", [], ["o_orderkey"],
        slice_by=F.floor(F.col("o_orderkey") / 1_000_000),
    )


@catalog.add(
    "cursor_violations_by_range",
    """SELECT l_suppkey, arrival, cursor, previous_cursor, 'cursor_did_not_advance' AS problem
FROM (SELECT *, lag(cursor) OVER (PARTITION BY l_suppkey ORDER BY arrival) AS previous_cursor
 FROM (SELECT DISTINCT l_suppkey, printf('%012d-%02d-%09d', l_orderkey, l_linenumber, l_partkey)
   AS arrival, strftime(max(l_shipdate) OVER (PARTITION BY l_suppkey, l_orderkey, l_linenumber,
    l_partkey), '%Y-%m-%d') AS cursor FROM lineitem))
WHERE cursor <= previous_cursor""",
)
def cursor_violations_by_range(spark: SparkSession, folder: str) -> DataFrame:
    """Without a known slice the rows are range-partitioned on the order itself."""
    items = table(spark, folder, "lineitem")
    arrival = F.format_string(
        "%012d-%02d-%09d", "l_orderkey", "l_linenumber", "l_partkey"
    )
    rows = (
        items.select("l_suppkey", arrival.alias("arrival"), "l_shipdate")
        .groupBy("l_suppkey", "arrival")
        .agg(F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("cursor"))
    )
    return check_cursor(rows, "cursor", None, ["l_suppkey"], ["arrival"])


OFFSET_CONTRACT = {"source_kind": "kafka_partition_offset_v1", "offset_cursor_width": 20}


def offset_read(spark: SparkSession, folder: str) -> RecordTables:
    return read_offsets(
        event_offsets(spark, folder), OFFSET_BATCH, "events", "log", 9, contract=OFFSET_CONTRACT
    )


_OFFSETS_SQL = """SELECT user_id, event_id, props,
 row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events WHERE event_id > 9"""
_OFFSET_BATCHES_SQL = f"""SELECT user_id, i // {OFFSET_BATCH} AS b, max(event_id) AS last, count(*) AS n
 FROM ({_OFFSETS_SQL}) GROUP BY 1, 2"""


@catalog.add(
    "offset_records",
    f"""SELECT 'events' AS topic, CAST(user_id AS INTEGER) AS partition, 'events' AS stream,
 i AS record_index, CAST(json(props) AS VARCHAR) AS data,
 lpad(CAST(event_id AS VARCHAR), 20, '0') AS emitted_at FROM ({_OFFSETS_SQL})""",
)
def offset_records(spark: SparkSession, folder: str) -> DataFrame:
    return offset_read(spark, folder).records


@catalog.add(
    "offset_states",
    f"""SELECT 'events' AS topic, CAST(user_id AS INTEGER) AS partition, 'events' AS stream,
 b AS state_index, '{{"connection_name":"log","cursor":"' || lpad(CAST(last AS VARCHAR), 20, '0') ||
 '","last_offset":' || last || ',"partition":' || user_id ||
 ',"read_direction":"asc","read_mode":"explicit_partition_offset","record_count":' || n ||
 ',"source_operational_contract":{{"offset_cursor_width":20,"source_kind":"kafka_partition_offset_v1"}}' ||
 ',"topic":"events"}}' AS data FROM ({_OFFSET_BATCHES_SQL})""",
)
def offset_states(spark: SparkSession, folder: str) -> DataFrame:
    return offset_read(spark, folder).states


@catalog.add(
    "offset_logs",
    f"""SELECT 'events' AS topic, CAST(user_id AS INTEGER) AS partition, 'events' AS stream,
 b AS log_index, 'INFO' AS level,
 'fetched batch=' || (b + 1) || ' records=' || n || ' offset=' || last AS message
FROM ({_OFFSET_BATCHES_SQL})
UNION ALL SELECT 'events', CAST(e.user_id AS INTEGER), 'events', coalesce(max(b), -1) + 1, 'INFO',
 'source exhausted after batch=' || (coalesce(max(b), -1) + 2)
FROM (SELECT DISTINCT user_id FROM events) e LEFT JOIN ({_OFFSET_BATCHES_SQL}) USING (user_id)
GROUP BY e.user_id""",
)
def offset_logs(spark: SparkSession, folder: str) -> DataFrame:
    return offset_read(spark, folder).logs


_DIRTY = "event_type IN ('view', 'click')"


@catalog.add(
    "offset_clean_records",
    f"""SELECT 'events' AS topic, CAST(user_id AS INTEGER) AS partition, 'events' AS stream,
 row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS record_index,
 CAST(json(props) AS VARCHAR) AS data, lpad(CAST(event_id AS VARCHAR), 20, '0') AS emitted_at
FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE {_DIRTY} AND event_id % 50 = 0)""",
)
def offset_clean_records(spark: SparkSession, folder: str) -> DataFrame:
    """Only partitions without a bad value are delivered."""
    return read_offsets(dirty_log(spark, folder, 50), OFFSET_BATCH, "events", "log").records


@catalog.add(
    "offset_errors",
    """SELECT 'events' AS topic, CAST(user_id AS INTEGER) AS partition, event_id AS "offset",
 'value_not_a_json_object' AS problem FROM events WHERE event_type IN ('view', 'click')""",
)
def offset_errors(spark: SparkSession, folder: str) -> DataFrame:
    return read_offsets(dirty_log(spark, folder), OFFSET_BATCH, "events", "log").errors


def dirty_log(spark: SparkSession, folder: str, every: int = 1) -> DataFrame:
    """Views carry a broken value and clicks a list, where the id divides by ``every``."""
    e = table(spark, folder, "events")
    dirty = F.col("event_id") % every == 0
    value = (
        F.when(dirty & (F.col("event_type") == "view"), F.concat(F.col("props"), F.lit("}")))
        .when(dirty & (F.col("event_type") == "click"), F.concat(F.lit("["), "props", F.lit("]")))
        .otherwise(F.col("props"))
    )
    return e.select(
        F.lit("events").alias("topic"),
        F.col("user_id").cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        value.alias("value"),
    )


def event_messages(spark: SparkSession, folder: str) -> DataFrame:
    """One message document per event: a log, a record and a state.

    Signups put a second record under another stream name, which is an error.
    """
    e = table(spark, folder, "events")
    key = F.col("event_id").cast("string")
    record = F.concat(
        F.lit('{"type":"RECORD","record":{"stream":"'),
        "event_type",
        F.lit('","data":{"user":'),
        F.col("user_id").cast("string"),
        F.lit(',"props":'),
        "props",
        F.lit(',"ratio":1.0},"emitted_at":'),
        F.when(F.col("event_id") % 3 > 0, F.concat(F.lit('"'), F.lpad(key, 12, "0"), F.lit('"')))
        .otherwise("null"),
        F.lit("}}"),
    )
    other = F.lit(',{"type":"RECORD","record":{"stream":"other","data":{}}}')
    state = F.concat(F.lit('{"type":"STATE","state":{"data":{"cursor":"'), key, F.lit('"}}}'))
    text = F.concat(
        F.lit('{"messages":[{"type":"LOG","log":{"level":"INFO","message":"event '),
        key,
        F.lit('"}},'),
        record,
        F.when(F.col("event_type") == "signup", other).otherwise(""),
        F.lit(","),
        state,
        F.lit("]}"),
    )
    return e.select("event_id", text.alias("text"))


_EMITTED = "CASE WHEN event_id % 3 > 0 THEN lpad(CAST(event_id AS VARCHAR), 12, '0') END"
_K = "regexp_extract(props, '[0-9]+')"


@catalog.add(
    "message_records",
    f"""SELECT event_id, event_type AS stream, CAST(0 AS INTEGER) AS record_index, '{{"props":{{"k":' || {_K} ||
 '}},"ratio":1.0,"user":' || user_id || '}}' AS data, {_EMITTED} AS emitted_at
FROM events WHERE event_type <> 'signup'""",
)
def message_records(spark: SparkSession, folder: str) -> DataFrame:
    return read_messages(event_messages(spark, folder), "event_id", "text").records


@catalog.add(
    "message_errors",
    """SELECT event_id, 'more_than_one_stream' AS problem FROM events WHERE event_type = 'signup'""",
)
def message_errors(spark: SparkSession, folder: str) -> DataFrame:
    return read_messages(event_messages(spark, folder), "event_id", "text").errors


@catalog.add(
    "record_elements",
    f"""WITH e AS (SELECT *, '{{"k":' || {_K} || '}}' AS p, '{{"k": ' || {_K} || '}}' AS ps,
  coalesce('"' || {_EMITTED} || '"', 'null') AS em FROM events WHERE event_type <> 'signup')
SELECT event_id, event_type || ':record:0' AS element_id, 'StructuredRecord' AS type,
 '{{"props": ' || ps || ', "ratio": 1.0, "user": ' || user_id || '}}' AS text,
 '{{"artifact_kind":"record","data":{{"props":' || p || ',"ratio":1.0,"user":' || user_id ||
 '}},"emitted_at":' || em || ',"flow_kind":"it","record_index":0,"stream":"' || event_type || '"}}'
 AS metadata FROM e
UNION ALL SELECT event_id, event_type || ':state:0', 'StructuredState',
 '{{"cursor": "' || event_id || '"}}', '{{"artifact_kind":"state","data":{{"cursor":"' || event_id ||
 '"}},"flow_kind":"it","state_index":0}}' FROM e
UNION ALL SELECT event_id, event_type || ':log:0', 'StructuredLog', 'event ' || event_id,
 '{{"artifact_kind":"log","flow_kind":"it","level":"INFO","log_index":0}}' FROM e""",
)
def record_elements(spark: SparkSession, folder: str) -> DataFrame:
    tables = read_messages(event_messages(spark, folder), "event_id", "text")
    return elements_from_records(tables, ["event_id"]).drop("ord")


@catalog.add(
    "artifact_lines",
    f"""SELECT event_id, '{{"data":{{"props":{{"k":' || {_K} || '}},"ratio":1.0,"user":' || user_id ||
 '}},"emitted_at":' || coalesce('"' || {_EMITTED} || '"', 'null') ||
 ',"record_index":0,"stream":"' || event_type || '"}}' AS line FROM events WHERE event_type <> 'signup'
UNION ALL SELECT event_id, '{{"level":"INFO","log_index":0,"message":"event ' || event_id || '"}}'
FROM events WHERE event_type <> 'signup'""",
)
def artifact_lines(spark: SparkSession, folder: str) -> DataFrame:
    tables = read_messages(event_messages(spark, folder), "event_id", "text")
    lines = record_lines(tables.records, "event_id").unionByName(
        log_lines(tables.logs, "event_id")
    )
    return lines.drop("ord")


@catalog.add(
    "record_list",
    """SELECT o_orderkey, 'orders' AS stream, CAST(j AS INTEGER) AS record_index,
 '{"line":' || j || ',"status":"' || o_orderstatus || '"}' AS data,
 CASE WHEN j = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS emitted_at
FROM orders, (SELECT unnest([0, 1]) AS j) WHERE o_orderpriority <> '5-LOW'""",
)
def record_list(spark: SparkSession, folder: str) -> DataFrame:
    """Two records per order; low-priority orders carry a record without data."""
    o = table(spark, folder, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.concat(
        F.lit('{"stream":"orders","records":[{"data":{"status":"'),
        "o_orderstatus",
        F.lit('","line":0},"emitted_at":"'),
        day,
        F.lit('"},'),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit('{"emitted_at":null}')).otherwise(
            F.concat(
                F.lit('{"data":{"line":1,"status":"'), "o_orderstatus", F.lit('"}}')
            )
        ),
        F.lit("]}"),
    )
    return read_record_list(o.select("o_orderkey", text.alias("text")), "o_orderkey", "text").records


def conversation_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A conversation is a source and each turn one page of two records, one with its text.

    In every seventh conversation the cursor repeats itself.
    """
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("__last"))
    turn = F.col("turn").cast("string")
    cursor = F.when(F.col("conv_id") % 7 == 0, F.lit("same")).otherwise(F.concat(F.lit("t"), turn))
    body = F.concat(
        F.lit('{"records":[{"turn":'),
        turn,
        F.lit(',"role":"'),
        "role",
        F.lit('","text":'),
        J.quote(F.col("text")),
        F.lit('},{"copy":true}],"next_cursor":'),
        F.when(F.col("turn") == F.col("__last"), F.lit("null")).otherwise(
            F.concat(F.lit('"'), cursor, F.lit('"'))
        ),
        F.lit("}"),
    )
    return turns.join(last, "conv_id").select(
        "conv_id",
        (F.col("turn") + 1).alias("page_number"),
        F.lit("https://api/x").alias("source_url"),
        F.lit("turns").alias("stream"),
        body.alias("body"),
    )


_PAGED_SQL = """WITH l AS (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY 1),
 p AS (SELECT c.conv_id, c.turn, c.role, c.text, l.last FROM conversations c JOIN l USING (conv_id)
  WHERE c.conv_id % 7 <> 0 OR l.last < 2)"""


@catalog.add(
    "paged_records",
    _PAGED_SQL
    + """ SELECT conv_id, 'turns' AS stream, 2 * turn + j AS record_index,
 CASE WHEN j = 0 THEN '{"role":"' || role || '","text":' || CAST(to_json(text) AS VARCHAR) || ',"turn":' || turn || '}' ELSE '{"copy":true}' END AS data,
 CAST(NULL AS VARCHAR) AS emitted_at FROM p, (SELECT unnest([0, 1]) AS j)""",
)
def paged_records(spark: SparkSession, folder: str) -> DataFrame:
    return read_paged(conversation_pages(spark, folder), ["conv_id"]).records


@catalog.add(
    "paged_states",
    _PAGED_SQL
    + """ SELECT conv_id, 'turns' AS stream, turn AS state_index, '{"cursor":"' ||
 CASE WHEN conv_id % 7 = 0 THEN 'same' ELSE 't' || turn END || '","page_number":' || (turn + 1) ||
 ',"record_count":2,"source_url":"https://api/x"}' AS data FROM p WHERE turn < last""",
)
def paged_states(spark: SparkSession, folder: str) -> DataFrame:
    return read_paged(conversation_pages(spark, folder), ["conv_id"]).states


@catalog.add(
    "paged_logs",
    _PAGED_SQL
    + """ SELECT conv_id, 'turns' AS stream, turn AS log_index, 'INFO' AS level, 'fetched page=' ||
 (turn + 1) || ' records=2 next_cursor=' || CASE WHEN turn = last THEN 'None'
  WHEN conv_id % 7 = 0 THEN 'same' ELSE 't' || turn END AS message FROM p
UNION ALL SELECT conv_id, 'turns', turn + 1, 'INFO', 'source exhausted after page=' || (turn + 1)
FROM p WHERE turn = last""",
)
def paged_logs(spark: SparkSession, folder: str) -> DataFrame:
    return read_paged(conversation_pages(spark, folder), ["conv_id"]).logs


@catalog.add(
    "paged_errors",
    """SELECT conv_id, CAST(2 AS BIGINT) AS page_number, 'cursor_did_not_advance' AS problem
FROM conversations WHERE conv_id % 7 = 0 GROUP BY conv_id HAVING max(turn) >= 2""",
)
def paged_errors(spark: SparkSession, folder: str) -> DataFrame:
    return read_paged(conversation_pages(spark, folder), ["conv_id"]).errors


@catalog.add(
    "normalize_values",
    """SELECT l_orderkey, '"' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '"' AS stamp,
 '"' || strftime(l_shipdate, '%Y-%m-%d') || '"' AS day,
 '"' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || '"' AS price,
 '{"at":"' || strftime(l_shipdate, '%Y-%m-%d') || '","parts":["' ||
 CAST(CAST(l_tax AS DECIMAL(6,4)) AS VARCHAR) || '",null]}' AS nested,
 CAST(l_linenumber AS VARCHAR) AS line FROM lineitem""",
)
def normalized_values(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem")
    tax = F.col("l_tax").cast("decimal(6,4)")
    day = F.col("l_shipdate").cast("date")
    rows = items.select(
        "l_orderkey",
        F.col("l_shipdate").alias("stamp"),
        day.alias("day"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.struct(day.alias("at"), F.array(tax, F.lit(None)).alias("parts")).alias("nested"),
        F.col("l_linenumber").alias("line"),
    )
    normal = normalize_values(rows)
    names = ("stamp", "day", "price", "nested", "line")
    return normal.select("l_orderkey", *[json_value(normal, n).alias(n) for n in names])


def customer_specs(spark: SparkSession, folder: str) -> DataFrame:
    """A source specification per customer, of six kinds, with credentials."""
    c = table(spark, folder, "customer")
    key = F.col("c_custkey")
    parts = {"k": key.cast("string"), "name": F.col("c_name"), "seg": F.col("c_mktsegment")}

    def filled(template: str) -> Column:
        pieces = []
        for piece in template.split("~"):
            pieces.append(parts[piece] if piece in parts else F.lit(piece))
        return F.concat(*pieces)

    text = pick((None,), F.lit(0))
    for kind, template in enumerate(SPEC_TEMPLATES):
        text = F.when(key % len(SPEC_TEMPLATES) == kind, filled(template)).otherwise(text)
    return c.select("c_custkey", text.alias("spec"))


SPEC_TEMPLATES = (
    '{"source":{"kind":"postgresql_incremental_v1","stream":"~seg~","connection_name":"~name~",'
    '"dsn":"postgresql://u:secret@h/db","schema":"s","table":"t~k~","columns":["id","at"],'
    '"cursor_column":"at","batch_size":~k~}}',
    '{"source":{"kind":"kafka_partition_offset_v1","stream":"~seg~","connection_name":"~name~",'
    '"brokers":["z:1","a:2"],"topic":"t","partition":~k~,"offset_start":null,"batch_size":10}}',
    '{"source":{"kind":"mongodb_incremental_v1","stream":"~seg~","connection_name":"~name~",'
    '"uri":"mongodb://u:p@h~k~/x","database":"d","collection":"c","fields":["a"],'
    '"cursor_field":"a","cursor_start":"0","batch_size":5}}',
    '{"source":{"kind":"clickhouse_incremental_v1","stream":"~seg~","connection_name":"~name~",'
    '"url":"http://u:p@Host~k~:8123/q?x=1","database":"d","table":"t","columns":["a"],'
    '"cursor_column":"a","batch_size":5,"username":"u","password":"p"}}',
    '{"source":{"kind":"s3_document_v1","bucket":"b~k~","key":"k/~name~","region":"r",'
    '"access_key":"A","secret_key":"S"}}',
    '{"source":{"kind":"http_document_v1","url":"https://h/~k~","timeout_s":5}}',
)
_SPEC_SQL = (
    """'{"batch_size":' || k || ',"columns":["id","at"],"connection_name":"' || c_name ||
 '","cursor_column":"at","cursor_start":null,"kind":"postgresql_incremental_v1","schema":"s",' ||
 '"stream":"' || seg || '","table":"t' || k || '"}'""",
    """'{"batch_size":10,"brokers":["a:2","z:1"],"connection_name":"' || c_name ||
 '","kind":"kafka_partition_offset_v1","offset_start":null,"partition":' || k || ',"stream":"' || seg ||
 '","topic":"t"}'""",
    """'{"batch_size":5,"collection":"c","connection_name":"' || c_name || '","cursor_field":"a",' ||
 '"cursor_start":"0","database":"d","fields":["a"],"kind":"mongodb_incremental_v1","stream":"' || seg ||
 '","uri":"mongodb://h' || k || '/x"}'""",
    """'{"batch_size":5,"columns":["a"],"connection_name":"' || c_name || '","cursor_column":"a",' ||
 '"cursor_start":null,"database":"d","endpoint":"http://host' || k || ':8123/q",' ||
 '"kind":"clickhouse_incremental_v1","stream":"' || seg || '","table":"t"}'""",
    """'{"bucket":"b' || k || '","endpoint_url":null,"key":"k/' || c_name ||
 '","kind":"s3_document_v1","region":"r","version_id":null}'""",
    """'{"accept":null,"kind":"http_document_v1","url":"https://h/' || k || '"}'""",
)


@catalog.add(
    "source_identity",
    "SELECT c_custkey, sha256(CASE c_custkey % 6 "
    + " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(_SPEC_SQL))
    + " END) AS source_sha256 FROM (SELECT c_custkey, c_name, c_mktsegment AS seg, "
    "CAST(c_custkey AS VARCHAR) AS k FROM customer)",
)
def identities(spark: SparkSession, folder: str) -> DataFrame:
    return source_identity(customer_specs(spark, folder), "spec").select(
        "c_custkey", "source_sha256"
    )


SPEC_FORMS = (
    ('{"source":{"kind":"s3_document_v1","n":~}}', "s3_document_v1", None),
    ('{"source":{"kind":"ftp_v1","n":~}}', "ftp_v1", "unsupported_source_kind"),
    ('{"source":{"kind":"","n":~}}', None, "source_kind_missing_or_empty"),
    ('{"source":[~]}', None, "source_field_missing_or_not_object"),
    ("[~]", None, "top_level_source_spec_must_be_object"),
    ('{"source":~', None, "malformed_json_source_spec"),
    ('{"source":{"kind":7,"n":~}}', None, "source_kind_missing_or_empty"),
)


@catalog.add(
    "classify_source_spec",
    f"""SELECT event_id, {sql_pick([f[1] for f in SPEC_FORMS], f'event_id % {len(SPEC_FORMS)}')} AS source_kind,
 {sql_pick([f[2] for f in SPEC_FORMS], f'event_id % {len(SPEC_FORMS)}')} AS source_problem FROM events""",
)
def spec_classes(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    form = pick([f[0] for f in SPEC_FORMS], F.col("event_id") % len(SPEC_FORMS))
    specs = e.select("event_id", F.replace(form, F.lit("~"), F.col("props")).alias("spec"))
    return classify_source_spec(specs, "spec").select("event_id", "source_kind", "source_problem")


PROGRESS_FORMS = (
    ('{"cursor":"~"}', "cursor_v1"),
    ('{"cursor":"","token":"~"}', "token_v1"),
    ('{"page_token":"~","page":1}', "token_v1"),
    ('{"cursor":5,"next_page_token":"~"}', "token_v1"),
    ('{"page_number":~}', "page_v1"),
    ('{"page_number":true,"page":~}', "page_v1"),
    ('{"page":1.0,"n":~}', "state_dict_v1"),
    ('{"token":null,"page":"~"}', "state_dict_v1"),
)


def event_states(spark: SparkSession, folder: str) -> DataFrame:
    """Each event leaves one state of its user, numbered by event id."""
    e = table(spark, folder, "events")
    form = pick([f[0] for f in PROGRESS_FORMS], F.col("event_id") % len(PROGRESS_FORMS))
    data = F.replace(form, F.lit("~"), F.col("event_id").cast("string"))
    return e.select(
        "user_id", F.col("event_id").alias("state_index"), J.canonical(data).alias("data")
    )


@catalog.add(
    "progress_kind",
    f"""SELECT event_id, {sql_pick([f[1] for f in PROGRESS_FORMS], f'event_id % {len(PROGRESS_FORMS)}')}
 AS progress_kind FROM events""",
)
def progress_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return progress_kind(event_states(spark, folder)).select(
        F.col("state_index").alias("event_id"), "progress_kind"
    )


def user_tasks(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "events").select("user_id").distinct()
    return users.select(
        "user_id",
        F.lit("p1").alias("pipeline_version"),
        identity.sha256_of(F.col("user_id").cast("string")).alias("sha256"),
    )


def user_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of a user, all in one stream."""
    e = table(spark, folder, "events")
    return e.select(
        "user_id",
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("stream"),
        F.col("event_id").alias("record_index"),
        F.col("props").alias("data"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("emitted_at"),
    )


def event_checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    return build_checkpoints(
        user_records(spark, folder),
        event_states(spark, folder),
        user_tasks(spark, folder),
        ["user_id"],
    )


_PROGRESS_SORTED = (
    '{"cursor":"~"}',
    '{"cursor":"","token":"~"}',
    '{"page":1,"page_token":"~"}',
    '{"cursor":5,"next_page_token":"~"}',
    '{"page_number":~}',
    '{"page":~,"page_number":true}',
    '{"n":~,"page":1.0}',
    '{"page":"~","token":null}',
)
_TASK_SQL = (
    """'{"kind":"it","pipeline_version":"p1","sha256":"' || sha256(CAST(user_id AS VARCHAR)) || '"}'"""
)
_CHECKPOINTS_SQL = f"""SELECT user_id, event_id AS checkpoint_index,
 {sql_pick([f[1] for f in PROGRESS_FORMS], f'event_id % {len(PROGRESS_FORMS)}')} AS progress_kind,
 replace({sql_pick(_PROGRESS_SORTED, f'event_id % {len(PROGRESS_FORMS)}')}, '~',
  CAST(event_id AS VARCHAR)) AS progress,
 'u' || user_id AS stream, {_TASK_SQL} AS task_identity_key
 FROM events"""
_KEYED_SQL = f"""SELECT *, '{{"kind":"it","progress":' || progress || ',"progress_kind":"' || progress_kind ||
 '","stream":' || coalesce('"' || stream || '"', 'null') || ',"task":' || task_identity_key || '}}'
 AS checkpoint_identity_key FROM ({_CHECKPOINTS_SQL})"""


@catalog.add(
    "checkpoint_lineage",
    f"""SELECT user_id, checkpoint_index, stream, progress_kind, progress, checkpoint_identity_key,
 lag(checkpoint_identity_key) OVER (PARTITION BY user_id ORDER BY checkpoint_index)
  AS parent_checkpoint_identity_key, 'intake' AS run_origin FROM ({_KEYED_SQL})""",
)
def lineage(spark: SparkSession, folder: str) -> DataFrame:
    return event_checkpoints(spark, folder).select(
        "user_id",
        "checkpoint_index",
        "stream",
        "progress_kind",
        "progress",
        "checkpoint_identity_key",
        "parent_checkpoint_identity_key",
        "run_origin",
    )


# Runs of 16 events; three of four are resumed inside the run before, the fourth begins a
# chain, is resumed from that of another chain, from one that is gone, or from its own end.
_RUNS_SQL = """SELECT 'k' || event_id AS key, CASE WHEN event_id % 16 <> 0 THEN 'k' || (event_id - 1)
 WHEN event_id % 64 <> 0 OR (event_id // 64) % 5 IN (1, 2) THEN 'k' || (event_id - 10)
 WHEN (event_id // 64) % 5 = 3 THEN 'gone' WHEN (event_id // 64) % 5 = 4 THEN 'k' || (event_id + 15) END AS up
FROM events"""


@catalog.add(
    "checkpoint_ancestry",
    f"""WITH RECURSIVE e AS ({_RUNS_SQL}),
 c AS (SELECT key, key AS root, 0 AS depth, CASE WHEN up IS NULL THEN 'whole' ELSE 'broken' END AS ancestry
  FROM e WHERE up IS NULL OR up NOT IN (SELECT key FROM e)
  UNION ALL SELECT e.key, c.root, c.depth + 1, c.ancestry FROM c JOIN e ON e.up = c.key)
SELECT e.key AS checkpoint_identity_key, c.root, CAST(c.depth AS BIGINT) AS depth,
 coalesce(c.ancestry, 'cycle') AS ancestry FROM e LEFT JOIN c ON c.key = e.key""",
)
def ancestry(spark: SparkSession, folder: str) -> DataFrame:
    """Roots of the events' checkpoints, whose runs are resumed from one another."""
    at, block = F.col("event_id"), F.floor(F.col("event_id") / 64) % 5
    key = F.concat(F.lit("k"), at)
    resumed = (
        F.when(at % 16 != 0, F.lit(None))
        .when((at % 64 != 0) | block.isin(1, 2), F.concat(F.lit("k"), at - 10))
        .when(block == 3, "gone")
        .when(block == 4, F.concat(F.lit("k"), at + 15))
    )
    entries = table(spark, folder, "events").select(
        key.alias("checkpoint_identity_key"),
        F.when(at % 16 != 0, F.concat(F.lit("k"), at - 1)).alias("parent_checkpoint_identity_key"),
        resumed.alias("resumed_from_checkpoint_identity_key"),
    )
    return checkpoint_ancestry(entries)


_ENTRY = '{"checkpoint_index":~,"checkpoint_identity_key":"c~","progress":{"cursor":"~"}}'
_GOOD = (
    '{"schema_version":1,"flow_kind":"it","stream":null,"task_identity_key":"t",'
    '"checkpoints":[' + _ENTRY + "]}"
)
CHECKPOINT_FORMS = (
    (_GOOD, "supported", None),
    ("[~]", "malformed", "not_a_json_object"),
    ('{"schema_version":~', "malformed", "not_a_json_object"),
    (
        _GOOD.replace('"schema_version":1', '"schema_version":true'),
        "malformed",
        "schema_version_not_an_integer",
    ),
    (
        _GOOD.replace('"flow_kind":"it"', '"flow_kind":""'),
        "malformed",
        "flow_kind_not_a_filled_string",
    ),
    (
        _GOOD.replace('"schema_version":1', '"schema_version":2'),
        "unsupported",
        "unsupported_schema_version",
    ),
    (
        _GOOD.replace('"flow_kind":"it"', '"flow_kind":"uns"'),
        "unsupported",
        "unsupported_flow_kind",
    ),
    (_GOOD.replace('"stream":null', '"stream":~'), "malformed", "stream_not_a_string"),
    (
        _GOOD.replace('"task_identity_key":"t"', '"task_identity_key":""'),
        "malformed",
        "task_identity_key_not_a_filled_string",
    ),
    (
        _GOOD.replace('"checkpoint_index":~', '"checkpoint_index":"~"'),
        "malformed",
        "entry_index_not_an_integer",
    ),
    (
        _GOOD.replace('{"cursor":"~"}', "[~]"),
        "malformed",
        "entry_progress_not_an_object",
    ),
    (
        _GOOD.replace('"stream":null', '"provenance":{"task_identity_key":"t"}'),
        "malformed",
        "provenance_run_origin_unsupported",
    ),
    (
        _GOOD.replace(
            '"stream":null',
            '"provenance":{"task_identity_key":"x","run_origin":"intake",'
            '"delivery_origin":"primary","execution_mode":"batch"}',
        ),
        "malformed",
        "provenance_task_differs",
    ),
)


@catalog.add(
    "checkpoint_compat",
    f"""SELECT event_id, {sql_pick([f[1] for f in CHECKPOINT_FORMS], f'event_id % {len(CHECKPOINT_FORMS)}')} AS status,
 {sql_pick([f[2] for f in CHECKPOINT_FORMS], f'event_id % {len(CHECKPOINT_FORMS)}')} AS reason FROM events""",
)
def compatibility(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    form = pick([f[0] for f in CHECKPOINT_FORMS], F.col("event_id") % len(CHECKPOINT_FORMS))
    texts = e.select(
        "event_id", F.replace(form, F.lit("~"), F.col("event_id").cast("string")).alias("text")
    )
    return checkpoint_compat(texts, "text").select("event_id", "status", "reason")


@catalog.add(
    "checkpoint_entries",
    """SELECT o_orderkey, CAST(j AS INTEGER) AS position, 'orders' AS stream, CAST(j AS BIGINT) AS checkpoint_index,
 'c' || j AS checkpoint_identity_key, CASE WHEN j > 0 THEN 'c' || (j - 1) END
  AS parent_checkpoint_identity_key, CASE WHEN j = 0 THEN 'page_v1' ELSE 'cursor_v1' END AS progress_kind,
 CASE WHEN j = 0 THEN '{"page":' || o_custkey || '}' ELSE '{"cursor":"' || o_orderstatus || '"}' END AS progress
FROM orders, (SELECT unnest([0, 1]) AS j)""",
)
def checkpoint_entries(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    text = F.concat(
        F.lit('{"schema_version":1,"flow_kind":"it","stream":"orders","task_identity_key":"t",'),
        F.lit('"checkpoints":[{"checkpoint_index":0,"checkpoint_identity_key":"c0","progress":{"page":'),
        F.col("o_custkey").cast("string"),
        F.lit('}},{"checkpoint_index":1,"checkpoint_identity_key":"c1",'),
        F.lit('"parent_checkpoint_identity_key":"c0","progress_kind":"cursor_v1","progress":{"cursor":"'),
        "o_orderstatus",
        F.lit('"}}]}'),
    )
    return read_checkpoint_entries(
        o.select("o_orderkey", text.alias("text")), "o_orderkey", "text"
    ).drop("task_identity_key")


def resume_selection(spark: SparkSession, folder: str) -> DataFrame:
    """A resume request per user: the latest checkpoint, a named one, or a wrong one."""
    entries = stored(
        event_checkpoints(spark, folder).withColumn("position", F.col("checkpoint_index"))
    )
    tasks = stored(user_tasks(spark, folder))
    headers = tasks.select(
        "user_id",
        F.when(F.col("user_id") % 10 == 4, "malformed")
        .when(F.col("user_id") % 10 == 5, "unsupported")
        .otherwise("supported")
        .alias("status"),
        identity.task_key(F.lit("it"), F.lit("p1"), F.col("sha256")).alias("task_identity_key"),
        F.concat(F.lit("u"), F.col("user_id")).alias("stream"),
    )
    first_cursor = (
        entries.filter(F.col("progress_kind") == "cursor_v1")
        .groupBy("user_id")
        .agg(F.min_by("checkpoint_identity_key", "checkpoint_index").alias("__named"))
    )
    requests = (
        tasks
        .join(first_cursor, "user_id", "left")
        .select(
            F.concat(F.lit("r"), F.col("user_id").cast("string")).alias("request"),
            "user_id",
            F.when(F.col("user_id") % 10 == 6, "p2").otherwise("p1").alias("pipeline_version"),
            "sha256",
            F.when(F.col("user_id") % 10 == 7, "nothing")
            .when(F.col("user_id") % 2 == 0, F.col("__named"))
            .alias("wanted_checkpoint_key"),
        )
    )
    return select_resume(headers, entries, requests, "user_id", "request")


_RESUME_SQL = f"""WITH k AS ({_KEYED_SQL}),
 f AS (SELECT user_id, arg_min(checkpoint_identity_key, checkpoint_index) AS named FROM k
  WHERE progress_kind = 'cursor_v1' GROUP BY 1),
 q AS (SELECT u.user_id, CASE WHEN u.user_id % 10 = 7 THEN 'nothing'
   WHEN u.user_id % 2 = 0 THEN f.named END AS wanted
  FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN f USING (user_id)),
 e AS (SELECT q.user_id, q.wanted, k.checkpoint_index, k.checkpoint_identity_key, k.progress_kind,
   k.progress, row_number() OVER (PARTITION BY q.user_id ORDER BY
    CASE WHEN q.wanted IS NULL THEN -k.checkpoint_index ELSE k.checkpoint_index END) AS rn
  FROM q LEFT JOIN k ON q.user_id = k.user_id AND (q.wanted IS NULL
   OR q.wanted = k.checkpoint_identity_key)),
 s AS (SELECT user_id, CASE WHEN wanted IS NULL THEN 'latest_checkpoint'
   ELSE 'explicit_checkpoint_identity' END AS mode, checkpoint_index, checkpoint_identity_key,
  CASE WHEN progress_kind = 'cursor_v1' THEN CAST(checkpoint_index AS VARCHAR) END
   AS exclusive_after_cursor,
  CASE WHEN user_id % 10 = 4 THEN 'checkpoint_malformed'
   WHEN user_id % 10 = 5 THEN 'checkpoint_incompatible'
   WHEN user_id % 10 = 6 THEN 'task_identity_mismatch'
   WHEN checkpoint_identity_key IS NULL THEN 'unknown_checkpoint_identity'
   WHEN progress_kind <> 'cursor_v1' THEN 'unsupported_progress_kind' END AS issue_code
  FROM e WHERE rn = 1)"""


@catalog.add(
    "select_resume",
    _RESUME_SQL
    + """ SELECT user_id, mode, checkpoint_index, checkpoint_identity_key, exclusive_after_cursor,
 issue_code, CASE WHEN issue_code = 'checkpoint_malformed' THEN 'malformed'
  WHEN issue_code IN ('checkpoint_incompatible', 'task_identity_mismatch') THEN 'incompatible'
  WHEN issue_code = 'unknown_checkpoint_identity' THEN 'blocked'
  WHEN issue_code = 'unsupported_progress_kind' THEN 'unsupported' END AS issue_status FROM s""",
)
def resume_requests(spark: SparkSession, folder: str) -> DataFrame:
    return resume_selection(spark, folder).select(
        "user_id",
        "mode",
        "checkpoint_index",
        "checkpoint_identity_key",
        "exclusive_after_cursor",
        "issue_code",
        "issue_status",
    )


@catalog.add(
    "resume_provenance",
    _RESUME_SQL
    + f""" SELECT user_id, 'resume' AS run_origin, checkpoint_identity_key, {_TASK_SQL}
 AS task_identity_key, exclusive_after_cursor FROM s WHERE issue_code IS NULL""",
)
def resume_origin(spark: SparkSession, folder: str) -> DataFrame:
    return resume_provenance(resume_selection(spark, folder)).select(
        "user_id",
        "provenance.run_origin",
        "provenance.checkpoint_identity_key",
        "provenance.task_identity_key",
        "resume.exclusive_after_cursor",
    )


def _resume_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events as records, every tenth cursor a checkpoint; one selection per user."""
    e = table(spark, folder, "events")
    emitted = F.lpad(F.col("event_id").cast("string"), 12, "0")
    records = e.select(
        "user_id",
        F.col("event_id").alias("record_index"),
        F.when((F.col("user_id") % 8 > 0) | (F.col("event_id") % 50 > 0), emitted).alias(
            "emitted_at"
        ),
    )
    states = e.select(
        "user_id",
        F.col("event_id").alias("state_index"),
        F.concat(F.lit('{"cursor":"'), emitted, F.lit('"}')).alias("data"),
    )
    selection = e.select("user_id").distinct().select(
        "user_id",
        F.lpad((F.col("user_id") * 30).cast("string"), 12, "0").alias("exclusive_after_cursor"),
        F.when(F.col("user_id") % 5 == 0, "empty_checkpoint_set").alias("issue_code"),
    )
    return records, states, selection


_RESUMED_SQL = """WITH b AS (SELECT user_id FROM events WHERE user_id % 8 = 0 AND event_id % 50 = 0
  AND user_id % 5 > 0 GROUP BY 1),
 r AS (SELECT * FROM events WHERE user_id % 5 > 0 AND user_id NOT IN (SELECT user_id FROM b)
  AND event_id > user_id * 30)"""


@catalog.add(
    "resume_records",
    _RESUMED_SQL
    + """ SELECT user_id, event_id AS record_index,
 CASE WHEN user_id % 8 > 0 OR event_id % 50 > 0 THEN lpad(CAST(event_id AS VARCHAR), 12, '0') END
 AS emitted_at FROM r""",
)
def resumed_records(spark: SparkSession, folder: str) -> DataFrame:
    return resume_filter(*_resume_inputs(spark, folder), ["user_id"])[0]


@catalog.add(
    "resume_states",
    _RESUMED_SQL
    + """ SELECT user_id, event_id AS state_index,
 '{"cursor":"' || lpad(CAST(event_id AS VARCHAR), 12, '0') || '"}' AS data FROM r""",
)
def resumed_states(spark: SparkSession, folder: str) -> DataFrame:
    return resume_filter(*_resume_inputs(spark, folder), ["user_id"])[1]


@catalog.add(
    "resume_blocked",
    _RESUMED_SQL
    + """ SELECT user_id, 'missing_record_emitted_at' AS issue_code, 'blocked' AS issue_status FROM b""",
)
def resume_blocked(spark: SparkSession, folder: str) -> DataFrame:
    return resume_filter(*_resume_inputs(spark, folder), ["user_id"])[2]


@catalog.add(
    "record_evidence",
    """WITH i AS (SELECT user_id, event_id, props,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events)
SELECT user_id, CAST(sum(length(CAST(json(props) AS VARCHAR)) + 1) - 1 AS BIGINT) AS normalized_text_len,
 sha256(string_agg(CAST(json(props) AS VARCHAR), chr(10) ORDER BY i)) AS normalized_text_sha256,
 substr(string_agg(CAST(json(props) AS VARCHAR), chr(10) ORDER BY i), 1, 16384) AS normalized_text_preview,
 count(*) AS elements_count, count(*) AS records_count, count(*) > 10 AS records_truncated,
 string_agg(CAST(json(props) AS VARCHAR), '|' ORDER BY i) FILTER (i < 10) AS preview,
 'not_available' AS structured_state_visibility, 'normalized_text_and_records_preview_v1' AS evidence_kind
FROM i GROUP BY user_id""",
)
def evidence_of_reads(spark: SparkSession, folder: str) -> DataFrame:
    """Evidence of one document per user whose records are its events."""
    tables = read_offsets(event_offsets(spark, folder), OFFSET_BATCH, "events", "log")
    elements = tables.records.select(
        F.col("partition").cast("long").alias("user_id"),
        F.lit("StructuredRecord").alias("type"),
        F.struct(F.lit(0).alias("kind"), F.col("record_index").alias("index")).alias("ord"),
        "data",
    )
    texts = elements.withColumn("text", F.col("data"))
    return record_evidence(texts, ["user_id"]).select(
        "user_id",
        "normalized_text_len",
        "normalized_text_sha256",
        "normalized_text_preview",
        "elements_count",
        "records_count",
        "records_truncated",
        F.array_join("records_preview", "|").alias("preview"),
        "structured_state_visibility",
        "evidence_kind",
    )


@catalog.add(
    "ingest_records",
    f"""SELECT count(*) AS elements, count(*) FILTER (type = 'StructuredState') AS states,
 count(*) FILTER (type = 'StructuredLog') AS logs,
 CAST(sum(length(text)) AS BIGINT) AS text_chars, (SELECT count(*) FROM events) AS checkpoints
FROM (SELECT 'StructuredRecord' AS type, replace(CAST(json(props) AS VARCHAR), ':', ': ') AS text FROM events
 UNION ALL SELECT 'StructuredState', '{{"cursor": "' || lpad(CAST(event_id AS VARCHAR), 12, '0') || '"}}'
 FROM events UNION ALL SELECT 'StructuredLog', event_type FROM events)""",
)
def record_ingest(spark: SparkSession, folder: str) -> DataFrame:
    ingest = _event_ingest(spark, folder)
    entries = ingest.checkpoints.agg(F.count("checkpoint_identity_key").alias("n")).scalar()
    return ingest.elements.agg(
        F.count(F.lit(1)).alias("elements"),
        F.count_if(F.col("type") == "StructuredState").alias("states"),
        F.count_if(F.col("type") == "StructuredLog").alias("logs"),
        F.sum(F.length("text")).alias("text_chars"),
    ).withColumn("checkpoints", entries)


@catalog.add(
    "ingest_record_elements",
    """SELECT user_id, 'u' || user_id || ':record:' || event_id AS element_id, 'StructuredRecord' AS type,
 replace(CAST(json(props) AS VARCHAR), ':', ': ') AS text FROM events
UNION ALL SELECT user_id, 'u' || user_id || ':state:' || event_id, 'StructuredState',
 '{"cursor": "' || lpad(CAST(event_id AS VARCHAR), 12, '0') || '"}' FROM events
UNION ALL SELECT user_id, 'u' || user_id || ':log:' || event_id, 'StructuredLog', event_type FROM events""",
)
def record_ingest_elements(spark: SparkSession, folder: str) -> DataFrame:
    return _event_ingest(spark, folder).elements.select("user_id", "element_id", "type", "text")


def _event_ingest(spark: SparkSession, folder: str) -> RecordIngest:
    """Every event leaves a record, a state and a log line of its user."""
    e = table(spark, folder, "events")
    emitted = F.lpad(F.col("event_id").cast("string"), 12, "0")
    at = (F.col("user_id"), F.concat(F.lit("u"), F.col("user_id")).alias("stream"))
    records = e.select(
        *at,
        F.col("event_id").alias("record_index"),
        J.canonical(F.col("props")).alias("data"),
        emitted.alias("emitted_at"),
    )
    states = e.select(
        *at,
        F.col("event_id").alias("state_index"),
        F.concat(F.lit('{"cursor":"'), emitted, F.lit('"}')).alias("data"),
    )
    logs = e.select(
        *at,
        F.col("event_id").alias("log_index"),
        F.lit("INFO").alias("level"),
        F.col("event_type").alias("message"),
    )
    return ingest_records(
        RecordTables(records, states, logs), user_tasks(spark, folder), ["user_id"]
    )
