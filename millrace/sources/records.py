"""Record documents: message envelopes, record lists and paged responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import jsontext as J
from millrace.functions import ordering
from millrace.functions.binding import evaluate_once
from millrace.session import stored
from millrace.sources.tables import RecordTables

PAGES_PER_SLICE = 1024


def _first_problem(items: Column) -> Column:
    return F.get(F.filter(items, lambda p: p.isNotNull()), F.lit(0))


BODY_OF = {"RECORD": "record", "STATE": "state", "LOG": "log"}


def _field(fields: Column, name: str) -> Column:
    return F.try_element_at(fields, F.lit(name))


def _messages(items: Column) -> Column:
    """Read each message in steps, so that every node is visited once."""

    def typed(m: Column) -> Column:
        return F.struct(
            J.string_of(_field(m, "type")).alias("kind"),
            m.isNotNull().alias("is_object"),
            m.alias("fields"),
        )

    def opened(m: Column) -> Column:
        body = F.lit(None).cast("variant")
        for kind, name in BODY_OF.items():
            body = F.when(m["kind"] == kind, _field(m["fields"], name)).otherwise(body)
        return F.struct(
            m["kind"].alias("kind"),
            m["is_object"].alias("is_object"),
            J.fields_of(body).alias("body"),
        )

    def read(m: Column) -> Column:
        body = m["body"]
        return F.struct(
            m["kind"].alias("kind"),
            m["is_object"].alias("is_object"),
            body.isNotNull().alias("has_body"),
            _field(body, "data").alias("data"),
            J.is_object(_field(body, "data")).alias("has_data"),
            J.absent(_field(body, "emitted_at"), "$").alias("no_emit"),
            *[
                J.string_of(_field(body, c)).alias(c)
                for c in ("stream", "emitted_at", "level", "message")
            ],
        )

    steps = F.transform(F.transform(F.transform(items, J.fields_of), typed), opened)
    return F.transform(F.transform(steps, read), _judged)


def _judged(m: Column) -> Column:
    kind = m["kind"]
    record, state, log = (kind == k for k in BODY_OF)
    known = F.coalesce(kind.isin(*BODY_OF), F.lit(False))

    def empty(name: str) -> Column:
        return F.coalesce(m[name], F.lit("")) == ""

    problem = (
        F.when(~m["is_object"], "message_not_an_object")
        .when(~known, "unsupported_message_type")
        .when(~m["has_body"], F.concat(F.lower(kind), F.lit("_not_an_object")))
        .when(record & empty("stream"), "record_stream_not_a_filled_string")
        .when(record & ~m["has_data"], "record_data_not_an_object")
        .when(
            record & ~m["no_emit"] & m["emitted_at"].isNull(), "record_emitted_at_not_a_string"
        )
        .when(state & ~m["has_data"], "state_data_not_an_object")
        .when(log & empty("level"), "log_level_not_a_filled_string")
        .when(log & empty("message"), "log_message_not_a_filled_string")
    )
    return F.struct(
        kind.alias("kind"),
        problem.alias("problem"),
        F.when(~log, J.render(m["data"])).alias("data"),
        *[m[c].alias(c) for c in ("stream", "emitted_at", "level", "message")],
    )


def read_messages(df: DataFrame, key: str, text: str) -> RecordTables:
    """Split message documents into records, states and logs.

    A document is one row, so its messages are numbered inside the row and no
    shuffle is needed.  Any bad message rejects its whole document, as does a
    second record stream.
    """
    listed = (
        evaluate_once(df, [key, text], {"__root": J.document(F.col(text), ["messages"])})
        .withColumn("__list", F.col("__root.messages"))
        .withColumn("__m", _messages(F.col("__list")))
        .withColumn("__records", F.filter("__m", lambda m: m["kind"] == "RECORD"))
        .withColumn("__stream", F.get(F.col("__records"), F.lit(0))["stream"])
    )
    problem = (
        F.when(
            F.col("__root").isNull(),
            J.document_problem(F.col(text), F.col("__root"), "document_not_an_object"),
        )
        .when(F.col("__list").isNull(), "messages_not_a_list")
        .otherwise(
            F.coalesce(
                _first_problem(F.transform("__m", lambda m: m["problem"])),
                F.when(
                    F.exists("__records", lambda m: m["stream"] != F.col("__stream")),
                    "more_than_one_stream",
                ),
            )
        )
    )
    parsed = evaluate_once(
        listed,
        [key],
        {"stream": F.col("__stream"), "problem": problem, "__messages": F.col("__m")},
    )
    good = parsed.filter(F.col("problem").isNull())

    def numbered(kind: str, index: str) -> DataFrame:
        picked = F.filter("__messages", lambda m: m["kind"] == kind)
        return good.select(key, "stream", F.posexplode(picked).alias(index, "m"))

    def indexed(kind: str) -> Column:
        return F.transform(
            F.filter("__messages", lambda m: m["kind"] == kind),
            lambda m, i: F.struct(
                F.lit(kind.lower()).alias("kind"),
                i.cast("long").alias("index"),
                *[m[c].alias(c) for c in ("data", "emitted_at", "level", "message")],
            ),
        )

    every = F.concat(*[indexed(kind) for kind in ("RECORD", "STATE", "LOG")])
    return RecordTables(
        merged=good.select(key, "stream", F.inline(every)),
        records=numbered("RECORD", "record_index").select(
            key, "stream", "record_index", "m.data", "m.emitted_at"
        ),
        states=numbered("STATE", "state_index").select(key, "stream", "state_index", "m.data"),
        logs=numbered("LOG", "log_index").select(
            key, "stream", "log_index", "m.level", "m.message"
        ),
        errors=parsed.filter(F.col("problem").isNotNull()).select(key, "problem"),
    )


def read_record_list(df: DataFrame, key: str, text: str) -> RecordTables:
    """Read ``{"stream": .., "records": [{data, emitted_at}]}`` documents."""

    def record(r: Column) -> Column:
        problem = (
            F.when(~J.is_object(r), "record_not_an_object")
            .when(~J.is_object(r, "$.data"), "record_data_not_an_object")
            .when(
                ~J.absent(r, "$.emitted_at") & J.string_at(r, "$.emitted_at").isNull(),
                "record_emitted_at_not_a_string",
            )
        )
        return F.struct(
            problem.alias("problem"),
            J.text_at(r, "$.data").alias("data"),
            J.string_at(r, "$.emitted_at").alias("emitted_at"),
        )

    listed = (
        evaluate_once(
            df, [key, text], {"__root": J.document(F.col(text), ["records"], ["stream"])}
        )
        .withColumn("__list", F.col("__root.records"))
        .withColumn("__read", F.transform("__list", record))
        .withColumn("__stream", F.nullif(J.string_of(F.col("__root.stream")), F.lit("")))
    )
    problem = (
        F.when(
            F.col("__root").isNull(),
            J.document_problem(F.col(text), F.col("__root"), "document_not_an_object"),
        )
        .when(F.col("__stream").isNull(), "stream_not_a_filled_string")
        .when(F.col("__list").isNull(), "records_not_a_list")
        .otherwise(_first_problem(F.transform("__read", lambda r: r["problem"])))
    )
    parsed = evaluate_once(
        listed,
        [key],
        {"stream": F.col("__stream"), "problem": problem, "__r": F.col("__read")},
    )
    good = parsed.filter(F.col("problem").isNull())
    spark = df.sparkSession
    key_type = df.schema[key].dataType.simpleString()
    return RecordTables(
        records=good.select(
            key, "stream", F.posexplode("__r").alias("record_index", "r")
        ).select(key, "stream", "record_index", "r.data", "r.emitted_at"),
        states=spark.createDataFrame(
            [], f"`{key}` {key_type}, stream string, state_index int, data string"
        ),
        logs=spark.createDataFrame(
            [], f"`{key}` {key_type}, stream string, log_index int, level string, message string"
        ),
        errors=parsed.filter(F.col("problem").isNotNull()).select(key, "problem"),
    )


def read_paged(
    pages: DataFrame,
    keys: Sequence[str],
    body: str = "body",
    page_number: str = "page_number",
    source_url: str = "source_url",
    stream: str = "stream",
    fault: str | None = None,
) -> RecordTables:
    """Read landed page responses ``{"records": [..], "next_cursor": ..}``.

    ``keys`` name one source, whose pages are numbered from 1.  Records carry no
    emit time.  Every page but the last leaves a state.  Any rejected page
    rejects its whole source.  ``fault`` names a column with the problem that a page came
    with (null for none); it goes before those of its body.
    """
    at = [*keys, stream]
    faults = [] if fault is None else [fault]
    listed = (
        evaluate_once(
            pages,
            [*at, page_number, source_url, body, *faults],
            {"__b": J.document(F.col(body), ["records"], ["next_cursor"])},
        )
        .withColumn("__items", F.col("__b.records"))
        .withColumn("__cursor", F.col("__b.next_cursor"))
        .withColumn("__next", F.nullif(J.string_of(F.col("__cursor")), F.lit("")))
    )
    problem = (
        F.when(
            F.col("__b").isNull(),
            J.document_problem(F.col(body), F.col("__b"), "response_not_an_object"),
        )
        .when(F.col("__items").isNull(), "records_not_a_list")
        .when(F.exists("__items", lambda r: ~J.is_object(r)), "record_not_an_object")
        .when(
            ~J.absent(F.col("__cursor"), "$") & F.col("__next").isNull(),
            "next_cursor_not_a_filled_string",
        )
    )
    if fault is not None:
        problem = F.coalesce(F.col(fault), problem)
    # Bodies are parsed once; what follows reads only the columns it needs.
    parsed = stored(
        evaluate_once(
            listed,
            [*at, page_number, source_url],
            {
                "next_cursor": F.col("__next"),
                "record_count": F.coalesce(F.size("__items"), F.lit(0)),
                "problem": problem,
                "__list": F.transform("__items", J.render),
            },
        )
    )
    # The second page that names a cursor is where a read would stop advancing.
    seen = Window.partitionBy(*keys, "next_cursor").orderBy(page_number)
    repeats = (
        parsed.filter(F.col("next_cursor").isNotNull() & F.col("problem").isNull())
        .select(*keys, page_number, "next_cursor")
        .withColumn("__rn", F.row_number().over(seen))
        .filter("__rn <= 2")
        .filter("__rn = 2")
        .select(*keys, page_number, F.lit("cursor_did_not_advance").alias("problem"))
    )
    bad_pages = (
        parsed.filter(F.col("problem").isNotNull())
        .select(*keys, page_number, "problem")
        .unionByName(repeats)
    )
    errors = bad_pages.groupBy(*keys).agg(
        F.min(F.struct(page_number, "problem")).alias("__e")
    ).select(*keys, f"__e.{page_number}", "__e.problem")
    # One small row per page decides which pages are read and where each one starts.
    slim = parsed.select(*at, page_number, source_url, "next_cursor", "record_count")
    headers = slim.join(errors.select(*keys), list(keys), "left_anti")
    slice_by = F.floor(F.col(page_number) / PAGES_PER_SLICE)
    started = ordering.sum_before(
        headers, keys, [page_number], "record_count", "__before", slice_by
    )
    bodies = parsed.select(*keys, page_number, "__list")
    records = (
        started.select(*at, page_number, "__before")
        .join(bodies, [*keys, page_number])
        .select(*at, "__before", F.posexplode("__list").alias("__i", "__r"))
        .select(
            *at,
            (F.col("__before") + F.col("__i")).alias("record_index"),
            F.col("__r").alias("data"),
            F.lit(None).cast("string").alias("emitted_at"),
        )
    )
    states = headers.filter(F.col("next_cursor").isNotNull()).select(
        *at,
        (F.col(page_number) - 1).alias("state_index"),
        J.object_text(
            {
                "cursor": J.quote(F.col("next_cursor")),
                "page_number": F.col(page_number).cast("string"),
                "source_url": J.quote(F.col(source_url)),
                "record_count": F.col("record_count").cast("string"),
            }
        ).alias("data"),
    )
    fetched = F.struct(
        (2 * (F.col(page_number) - 1)).alias("at"),
        F.concat(
            F.lit("fetched page="),
            F.col(page_number),
            F.lit(" records="),
            F.col("record_count"),
            F.lit(" next_cursor="),
            F.coalesce(F.col("next_cursor"), F.lit("None")),
        ).alias("message"),
    )
    finished = F.struct(
        (2 * F.col(page_number) - 1).alias("at"),
        F.concat(F.lit("source exhausted after page="), F.col(page_number)).alias("message"),
    )
    logs = headers.select(
        *at,
        page_number,
        "next_cursor",
        F.explode(
            F.when(F.col("next_cursor").isNull(), F.array(fetched, finished)).otherwise(
                F.array(fetched)
            )
        ).alias("l"),
    ).select(
        *at,
        F.when(F.col("l.at") % 2 == 0, F.col(page_number) - 1)
        .otherwise(F.col(page_number))
        .alias("log_index"),
        F.lit("INFO").alias("level"),
        "l.message",
    )
    return RecordTables(records=records, states=states, logs=logs, errors=errors)
