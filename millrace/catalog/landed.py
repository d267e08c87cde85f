"""Queries that write single objects and read them back, as themselves and as landed pages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import Catalog, table
from millrace.functions import ordering
from millrace.session import results_folder, stored
from millrace.sources.landed import landed_pages, page_key, paged_tables, stream_pages
from millrace.sources.objects import read_objects, write_objects

catalog = Catalog()


def _place(spark: SparkSession) -> str:
    return f"{results_folder(spark)}/objects-{uuid.uuid4().hex}"


@catalog.add(
    "write_objects",
    """SELECT (page_id % 16) || '/' || sha256(url) || ':' || page_id || '.html' AS object_key,
 CAST(strlen(body) AS BIGINT) AS size, sha256(body) AS sha256
FROM (SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN lower(url) || html ELSE html END AS body FROM pages)""",
)
def objects(spark: SparkSession, folder: str) -> DataFrame:
    """Every page is an object; a second delivery overwrites every third one."""
    place = _place(spark)
    key = F.concat(
        (F.col("page_id") % 16).cast("string"),
        F.lit("/"),
        F.sha2("url", 256),
        F.lit(":"),
        F.col("page_id").cast("string"),
        F.lit(".html"),
    )
    pages = table(spark, folder, "pages").select("page_id", "url", key.alias("object_key"), "html")
    write_objects(pages, place, body="html")
    again = pages.filter(F.col("page_id") % 3 == 0)
    write_objects(again.withColumn("html", F.concat(F.lower("url"), "html")), place, body="html")
    return read_objects(spark, place).select(
        "object_key", F.length("body").cast("long").alias("size"), F.sha2("body", 256).alias("sha256")
    )


PAGE_IDS = 100


def document_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A language is a source; a page holds its documents of up to a hundred ids in a row."""
    docs = table(spark, folder, "documents").select(
        F.coalesce("lang", F.lit("none")).alias("source"),
        F.floor(F.col("doc_id") / PAGE_IDS).alias("block"),
        "doc_id",
        "text",
    )
    # Pages are numbered by their names alone; texts are moved once.
    numbered = ordering.sum_before(
        docs.select("source", "block").distinct().withColumn("one", F.lit(1)),
        ["source"],
        ["block"],
        "one",
        "before",
        F.floor(F.col("block") / 1024),
        totals={"pages": "one"},
    )
    blocks = docs.groupBy("source", "block").agg(
        F.array_sort(F.collect_list(F.struct("doc_id", "text"))).alias("records")
    )
    name = F.concat(F.lit("after "), "source", F.lit("/"))
    asked = F.when(F.col("before") > 0, F.concat(name, F.col("before").cast("string")))
    number = F.col("before") + 1
    following = F.when(number < F.col("pages"), F.concat(name, number.cast("string")))
    return blocks.join(numbered, ["source", "block"]).select(
        page_key(F.col("source"), number, asked).alias("object_key"),
        number.alias("page_number"),
        "pages",
        F.to_json(F.struct("records", following.alias("next_cursor"))).alias("body"),
    )


_LANDED_SQL = """l AS (SELECT coalesce(lang, 'none') AS source, doc_id, text FROM documents)"""


@catalog.add(
    "landed_records",
    f"""WITH {_LANDED_SQL} SELECT source, 'docs' AS stream,
 row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS record_index,
 CAST(doc_id AS BIGINT) AS doc_id, sha256(text) AS text_sha256 FROM l""",
)
def landed_records(spark: SparkSession, folder: str) -> DataFrame:
    """Pages are landed as single files and followed by many tasks."""
    place = _place(spark)
    write_objects(document_pages(spark, folder), place)
    read = paged_tables(landed_pages(spark, place), F.lit("https://api/docs"), F.lit("docs"))
    data = F.from_json("data", "doc_id long, text string")
    return read.records.select("source", "stream", "record_index", data.alias("d")).select(
        "source",
        "stream",
        F.col("record_index").cast("long").alias("record_index"),
        "d.doc_id",
        F.sha2("d.text", 256).alias("text_sha256"),
    )


@catalog.add(
    "landed_states",
    f"""WITH {_LANDED_SQL}, b AS (SELECT source, count(*) AS n,
 row_number() OVER (PARTITION BY source ORDER BY doc_id // {PAGE_IDS}) AS page,
 count(*) OVER (PARTITION BY source) AS pages FROM l GROUP BY source, doc_id // {PAGE_IDS})
SELECT source, CAST(page - 1 AS BIGINT) AS state_index,
 '{{"cursor":"after ' || source || '/' || page || '","page_number":' || page || ',"record_count":' || n ||
 ',"source_url":"https://api/docs"}}' AS data FROM b WHERE page < pages""",
)
def landed_states(spark: SparkSession, folder: str) -> DataFrame:
    """The first half of each source lands, is streamed, then the rest, by a restarted stream."""
    place, out = _place(spark), _place(spark)
    pages = stored(document_pages(spark, folder))
    early = F.col("page_number") * 2 <= F.col("pages")
    for landed in (pages.filter(early), pages.filter(~early)):
        write_objects(landed, place)
        (
            stream_pages(spark, place)
            .writeStream.format("parquet")
            .option("path", f"{out}/rows")
            .option("checkpointLocation", f"{out}/progress")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    read = spark.read.parquet(f"{out}/rows")
    states = paged_tables(read, F.lit("https://api/docs"), F.lit("docs")).states
    return states.select("source", F.col("state_index").cast("long").alias("state_index"), "data")
