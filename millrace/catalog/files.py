"""Queries that write given tables out as files and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import Catalog, table
from millrace.catalog.documents import LINES_SQL
from millrace.functions import identity
from millrace.operators.partition import partition_documents
from millrace.operators.sinks import read_artifacts, write_artifacts
from millrace.operators.store import CODEC, compact_keyed, deal_keyed, write_keyed
from millrace.session import results_folder
from millrace.session import stored as written
from millrace.sources.files import scan_files
from millrace.sources.tabular import SEPARATORS, partition_tabular

catalog = Catalog()


def _place(spark: SparkSession) -> str:
    return f"{results_folder(spark)}/files-{uuid.uuid4().hex}"


#: Tasks that write files; small rows cost a file each, so their bytes do not say how many.
FILE_TASKS = 64


@catalog.add(
    "scan_files",
    """SELECT CAST(s_suppkey AS VARCHAR) AS folder, '.txt' AS extension,
 CAST(sum(strlen(coalesce(s_name, '')) + 1) AS BIGINT) AS size_bytes,
 sha256(string_agg(coalesce(s_name, '') || chr(10), '' ORDER BY s_name NULLS FIRST)) AS sha256
FROM supplier GROUP BY s_nationkey, s_suppkey""",
)
def scanned(spark: SparkSession, folder: str) -> DataFrame:
    """A file for each supplier, in its own folder below that of its nation, is listed and
    hashed."""
    place = _place(spark)
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("key"), "s_name"
    )
    ordered = suppliers.repartition(FILE_TASKS, "nation", "key").sortWithinPartitions("nation", "key", "s_name")
    ordered.write.partitionBy("nation", "key").text(place)
    key = F.regexp_extract("uri", "/key=(-?[0-9]+)/", 1)
    return scan_files(spark, place, with_sha=True).select(
        F.nullif(key, F.lit("")).alias("folder"), "extension", "size_bytes", "sha256"
    )


_KINDS = ("csv", "tsv", "json", "ndjson", "xml")


@catalog.add(
    "partition_tabular",
    f"""SELECT kind, 'TableRow' AS type, CAST(c_custkey // 1000 AS VARCHAR) AS file,
 CAST(row_number() OVER (PARTITION BY kind, c_custkey // 1000 ORDER BY c_custkey) - 1 AS BIGINT) AS ord,
 (c_custkey // 1000) || ':' || (row_number() OVER (PARTITION BY kind, c_custkey // 1000 ORDER BY c_custkey) - 1)
 AS element_id,
 '{{"k":' || c_custkey || ',"name":"' || c_name || ' \\"' ||
 CASE WHEN kind = 'xml' THEN '' ELSE '\\n' END || lower(c_mktsegment) || '\\"","empty":null}}' AS text
FROM customer, (SELECT unnest({list(_KINDS)}) AS kind)""",
)
def tabular(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as files of every kind, with quotes and line breaks in their values."""
    c = table(spark, folder, "customer")
    out = None
    for kind in _KINDS:
        place = f"{_place(spark)}/{kind}"
        gap = "" if kind == "xml" else "\n"
        name = F.concat("c_name", F.lit(f' "{gap}'), F.lower("c_mktsegment"), F.lit('"'))
        rows = c.select(
            F.floor(F.col("c_custkey") / 1000).alias("file"),
            F.col("c_custkey").alias("k"),
            name.alias("name"),
            F.lit(None).cast("string").alias("empty"),
        )
        if kind == "json":  # a file is one list
            rows = rows.groupBy("file").agg(
                F.to_json(F.array_sort(F.collect_list(F.struct("k", "name", "empty")))).alias("list")
            )
            rows.repartition("file").write.partitionBy("file").text(place)
        else:
            ordered = rows.repartition("file").sortWithinPartitions("file", "k")
            writer = ordered.write.partitionBy("file")
            if kind in SEPARATORS:
                writer.csv(place, header=True, sep=SEPARATORS[kind], quote='"', escape='"')
            elif kind == "xml":
                writer.format("xml").option("rowTag", "row").save(place)
            else:
                writer.json(place)
        read = partition_tabular(spark, f"{place}/*", kind, "k long, name string, empty string")
        named = "^.*/file=([0-9]+)/[^/]*?(:[0-9]+)?$"
        one = read.select(
            F.lit(kind).alias("kind"),
            "type",
            F.regexp_replace("uri", named, "$1").alias("file"),
            "ord",
            F.regexp_replace("element_id", named, "$1$2").alias("element_id"),
            "text",
        )
        out = one if out is None else out.unionByName(one)
    return out


@catalog.add(
    "read_artifacts",
    f"""WITH d AS (SELECT sha256(text) AS sha256, min(doc_id) AS doc_id, any_value(text) AS text
 FROM documents GROUP BY 1)
SELECT sha256, doc_id, CASE WHEN doc_id % 3 = 0 THEN 'b2' ELSE 'b1' END AS batch,
 CAST(n AS BIGINT) AS elements, chars AS text_chars, sha256(t) AS text_sha256
FROM d JOIN (SELECT doc_id, count(*) AS n, length(string_agg(text, chr(10) || chr(10) ORDER BY ord)) AS chars,
 string_agg(text, chr(10) || chr(10) ORDER BY ord) AS t FROM ({LINES_SQL}) GROUP BY doc_id) USING (doc_id)""",
)
def stored(spark: SparkSession, folder: str) -> DataFrame:
    """Partitioned documents of two batches; the second replaces those of every third content."""
    place = _place(spark)
    docs = table(spark, folder, "documents").withColumn("sha256", identity.sha256_of(F.col("text")))
    firsts = docs.groupBy("sha256").agg(F.min("doc_id").alias("doc_id"))
    # Three batches are made of them: the texts are moved to their buckets' tasks once.
    chosen = docs.join(firsts, ["sha256", "doc_id"]).select("sha256", "doc_id", "text")
    contents = written(deal_keyed(chosen), CODEC)
    results = partition_documents(contents, "text").select(
        "sha256", "doc_id", "elements", "normalized_text"
    )
    meta = contents.select("sha256", "doc_id")
    third = F.col("doc_id") % 3 == 0
    write_artifacts(meta, results, place, "b1", dealt=True)
    write_artifacts(meta.filter(third), results.filter(third), place, "b2", dealt=True)
    # A batch that is run again replaces its own rows.
    write_artifacts(meta, results, place, "b1", dealt=True)
    return read_artifacts(spark, place, "results").select(
        "sha256",
        "doc_id",
        "batch",
        F.size("elements").cast("long").alias("elements"),
        F.length("normalized_text").cast("long").alias("text_chars"),
        identity.sha256_of(F.col("normalized_text")).alias("text_sha256"),
    )


@catalog.add(
    "read_artifacts_asked",
    """SELECT sha256(text) AS sha256, min(doc_id) AS doc_id, 'b9' AS batch FROM documents
WHERE doc_id % 50 = 0 GROUP BY 1""",
)
def asked(spark: SparkSession, folder: str) -> DataFrame:
    """Contents of every fiftieth document, looked up in a store of ten compacted batches."""
    place = _place(spark)
    docs = table(spark, folder, "documents").withColumn("sha256", identity.sha256_of(F.col("text")))
    wanted = docs.filter(F.col("doc_id") % 50 == 0).groupBy("sha256").agg(F.min("doc_id").alias("doc_id"))
    for n in range(10):
        rows = wanted if n == 9 else docs.filter(F.col("doc_id") % 10 == n).select("sha256", "doc_id")
        write_keyed(rows, place, "run_meta", f"b{n}")
    compact_keyed(spark, place, "run_meta", before="b9", apart=4)
    return read_artifacts(spark, place, "run_meta", wanted).select("sha256", "doc_id", "batch")
