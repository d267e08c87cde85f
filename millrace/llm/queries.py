"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.catalog.base import Catalog, table
from millrace.llm.bpe import encode_texts
from millrace.llm.exact_dedup import exact_groups
from millrace.llm.language import predict_language, train_language
from millrace.llm.licenses import license_digest, scan_licenses
from millrace.llm.mixing import take
from millrace.llm.neighbours import nearest
from millrace.llm.packing import pack
from millrace.llm.quality import score_quality, train_quality
from millrace.llm.samples import held_out
from millrace.llm.sharding import assign_shards
from millrace.llm.simhash import hex_digits, near_duplicates
from millrace.llm.spelling import group_variants, vocabulary
from millrace.llm.url_filter import judge_urls
from millrace.llm.whitening import whiten

catalog = Catalog()
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
QUALITY_THRESHOLD = 0.3
URL_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)


@catalog.add("op1_license_scan")
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices of every document."""
    return license_digest(scan_licenses(table(spark, folder, "documents")))


@catalog.add(
    "op2_mix_sources",
    r"""
    WITH d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
      FROM documents
    ), s AS (
      SELECT source, sum(size) AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
      FROM d GROUP BY source
    ), w AS (
      SELECT *, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
             3.0::DOUBLE * source_size AS most, sum(source_size) OVER () AS whole
      FROM s
    ), o AS (
      SELECT *,
             (whole - coalesce(sum(most) OVER (ORDER BY most / weight, place
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY most / weight, place
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w
    ), t AS (
      SELECT source, source_size,
             CASE WHEN level * weight < most
                  THEN max(CASE WHEN level * weight < most THEN level END) OVER () * weight
                  ELSE most END AS target
      FROM o
    ), r AS (
      SELECT d.doc_id, d.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
           CAST(CASE WHEN source_size = 0 THEN 0 ELSE
             (budget // source_size) * size
             + greatest(0, least(size, budget % source_size - earlier)) END AS BIGINT) AS taken
    FROM r
    """,
)
def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document."""
    taken = take(table(spark, folder, "documents"))
    words = F.col("epochs") * F.col("size") + F.col("part")
    return taken.select("doc_id", "size", "source_size", "target", words.alias("taken"))


@catalog.add("op3_bpe")
def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encode and decode every document; digests of ids and decoded text."""
    docs = table(spark, folder, "documents")
    encoded = encode_texts(docs, VOCABULARY, ["doc_id"], decoded=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@catalog.add("op4_nearest_vectors")
def op4_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth."""
    return nearest(table(spark, folder, "embeddings"), every=20, k=20)


@catalog.add(
    "op5_exact_dedup",
    """
    WITH n AS (
      SELECT doc_id,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz') AS content
      FROM documents
    )
    SELECT doc_id, max(doc_id) OVER (PARTITION BY content) AS keep_id,
           count(*) OVER (PARTITION BY content) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY content) AS kept,
           sha256(content) AS text_sha256
    FROM n
    """,
)
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal texts and the document of each that stays."""
    groups = exact_groups(table(spark, folder, "documents"))
    return groups.withColumnRenamed("digest", "text_sha256")


@catalog.add("op6_language_id")
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, folder, "documents")
    found = predict_language(docs, train_language(docs), ["doc_id"])
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


@catalog.add(
    "op7_url_filter",
    r"""
    WITH p AS (
      SELECT page_id, coalesce(url, '') AS u FROM pages
    ), s AS (
      SELECT page_id,
             translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
      FROM p
    ), r(host_rule, path_rule, verdict) AS (
      VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
             ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
    ), m AS (
      SELECT s.page_id, s.host, s.path, r.host_rule || r.path_rule AS rule, r.verdict,
             row_number() OVER (PARTITION BY s.page_id
                                ORDER BY length(r.host_rule || r.path_rule) DESC, r.verdict DESC,
                                         length(r.host_rule) DESC) AS place
      FROM s JOIN r ON (s.host = r.host_rule OR ends_with(s.host, '.' || r.host_rule))
                   AND starts_with(s.path, r.path_rule)
    )
    SELECT s.page_id, s.host, s.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
    FROM s LEFT JOIN m ON m.page_id = s.page_id AND m.place = 1
    """,
)
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, winning rule and verdict of every page."""
    return judge_urls(table(spark, folder, "pages"), URL_RULES, ["page_id"])


@catalog.add("op8_quality")
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, folder, "documents")
    model = train_quality(docs, table(spark, folder, "labels"))
    scored = score_quality(docs, model, ["doc_id"])
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


@catalog.add("op9_simhash")
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, folder, "documents"), shingle=3, radius=3)
    return found.select("doc_id", hex_digits().alias("fingerprint"), "component_id")


@catalog.add("op10_sharding")
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document, sizes near equal."""
    placed = assign_shards(table(spark, folder, "documents"), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@catalog.add("op11_packing")
def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of every document in sequences of at most 2048 tokens."""
    return pack(table(spark, folder, "documents"), VOCABULARY, size=2048, end=1)


@catalog.add(
    "op12_spelling",
    r"""
    WITH RECURSIVE steps AS (
      SELECT list_transform(range(256), lambda b: list_reduce(
               list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END
             )) AS crc
    ), runs AS (
      SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
             translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{7,}')),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
      FROM documents
    ), counted AS (
      SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS x FROM runs GROUP BY id, run
    ), hashed AS (
      SELECT run, n, xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT,
                 list_transform(range(1, length(x) + 1, 2), lambda i: CAST('0x' || x[i:i + 1] AS BIGINT))),
               lambda c, b: xor(c // 256, crc[xor(c % 256, b) + 1]))) AS h
      FROM counted, steps
    ), spelled AS (
      SELECT CASE WHEN h % 31 = 0 THEN run[:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word,
             n AS times
      FROM hashed
    ), words AS (
      SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelled
      WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
    ), places AS (
      SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words
    ), shorter AS (
      SELECT word, n, p, word[:p - 1] || word[p + 1:] AS rest FROM places
    ), pairs AS (
      SELECT a.word, b.word AS other, b.n AS other_n
      FROM shorter a JOIN shorter b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
      UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
    ), best AS (
      SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n
      FROM pairs GROUP BY word
    ), formed AS (
      SELECT words.word, n, coalesce(n_near, 0) AS n_near,
             CASE WHEN form_n >= 10 * n THEN form END AS form,
             CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
      FROM words LEFT JOIN best ON best.word = words.word
    ), chains AS (
      SELECT word, word AS root, form AS onward FROM formed
      UNION ALL
      SELECT c.word, f.word, f.form FROM chains c JOIN formed f ON f.word = c.onward
    )
    SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
    FROM formed f JOIN chains c ON c.word = f.word AND c.onward IS NULL
    """,
)
def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Near words, form and root of every word of the documents."""
    grouped = group_variants(vocabulary(table(spark, folder, "documents")))
    return grouped.select("word", "form", "root", "n", "n_near", "form_n")


@catalog.add("op13_whitening")
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The first four whitened components of every vector."""
    whitened = whiten(table(spark, folder, "embeddings"), components=4)
    return whitened.withColumn("deviation", F.col("deviation").try_cast("long"))


catalog.add("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
