"""Queries over documents, pages and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import Catalog, pick, sql_pick, table
from millrace.functions import identity
from millrace.operators.delivery import (
    PREVIEW_CHARS,
    build_payloads,
    document_evidence,
    row_evidence,
    text_evidence,
    vector_rows,
)
from millrace.operators.elements import doc_summary, element_counts, normalized_text
from millrace.operators.metadata import decorate_elements, normalize_metadata
from millrace.operators.partition import explode_elements, partition_documents
from millrace.operators.routing import (
    KIND_BY_EXTENSION,
    effective_strategy,
    plan_intake,
    route_by_extension,
)
from millrace.operators.runs import with_run_meta
from millrace.plans.documents import ingest_documents, source_report
from millrace.sources.fetched import (
    check_selector,
    fetched_metadata,
    wiki_filename,
)
from millrace.sources.specs import DOCUMENT_CONTRACT_BY_ALIAS, resolve_source_contract

catalog = Catalog()

RUN = {
    "run_id": "run-1",
    "pipeline_version": "p1",
    "timestamp_utc": "2026-01-01T00:00:00Z",
}
# Lines, trimmed and not empty, with their type, by the rule of the text partitioner.
LINES_SQL = """SELECT doc_id, source, lang, ord, line AS text,
 CASE WHEN regexp_matches(line, '^(?:[-*•‣▪–]|[0-9]{1,3}[.)])\\s+\\S') THEN 'ListItem'
  WHEN length(line) <= 80 AND NOT regexp_matches(line, '[.!?:;,…]$') THEN 'Title'
  ELSE 'NarrativeText' END AS type
FROM (SELECT doc_id, source, lang, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS ord
 FROM (SELECT doc_id, source, lang, regexp_replace(l[i], '^\\s+|\\s+$', '', 'g') AS line, i
  FROM (SELECT doc_id, source, lang, string_split_regex(text, '\\r\\n|[\\n\\r]') AS l FROM documents) d,
   LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i) r)
 WHERE line <> '')"""


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").withColumn(
        "sha256", identity.sha256_of(F.col("text"))
    )


def results(spark: SparkSession, folder: str) -> DataFrame:
    return partition_documents(documents(spark, folder), "text")


@catalog.add(
    "content_evidence",
    f"""SELECT doc_id, 'available' AS normalized_text_status,
 substr(text, 1, {PREVIEW_CHARS}) AS normalized_text_preview, length(text) AS normalized_text_len,
 sha256(text) AS normalized_text_sha256, length(text) > {PREVIEW_CHARS} AS normalized_text_truncated
FROM documents""",
)
def content_evidence_of_texts(spark: SparkSession, folder: str) -> DataFrame:
    return text_evidence(table(spark, folder, "documents").select("doc_id", "text"), "text")


@catalog.add("partition_text", f"SELECT doc_id, ord, type, text FROM ({LINES_SQL})")
def partition_text(spark: SparkSession, folder: str) -> DataFrame:
    return explode_elements(results(spark, folder), "doc_id").select(
        "doc_id", F.col("ord").cast("long").alias("ord"), "type", "text"
    )


SUMMARY_SQL = f"""SELECT doc_id, count(*) AS elements_count,
 CAST(sum(length(text)) + 2 * (count(*) - 1) AS BIGINT) AS normalized_text_len
FROM ({LINES_SQL}) GROUP BY doc_id"""


@catalog.add("doc_summary", SUMMARY_SQL)
def summary(spark: SparkSession, folder: str) -> DataFrame:
    return doc_summary(results(spark, folder), "doc_id").select(
        "doc_id",
        F.col("elements_count").cast("long").alias("elements_count"),
        F.col("normalized_text_len").cast("long").alias("normalized_text_len"),
    )


@catalog.add("element_counts", SUMMARY_SQL)
def counts_from_rows(spark: SparkSession, folder: str) -> DataFrame:
    return element_counts(explode_elements(results(spark, folder), "doc_id"), ["doc_id"])


@catalog.add(
    "normalized_text",
    """SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS normalized_text
FROM conversations WHERE text <> '' GROUP BY conv_id""",
)
def conversation_text(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").withColumnRenamed("turn", "ord")
    return normalized_text(
        turns, ["conv_id"], "\n\n", skip_empty=True, slice_by=F.floor(F.col("ord") / 1024)
    )


@catalog.add(
    "row_evidence",
    f"""SELECT conv_id, elements_count, CAST(length(t) AS BIGINT) AS normalized_text_len,
 substr(t, 1, {PREVIEW_CHARS}) AS normalized_text_preview,
 sha256(t) AS normalized_text_sha256, length(t) > {PREVIEW_CHARS} AS normalized_text_truncated
FROM (SELECT conv_id, count(*) AS elements_count, string_agg(text, chr(10) ORDER BY turn) AS t
 FROM conversations GROUP BY conv_id)""",
)
def conversation_evidence(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    return row_evidence(turns, ["conv_id"], "turn", "\n")


@catalog.add(
    "source_report",
    f"""SELECT source, count(*) AS docs, count(DISTINCT sha) AS contents,
 CAST(sum(n) AS BIGINT) AS elements, CAST(sum(chars) AS BIGINT) AS text_chars,
 count(*) FILTER (chars > {PREVIEW_CHARS}) AS truncated
FROM (SELECT doc_id, source, sha256(text) AS sha FROM documents) JOIN
 (SELECT doc_id, count(*) AS n, sum(length(text)) + 2 * (count(*) - 1) AS chars
  FROM ({LINES_SQL}) GROUP BY doc_id) USING (doc_id) GROUP BY source""",
)
def report_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return source_report(table(spark, folder, "documents"))


def intake_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Documents as files; those with a label were run before."""
    docs = documents(spark, folder).withColumn(
        "uri", F.concat(F.lit("/in/"), F.lpad(F.col("doc_id").cast("string"), 9, "0"))
    )
    labelled = table(spark, folder, "labels").select("doc_id")
    existing = docs.join(labelled, "doc_id", "left_semi").select("sha256")
    return docs, existing


@catalog.add(
    "plan_intake",
    """WITH d AS (SELECT doc_id, sha256(text) AS sha FROM documents),
 known AS (SELECT DISTINCT sha FROM d WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT doc_id, sha AS sha256, CASE WHEN row_number() OVER (PARTITION BY sha ORDER BY doc_id) = 1
 AND sha NOT IN (SELECT sha FROM known) THEN 'process' ELSE 'skipped_existing' END AS decision
FROM d""",
)
def intake(spark: SparkSession, folder: str) -> DataFrame:
    docs, existing = intake_inputs(spark, folder)
    return plan_intake(docs.select("doc_id", "uri", "sha256"), existing).select(
        "doc_id", "sha256", "decision"
    )


EXTENSIONS = (*KIND_BY_EXTENSION, ".PDF", ".exe", "", ".tar")
STRATEGIES = ("auto", "fast", "hi_res", "ocr_only")
_KIND_SQL = """CASE WHEN e IN ('.txt', '.text', '.log') THEN 'text' WHEN e IN ('.html', '.htm') THEN 'html'
 WHEN e IN ('.md', '.markdown') THEN 'md' WHEN e = '.eml' THEN 'email'
 WHEN e IN ('.png', '.jpg', '.jpeg', '.tiff', '.tif', '.bmp', '.heic') THEN 'image'
 WHEN e IN ('.xlsx', '.xls') THEN 'xlsx' WHEN e IN ('.ndjson', '.jsonl') THEN 'ndjson'
 WHEN e IN ('.xml', '.msg', '.json', '.pdf', '.csv', '.tsv', '.doc', '.docx', '.ppt', '.pptx', '.rtf', '.rst',
  '.epub', '.odt', '.org') THEN substr(e, 2) END"""


@catalog.add(
    "route_by_extension",
    f"""SELECT *, CASE WHEN kind IS NULL THEN 'ZE-UNS-UNSUPPORTED-TYPE' END AS error_code,
 CASE WHEN kind = 'image' AND strategy = 'fast' THEN 'auto'
  WHEN kind IN ('pdf', 'image') THEN strategy END AS effective_strategy
FROM (SELECT doc_id, extension, strategy, {_KIND_SQL} AS kind
 FROM (SELECT *, lower(extension) AS e FROM (SELECT doc_id, {sql_pick(EXTENSIONS, f'doc_id % {len(EXTENSIONS)}')} AS extension,
  {sql_pick(STRATEGIES, 'n_chars % 4')} AS strategy FROM documents)))""",
)
def route(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "documents").select(
        "doc_id",
        pick(EXTENSIONS, F.col("doc_id") % len(EXTENSIONS)).alias("extension"),
        pick(STRATEGIES, F.col("n_chars") % 4).alias("strategy"),
    )
    return effective_strategy(route_by_extension(files))


CONTENT_TYPES = ("text/html; charset=UTF-8", " Application/PDF", "", "image/png", None)
DISPOSITIONS = (
    None,
    'attachment; filename="report one.pdf"',
    "attachment; filename*=UTF-8''na%20me.txt; filename=plain.txt",
    "inline",
    'attachment; filename="/tmp/x/"; FILENAME=second.csv',
)
_DISPOSITION_NAMES = (None, "report one.pdf", "na me.txt", None, "x")
_EXT_CASE = """WHEN 'text/plain' THEN '.txt' WHEN 'text/html' THEN '.html' WHEN 'text/csv' THEN '.csv'
 WHEN 'application/pdf' THEN '.pdf' WHEN 'application/json' THEN '.json' WHEN 'application/xml' THEN '.xml'
 WHEN 'text/xml' THEN '.xml'"""


def _sql_quoted(values: tuple) -> tuple:
    return tuple(None if v is None else v.replace("'", "''") for v in values)


@catalog.add(
    "fetched_metadata",
    f"""SELECT page_id, mime_type, coalesce(named,
  CASE WHEN base = '' THEN 'downloaded' || ext
   WHEN regexp_matches(base, '^.+\\.[^.]+$') THEN base ELSE base || ext END) AS filename
FROM (SELECT *, coalesce(CASE mime_type {_EXT_CASE} END, '') AS ext,
  regexp_extract(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', ''),
   '([^/]*)$', 1) AS base
 FROM (SELECT page_id, url, nullif(lower(trim(split_part({sql_pick(CONTENT_TYPES, 'page_id % 5')},
   ';', 1))), '') AS mime_type,
  {sql_pick(_DISPOSITION_NAMES, '(page_id // 5) % 5')} AS named FROM pages))""",
)
def fetched(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select(
        "page_id",
        "url",
        pick(CONTENT_TYPES, F.col("page_id") % 5).alias("content_type"),
        pick(DISPOSITIONS, F.floor(F.col("page_id") / 5) % 5).alias("disposition"),
    )
    return fetched_metadata(pages, "content_type", url="url", disposition="disposition").select(
        "page_id", "mime_type", "filename"
    )


KEY_TAILS = (".md", "", "/", ".tar.gz", "/.")


@catalog.add(
    "object_metadata",
    f"""SELECT doc_id, mime_type, CASE WHEN regexp_matches(base, '^.+\\.[^.]+$') THEN base
  ELSE base || coalesce(CASE mime_type {_EXT_CASE} END, '') END AS filename
FROM (SELECT doc_id, nullif(lower(trim(split_part({sql_pick(CONTENT_TYPES, 'n_chars % 5')}, ';', 1))),
  '') AS mime_type, 'doc-' || doc_id || {sql_pick(('.md', '', '', '.tar.gz', ''), 'doc_id % 5')} AS base
 FROM documents)""",
)
def object_metadata(spark: SparkSession, folder: str) -> DataFrame:
    objects = table(spark, folder, "documents").select(
        "doc_id",
        F.concat(
            "source",
            F.lit("/doc-"),
            F.col("doc_id").cast("string"),
            pick(KEY_TAILS, F.col("doc_id") % 5),
        ).alias("key"),
        pick(CONTENT_TYPES, F.col("n_chars") % 5).alias("content_type"),
    )
    return fetched_metadata(objects, "content_type", key="key").select(
        "doc_id", "mime_type", "filename"
    )


@catalog.add(
    "wiki_pages",
    """SELECT *, CASE WHEN problem IS NOT NULL THEN false END AS retryable
FROM (SELECT doc_id, CASE WHEN short <> '' THEN short || '.html'
   ELSE 'confluence-page-' || doc_id || '.html' END AS filename,
  CASE WHEN space_key IS NOT NULL AND space_key <> lang THEN 'space_key_mismatch'
   WHEN page_version IS NOT NULL AND page_version IS DISTINCT FROM n_chars % 4
    THEN 'page_version_mismatch' END AS problem
 FROM (SELECT doc_id, lang, n_chars, CASE WHEN doc_id % 3 > 0 THEN 'en' END AS space_key,
   CASE WHEN doc_id % 2 = 0 THEN 1 END AS page_version,
   lower(regexp_replace(regexp_replace(text, '[^A-Za-z0-9]+', '-', 'g'),
    '^-+|-+$', '', 'g')) AS short FROM documents))""",
)
def wiki_pages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    key = F.col("doc_id")
    pages = docs.select(
        key,
        wiki_filename(F.col("text"), key).alias("filename"),
        F.col("lang").alias("resolved_space_key"),
        (F.col("n_chars") % 4).alias("resolved_page_version"),
    )
    asked = docs.select(
        key,
        F.when(key % 3 > 0, "en").alias("space_key"),
        F.when(key % 2 == 0, 1).alias("page_version"),
    )
    return check_selector(pages, asked, "doc_id").select(
        "doc_id", "filename", "problem", "retryable"
    )


ALIASES = (*DOCUMENT_CONTRACT_BY_ALIAS, " Git ", "ftp")
_ALIAS_SQL = """CASE WHEN a = 'url' THEN 'http_document_v1'
 WHEN regexp_matches(a, '^(http|s3|git|google_drive|confluence)(_document(_v1)?)?$')
 THEN regexp_extract(a, '^(http|s3|git|google_drive|confluence)', 1) || '_document_v1' END"""


@catalog.add(
    "resolve_source_contract",
    f"""SELECT *, 'source.uns.' || replace(source_contract_id, '_v1', '.v1') AS source_spec_id
FROM (SELECT doc_id, {_ALIAS_SQL} AS source_contract_id
 FROM (SELECT doc_id, lower(trim({sql_pick(ALIASES, f'doc_id % {len(ALIASES)}')})) AS a FROM documents))""",
)
def contracts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id",
        F.lit("uns").alias("kind"),
        pick(ALIASES, F.col("doc_id") % len(ALIASES)).alias("alias"),
    )
    return resolve_source_contract(docs, "kind", "alias").select(
        "doc_id", "source_contract_id", "source_spec_id"
    )


@catalog.add(
    "task_keys",
    """SELECT doc_id, '{"kind":"uns","pipeline_version":"' || lang || '","sha256":"' || sha || '"}'
  AS task_key, sha || ':' || source AS delivery_key,
 h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' ||
  translate(h[17], '0123456789abcdef', '89ab89ab89ab89ab') || h[18:20] || '-' || h[21:32]
  AS object_uuid
FROM (SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(sha)) AS h
 FROM (SELECT doc_id, lang, source, sha256(text) AS sha FROM documents))""",
)
def task_keys(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select(
        "doc_id",
        identity.task_key(F.lit("uns"), F.col("lang"), F.col("sha256")).alias("task_key"),
        identity.delivery_key(F.col("sha256"), F.col("source")).alias("delivery_key"),
        identity.object_uuid(F.col("sha256")).alias("object_uuid"),
    )


def _replaced(value: str, *steps: tuple[str, str]) -> str:
    """Nested SQL calls that replace every match of a pattern by an expression."""
    for pattern, by in steps:
        value = f"regexp_replace({value}, '{pattern}', {by}, 'g')"
    return value


_BODY_SQL = _replaced(
    "html",
    ("(?s)<!--.*?-->", "''"),
    ("(?is)<script\\b.*?</script\\s*>", "chr(10)"),
    ("(?is)<style\\b.*?</style\\s*>", "chr(10)"),
    ("(?is)<nav\\b.*?</nav\\s*>", "chr(10)"),
    ("(?is)<head\\b.*?</head\\s*>", "chr(10)"),
    ("\\s+", "' '"),
    ("(?i)<h[1-6]\\b[^>]*>", "chr(10) || chr(1)"),
    ("(?i)<li\\b[^>]*>", "chr(10) || chr(2)"),
    ("(?i)</(?:h[1-6]|li)\\s*>", "chr(3) || chr(10)"),
    ("(?i)</?(?:article|body|br|div|footer|html|p|table|td|th|tr|ul|ol|section)\\b[^>]*>", "chr(10)"),
    ("<[A-Za-z/!?][^>]*>", "''"),
    ("[\\x01\\x02]\\s*\\x03", "''"),
    ("([\\x01\\x02]+) *\\n\\s*", "chr(10) || '\\1'"),
    ("\\x03", "''"),
    ("&copy;", "'©'"),
    ("&middot;", "'·'"),
    ("&quot;", "'\"'"),
    ("&lt;", "'<'"),
    ("&gt;", "'>'"),
    ("&amp;", "'&'"),
)


@catalog.add(
    "partition_html",
    f"""SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS ord,
 CASE WHEN contains(line, chr(1)) THEN 'Title'
  WHEN contains(line, chr(2)) OR regexp_matches(text, '^(?:[-*•‣▪–]|[0-9]{{1,3}}[.)])\\s+\\S')
  THEN 'ListItem' ELSE 'NarrativeText' END AS type, text
FROM (SELECT page_id, i, l[i] AS line, regexp_replace(l[i], '^[\\s\\x01\\x02]+|\\s+$', '', 'g') AS text
 FROM (SELECT page_id, string_split({_BODY_SQL}, chr(10)) AS l FROM pages) p,
  LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i) r)
WHERE text <> ''""",
)
def partition_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").withColumn("sha256", identity.sha256_of(F.col("html")))
    return explode_elements(partition_documents(pages, "html", "html"), "page_id").select(
        "page_id", F.col("ord").cast("long").alias("ord"), "type", "text"
    )


@catalog.add(
    "partition_md",
    """SELECT conv_id, turn, CAST(0 AS BIGINT) AS ord, 'Title' AS type, role AS text FROM conversations
UNION ALL SELECT conv_id, turn, CAST(1 AS BIGINT), 'NarrativeText',
 regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s*\\n\\s*', ' ', 'g')
FROM conversations WHERE regexp_matches(text, '\\S')""",
)
def partition_md(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as markdown: the role is a heading, the text a body."""
    turns = table(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        F.concat(F.lit("## "), "role", F.lit("\n\n"), "text").alias("text"),
    )
    hashed = turns.withColumn("sha256", identity.sha256_of(F.col("text")))
    parts = partition_documents(hashed, "md")
    return explode_elements(parts, "conv_id", "turn").select(
        "conv_id", "turn", F.col("ord").cast("long").alias("ord"), "type", "text"
    )


@catalog.add(
    "normalize_bbox",
    """SELECT vec_id, CASE WHEN label % 3 = 0 THEN true WHEN label % 3 = 1 THEN false END AS is_extracted,
 round(x_min, 5) AS x_min, round(y_min, 5) AS y_min, round(x_max, 5) AS x_max, round(y_max, 5) AS y_max,
 CASE WHEN label % 3 = 2 THEN 'is_extracted_not_a_boolean' ELSE '' END AS warnings,
 false AS has_folder
FROM (SELECT vec_id, label, list_min(xs) AS x_min, list_min(ys) AS y_min, list_max(xs) AS x_max,
  list_max(ys) AS y_max
 FROM (SELECT vec_id, label, [CAST(embedding[2 * i + 1] AS DOUBLE) FOR i IN range(32)] AS xs,
  [CAST(embedding[2 * i + 2] AS DOUBLE) FOR i IN range(32)] AS ys FROM embeddings))""",
)
def normalize_bbox(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    pairs = F.transform(
        F.sequence(F.lit(0), (F.size("embedding") / 2 - 1).cast("int")),
        lambda i: F.array(
            F.get("embedding", 2 * i).cast("double"), F.get("embedding", 2 * i + 1).cast("double")
        ),
    )
    raw = F.to_json(
        F.struct(
            F.lit("/private/in").alias("file_directory"),
            pick(("true", "No", "maybe"), F.col("label") % 3).alias("is_extracted"),
            F.struct(pairs.alias("points"), F.lit("PixelSpace").alias("system")).alias(
                "coordinates"
            ),
        )
    )
    elements = vectors.select("vec_id", raw.alias("metadata"))
    normal = normalize_metadata(elements)
    return normal.select(
        "vec_id",
        "is_extracted",
        *[F.round(F.col(f"bbox.{c}"), 5).alias(c) for c in ("x_min", "y_min", "x_max", "y_max")],
        F.array_join("metadata_warnings", ",").alias("warnings"),
        F.col("metadata").contains("file_directory").alias("has_folder"),
    )


@catalog.add(
    "decorate_elements",
    f"""SELECT doc_id, ord, '{{"fetched_filename":"doc-' || doc_id || '.txt",' ||
 CASE WHEN doc_id % 2 = 0 THEN '"fetched_mime_type":"text/plain",' ELSE '' END ||
 '"lang":"' || lang || '","source_kind":"http_document_v1","source_url":"https://h/' || source || '"}}'
 AS metadata FROM ({LINES_SQL})""",
)
def decorated(spark: SparkSession, folder: str) -> DataFrame:
    """Documents are decorated before they are taken apart, so no element is joined."""
    docs = results(spark, folder).withColumn("metadata", F.to_json(F.struct("lang")))
    fetches = table(spark, folder, "documents").select(
        "doc_id",
        F.concat(F.lit("https://h/"), "source").alias("url"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"),
        F.when(F.col("doc_id") % 2 == 0, "text/plain").alias("mime_type"),
    )
    fields = {
        "source_url": "url",
        "fetched_filename": "filename",
        "fetched_mime_type": "mime_type",
    }
    with_facts = decorate_elements(docs, fetches, "doc_id", "http_document_v1", fields)
    return explode_elements(with_facts, "doc_id", "metadata").select(
        "doc_id", F.col("ord").cast("long").alias("ord"), "metadata"
    )


def _run_facts(spark: SparkSession, folder: str) -> DataFrame:
    docs = results(spark, folder)
    return docs.select(
        "doc_id",
        "sha256",
        F.concat(F.lit("run-"), F.col("doc_id").cast("string")).alias("run_id"),
        F.lit("p1").alias("pipeline_version"),
        F.lit("2026-01-01T00:00:00Z").alias("timestamp_utc"),
        F.lit("success").alias("outcome"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"),
        F.lit(None).cast("string").alias("mime_type"),
        F.col("n_chars").alias("size_bytes"),
        F.lit("2026-01-01T00:00:00Z").alias("created_at_utc"),
        F.lit("builtin").alias("engine_name"),
        F.lit("spark").alias("engine_backend"),
        F.lit("1").alias("engine_version"),
        F.lit("auto").alias("strategy"),
        F.size("elements").alias("elements_count"),
        F.length("normalized_text").alias("normalized_text_len"),
        F.lit(1).alias("attempts"),
        F.lit("intake").alias("run_origin"),
        F.lit("primary").alias("delivery_origin"),
        F.lit("batch").alias("execution_mode"),
        "normalized_text",
        "elements",
    )


@catalog.add(
    "run_meta",
    f"""SELECT doc_id, '{{"document":{{"created_at_utc":"2026-01-01T00:00:00Z","filename":"d' || doc_id ||
 '.txt","mime_type":null,"sha256":"' || sha256(text) || '","size_bytes":' || n_chars ||
 '}},"engine":{{"backend":"spark","name":"builtin","strategy":"auto","version":"1"}},"error":null,' ||
 '"metrics":{{"attempts":1,"duration_ms":null,"elements_count":' || elements_count ||
 ',"normalized_text_len":' || normalized_text_len || '}},"outcome":"success","pipeline_version":"p1",' ||
 '"provenance":{{"delivery_origin":"primary","execution_mode":"batch","run_origin":"intake"}},' ||
 '"run_id":"run-' || doc_id || '","schema_version":3,"timestamp_utc":"2026-01-01T00:00:00Z",' ||
 '"warnings":[]}}' AS run_meta
FROM documents JOIN ({SUMMARY_SQL}) USING (doc_id)""",
)
def run_meta(spark: SparkSession, folder: str) -> DataFrame:
    return with_run_meta(_run_facts(spark, folder)).select("doc_id", "run_meta")


@catalog.add(
    "build_payloads",
    f"""WITH t AS (SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY ord) AS nt,
  count(*) AS n FROM ({LINES_SQL}) GROUP BY doc_id)
SELECT doc_id, sha || ':run-' || doc_id AS delivery_identity,
 '{{"artifacts":{{"out_dir":"/out/' || sha || '","run_meta_path":"/out/' || sha ||
 '/run_meta.json","elements_path":"/out/' || sha || '/elements.json","normalized_path":"/out/' || sha ||
 '/normalized.txt"}},"content_evidence":{{"elements_count":' || n ||
 ',"normalized_text_status":"available","normalized_text_preview":' ||
 CAST(to_json(substr(nt, 1, {PREVIEW_CHARS})) AS VARCHAR) || ',"normalized_text_len":' || length(nt) ||
 ',"normalized_text_sha256":"' || sha256(nt) || '","normalized_text_truncated":' ||
 CASE WHEN length(nt) > {PREVIEW_CHARS} THEN 'true' ELSE 'false' END ||
 ',"evidence_kind":"normalized_text_preview_v1"}},"run_meta":{{"engine":"builtin"}},' ||
 '"schema_version":1,"sha256":"' || sha || '"}}' AS payload_json
FROM (SELECT doc_id, sha256(text) AS sha FROM documents) JOIN t USING (doc_id)""",
)
def payloads(spark: SparkSession, folder: str) -> DataFrame:
    docs = results(spark, folder)
    meta = docs.select(
        "doc_id",
        "sha256",
        F.concat(F.lit("run-"), F.col("doc_id").cast("string")).alias("run_id"),
        F.lit("builtin").alias("engine_name"),
        F.lit('{"engine":"builtin"}').alias("run_meta"),
    )
    evidence = document_evidence(docs, ["doc_id"])
    return build_payloads(meta, evidence, "/out", on="doc_id").select(
        "doc_id", "delivery_identity", "payload_json"
    )


@catalog.add(
    "vector_rows",
    f"""WITH t AS (SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY ord) AS nt,
  count(*) AS n FROM ({LINES_SQL}) GROUP BY doc_id)
SELECT h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' ||
  translate(h[17], '0123456789abcdef', '89ab89ab89ab89ab') || h[18:20] || '-' || h[21:32] AS uuid,
 sha AS sha256, 'run-' || doc_id AS run_id, 'd' || doc_id || '.txt' AS filename,
 n_chars AS size_bytes, n AS elements_count, nt AS normalized_text,
 'primary' AS delivery_origin, 'batch' AS execution_mode
FROM (SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(sha)) AS h
 FROM (SELECT doc_id, n_chars, sha256(text) AS sha FROM documents)) JOIN t USING (doc_id)""",
)
def vectors(spark: SparkSession, folder: str) -> DataFrame:
    runs = _run_facts(spark, folder).withColumn("has_result", F.lit(True))
    return vector_rows(runs).select(
        "uuid",
        "sha256",
        "run_id",
        "filename",
        "size_bytes",
        F.col("elements_count").cast("long").alias("elements_count"),
        "normalized_text",
        "delivery_origin",
        "execution_mode",
    )


def ingested_sql(filename: str) -> str:
    """Payload of every document, as the ingest of run ``run-1`` shapes it."""
    return f"""SELECT filename, sha AS sha256, sha || ':run-1' AS delivery_identity, n AS elements_count,
 CAST(length(nt) AS BIGINT) AS normalized_text_len,
 '{{"artifacts":{{"out_dir":"/out/' || sha || '","run_meta_path":"/out/' || sha ||
 '/run_meta.json","elements_path":"/out/' || sha || '/elements.json","normalized_path":"/out/' || sha ||
 '/normalized.txt"}},"content_evidence":{{"elements_count":' || n ||
 ',"normalized_text_status":"available","normalized_text_preview":' ||
 CAST(to_json(substr(nt, 1, {PREVIEW_CHARS})) AS VARCHAR) || ',"normalized_text_len":' || length(nt) ||
 ',"normalized_text_sha256":"' || sha256(nt) || '","normalized_text_truncated":' ||
 CASE WHEN length(nt) > {PREVIEW_CHARS} THEN 'true' ELSE 'false' END ||
 ',"evidence_kind":"normalized_text_preview_v1"}},"run_meta":{{"document":{{"created_at_utc":' ||
 '"2026-01-01T00:00:00Z","filename":"' || filename || '","mime_type":null,"sha256":"' || sha ||
 '","size_bytes":' || bytes || '}},"engine":{{"backend":"spark","name":"builtin","strategy":"auto",' ||
 '"version":"1"}},"error":null,"metrics":{{"attempts":1,"duration_ms":null,"elements_count":' || n ||
 ',"normalized_text_len":' || length(nt) || '}},"outcome":"success","pipeline_version":"p1",' ||
 '"provenance":{{"delivery_origin":"primary","execution_mode":"batch","run_origin":"intake",' ||
 '"task_identity_key":"{{\\"kind\\":\\"uns\\",\\"pipeline_version\\":\\"p1\\",\\"sha256\\":\\"' || sha ||
 '\\"}}"}},"run_id":"run-1","schema_version":3,"timestamp_utc":"2026-01-01T00:00:00Z","warnings":[]}},' ||
 '"schema_version":1,"sha256":"' || sha || '"}}' AS payload_json
FROM (SELECT doc_id, {filename} AS filename, sha256(text) AS sha, strlen(text) AS bytes FROM documents)
 JOIN (SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY ord) AS nt, count(*) AS n
  FROM ({LINES_SQL}) GROUP BY doc_id) USING (doc_id)"""


INGESTED_SQL = ingested_sql("'/in/' || lpad(CAST(doc_id AS VARCHAR), 9, '0')")


@catalog.add(
    "ingest_documents",
    f"""WITH d AS (SELECT doc_id, sha256(text) AS sha FROM documents),
 known AS (SELECT DISTINCT sha FROM d WHERE doc_id IN (SELECT doc_id FROM labels)),
 chosen AS (SELECT min(doc_id) AS doc_id FROM d WHERE sha NOT IN (SELECT sha FROM known) GROUP BY sha)
SELECT p.* FROM ({INGESTED_SQL}) p
WHERE filename IN (SELECT '/in/' || lpad(CAST(doc_id AS VARCHAR), 9, '0') FROM chosen)""",
)
def ingest(spark: SparkSession, folder: str) -> DataFrame:
    docs, existing = intake_inputs(spark, folder)
    files = docs.select("uri", F.col("uri").alias("filename"), "text")
    tables = ingest_documents(files, existing, "text", RUN, "/out")
    return tables.payloads.select(
        "filename",
        "sha256",
        "delivery_identity",
        F.col("elements_count").cast("long").alias("elements_count"),
        F.col("normalized_text_len").cast("long").alias("normalized_text_len"),
        "payload_json",
    )
