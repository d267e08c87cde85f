"""Source specifications: dispatch, contract names and identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import identity
from millrace.functions import jsontext as J

# Names a task may use for a document source, and their contract.
DOCUMENT_CONTRACT_BY_ALIAS = {
    "http": "http_document_v1",
    "http_document": "http_document_v1",
    "http_document_v1": "http_document_v1",
    "url": "http_document_v1",
    "s3": "s3_document_v1",
    "s3_document": "s3_document_v1",
    "s3_document_v1": "s3_document_v1",
    "git": "git_document_v1",
    "git_document": "git_document_v1",
    "git_document_v1": "git_document_v1",
    "google_drive": "google_drive_document_v1",
    "google_drive_document": "google_drive_document_v1",
    "google_drive_document_v1": "google_drive_document_v1",
    "confluence": "confluence_document_v1",
    "confluence_document": "confluence_document_v1",
    "confluence_document_v1": "confluence_document_v1",
}
# Names a task may use for a record source, and their contract.
RECORD_CONTRACT_BY_ALIAS = {
    "http_json_cursor": "http_json_cursor_v1",
    "http_json_cursor_v1": "http_json_cursor_v1",
    "postgresql": "postgresql_incremental_v1",
    "postgresql_incremental": "postgresql_incremental_v1",
    "postgresql_incremental_v1": "postgresql_incremental_v1",
    "clickhouse": "clickhouse_incremental_v1",
    "clickhouse_incremental": "clickhouse_incremental_v1",
    "clickhouse_incremental_v1": "clickhouse_incremental_v1",
    "kafka": "kafka_partition_offset_v1",
    "kafka_partition_offset": "kafka_partition_offset_v1",
    "kafka_partition_offset_v1": "kafka_partition_offset_v1",
    "mongodb": "mongodb_incremental_v1",
    "mongodb_incremental": "mongodb_incremental_v1",
    "mongodb_incremental_v1": "mongodb_incremental_v1",
}
DOCUMENT_KINDS = tuple(dict.fromkeys(DOCUMENT_CONTRACT_BY_ALIAS.values()))
RECORD_KINDS = tuple(dict.fromkeys(RECORD_CONTRACT_BY_ALIAS.values()))

# Fields that make up the identity of a source, by kind, in the order that
# sources declare them.  Credentials are no part of it.
IDENTITY_FIELDS = {
    "postgresql_incremental_v1": (
        "stream", "connection_name", "schema", "table", "columns", "cursor_column",
        "cursor_start", "batch_size",
    ),
    "clickhouse_incremental_v1": (
        "stream", "connection_name", "endpoint", "database", "table", "columns",
        "cursor_column", "cursor_start", "batch_size",
    ),
    "mongodb_incremental_v1": (
        "stream", "connection_name", "uri", "database", "collection", "fields",
        "cursor_field", "cursor_start", "batch_size",
    ),
    "kafka_partition_offset_v1": (
        "stream", "connection_name", "brokers", "topic", "partition", "offset_start",
        "batch_size",
    ),
    "http_json_cursor_v1": ("stream", "url", "cursor_param", "query"),
    "http_document_v1": ("url", "accept"),
    "s3_document_v1": ("bucket", "key", "region", "endpoint_url", "version_id"),
    "git_document_v1": ("repo_root", "commit", "relative_path"),
    "google_drive_document_v1": (
        "file_id", "acquisition_mode", "export_mime_type", "drive_id",
    ),
    "confluence_document_v1": (
        "site_url", "page_id", "space_key", "page_version", "body_format",
    ),
}


def spec_id_of(contract_id: str) -> str:
    family = "uns" if contract_id in DOCUMENT_KINDS else "it"
    return f"source.{family}.{contract_id.removesuffix('_v1')}.v1"


def _lookup(table: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def contract_id(kind: Column, source: Column) -> Column:
    """Contract of a task's source name; null for a name nobody registered."""
    alias = F.lower(F.trim(source))
    return F.when(kind == "uns", _lookup(DOCUMENT_CONTRACT_BY_ALIAS, alias)).otherwise(
        _lookup(RECORD_CONTRACT_BY_ALIAS, alias)
    )


def resolve_source_contract(df: DataFrame, kind: str, source: str) -> DataFrame:
    """Add ``source_contract_id`` and ``source_spec_id``."""
    ids = {c: spec_id_of(c) for c in (*DOCUMENT_KINDS, *RECORD_KINDS)}
    return df.withColumn("source_contract_id", contract_id(F.col(kind), F.col(source))).withColumn(
        "source_spec_id", _lookup(ids, F.col("source_contract_id"))
    )


def classify_source_spec(
    df: DataFrame, text: str, kinds: tuple[str, ...] = DOCUMENT_KINDS
) -> DataFrame:
    """Add ``source_kind`` and ``source_problem`` of a JSON source specification."""
    spec = J.parse(F.col(text))
    kind = J.filled_string_at(F.col("__spec"), "$.source.kind")
    return (
        df.withColumn("__spec", spec)
        .withColumn("source_kind", kind)
        .withColumn(
            "source_problem",
            F.when(F.col("__spec").isNull(), "malformed_json_source_spec")
            .when(~J.is_object(F.col("__spec")), "top_level_source_spec_must_be_object")
            .when(~J.is_object(F.col("__spec"), "$.source"), "source_field_missing_or_not_object")
            .when(F.col("source_kind").isNull(), "source_kind_missing_or_empty")
            .when(~F.col("source_kind").isin(*kinds), "unsupported_source_kind"),
        )
        .drop("__spec")
    )


def _identity_value(spec: Column, field: str) -> Column:
    path = f"$.source.{field}"
    if field == "brokers":
        brokers = F.array_sort(F.try_variant_get(spec, path, "array<string>"))
        return F.to_json(brokers)
    if field == "uri":
        return J.quote(
            F.regexp_replace(J.string_at(spec, path), r"^([A-Za-z+]+://)[^@]*@", "$1")
        )
    if field == "endpoint":
        url = J.string_at(spec, "$.source.url")
        scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z]+)://", 1))
        host = F.lower(F.regexp_extract(url, r"^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]+)", 1))
        port = F.regexp_extract(url, r"^[A-Za-z]+://(?:[^/?#@]*@)?[^/?#:]+(:\d+)", 1)
        path_part = F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1)
        return J.quote(F.concat(scheme, F.lit("://"), host, port, path_part))
    if field == "body_format":
        return F.lit('"storage"')
    if field == "query":
        return F.coalesce(J.text_at(spec, path), F.lit("{}"))
    return J.text_at(spec, path)


def identity_text(spec: Column, kind: Column) -> Column:
    """Canonical identity text of a parsed spec; null for an unknown kind."""
    text = F.lit(None).cast("string")
    for name, fields in IDENTITY_FIELDS.items():
        body = {f: _identity_value(spec, f) for f in fields}
        body["kind"] = F.lit(f'"{name}"')
        text = F.when(kind == name, J.object_text(body)).otherwise(text)
    return J.ascii_only(text)


def source_identity(df: DataFrame, text: str, default_sha: str | None = None) -> DataFrame:
    """Add ``source_sha256``; unknown specs keep ``default_sha`` when it is given."""
    sha = identity.sha256_of(identity_text(F.col("__spec"), F.col("__kind")))
    if default_sha is not None:
        sha = F.coalesce(sha, F.col(default_sha))
    return (
        df.withColumn("__spec", J.parse(F.col(text)))
        .withColumn("__kind", J.string_at(F.col("__spec"), "$.source.kind"))
        .withColumn("source_sha256", sha)
        .drop("__spec", "__kind")
    )
