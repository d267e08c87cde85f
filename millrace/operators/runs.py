"""Run metadata rows and their JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import jsontext as J

RUN_META_SCHEMA_VERSION = 3

DOCUMENT_FIELDS = ("filename", "mime_type", "sha256", "size_bytes", "created_at_utc")
ENGINE_FIELDS = ("name", "backend", "version", "strategy")
METRIC_FIELDS = ("duration_ms", "elements_count", "normalized_text_len", "attempts")
PROVENANCE_FIELDS = (
    "run_origin",
    "delivery_origin",
    "execution_mode",
    "task_id",
    "checkpoint_identity_key",
    "task_identity_key",
)


def _json_of(df: DataFrame, name: str) -> Column:
    """JSON text of a column, ``null`` when the table lacks it."""
    if name not in df.columns:
        return F.lit("null")
    if df.schema[name].dataType.simpleString() in ("string", "void"):
        return J.quote(F.col(name).cast("string"))
    return F.coalesce(F.col(name).cast("string"), F.lit("null"))


def run_meta_text(df: DataFrame) -> Column:
    """Run metadata as canonical JSON text from flat columns.

    Engine columns are ``engine_name`` and so on.  A run without ``has_result`` has
    no document and no engine; null provenance fields are left out.
    """
    has_result = F.col("has_result") if "has_result" in df.columns else F.lit(True)
    document = J.object_text({f: _json_of(df, f) for f in DOCUMENT_FIELDS})
    engine = J.object_text(
        {
            f: _json_of(df, "strategy" if f == "strategy" else f"engine_{f}")
            for f in ENGINE_FIELDS
        }
    )
    error = J.object_text(
        {
            "code": _json_of(df, "error_code"),
            "message": _json_of(df, "error_message"),
            "details": F.col("error_details") if "error_details" in df.columns else F.lit("null"),
        }
    )
    has_error = F.col("error_code").isNotNull() if "error_code" in df.columns else F.lit(False)
    provenance = J.object_text(
        {
            f: F.when(_json_of(df, f) != "null", _json_of(df, f))
            for f in PROVENANCE_FIELDS
            if f in df.columns
        },
        omit_null=True,
    )
    return J.object_text(
        {
            "schema_version": F.lit(str(RUN_META_SCHEMA_VERSION)),
            "outcome": _json_of(df, "outcome"),
            "run_id": _json_of(df, "run_id"),
            "pipeline_version": _json_of(df, "pipeline_version"),
            "timestamp_utc": _json_of(df, "timestamp_utc"),
            "document": F.when(has_result, document),
            "engine": F.when(has_result, engine),
            "metrics": J.object_text({f: _json_of(df, f) for f in METRIC_FIELDS}),
            "warnings": F.coalesce(F.to_json("warnings"), F.lit("[]"))
            if "warnings" in df.columns
            else F.lit("[]"),
            "error": F.when(has_error, error),
            "provenance": provenance
            if any(f in df.columns for f in PROVENANCE_FIELDS)
            else F.lit("null"),
        }
    )


def with_run_meta(df: DataFrame) -> DataFrame:
    return df.withColumn("run_schema_version", F.lit(RUN_META_SCHEMA_VERSION)).withColumn(
        "run_meta", run_meta_text(df)
    )
