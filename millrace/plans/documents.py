"""Document ingest."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import identity
from millrace.operators.delivery import document_evidence, shape_payloads
from millrace.operators.partition import partition_documents
from millrace.operators.routing import plan_intake
from millrace.operators.runs import with_run_meta
from millrace.session import stored


@dataclass(frozen=True)
class DocumentIngest:
    """Every table a document run leaves."""

    intake: DataFrame
    results: DataFrame
    run_meta: DataFrame
    payloads: DataFrame


def _aliased(columns: Mapping[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def ingest_documents(
    documents: DataFrame,
    existing: DataFrame | Callable[[DataFrame], DataFrame],
    kind: str,
    run: Mapping[str, str],
    out_root: str,
    skip_existing: bool = True,
    force: bool = False,
    store_results: bool = False,
) -> DocumentIngest:
    """From documents (``uri``, ``filename``, ``text``) to delivery payloads.

    A uri names one document.  Contents are hashed once and the hashes written, so the
    plan of what to process reads no text; the texts that are processed are read once
    more and shuffled once at most, and payloads are made where the text is.  ``existing``
    has the shas that are known, or finds them for a table of shas.  ``run`` has ``run_id``, ``pipeline_version`` and ``timestamp_utc``.  ``store_results``
    writes the results once, for callers that write more than one of the tables.
    """
    hashed = stored(documents.select("uri", identity.sha256_of(F.col("text")).alias("sha256")))
    known = existing(hashed) if callable(existing) else existing
    intake = plan_intake(hashed, known, skip_existing, force)
    chosen = intake.filter(F.col("decision") == "process").select("uri", "sha256").distinct()
    results = partition_documents(documents.join(chosen, "uri"), kind)
    if store_results:
        results = stored(results)
    facts_of = {
        "uri": F.col("uri"),
        "filename": F.col("filename"),
        "sha256": F.col("sha256"),
        "size_bytes": F.octet_length("text"),
        "mime_type": F.lit(None).cast("string"),
        "created_at_utc": F.lit(run["timestamp_utc"]),
        **{k: F.lit(v) for k, v in run.items()},
        "outcome": F.lit("success"),
        "engine_name": F.lit("builtin"),
        "engine_backend": F.lit("spark"),
        "engine_version": F.lit("1"),
        "strategy": F.lit("auto"),
        "elements_count": F.size("elements"),
        "normalized_text_len": F.length("normalized_text"),
        "attempts": F.lit(1),
        "run_origin": F.lit("intake"),
        "delivery_origin": F.lit("primary"),
        "execution_mode": F.lit("batch"),
        "task_identity_key": identity.task_key(
            F.lit("uns"), F.lit(run["pipeline_version"]), F.col("sha256")
        ),
    }
    facts = results.select(*_aliased(facts_of))
    run_meta = with_run_meta(facts)
    evidence_columns = ("normalized_text", "elements")
    described = document_evidence(
        results.select(*evidence_columns, F.struct(*_aliased(facts_of)).alias("__facts")),
        ["__facts"],
    )
    shown = [c for c in described.columns if c != "__facts"]
    delivered = with_run_meta(
        described.select("__facts.*", F.struct(*shown).alias("content_evidence"))
    )
    payloads = shape_payloads(delivered, out_root)
    return DocumentIngest(intake=intake, results=results, run_meta=run_meta, payloads=payloads)


def source_report(documents: DataFrame, kind: str = "text") -> DataFrame:
    """Per source: documents, contents, elements, text length and truncated previews."""
    results = partition_documents(
        documents.withColumn("sha256", identity.sha256_of(F.col("text"))), kind
    )
    evidence = document_evidence(results, ["source", "sha256"])
    return evidence.groupBy("source").agg(
        F.count(F.lit(1)).alias("docs"),
        F.countDistinct("sha256").alias("contents"),
        F.sum("elements_count").alias("elements"),
        F.sum("normalized_text_len").alias("text_chars"),
        F.count_if("normalized_text_truncated").alias("truncated"),
    )
