"""Keys that make work and deliveries idempotent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import jsontext as J

# Fixed value: the DNS namespace of name-based UUIDs.
DNS_NAMESPACE_HEX = "6ba7b8109dad11d180b400c04fd430c8"


def sha256_of(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def task_key(kind: Column, pipeline_version: Column, sha256: Column) -> Column:
    return J.ascii_only(
        J.object_text(
            {
                "kind": J.quote(kind),
                "pipeline_version": J.quote(pipeline_version),
                "sha256": J.quote(sha256),
            }
        )
    )


def checkpoint_key(
    task_key_text: Column, stream: Column, progress_kind: Column, progress: Column
) -> Column:
    """Key of one checkpoint entry; ``progress`` is canonical JSON text."""
    return J.ascii_only(
        J.object_text(
            {
                "kind": F.lit('"it"'),
                "progress": progress,
                "progress_kind": J.quote(progress_kind),
                "stream": J.quote(stream),
                "task": task_key_text,
            }
        )
    )


def delivery_key(sha256: Column, run_id: Column) -> Column:
    return F.concat_ws(":", sha256, run_id)


def object_uuid(sha256: Column) -> Column:
    """Name-based UUID (version 5) of a content sha in the DNS namespace."""
    digest = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE_HEX)), F.encode(sha256, "UTF-8")))
    variant = F.translate(digest.substr(17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        digest.substr(1, 8),
        digest.substr(9, 4),
        F.concat(F.lit("5"), digest.substr(14, 3)),
        F.concat(variant, digest.substr(18, 3)),
        digest.substr(21, 12),
    )
