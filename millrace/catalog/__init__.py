"""All registered queries."""

from __future__ import annotations

from millrace.catalog import delivery, documents, files, landed, operations, records, streams
from millrace.catalog.base import Query


def all_queries() -> list[Query]:
    groups = (documents, files, records, landed, delivery, operations, streams)
    return [q for group in groups for q in group.catalog.queries]
