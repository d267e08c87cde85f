"""Millrace: document and record ingest expressed as Spark DataFrame transforms."""
