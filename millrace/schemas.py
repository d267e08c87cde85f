"""Column layouts of the stored tables."""

from __future__ import annotations

INPUTS = (
    "uri string, source string, discovered_at_utc string, filename string, "
    "extension string, size_bytes bigint"
)
RECORDS = "stream string, record_index bigint, data string, emitted_at string"
STATES = "stream string, state_index bigint, data string"
LOGS = "stream string, log_index bigint, level string, message string"
ELEMENTS = "element_id string, type string, text string, metadata string"
RECEIPTS = (
    "sha256 string, run_id string, destination string, ok boolean, attempts int, "
    "retryable boolean, failure_kind string, error_code string"
)
DEAD_LETTERS = (
    "name string, state string, mtime_s bigint, size_bytes bigint, destination string, "
    "sha256 string, run_id string, run_meta string"
)
TASK_STATE = (
    "task_id string, bucket string, task_json string, failure_count int, orphan_count int, "
    "claimed_at double, created_at double, updated_at double, provenance "
    "array<struct<action:string,source_bucket:string,target_bucket:string,recorded_at:double>>"
)
MESSAGE_LOG = "topic string, partition int, offset bigint, value string"
