"""Why something failed and whether to try again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Failure kinds and error codes that receipts share.
SHARED_FAILURE_KINDS = (
    "client_error",
    "server_error",
    "rate_limited",
    "timeout",
    "connection",
    "protocol",
    "locked",
    "constraint",
    "operational",
    "database_error",
)
SHARED_ERROR_CODES = (
    "ZE-DELIVERY-FAILED",
    "ZE-DELIVERY-HTTP-FAILED",
    "ZE-DELIVERY-KAFKA-FAILED",
    "ZE-DELIVERY-WEAVIATE-FAILED",
    "ZE-DELIVERY-INVALID-PAYLOAD",
)
# Error codes that are never retried.
NEVER_RETRIED = ("ZE-UNS-EXTRA-MISSING", "ZE-UNS-UNSUPPORTED-TYPE")
# Error types that are always worth another try.
TRANSIENT_TYPES = ("TimeoutError", "ConnectionError", "InterruptedError", "timeout")
# Statuses a sink reads as bad data rather than a bad request.
CONSTRAINT_STATUSES = {"loki": (400, 413, 422), "weaviate": (400, 404, 409, 422)}
# Column-store answers that mean bad data.
COLUMN_STORE_CONSTRAINTS = (
    "type mismatch",
    "cannot parse",
    "does not exist",
    "unknown table",
    "unknown_table",
    "unknown database",
    "unknown column",
    "unknown identifier",
)
# Messages of a broken database connection, and its SQL states.
TRANSPORT_FRAGMENTS = (
    "connection timeout",
    "connection refused",
    "could not connect to server",
    "server closed the connection unexpectedly",
    "network is unreachable",
    "timed out",
)
RETRYABLE_SQLSTATES = ("40001", "40P01", "55P03")


def _has(text: Column, *fragments: str) -> Column:
    found = text.contains(fragments[0])
    for fragment in fragments[1:]:
        found = found | text.contains(fragment)
    return found


def retryable_status(status: Column) -> Column:
    return (status == 429) | status.between(500, 599)


def status_kind(status: Column, destination: Column) -> Column:
    """Failure kind of an HTTP status at a destination."""
    vector, log = destination == "weaviate", destination == "loki"
    return (
        F.when(status == 429, "rate_limited")
        .when(vector & status.isin(401, 403), "client_error")
        .when(status.between(500, 599), "server_error")
        .when(log & status.isin(*CONSTRAINT_STATUSES["loki"]), "constraint")
        .when(vector & status.isin(*CONSTRAINT_STATUSES["weaviate"]), "constraint")
        .when(vector, "operational")
        .otherwise("client_error")
    )


def classify_http(
    df: DataFrame, status: str = "status_code", destination: str = "destination"
) -> DataFrame:
    """Add ``failure_kind`` and ``retryable`` of a failed HTTP delivery."""
    return df.withColumn(
        "failure_kind", status_kind(F.col(status), F.col(destination))
    ).withColumn("retryable", retryable_status(F.col(status)))


def classify_response_text(
    df: DataFrame, status: str = "status_code", text: str = "response_text"
) -> DataFrame:
    """The column store: what its answer says comes before the status."""
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    refused = lowered.contains("authentication failed")
    broken = _has(lowered, *COLUMN_STORE_CONSTRAINTS)
    return df.withColumn(
        "failure_kind",
        F.when(refused, "client_error")
        .when(broken, "constraint")
        .otherwise(status_kind(F.col(status), F.lit("clickhouse"))),
    ).withColumn("retryable", ~refused & ~broken & retryable_status(F.col(status)))


def _document_store_kind(name: Column, text: Column) -> Column:
    return (
        F.when(name.isin("DuplicateKeyError", "DocumentTooLarge"), "constraint")
        .when(name.isin("NetworkTimeout", "ExecutionTimeout") | _has(text, "timeout"), "timeout")
        .when(
            name.isin("AutoReconnect", "ConnectionFailure", "ServerSelectionTimeoutError"),
            "connection",
        )
        .when(_has(text, "duplicate key", "e11000", "validation"), "constraint")
        .when(_has(text, "bson") & _has(text, "size"), "constraint")
        .when(_has(text, "server selection", "connect"), "connection")
        .when(_has(text, "authentication", "unauthorized", "not authorized"), "client_error")
        .otherwise("operational")
    )


def _log_kind(name: Column, message: Column) -> Column:
    return (
        F.when(name == "TimeoutError", "timeout")
        .when(name.isin("ValueError", "UnicodeDecodeError", "UnicodeEncodeError"), "client_error")
        .when(_has(message, "invalid", "embedded null", "unknown topic"), "client_error")
        .when(_has(message, "authentication", "authorization"), "client_error")
        .when(_has(message, "timeout", "timed out"), "timeout")
        .when(_has(message, "broker", "connect", "transport"), "connection")
        .otherwise("operational")
    )


def _object_store_kind(text: Column) -> Column:
    return (
        F.when(_has(text, "timeout"), "timeout")
        .when(_has(text, "connect", "endpoint"), "connection")
        .otherwise("operational")
    )


def _local_database_kind(name: Column, message: Column) -> Column:
    operational = F.when(_has(message, "locked", "busy"), "locked").otherwise("operational")
    return (
        F.when(name == "IntegrityError", "constraint")
        .when(name == "OperationalError", operational)
        .when(name.isin("OSError", "PermissionError", "FileNotFoundError"), "operational")
        .otherwise("database_error")
    )


def _vector_kind(status: Column, message: Column) -> Column:
    said = (
        F.when(_has(message, "timeout"), "timeout")
        .when(_has(message, "connect", "network"), "connection")
        .when(_has(message, "protocol"), "protocol")
        .when(_has(message, "authentication", "api key", "unauthorized"), "client_error")
        .otherwise("operational")
    )
    return F.when(status.isNotNull(), status_kind(status, F.lit("weaviate"))).otherwise(said)


def _http_client_kind(name: Column, other: str) -> Column:
    return (
        F.when(
            name.isin(
                "TimeoutException", "ConnectTimeout", "ReadTimeout", "WriteTimeout", "PoolTimeout"
            ),
            "timeout",
        )
        .when(
            name.isin("NetworkError", "ConnectError", "ReadError", "WriteError", "CloseError"),
            "connection",
        )
        .when(name == "RemoteProtocolError", "protocol")
        .otherwise(other)
    )


RETRYABLE_KINDS = {
    "mongodb": ("timeout", "connection"),
    "kafka": ("timeout", "connection"),
    "s3": ("timeout", "connection"),
    "sqlite": ("locked",),
    "filesystem": ("locked",),
    "weaviate": ("timeout", "connection", "protocol", "rate_limited", "server_error"),
    "webhook": ("timeout", "connection", "protocol"),
    "opensearch": ("timeout", "connection", "protocol"),
    "loki": ("timeout", "connection", "protocol"),
    "clickhouse": ("timeout", "connection", "protocol"),
}


def classify_exception(
    df: DataFrame,
    destination: str = "destination",
    name: str = "exc_type",
    message: str = "exc",
    status: str | None = None,
) -> DataFrame:
    """Add ``failure_kind`` and ``retryable`` of a delivery that raised."""
    kind_of, where = F.col(name), F.col(destination)
    said = F.lower(F.coalesce(F.col(message), F.lit("")))
    both = F.concat_ws(" ", F.lower(kind_of), said)
    code = F.col(status) if status else F.lit(None).cast("int")
    busy = F.when(_has(said, "used by another process", "busy"), "locked").otherwise("operational")
    kind = (
        F.when(where == "mongodb", _document_store_kind(kind_of, both))
        .when(where == "kafka", _log_kind(kind_of, said))
        .when(where == "s3", _object_store_kind(both))
        .when(where == "sqlite", _local_database_kind(kind_of, said))
        .when(where == "filesystem", busy)
        .when(where == "weaviate", _vector_kind(code, said))
        .when(where == "webhook", _http_client_kind(kind_of, "http_error"))
        .otherwise(_http_client_kind(kind_of, "operational"))
    )
    retry = F.lit(False)
    for sink, kinds in RETRYABLE_KINDS.items():
        retry = F.when(where == sink, F.col("failure_kind").isin(*kinds)).otherwise(retry)
    return df.withColumn("failure_kind", kind).withColumn("retryable", retry)


def classify_batch_items(
    items: DataFrame, keys: Sequence[str], position: str = "position", status: str = "status_code"
) -> DataFrame:
    """One verdict per vector batch from its failed objects.

    The first status worth a retry decides, then the first status; a batch
    without any status is retried.
    """
    code = F.col(status)
    verdict = items.groupBy(*keys).agg(
        F.min_by(F.when(retryable_status(code), code), F.when(retryable_status(code), F.col(position))).alias("__again"),
        F.min_by(code, F.when(code.isNotNull(), F.col(position))).alias("__first"),
    )
    deciding = F.coalesce("__again", "__first")
    return verdict.select(
        *keys,
        F.when(deciding.isNull(), "operational")
        .otherwise(status_kind(deciding, F.lit("weaviate")))
        .alias("failure_kind"),
        (F.col("__again").isNotNull() | F.col("__first").isNull()).alias("retryable"),
    )


def classify_source_error(
    df: DataFrame, sqlstate: str = "sqlstate", name: str = "exc_type", message: str = "exc"
) -> DataFrame:
    """Add ``retryable`` of a failed database read."""
    state = F.coalesce(F.col(sqlstate), F.lit(""))
    said = F.lower(F.coalesce(F.col(message), F.lit("")))
    kind = F.coalesce(F.col(name), F.lit(""))
    transport = (
        kind.isin(
            "OSError", "TimeoutError", "ConnectionError", "ConnectionRefusedError",
            "ConnectionResetError", "ConnectionAbortedError", "BrokenPipeError",
        )
        | F.lower(kind).contains("connectiontimeout")
        | _has(said, *TRANSPORT_FRAGMENTS)
    )
    return df.withColumn(
        "retryable", transport | state.startswith("08") | state.isin(*RETRYABLE_SQLSTATES)
    )


def is_retryable(
    df: DataFrame,
    code: str = "error_code",
    flag: str = "details_retryable",
    name: str = "exc_type",
    message: str = "exc",
) -> DataFrame:
    """Add ``retryable`` of a failed run.

    ``flag`` is what the error itself says, as the text ``true`` or ``false``.
    """
    said = F.lower(F.coalesce(F.col(message), F.lit("")))
    return df.withColumn(
        "retryable",
        F.when(F.col(code).isin(*NEVER_RETRIED), F.lit(False))
        .when(F.col(flag) == "true", F.lit(True))
        .when(F.col(flag) == "false", F.lit(False))
        .otherwise(
            F.coalesce(F.col(name).isin(*TRANSIENT_TYPES), F.lit(False))
            | _has(said, "rate limit", "too many requests")
        ),
    )


def run_outcomes(
    attempts: DataFrame,
    keys: Sequence[str],
    max_attempts: int,
    retry_enabled: bool = True,
    skip_unsupported: bool = True,
) -> DataFrame:
    """Fold an attempt log (``attempt`` from 1, ``ok``, ``error_code``, ``retryable``).

    A run ends at its first success, its first error that is not retried, or
    its last allowed attempt; later rows of the log do not count.
    """
    allowed = max_attempts if retry_enabled else 1
    final = (
        F.col("ok")
        | ~F.coalesce(F.col("retryable"), F.lit(False))
        | (F.col("attempt") >= F.lit(allowed))
    )
    facts = F.struct("attempt", "ok", "error_code", "retryable")
    folded = attempts.groupBy(*keys).agg(
        F.min(F.when(final, facts)).alias("__end"), F.max(facts).alias("__last")
    )
    end = F.coalesce("__end", "__last")
    return folded.withColumn("__e", end).select(
        *keys,
        F.when(F.col("__e.ok"), "success")
        .when(
            F.lit(skip_unsupported) & (F.col("__e.error_code") == "ZE-UNS-UNSUPPORTED-TYPE"),
            "skipped_unsupported",
        )
        .otherwise("failed")
        .alias("outcome"),
        F.col("__e.attempt").alias("attempts"),
        F.when(~F.col("__e.ok"), F.col("__e.error_code")).alias("error_code"),
        F.when(~F.col("__e.ok"), F.coalesce("__e.retryable", F.lit(False))).alias("retryable"),
    )
