"""Delivery receipts: shared summary and fan-out parents.

A receipt row has ``destination``, ``ok`` and the detail columns ``attempts``,
``retryable``, ``failure_kind`` and ``error_code``, all of which may be null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import jsontext as J
from millrace.operators.failures import SHARED_ERROR_CODES, SHARED_FAILURE_KINDS


def receipt_details(receipts: DataFrame, details: str = "details") -> DataFrame:
    """Read the detail columns from a JSON details text."""
    d = F.col("__d")
    return (
        receipts.withColumn("__d", J.parse(F.col(details)))
        .withColumn("attempts", J.integer_at(d, "$.attempts").cast("int"))
        .withColumn("retryable", J.boolean_at(d, "$.retryable"))
        .withColumn("failure_kind", J.string_at(d, "$.failure_kind"))
        .withColumn("error_code", J.string_at(d, "$.error_code"))
        .drop("__d")
    )


def _shared(value: Column, allowed: Sequence[str]) -> Column:
    return F.when(F.col("ok"), "not_failed").when(value.isin(*allowed), value).otherwise("unknown")


def receipt_summary(receipts: DataFrame) -> DataFrame:
    """Add the summary every receipt shares, whatever its destination reported."""
    return (
        receipts.withColumn(
            "delivery_outcome", F.when(F.col("ok"), "delivered").otherwise("failed")
        )
        .withColumn(
            "failure_retryability",
            F.when(F.col("ok"), "not_failed")
            .when(F.col("retryable"), "retryable")
            .when(~F.col("retryable"), "non_retryable")
            .otherwise("unknown"),
        )
        .withColumn("shared_failure_kind", _shared(F.col("failure_kind"), SHARED_FAILURE_KINDS))
        .withColumn("shared_error_code", _shared(F.col("error_code"), SHARED_ERROR_CODES))
        .withColumn(
            "attempt_count",
            F.when(F.col("attempts") >= 1, F.col("attempts")).otherwise(1),
        )
        .withColumn("payload_count", F.lit(1))
    )


def fanout(children: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One parent receipt per document from its child receipts.

    A detail is kept only when all failed children that know it agree.  The
    children stay rows of their own table, so the number of them per document
    does not matter; agreement is a minimum equal to a maximum.
    """
    failed = ~F.col("ok")
    known_retry = F.when(
        failed & F.col("failure_retryability").isin("retryable", "non_retryable"),
        F.col("failure_retryability"),
    )

    def known(name: str) -> Column:
        return F.when(failed & (F.col(name) != "unknown"), F.col(name))

    values = {
        "__retry": known_retry,
        "__kind": known("shared_failure_kind"),
        "__code": known("shared_error_code"),
    }
    grouped = receipt_summary(children).groupBy(*keys).agg(
        F.bool_and("ok").alias("ok"),
        F.count(F.lit(1)).alias("child_count"),
        F.count_if("ok").alias("ok_children"),
        F.count_if(failed).alias("failed_children"),
        F.max("attempt_count").alias("attempts"),
        *[F.min(v).alias(f"{n}_min") for n, v in values.items()],
        *[F.max(v).alias(f"{n}_max") for n, v in values.items()],
    )

    def agreed(name: str) -> Column:
        low, high = F.col(f"{name}_min"), F.col(f"{name}_max")
        return F.when(low == high, low)

    return grouped.select(
        *keys,
        F.lit("fanout").alias("destination"),
        "ok",
        "child_count",
        "ok_children",
        "failed_children",
        "attempts",
        (agreed("__retry") == "retryable").alias("retryable"),
        agreed("__kind").alias("failure_kind"),
        agreed("__code").alias("error_code"),
    )
