"""Element metadata: clean-up and fetch facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import jsontext as J
from millrace.functions.binding import evaluate_once

# Texts read as a boolean.
TRUE_TEXTS = ("true", "t", "yes", "y", "on", "1")
FALSE_TEXTS = ("false", "f", "no", "n", "off", "0")


def _entries(metadata: Column) -> Column:
    """Top-level fields of an object as (name, canonical text) pairs."""
    fields = F.try_variant_get(J.parse(metadata), "$", "map<string,variant>")
    return F.transform(
        F.map_entries(fields), lambda e: F.struct(e["key"], J.render(e["value"]).alias("text"))
    )


def with_fields(metadata: Column, added: dict[str, Column], dropped: Sequence[str] = ()) -> Column:
    """Set fields of an object; a null text leaves the field as it was."""
    fresh = F.filter(
        F.array(
            *[
                F.struct(F.lit(name).alias("key"), text.alias("text"))
                for name, text in added.items()
            ]
        ),
        lambda e: e["text"].isNotNull(),
    )
    names = F.concat(
        F.transform(fresh, lambda e: e["key"]), F.array(*[F.lit(d) for d in dropped]).cast("array<string>")
    )
    kept = F.filter(_entries(metadata), lambda e: ~F.array_contains(names, e["key"]))
    merged = F.array_sort(F.concat(kept, fresh))
    body = F.transform(merged, lambda e: F.concat(J.quote(e["key"]), F.lit(":"), e["text"]))
    return F.concat(F.lit("{"), F.array_join(body, ","), F.lit("}"))


def bbox_of(points: Column) -> Column:
    """Smallest box around ``[x, y]`` points; null when there are none or one is broken."""
    xs = F.transform(points, lambda p: F.get(p, F.lit(0)))
    ys = F.transform(points, lambda p: F.get(p, F.lit(1)))
    whole = ~F.exists(
        points, lambda p: p.isNull() | (F.size(p) < 2) | F.exists(p, lambda c: c.isNull())
    )
    return F.when(
        (F.size(points) > 0) & whole,
        F.struct(
            F.array_min(xs).alias("x_min"),
            F.array_min(ys).alias("y_min"),
            F.array_max(xs).alias("x_max"),
            F.array_max(ys).alias("y_max"),
        ),
    )


def normalize_metadata(elements: DataFrame, metadata: str = "metadata") -> DataFrame:
    """Drop the folder, read ``is_extracted`` as a boolean and derive ``bbox``.

    ``metadata`` is JSON text.  Values that cannot be read leave a warning.
    """
    m = F.col("__m")
    raw = F.lower(F.trim(F.coalesce(J.string_at(m, "$.is_extracted"), F.lit(""))))
    number = J.integer_at(m, "$.is_extracted")
    extracted = (
        F.when(J.kind_at(m, "$.is_extracted") == "BOOLEAN", J.boolean_at(m, "$.is_extracted"))
        .when(raw.isin(*TRUE_TEXTS) | (number == 1), F.lit(True))
        .when(raw.isin(*FALSE_TEXTS) | (number == 0), F.lit(False))
    )
    unreadable = ~J.absent(m, "$.is_extracted") & F.col("is_extracted").isNull()
    points = F.try_variant_get(m, "$.coordinates.points", "array<array<double>>")
    has_box = J.is_object(m, "$.coordinates")
    box = F.col("bbox")
    box_text = F.when(box.isNotNull(), F.to_json(box))
    read = evaluate_once(
        elements.withColumn("__m", F.try_parse_json(metadata)),
        [*elements.columns, "__m"],
        {"is_extracted": extracted, "bbox": F.when(has_box, bbox_of(points))},
    )
    return (
        read.withColumn(
            "metadata_warnings",
            F.filter(
                F.array(
                    F.when(unreadable, "is_extracted_not_a_boolean"),
                    F.when(has_box & box.isNull(), "coordinates_without_a_box"),
                ),
                lambda w: w.isNotNull(),
            ),
        )
        .withColumn(
            metadata,
            with_fields(
                F.col(metadata),
                {"is_extracted": F.col("is_extracted").cast("string"), "bbox": box_text},
                ["file_directory"],
            ),
        )
        .drop("__m")
    )


def decorate_elements(
    elements: DataFrame,
    fetched: DataFrame,
    on: str,
    source_kind: str,
    fields: dict[str, str],
    metadata: str = "metadata",
) -> DataFrame:
    """Add fetch facts to the metadata of every element.

    ``elements`` has a row for each element, or a row for each document whose elements
    share the metadata: decorated before its elements are taken apart, a document is
    joined once.  ``fetched`` has one row per document; ``fields`` maps a metadata name to one
    of its columns, and null facts are left out.
    """
    facts = fetched.select(on, *[F.col(c).alias(f"__f_{name}") for name, c in fields.items()])
    added = {name: F.when(F.col(f"__f_{name}").isNotNull(), J.quote(F.col(f"__f_{name}"))) for name in fields}
    added["source_kind"] = J.quote(F.lit(source_kind))
    return (
        elements.join(facts, on)
        .withColumn(metadata, with_fields(F.col(metadata), added))
        .drop(*[f"__f_{name}" for name in fields])
    )
