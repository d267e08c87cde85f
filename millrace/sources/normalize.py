"""Database values as JSON-ready values, driven by the schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import jsontext as J

_PLAIN = (
    T.StringType,
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
)


def _iso_timestamp(value: Column, zone: str) -> Column:
    """ISO text; the fraction appears only when it is not zero."""
    seconds = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(value, "SSSSSS")
    return F.concat(
        seconds,
        F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
        F.lit(zone),
    )


def normalize(value: Column, kind: T.DataType, name: str) -> Column:
    if isinstance(kind, _PLAIN) or isinstance(kind, T.NullType):
        return value
    if isinstance(kind, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(kind, T.TimestampNTZType):
        return _iso_timestamp(value, "")
    if isinstance(kind, T.TimestampType):
        return _iso_timestamp(F.to_utc_timestamp(value, F.current_timezone()), "+00:00")
    if isinstance(kind, T.DecimalType):
        return value.cast("string")
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: normalize(v, kind.elementType, name))
    if isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise TypeError(f"column {name}: object keys must be strings")
        return F.transform_values(value, lambda _, v: normalize(v, kind.valueType, name))
    if isinstance(kind, T.StructType):
        fields = [
            normalize(value[f.name], f.dataType, f"{name}.{f.name}").alias(f.name)
            for f in kind.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    raise TypeError(f"column {name}: unsupported value type {kind.simpleString()}")


def normalize_values(df: DataFrame) -> DataFrame:
    """ISO dates, plain decimals, nested values handled alike; other types are an error."""
    return df.select(
        *[normalize(F.col(f"`{f.name}`"), f.dataType, f.name).alias(f.name) for f in df.schema]
    )


def _key_sorted(value: Column, kind: T.DataType) -> Column:
    """The same value with the fields of every object in name order."""
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _key_sorted(v, kind.elementType))
    if isinstance(kind, T.MapType):
        inner = F.transform_values(value, lambda _, v: _key_sorted(v, kind.valueType))
        entries = F.map_entries(inner)
        by_key = F.array_sort(
            entries,
            lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0),
        )
        return F.map_from_entries(by_key)
    if isinstance(kind, T.StructType):
        ordered = sorted(kind.fields, key=lambda f: f.name)
        fields = [_key_sorted(value[f.name], f.dataType).alias(f.name) for f in ordered]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def json_value(df: DataFrame, name: str) -> Column:
    """Canonical JSON text of a normalised column."""
    value = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return J.quote(value)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(_key_sorted(value, kind), {"ignoreNullFields": "false"})
    return value.cast("string")
