"""Small string rules shared by sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line breaks a text reader recognises: CR LF, LF, CR, VT, FF, FS, GS, RS, NEL, LS, PS.
LINE_BREAK = "\\r\\n|[\\n\\r\\x0B\\x0C\\x1C\\x1D\\x1E\\x85\\u2028\\u2029]"


def lines_of(text: Column) -> Column:
    """Lines of a text; a final line break does not open another line."""
    return F.split(F.regexp_replace(text, f"(?:{LINE_BREAK})\\z", ""), LINE_BREAK)


def base_name(path: Column) -> Column:
    """Last path component, ignoring trailing slashes and ``/.``."""
    return F.regexp_extract(F.regexp_replace(path, r"(?:/\.?)+$", ""), r"([^/]*)$", 1)


def suffix_of(name: Column) -> Column:
    """Extension with its dot; empty for dot files and names ending in a dot."""
    return F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)


def percent_decode(text: Column) -> Column:
    """Percent-decoding that leaves ``+`` alone and keeps texts it cannot decode."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def slug(text: Column, limit: int = 80) -> Column:
    """File-name-safe form of a name."""
    safe = F.regexp_replace(F.trim(text), r"[^A-Za-z0-9_.\-]+", "_").substr(1, limit)
    return F.when(safe == "", F.lit("unknown")).otherwise(safe)
