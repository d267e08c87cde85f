"""Facts about fetched documents: type, file name and selector checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import textrules

# Extension a media type gives to a name without one.
EXTENSION_BY_MIME = {
    "application/json": ".json",
    "application/pdf": ".pdf",
    "application/xml": ".xml",
    "text/csv": ".csv",
    "text/html": ".html",
    "text/plain": ".txt",
    "text/xml": ".xml",
}


def mime_type(content_type: Column) -> Column:
    """Media type without parameters, lower case; null when empty."""
    mime = F.lower(F.trim(F.substring_index(content_type, ";", 1)))
    return F.when(mime != "", mime)


def _unquoted(value: Column) -> Column:
    return F.regexp_replace(F.trim(value), '^"+|"+$', "")


def filename_from_disposition(header: Column) -> Column:
    """First non-empty ``filename*=`` or ``filename=`` of a content-disposition header."""

    def name_in(segment: Column) -> Column:
        part = F.trim(segment)
        raw = _unquoted(F.regexp_extract(part, r"^[^=]*=(.*)$", 1))
        extended = textrules.percent_decode(F.regexp_replace(raw, r"^.*?''", ""))
        return F.when(
            F.lower(part).startswith("filename*="), textrules.base_name(extended)
        ).when(F.lower(part).startswith("filename="), textrules.base_name(raw))

    names = F.filter(F.transform(F.split(header, ";"), name_in), lambda n: n != "")
    return F.get(names, F.lit(0))


def _completed(name: Column, mime: Column) -> Column:
    pairs = [F.lit(x) for pair in EXTENSION_BY_MIME.items() for x in pair]
    extension = F.coalesce(F.try_element_at(F.create_map(*pairs), mime), F.lit(""))
    return (
        F.when(F.coalesce(name, F.lit("")) == "", F.concat(F.lit("downloaded"), extension))
        .when(textrules.suffix_of(name) != "", name)
        .otherwise(F.concat(name, extension))
    )


def url_filename(url: Column, disposition: Column, mime: Column) -> Column:
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    base = textrules.base_name(textrules.percent_decode(path))
    return F.coalesce(filename_from_disposition(disposition), _completed(base, mime))


def object_filename(key: Column, mime: Column) -> Column:
    return _completed(textrules.base_name(key), mime)


def wiki_filename(title: Column, page_id: Column) -> Column:
    dashed = F.regexp_replace(title, "[^A-Za-z0-9]+", "-")
    short = F.lower(F.btrim(dashed, F.lit("-")))
    # Asked of the title, so the short name is made once.
    return F.when(title.rlike("[A-Za-z0-9]"), F.concat(short, F.lit(".html"))).otherwise(
        F.concat(F.lit("confluence-page-"), page_id.cast("string"), F.lit(".html"))
    )


def fetched_metadata(
    df: DataFrame, content_type: str, url: str | None = None, key: str | None = None,
    disposition: str | None = None,
) -> DataFrame:
    """Add ``mime_type`` and ``filename`` of documents fetched by URL or object key."""
    typed = df.withColumn("mime_type", mime_type(F.col(content_type)))
    if url is not None:
        header = F.col(disposition) if disposition else F.lit(None).cast("string")
        return typed.withColumn("filename", url_filename(F.col(url), header, F.col("mime_type")))
    return typed.withColumn("filename", object_filename(F.col(key), F.col("mime_type")))


def check_selector(fetched: DataFrame, specs: DataFrame, on: str) -> DataFrame:
    """Compare what a wiki fetch returned with what was asked for.

    ``specs`` has one row per request.  A selector that was not asked for is not
    checked; a mismatch cannot be retried.
    """
    joined = fetched.join(specs, on)
    space_differs = F.col("space_key").isNotNull() & ~F.col("resolved_space_key").eqNullSafe(
        F.col("space_key")
    )
    version_differs = F.col("page_version").isNotNull() & ~F.col(
        "resolved_page_version"
    ).eqNullSafe(F.col("page_version"))
    problem = F.when(space_differs, "space_key_mismatch").when(
        version_differs, "page_version_mismatch"
    )
    return joined.withColumn("problem", problem).withColumn(
        "retryable", F.when(F.col("problem").isNotNull(), F.lit(False))
    )
