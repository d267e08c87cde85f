"""Delimited, JSON and XML files as one element per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import stored

KINDS = ("csv", "tsv", "json", "ndjson", "xml")
SEPARATORS = {"csv": ",", "tsv": "\t"}

# What is behind an opening quote up to its closing one or, possessively, to the end.
_QUOTED = '(?:[^"]++|"")*+'
_BEFORE = Window.unboundedPreceding, -1


def _options(kind: str) -> dict[str, str]:
    return {"sep": SEPARATORS[kind], "quote": '"', "escape": '"', "multiLine": "true"}


def _ends_quoted(line: Column, separator: str) -> tuple[Column, Column]:
    """Whether a line ends inside quotes, if it begins outside and if it begins inside.

    A quote opens only at the begin of a value; what stands between a closing quote and
    the next separator belongs to the value.
    """
    value = f'(?:"{_QUOTED}"[^{separator}]*+|[^"{separator}][^{separator}]*+|)'
    opened = f'(?:{value}{separator})*+"{_QUOTED}\\z'
    has_quote = line.contains('"')
    outside = has_quote & line.rlike(f"\\A{opened}")
    inside = ~has_quote | line.rlike(f'\\A{_QUOTED}(?:\\z|"[^{separator}]*+{separator}{opened})')
    return outside, inside


def _carried(window, known: Column, swaps: Column) -> Column:
    """State after the rows of ``window``, from outside quotes.

    A line sets the state (it ends the same way, however it begins), swaps it or leaves
    it.  After the last line that set it, only the number of swaps counts.
    """
    set_at = F.last(known.bitwiseXOR(swaps), ignorenulls=True).over(window)
    total = F.coalesce(F.last(swaps).over(window), F.lit(0))
    return F.coalesce(set_at, F.lit(0)).bitwiseXOR(total)


def _located_lines(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Lines of all files, with their file block and how they change the quote state.

    ``known`` is the state after a line that sets it, ``swap`` is 1 for a line that
    swaps it.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    outside, inside = _ends_quoted(F.col("value"), separator)
    return (
        lines.select(
            F.col("_metadata.file_path").alias("uri"),
            F.col("_metadata.file_block_start").alias("block"),
            # Lines of a file's block follow each other in one task.
            F.monotonically_increasing_id().alias("spot"),
            F.col("value").alias("line"),
            outside.cast("int").alias("outside"),
            inside.cast("int").alias("inside"),
        )
        .withColumn("known", F.when(F.col("outside") == F.col("inside"), F.col("outside")))
        .withColumn("swap", (F.col("outside") > F.col("inside")).cast("int"))
        .drop("outside", "inside")
    )


def _block_states(lines: DataFrame) -> DataFrame:
    """The quote state at the begin of every block; a row for each block of a file."""
    # In a block only the last line that sets the state, and the swaps behind it, count.
    last = F.max(F.when(F.col("known").isNotNull(), F.struct("spot", "known")))
    swaps = F.sum("swap")
    own = lines.groupBy("uri", "block").agg(last.alias("last"), swaps.alias("swaps"))
    behind = (
        lines.filter("swap = 1")
        .join(own.filter("last IS NOT NULL").select("uri", "block", "last"), ["uri", "block"])
        .filter(F.col("spot") > F.col("last.spot"))
        .groupBy("uri", "block")
        .agg(F.count("*").alias("behind"))
    )
    blocks = own.join(behind, ["uri", "block"], "left").select(
        "uri",
        "block",
        F.when(
            F.col("last").isNotNull(),
            F.col("last.known").bitwiseXOR((F.coalesce("behind", F.lit(0)) % 2).cast("int")),
        ).alias("known"),
        F.when(F.col("last").isNull(), F.col("swaps") % 2).otherwise(0).cast("int").alias("swap"),
    )
    in_file = Window.partitionBy("uri").orderBy("block")
    summed = blocks.withColumn("swaps", (F.sum("swap").over(in_file) % 2).cast("int"))
    before = in_file.rowsBetween(*_BEFORE)
    return summed.select(
        "uri", "block", _carried(before, F.col("known"), F.col("swaps")).alias("state")
    )


def delimited_records(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """``uri``, ``number`` (from 0, the header's) and ``record`` text of delimited files.

    Files are read as lines, so a large one is read by many tasks.  A line break ends a
    record unless it stands inside quotes, which a line alone does not tell: each block of
    a file is summed up as a change of the quote state, a prefix scan over the blocks of a
    file gives the state at the begin of each, and inside a block the lines are walked in
    order.  A record that runs over the end of a block is put together from its pieces.
    Empty lines outside quotes are no records.
    """
    lines = _located_lines(spark, path, SEPARATORS[kind])
    states = stored(_block_states(lines))
    in_block = Window.partitionBy("uri", "block").orderBy("spot")
    # One shuffle brings a block's lines together; a block is as large as a read task.
    walked = (
        lines.join(states, ["uri", "block"])
        .withColumn("swaps", (F.sum("swap").over(in_block) % 2).cast("int"))
        .withColumn(
            "before",
            F.coalesce(
                F.last(F.col("known").bitwiseXOR(F.col("swaps")), ignorenulls=True).over(
                    in_block.rowsBetween(*_BEFORE)
                ),
                F.col("state"),
            ).bitwiseXOR(
                F.coalesce(F.last("swaps").over(in_block.rowsBetween(*_BEFORE)), F.lit(0))
            ),
        )
        .withColumn("blank", (F.col("before") == 0) & F.col("line").isin("", "\r"))
        .filter(~F.col("blank"))
        .withColumn("local", F.sum((F.col("before") == 0).cast("int")).over(in_block))
    )
    pieces = stored(
        walked.groupBy("uri", "block", "local").agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("spot", "line"))), lambda p: p["line"]
                ),
                "\n",
            ).alias("piece")
        )
    )
    in_file = Window.partitionBy("uri").orderBy("block")
    blocks = (
        pieces.groupBy("uri", "block")
        .agg(F.max("local").alias("records"))
        .withColumn("earlier", F.coalesce(F.sum("records").over(in_file.rowsBetween(*_BEFORE)), F.lit(0)))
    )
    numbered = pieces.join(blocks, ["uri", "block"]).select(
        "uri",
        "block",
        (F.col("earlier") + F.col("local") - 1).alias("number"),
        "piece",
        # A block's first piece may continue a record, its last record may go on.
        ((F.col("local") == 0) | (F.col("local") == F.col("records"))).alias("edge"),
    )
    stitched = (
        numbered.filter("edge")
        .groupBy("uri", "number")
        .agg(F.array_sort(F.collect_list(F.struct("block", "piece"))).alias("pieces"))
        .select(
            "uri",
            "number",
            F.array_join(F.transform("pieces", lambda p: p["piece"]), "\n").alias("record"),
        )
    )
    whole = numbered.filter("NOT edge").select("uri", "number", F.col("piece").alias("record"))
    return whole.unionByName(stitched).withColumn("record", F.regexp_replace("record", "\r\\z", ""))


def partition_tabular(
    spark: SparkSession,
    path: str,
    kind: str,
    schema: T.StructType | str | None = None,
    row_tag: str = "row",
    multiline: bool = True,
) -> DataFrame:
    """Rows of files as elements (uri, element_id, ord, type, text).

    ``ord`` is the row's number in its file, from 0, and ``element_id`` the file and that
    number, whatever other files are read and however the file is split.  Quoted values
    of csv and tsv files may hold line breaks and doubled quotes (``delimited_records``);
    without ``multiline`` their rows are lines.  Lines end with a line feed, with or without
    a carriage return.  A json file is one document and is read by one task; all other
    kinds are split.  Without a schema the files are read once more to find it.
    """
    if kind not in KINDS:
        raise ValueError(f"unsupported tabular kind: {kind}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind in SEPARATORS and multiline:
        if schema is None:
            schema = reader.csv(path, header=True, **_options(kind)).schema
        return _delimited_elements(spark, path, kind, schema)
    if kind in SEPARATORS:
        rows = reader.csv(path, header=True, sep=SEPARATORS[kind], quote='"', escape='"')
    elif kind == "xml":
        rows = reader.format("xml").option("rowTag", row_tag).load(path)
    else:
        rows = reader.option("multiLine", str(kind == "json").lower()).json(path)
    columns = [F.col(f"`{c}`") for c in rows.columns]
    located = rows.select(
        _row_text(F.struct(*columns)).alias("text"),
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("__block"),
        # Rows of a file's block follow each other in one task.
        F.monotonically_increasing_id().alias("__spot"),
    )
    before = Window.partitionBy("uri").orderBy("__block").rowsBetween(*_BEFORE)
    blocks = (
        located.groupBy("uri", "__block")
        .agg(F.min("__spot").alias("__first"), F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    number = F.col("__before") + F.col("__spot") - F.col("__first")
    return _elements(located.join(blocks, ["uri", "__block"]), number)


def _row_text(row: Column) -> Column:
    return F.to_json(row, {"ignoreNullFields": "false"})


def _elements(rows: DataFrame, number: Column) -> DataFrame:
    return rows.select(
        "uri",
        F.concat_ws(":", "uri", number).alias("element_id"),
        number.alias("ord"),
        F.lit("TableRow").alias("type"),
        "text",
    )


def _delimited_elements(
    spark: SparkSession, path: str, kind: str, schema: T.StructType | str
) -> DataFrame:
    """Records behind each file's header as elements."""
    declared = schema if isinstance(schema, str) else schema.toDDL()
    row = F.from_csv("record", declared, _options(kind))
    rows = delimited_records(spark, path, kind).filter("number > 0")
    return _elements(rows.withColumn("text", _row_text(row)), F.col("number") - 1)
