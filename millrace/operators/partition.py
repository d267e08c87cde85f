"""Documents to ordered elements.

Every rule here is an expression over one row, so partitioning a document table
is a narrow transform: no shuffle, and the full text of each document is used.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import textrules
from millrace.functions.binding import evaluate_once, let

TITLE_MAX_CHARS = 80
LIST_MARK = r"^(?:[-*•‣▪–]|\d{1,3}[.)])\s+\S"
END_MARK = r"[.!?:;,…]$"

# A reference that is no Unicode character is shown as this one.
_REPLACEMENT = "\ufffd"
# Names that stand for a character without a semicolon behind them too, longest first.
_BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_BARE = f"&(?:{'|'.join(_BARE_NAMES)})"
_REFERENCE = rf"&(?:#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*;)|{_BARE}"

_TITLE = "\ue001"
_ITEM = "\ue002"
_END = "\ue003"
_BREAK = "\ue004"
#: A row with bars, and below it the row of dashes that makes it a table's head.
_TABLE = r"^[^\n]*\|[^\n]*\n[ \t]*\|?[ \t]*:?-{2,}[ \t:|-]*(?:\n|$)"
_TAG = r"""(?:<[A-Za-z/!?](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|<[A-Za-z/!?][^>]*+>)"""
_ATTRIBUTES = r"""\b(?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>)"""
_BLOCKS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form"
    "|h[1-6]|header|hr|html|li|main|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul"
)


def line_type(line: Column) -> Column:
    """Element type of one trimmed line."""
    return (
        F.when(line.rlike(LIST_MARK), "ListItem")
        .when((F.length(line) <= TITLE_MAX_CHARS) & ~line.rlike(END_MARK), "Title")
        .otherwise("NarrativeText")
    )


def text_elements(text: Column) -> Column:
    """Array of (type, text): one element per non-empty line."""
    trimmed = F.transform(textrules.lines_of(text), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    filled = F.filter(trimmed, lambda s: s != "")
    return F.transform(filled, lambda s: F.struct(line_type(s).alias("type"), s.alias("text")))


@cache
def _named_references() -> list[Column]:
    """Names (``&name;`` or ``&name``) and their characters, as the HTML standard lists them."""
    return [F.lit(x) for name, text in html5.items() for x in (f"&{name}", text)]


@cache
def _remapped_numbers() -> list[Column]:
    """Numbers of C1 controls that stand for the character of a Windows code page."""
    pairs = ((b, bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0))
    return [F.lit(x) for number, text in pairs if text for x in (number, text)]


def _character(reference: Column) -> Column:
    """What one character reference stands for.

    Of an unknown name the longest begin that needs no semicolon counts; else it stays.
    """
    digits = F.regexp_extract(reference, "^&#[xX]?0*([0-9A-Fa-f]*);?$", 1)
    base_16 = reference.rlike("^&#[xX]")
    short = F.when(F.length(digits) <= 8, digits)
    point = F.when(base_16, F.conv(short, 16, 10)).otherwise(short).try_cast("long")
    valid = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    remapped = F.try_element_at(F.create_map(*_remapped_numbers()), point.cast("int"))
    names = F.create_map(*_named_references())
    begin = F.regexp_extract(reference, f"^{_BARE}", 0)
    rest = F.substring(reference, F.length(begin) + 1, F.length(reference))
    return F.when(
        reference.startswith("&#"),
        F.when(valid, F.coalesce(remapped, character)).otherwise(_REPLACEMENT),
    ).otherwise(
        F.coalesce(
            F.try_element_at(names, reference),
            F.concat(F.try_element_at(names, begin), rest),
            reference,
        )
    )


def decode_entities(text: Column) -> Column:
    """Decode character references, each once."""

    def decoded(current: Column) -> Column:
        between = F.split(current, _REFERENCE)
        characters = F.transform(
            F.regexp_extract_all(current, F.lit(_REFERENCE), F.lit(0)), _character
        )
        joined = F.zip_with(
            between, characters, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))
        )
        return F.when(current.contains("&"), F.array_join(joined, "")).otherwise(current)

    return let(text, decoded)


def html_text(html: Column) -> Column:
    """Text of an HTML page, one block per line, with marks on headings and items.

    A comment, script or style that is not closed reaches to the end.  Lines of
    preformatted text stay lines; blanks that do not break are blanks.
    """
    removed = F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", "")
    removed = F.regexp_replace(removed, r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)", "\n")
    removed = F.regexp_replace(
        removed, r"(?is)<(nav|noscript|template|head)\b.*?</\1\s*>", "\n"
    )
    kept = F.regexp_replace(
        removed,
        rf"(?i)(<pre{_ATTRIBUTES}|\G(?!\A))((?:(?!</pre>)[^\n])*+)\n",
        f"$1$2{_BREAK}",
    )
    flat = F.regexp_replace(kept, r"[\s]+", " ")
    marked = F.regexp_replace(flat, rf"(?i)<h[1-6]{_ATTRIBUTES}", f"\n{_TITLE}")
    marked = F.regexp_replace(marked, rf"(?i)<li{_ATTRIBUTES}", f"\n{_ITEM}")
    marked = F.regexp_replace(marked, r"(?i)</(?:h[1-6]|li)\s*>", f"{_END}\n")
    blocks = F.regexp_replace(marked, rf"(?i)</?(?:{_BLOCKS}){_ATTRIBUTES}", "\n")
    plain = F.regexp_replace(F.regexp_replace(blocks, _TAG, ""), _BREAK, "\n")
    # A mark belongs to the first text behind it, unless its element ends before.
    empty = F.regexp_replace(plain, rf"[{_TITLE}{_ITEM}]\s*+{_END}", "")
    carried = F.regexp_replace(empty, rf"([{_TITLE}{_ITEM}]+)[ ]*\n\s*+", "\n$1")
    decoded = decode_entities(F.regexp_replace(carried, _END, ""))
    return F.replace(decoded, F.lit("\u00a0"), F.lit(" "))


def html_elements(html: Column) -> Column:
    """Array of (type, text) of an HTML page."""
    def clean(line: Column) -> Column:
        return F.regexp_replace(line, f"^[\\s {_TITLE}{_ITEM}]+|[\\s ]+$", "")

    def cleaned(line: Column) -> Column:
        return F.struct(clean(line).alias("text"), line.alias("line"))

    def element(c: Column) -> Column:
        kind = (
            F.when(c["line"].contains(_TITLE), "Title")
            .when(c["line"].contains(_ITEM) | c["text"].rlike(LIST_MARK), "ListItem")
            .otherwise("NarrativeText")
        )
        return F.struct(kind.alias("type"), c["text"].alias("text"))

    lines = F.transform(F.split(html_text(html), "\n"), cleaned)
    return F.transform(F.filter(lines, lambda c: c["text"] != ""), element)


def md_elements(text: Column) -> Column:
    """Array of (type, text): headings, list items, tables, paragraphs and fenced code."""
    unified = F.regexp_replace(text, r"\r\n?", "\n")
    # Underlined headings, and quotes without their marks.
    unified = F.regexp_replace(unified, r"(?m)^ {0,3}(?:> ?)+", "")
    unified = F.regexp_replace(
        unified, r"(?m)^(?! {0,3}(?:[-*+>#|`~]|\d+[.)]\s))( {0,3}\S.*)\n {0,3}(?:=+|-+)[ \t]*$", "# $1"
    )
    pieces = F.split(unified, r"(?m)^[ ]{0,3}(?:```|~~~).*$")

    def prose(piece: Column) -> Column:
        spaced = F.regexp_replace(piece, r"(?m)^( {0,3}#{1,6}\s.*)$", "\n$1\n")
        # Lines behind an item up to a blank one belong to it.
        spaced = F.regexp_replace(spaced, r"(?m)^(\s*(?:[-*+]|\d+[.)])\s+\S.*)$", "\n$1")
        blocks = F.transform(
            F.split(spaced, r"\n\s*\n"),
            lambda b: F.regexp_replace(b, r"^\s+|\s+$", ""),
        )
        heading, item = r"^#{1,6}\s+", r"^(?:[-*+]|\d+[.)])\s+"
        return F.transform(
            F.filter(blocks, lambda b: b != ""),
            lambda b: F.when(
                b.rlike(heading),
                F.struct(
                    F.lit("Title").alias("type"),
                    F.regexp_replace(b, r"^#{1,6}\s+|\s+#+$", "").alias("text"),
                ),
            )
            .when(
                b.rlike(item),
                F.struct(
                    F.lit("ListItem").alias("type"),
                    F.regexp_replace(F.regexp_replace(b, item, ""), r"\s*\n\s*", " ").alias("text"),
                ),
            )
            .when(
                b.rlike(_TABLE),
                F.struct(
                    F.lit("Table").alias("type"),
                    F.regexp_replace(
                        F.regexp_replace(
                            F.regexp_replace(b, r"(?m)^[ \t]*\|?[ \t:|-]*--[ \t:|-]*$\n?", ""),
                            r"(?m)^[ \t]*\|[ \t]*|[ \t]*\|[ \t]*$",
                            "",
                        ),
                        r"[ \t]*\|[ \t]*",
                        " ",
                    ).alias("text"),
                ),
            )
            .otherwise(
                F.struct(
                    F.lit("NarrativeText").alias("type"),
                    F.regexp_replace(b, r"\s*\n\s*", " ").alias("text"),
                )
            ),
        )

    def piece_elements(piece: Column, position: Column) -> Column:
        code = F.regexp_replace(piece, r"^\n+|\n+$", "")
        snippet = F.filter(
            F.array(F.struct(F.lit("CodeSnippet").alias("type"), code.alias("text"))),
            lambda e: e["text"] != "",
        )
        return F.when(position % 2 == 1, snippet).otherwise(prose(piece))

    return F.flatten(F.transform(pieces, piece_elements))


ELEMENT_RULES: dict[str, Callable[[Column], Column]] = {
    "text": text_elements,
    "html": html_elements,
    "md": md_elements,
}


def register_rule(kind: str, rule: Callable[[Column], Column]) -> None:
    """Plug in the partition rule of another document kind."""
    ELEMENT_RULES[kind] = rule


def partition_documents(
    documents: DataFrame, kind: str, text: str = "text", sha: str = "sha256"
) -> DataFrame:
    """Add ``elements`` (element_id, type, text) and ``normalized_text`` to each document."""
    elements = F.transform(
        ELEMENT_RULES[kind](F.col(text)),
        lambda e, i: F.struct(
            F.concat_ws(":", F.col(sha), i.cast("string")).alias("element_id"),
            e["type"].alias("type"),
            e["text"].alias("text"),
        ),
    )
    listed = evaluate_once(documents, documents.columns, {"elements": elements})
    return listed.withColumn(
        "normalized_text", F.array_join(F.transform("elements", lambda e: e["text"]), "\n\n")
    )


def explode_elements(results: DataFrame, *keys: str) -> DataFrame:
    """One row per element with its position in the document."""
    return results.select(*keys, F.posexplode("elements").alias("ord", "e")).select(
        *keys, "ord", "e.element_id", "e.type", "e.text"
    )
