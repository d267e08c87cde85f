"""JSON text and variant helpers built from Spark expressions only.

Free-form objects travel as *canonical JSON text*: keys sorted, no blanks, raw
non-ASCII.  ``parse`` turns any JSON text into a variant and ``render`` turns a
variant back into canonical text.  A variant stores ``1.0`` as the number one,
so ``parse`` marks integral floats first and ``render`` removes the mark; that
keeps ``1`` and ``1.0`` apart.  Numbers that a variant cannot hold (integers of 39
digits and more, exponents of three) are marked too and keep their text.

An object that repeats a key keeps the last value where the session has
``spark.sql.variant.allowDuplicateKeys`` set (``session.KEEP_LAST_KEY``), as sessions
made here and by the entry have; else its document counts as malformed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.binding import let

_MARK = "\ue000"
_END = "\ue003"
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_FLOAT_SKIP = rf'(?:{_STRING}|[^"\-0-9]++|(?!-?\d++\.0++(?![\deE]))-?\d[\d.eE+\-]*+)*+'
_MAYBE_FLOAT = r"(?:^|[:,\[\s])-?\d+\.0+(?:[\s,}\]]|$)"
_INTEGRAL_FLOAT = rf"\G({_FLOAT_SKIP})(-?\d++\.0++)(?![\deE])"
_LARGE_MARK = "\ue001"
_LARGE = r"-?\d++(?:\.\d++)?+[eE]\+?\d{3,}+|-?\d{39,}+(?![\d.eE])"
_LARGE_SKIP = rf'(?:{_STRING}|[^"\-0-9]++|(?!{_LARGE})-?\d[\d.eE+\-]*+)*+'
_MAYBE_LARGE = r"\d[eE]\+?\d{3}|\d{39}"
#: Longest string, in characters, that ``try_parse_json`` takes.
_SHORT_STRING = 20_000_000
_STRICT = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false"}
#: Longest text of one variant, in bytes.
LONGEST_VARIANT = 134_217_728
_LONG = {**_STRICT, "maxStringLen": "2147483647", "maxNumLen": "2147483647"}
_SEPARATOR = rf'\G((?:[^",:]++|{_STRING})*+)([,:])'


def _marked(text: Column) -> Column:
    floats = F.when(
        # The plain search comes first, as most texts hold no such number.
        text.contains(".0") & text.rlike(_MAYBE_FLOAT),
        F.regexp_replace(text, _INTEGRAL_FLOAT, f'$1"{_MARK}$2"'),
    ).otherwise(text)
    return F.when(
        floats.rlike(_MAYBE_LARGE),
        F.regexp_replace(floats, rf"\G({_LARGE_SKIP})({_LARGE})", f'$1"{_LARGE_MARK}$2"'),
    ).otherwise(floats)


def parse(text: Column) -> Column:
    """Variant of a JSON text, null when the text is malformed.

    Spark's parser stops after the first value.  Read as the first of two list
    items, a text with anything behind its value is malformed as it should be.  Only the
    limit of a variant (``LONGEST_VARIANT``) bounds the text and the strings in it.
    """
    pair = F.concat(F.lit("["), _marked(text), F.lit(f',"{_END}"]'))
    quick = F.try_variant_get(F.try_parse_json(pair), "$", "array<variant>")
    long = F.from_json(pair, "array<variant>", _LONG)
    return F.coalesce(
        _first_of_pair(quick), F.when(F.length(text) > _SHORT_STRING, _first_of_pair(long))
    )


def _first_of_pair(pair: Column) -> Column:
    whole = F.filter(
        F.array(pair),
        lambda items: (F.size(items) == 2)
        & (F.try_variant_get(F.get(items, F.lit(1)), "$", "string") == _END),
    )
    return F.get(F.get(whole, F.lit(0)), F.lit(0))


def document(text: Column, lists: Sequence[str], values: Sequence[str] = ()) -> Column:
    """Named fields of a JSON object: ``lists`` as arrays of variants, ``values`` as variants.

    Each item is a variant of its own, so a document may be as large as a row; only the
    limit of a variant bounds an item and the strings in it.  Null for a text that is
    malformed or no object; a field that is no list is null.
    """
    fields = [f"`{n}`:array<variant>" for n in lists] + [f"`{n}`:variant" for n in values]
    schema = f"array<struct<{','.join(fields)},`{_END}`:int>>"
    pair = F.from_json(
        F.concat(F.lit("["), _marked(text), F.lit(f',{{"{_END}":1}}]')),
        schema,
        _LONG,
    )
    whole = F.filter(
        F.array(pair), lambda items: (F.size(items) == 2) & (F.get(items, F.lit(1))[_END] == 1)
    )
    return F.get(F.get(whole, F.lit(0)), F.lit(0))


def list_size(text: Column) -> Column:
    """Number of items of a JSON list; null for a text that is malformed or no list.

    Items are read as texts, so neither the list nor a string in it meets a limit below
    that of a row.
    """
    pair = F.from_json(
        F.concat(F.lit("["), text, F.lit(f',["{_END}"]]')), "array<array<string>>", _LONG
    )
    whole = F.filter(
        F.array(pair),
        lambda items: (F.size(items) == 2) & (F.get(F.get(items, F.lit(1)), F.lit(0)) == _END),
    )
    found = F.get(F.get(whole, F.lit(0)), F.lit(0))
    return let(found, lambda items: F.when(items.isNotNull(), F.size(items)))


def document_problem(text: Column, whole: Column, other: str) -> Column:
    """Why ``document`` is null: an item beyond a variant, malformed, or ``other`` for no object."""
    return F.when(
        whole.isNull(),
        F.when(parse(text).isNotNull(), other)
        .when(F.octet_length(text) > LONGEST_VARIANT, "item_too_large_or_malformed_json")
        .otherwise("malformed_json"),
    )


def render(value: Column) -> Column:
    """Canonical JSON text of a variant."""
    text = F.regexp_replace(F.to_json(value), f'"{_MARK}(-?\\d+\\.0)0*"', "$1")
    return F.regexp_replace(text, f'"{_LARGE_MARK}([^"]*)"', "$1")


def canonical(text: Column) -> Column:
    return render(parse(text))


def spaced(text: Column) -> Column:
    """Canonical text with a blank after every separator, as element texts show it."""
    return F.regexp_replace(text, _SEPARATOR, "$1$2 ")


def ascii_only(text: Column) -> Column:
    """Escape characters above 0x7F as ``\\uXXXX`` pairs, as identity keys need."""
    def escape(ch: Column) -> Column:
        units = F.lower(F.hex(F.encode(ch, "UTF-16BE")))
        return F.when(
            F.ascii(ch) > 127, F.regexp_replace(units, "(.{4})", r"\\u$1")
        ).otherwise(ch)

    def whole(t: Column) -> Column:
        escaped = F.array_join(F.transform(F.split(t, ""), escape), "")
        return F.when(t.rlike(r"[^\x00-\x7F]"), escaped).otherwise(t)

    return let(text, whole)


def quote(value: Column) -> Column:
    """JSON text of one scalar; a null becomes ``null``.

    Only the brackets of the list around the scalar can be trimmed off: a string
    begins and ends with its quotes.
    """
    return F.btrim(F.to_json(F.array(value)), F.lit("[]"))


def object_text(fields: Mapping[str, Column], omit_null: bool = False) -> Column:
    """Object text from ready JSON texts, keys sorted.

    With ``omit_null`` a field whose text is null is left out, otherwise it is
    written as ``null``.
    """
    parts = []
    for name in sorted(fields):
        head = F.lit(f'"{name}":')
        parts.append(
            F.concat(head, fields[name])
            if omit_null
            else F.concat(head, F.coalesce(fields[name], F.lit("null")))
        )
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def string_values(value: Column) -> Column:
    """All strings that a variant holds as values, at any depth; keys do not count."""
    quoted = F.regexp_extract_all(render(value), F.lit(f"{_STRING}:?"), F.lit(0))
    values = F.filter(quoted, lambda s: ~s.endswith(":"))
    listed = F.concat(F.lit("["), F.array_join(values, ","), F.lit("]"))
    return F.from_json(listed, "array<string>", _LONG)


def _at(value: Column, path: str) -> Column:
    return value if path == "$" else F.try_variant_get(value, path, "variant")


def kind_at(value: Column, path: str = "$") -> Column:
    """Type name of a scalar at a path: STRING, BIGINT, BOOLEAN, VOID, ..."""
    return F.schema_of_variant(_at(value, path))


def is_object(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "map<string,variant>").isNotNull()


def is_list(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "array<variant>").isNotNull()


def absent(value: Column, path: str = "$") -> Column:
    """True for a missing field and for a JSON null."""
    node = _at(value, path)
    return node.isNull() | F.is_variant_null(node)


def string_of(node: Column) -> Column:
    """The string a variant holds; null for another type."""
    found = F.try_variant_get(node, "$", "string")
    number = found.startswith(_MARK) | found.startswith(_LARGE_MARK)
    return F.when((kind_at(node) == "STRING") & ~number, found)


def fields_of(node: Column) -> Column:
    """Fields of an object as a map; null for another type."""
    return F.try_variant_get(node, "$", "map<string,variant>")


def string_at(value: Column, path: str = "$") -> Column:
    """The string at a path; null when it is missing or another type."""
    return let(_at(value, path), string_of)


def filled_string_at(value: Column, path: str = "$") -> Column:
    return F.nullif(string_at(value, path), F.lit(""))


def integer_at(value: Column, path: str = "$") -> Column:
    """The integer at a path; booleans and floats do not count."""
    return F.when(kind_at(value, path) == "BIGINT", F.try_variant_get(value, path, "bigint"))


def boolean_at(value: Column, path: str) -> Column:
    return F.when(kind_at(value, path) == "BOOLEAN", F.try_variant_get(value, path, "boolean"))


def text_at(value: Column, path: str) -> Column:
    """Canonical JSON text of the node at a path; null when it is missing."""
    return render(_at(value, path))


def list_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "array<variant>")
