"""Text and number expressions."""

from __future__ import annotations

import html
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

IDEOGRAPHIC_SPACE = "　"

# All names of HTML that end with a semicolon, as "name;" and what they stand for, short ones first as a map is
# searched from its start. What they have of the markup's own characters stays escaped, which is decoded last.
_PAIR, _IS = "\u0001", "\u0002"
_NAMED_ENTITIES = _PAIR.join(
    f"{name}{_IS}{html.escape(html5[name], quote=False)}" for name in sorted(html5, key=len) if name.endswith(";")
)
_NAMED_ENTITY = "&([a-zA-Z][a-zA-Z0-9]*;)"
_NUMERIC_ENTITY = "&#([xX][0-9a-fA-F]{1,6}|[0-9]{1,7});"
# These stand for characters of the markup itself. The ampersand comes last, so
# that "&amp;lt;" yields "&lt;".
_MARKUP_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&amp;", "&"),
]


def strip_chars(col: Column, chars: str) -> Column:
    """Remove any of ``chars`` from both ends."""
    return F.btrim(col, F.lit(chars))


def strip_spaces(col: Column) -> Column:
    """Remove spaces, and nothing else, from both ends."""
    return strip_chars(col, " ")


def drop_spaces(col: Column) -> Column:
    """Remove every ASCII space."""
    return F.replace(col, F.lit(" "), F.lit(""))


def code_and_name(col: Column) -> tuple[Column, Column]:
    """``code<U+3000>name`` as two columns; both NULL unless there are exactly two parts."""
    parts = F.split(col, IDEOGRAPHIC_SPACE)
    two = F.size(parts) == 2
    return (
        F.when(two, drop_spaces(F.get(parts, F.lit(0)))),
        F.when(two, drop_spaces(F.get(parts, F.lit(1)))),
    )


def thousands(col: Column) -> Column:
    """``'2,593.5'`` as DECIMAL(18,2); NULL where the text is no number, or does not fit without rounding."""
    exact = F.replace(col, F.lit(","), F.lit("")).try_cast("decimal(38,18)")
    value = exact.try_cast("decimal(18,2)")
    return F.when(value == exact, value)


def as_string(col: Column) -> Column:
    return col.cast("string")


def _padding(text: Column, width: int) -> Column:
    return F.repeat(F.lit(" "), F.greatest(F.lit(width) - F.char_length(text), F.lit(0)))


def report_line(name: Column, number: Column) -> Column:
    """Name padded to 8 on the right, number padded to 5 on the left; never cut."""
    number = as_string(number)
    return F.concat(
        name, _padding(name, 8), F.lit("股本 "), _padding(number, 5), number, F.lit(" (億)")
    )


def strip_prefix(col: Column, n: int) -> Column:
    """Drop the first ``n`` characters."""
    return F.substr(col, F.lit(n + 1))


def file_name(col: Column) -> Column:
    """The part of a path after the last slash."""
    return F.regexp_extract(col, r"[^/]+$", 0)


def _decoded(col: Column, entities: list[tuple[str, str]]) -> Column:
    decoded = col
    for entity, char in entities:
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    return F.when(F.contains(col, F.lit("&")), decoded).otherwise(col)


def _numeric_decoded(col: Column) -> Column:
    """Numeric entities as characters; those of the markup's own characters by name instead."""

    def replaced(text: Column, number: Column) -> Column:
        hexadecimal = number.startswith("x") | number.startswith("X")
        digits = F.when(hexadecimal, F.substr(number, F.lit(2))).otherwise(F.conv(number, 10, 16))
        point = F.conv(digits, 16, 10).cast("int")
        there = ((point > 0) & (point < 0xD800)) | ((point > 0xDFFF) & (point <= 0x10FFFF))
        char = F.when(there, F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")).otherwise("\ufffd")
        for entity, own in _MARKUP_ENTITIES:
            char = F.when(point == ord(own), entity).otherwise(char)
        return F.replace(text, F.concat(F.lit("&#"), number, F.lit(";")), char)

    numbers = F.array_distinct(F.regexp_extract_all(col, F.lit(_NUMERIC_ENTITY), 1))
    return F.when(F.contains(col, F.lit("&#")), F.aggregate(numbers, col, replaced)).otherwise(col)


def _named_decoded(col: Column) -> Column:
    """Entities by name as characters, but for those of the markup's own characters."""
    known = F.str_to_map(F.lit(_NAMED_ENTITIES), F.lit(_PAIR), F.lit(_IS))

    def replaced(text: Column, name: Column) -> Column:
        entity = F.concat(F.lit("&"), name)
        return F.replace(text, entity, F.coalesce(F.try_element_at(known, name), entity))

    names = F.array_distinct(F.regexp_extract_all(col, F.lit(_NAMED_ENTITY), 1))
    names = F.filter(names, lambda name: ~name.isin("lt;", "gt;", "amp;"))
    return F.when(F.contains(col, F.lit("&")), F.aggregate(names, col, replaced)).otherwise(col)


def decode_plain_entities(col: Column) -> Column:
    """Decode what is no markup; names are those of HTML, with a semicolon."""
    return _named_decoded(_numeric_decoded(col))


def decode_markup_entities(col: Column) -> Column:
    """Decode ``<``, ``>`` and ``&``: to be done last, on the text of an element."""
    return _decoded(col, _MARKUP_ENTITIES)


def decode_entities(col: Column) -> Column:
    """All entities of an element's text, each once: ``&amp;lt;`` becomes ``&lt;``."""
    return F.when(F.contains(col, F.lit("&")), decode_markup_entities(decode_plain_entities(col))).otherwise(col)


def csv_line(cols: list[Column]) -> Column:
    """One CSV record without its line end: quoted only where needed, quotes doubled, NULL empty."""

    def field(col: Column) -> Column:
        quoted = F.concat(F.lit('"'), F.replace(col, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(col.rlike('[,"\\r\\n]'), quoted).otherwise(F.coalesce(col, F.lit("")))

    return F.concat_ws(",", *[field(as_string(c)) for c in cols])
