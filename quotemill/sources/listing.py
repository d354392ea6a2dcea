"""Listing pages: one HTML text per page, section rows between the data rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import code_and_name, decode_entities, strip_spaces
from ..operators.rejects import REASON
from ..schemas import LISTING_FIELDS

_COMMENT = r"(?s)<!--.*?-->"
# what a script or style holds is no markup
_RAW = r"(?is)(<(script|style)(?=[\s>])[^>]*>).*?(?=</\2|\z)"
# the rest of a tag: a quoted attribute value may hold anything but its quote
_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_STRUCTURE = r"(/?(?:tr|table|thead|tbody|tfoot))(?=[\s/>])"
# a tag that opens or ends rows or tables, with all that follows up to the next one
_PIECE = rf"(?i)<{_STRUCTURE}{_ATTRIBUTES}>?+(?:[^<]++|<(?!{_STRUCTURE})(?:/?[a-z]{_ATTRIBUTES}>?+)?+)*+"
_KIND = rf"(?i)^<{_STRUCTURE}"
_ELEMENT_TEXT = rf"<[a-zA-Z]{_ATTRIBUTES}>((?:[^<]++|<(?![a-zA-Z/!?]))*+)"
_SECTION_CELLS = 4
_DATA_CELLS = 8


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _row_ends(kinds: Column) -> Column:
    """array<struct<row, end>>: the rows with a table in them, and the pieces before which they end.

    One fold over the kinds of a page's pieces. Its state is the open row of each open table; a row is
    ended by a row, or the end of a row or of the table, at its own depth.
    """
    none = F.array().cast("array<struct<row:int,end:int>>")
    closed = F.lit(-1)

    def ended(row, end):
        long = (row >= 0) & (row + 1 < end)
        return F.when(long, F.array(F.struct(row.alias("row"), end.alias("end")))).otherwise(none)

    def step(state, piece):
        depth = F.size(state["rows"])
        below = F.slice(state["rows"], 1, depth - 1)
        more = F.concat(state["ends"], ended(F.get(state["rows"], depth - 1), piece["at"]))
        opens, leaves = piece["kind"] == "table", (piece["kind"] == "/table") & (depth > 1)
        now = F.when(piece["kind"] == "tr", piece["at"]).otherwise(closed)
        rows = (
            F.when(opens, F.concat(state["rows"], F.array(closed)))
            .when(leaves, below)
            .otherwise(F.concat(below, F.array(now)))
        )
        return F.struct(rows.alias("rows"), F.when(opens, state["ends"]).otherwise(more).alias("ends"))

    pieces = F.transform(kinds, lambda kind, i: F.struct(kind.alias("kind"), i.alias("at")))
    start = F.struct(F.array(closed).alias("rows"), none.alias("ends"))
    last = lambda state: F.concat(
        state["ends"], F.flatten(F.transform(state["rows"], lambda row: ended(row, F.size(kinds))))
    )
    return F.aggregate(pieces, start, step, last)


def _row_texts(html: Column) -> Column:
    """array<string>: the markup of each ``tr`` of a page, in the order of their starts.

    The page is cut before each tag that opens or ends rows or tables; a row is one piece, or several
    if there is a table in it, whose rows then also stand by themselves.
    """

    def texts(pieces):
        def of(kinds):
            starts = F.filter(F.sequence(F.lit(0), F.size(kinds) - 1), lambda i: F.get(kinds, i) == "tr")
            holds = lambda i: (F.get(kinds, i) == "tr") & (F.get(kinds, i + 1) == "table")
            nested = F.exists(starts, holds)

            def row(ends):
                def text(i):
                    end = F.get(F.filter(ends, lambda e: e["row"] == i), F.lit(0))["end"]
                    return F.when(
                        holds(i), F.array_join(F.slice(pieces, i + 1, F.coalesce(end, i + 1) - i), "")
                    ).otherwise(F.get(pieces, i))

                return F.transform(starts, text)

            plain = F.transform(starts, lambda i: F.get(pieces, i))
            return F.when(nested, _let(_row_ends(kinds), row)).otherwise(plain)

        kinds = F.transform(pieces, lambda piece: F.lower(F.regexp_extract(piece, _KIND, 1)))
        return F.when(F.size(pieces) > 0, _let(kinds, of))

    return _let(F.regexp_extract_all(html, F.lit(_PIECE), F.lit(0)), texts)


def listing_rows(pages: DataFrame, key_cols: list[str], html_col: str = "html") -> DataFrame:
    """All data rows of all pages, each with the section it stands under.

    A page is cut into its rows; the first row is the header. A row of four
    elements opens a section and names it in its third element. The rows of a
    section are cut out of the page's own array with ``slice`` and exploded
    together with the name, so the heading reaches its rows without a window,
    and the job has no shuffle at all. ``pos`` is the row's place on its page.

    A tag ends at the first ``>`` outside of quoted attribute values. The elements of a row include
    those of a table in it, and the rows of that table are rows as well. Comments are
    dropped, they count as no element, and what a script or style holds is no markup.
    """

    def cells(text):
        return F.transform(F.regexp_extract_all(text, F.lit(_ELEMENT_TEXT), F.lit(1)), decode_entities)

    def numbered_rows(texts):
        return F.transform(
            F.slice(texts, 2, F.greatest(F.size(texts) - 1, F.lit(0))),
            lambda text, i: F.struct((i + 2).alias("pos"), cells(text).alias("cells")),
        )

    def section_starts(rows):
        headings = F.filter(rows, lambda row: F.size(row.cells) == _SECTION_CELLS)
        return F.concat(
            F.array(F.struct(F.lit(2).alias("start"), F.lit("").alias("type"))),
            F.transform(
                headings,
                lambda row: F.struct(
                    (row.pos + 1).alias("start"),
                    strip_spaces(F.get(row.cells, F.lit(2))).alias("type"),
                ),
            ),
        )

    def cut(rows, starts):
        def section(this, i):
            end = F.coalesce(F.get(starts, i + 1)["start"] - 1, F.size(rows) + 2)
            length = F.greatest(end - this.start, F.lit(0))
            return F.struct(
                this.type.alias("type"), F.slice(rows, this.start - 1, length).alias("rows")
            )

        return F.transform(starts, section)

    html = F.col(html_col)
    html = F.when(F.contains(html, F.lit("<!--")), F.regexp_replace(html, _COMMENT, "")).otherwise(html)
    html = F.when(html.rlike("(?i)<(?:script|style)"), F.regexp_replace(html, _RAW, "$1")).otherwise(html)
    sections = _let(
        _row_texts(html),
        lambda texts: _let(
            numbered_rows(texts),
            lambda rows: _let(section_starts(rows), lambda starts: cut(rows, starts)),
        ),
    )
    data = pages.select(*key_cols, F.inline(sections)).select(
        *key_cols, "type", F.inline("rows")
    )

    texts = {
        f"text_{i}": F.get("cells", F.lit(i))
        for i in range(1, _DATA_CELLS - 1)
    }
    code, name = code_and_name(F.col("text_1"))
    reason = F.when(
        F.size("cells") != _DATA_CELLS,
        F.concat(F.lit("cells: "), F.size("cells").cast("string")),
    ).when(code.isNull(), F.lit("no single U+3000 in the name cell"))
    values = [code, name, *[F.col(text) for text in list(texts)[1:]]]
    return (
        data.withColumns(texts)
        .withColumn(REASON, reason)
        .select(
            *key_cols,
            "pos",
            "type",
            *[
                F.when(F.col(REASON).isNull(), value).alias(field)
                for field, value in zip(LISTING_FIELDS[1:], values)
            ],
            F.when(F.col(REASON).isNotNull(), F.col("cells")).alias("cells"),
            REASON,
        )
    )
