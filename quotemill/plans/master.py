"""Security master: from landed listing pages, or from its CSV export."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.columns import book_of
from ..operators.rejects import accepted, rejected
from ..operators.snapshots import stale_sources
from ..schemas import BOOKS, EQUITY_TYPE, LISTING_FIELDS
from ..session import staged
from ..sources.listing import listing_rows


def master_sets(rows: DataFrame, order: str) -> dict[str, DataFrame]:
    """``codes`` (equities of all books) and one set of all types per book; last row per code wins.

    ``rows`` has the listing fields, ``book`` and the ``order`` column. They are reduced
    once, to the last row of each book and code and its last equity row; the sets come
    from that.
    """
    row = F.struct(*LISTING_FIELDS, "book")
    equity_order = F.when(F.col("type") == EQUITY_TYPE, F.col(order))
    last = rows.groupBy(F.col("book").alias("of_book"), F.col("code").alias("of_code")).agg(
        F.max_by(row, F.col(order)).alias("any"),
        F.max_by(row, equity_order).alias("equity"),
        F.max(equity_order).alias("equity_order"),
    )
    last = staged(last, "master")
    codes = last.where("equity_order is not null").groupBy("of_code").agg(
        F.max_by("equity", "equity_order").alias("equity")
    )
    sets = {"codes": codes.select("equity.*")}
    for book in BOOKS:
        sets[book] = last.where(F.col("of_book") == book).select("any.*")
    return sets


def build_master(
    pages: DataFrame, as_of: dt.datetime | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Master sets and rejects from ``pages(source, url, captured, html)``.

    ``url`` and ``captured`` identify a page; later captures win, then later pages by
    url, then later rows. With ``as_of``, pages captured after it are left out. Pages are
    parsed once, and the rows staged.
    """
    if as_of is not None:
        pages = pages.where(F.col("captured") <= F.lit(as_of))
    rows = staged(listing_rows(pages, ["source", "url", "captured"]), "listing-rows")
    good = accepted(rows).select(
        *LISTING_FIELDS,
        book_of(F.col("source")).alias("book"),
        F.struct("captured", "url", "pos").alias("page_order"),
    )
    return master_sets(good, "page_order"), rejected(rows)


def stale_master_sources(
    expected: DataFrame, catalog: DataFrame, as_of: dt.datetime
) -> DataFrame:
    """The expected source files that have to be fetched again."""
    return stale_sources(expected, catalog, as_of).where("stale")
