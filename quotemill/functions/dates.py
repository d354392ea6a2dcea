"""Date expressions. None reads the clock: the caller passes the day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compact_date(col: Column) -> Column:
    """``yyyymmdd``"""
    return F.date_format(col, "yyyyMMdd")


def snap_label(col: Column) -> Column:
    """``yymmdd``"""
    return F.date_format(col, "yyMMdd")


def trade_date(col: Column) -> Column:
    """Saturday and Sunday become the Friday before."""
    day = F.to_date(col)
    return F.date_sub(day, F.greatest(F.weekday(day) - 4, F.lit(0)))


def title_date(title: Column, marker: Column) -> Column:
    """The date in a title that is exactly ``<marker>yymmdd.zip``, else NULL.

    Two-digit years from 69 on belong to the 1900s.
    """
    rest = F.when(F.startswith(title, marker), F.substr(title, F.char_length(marker) + 1))
    digits = F.regexp_extract(rest, r"^(\d{6})\.zip\z", 1)
    century = F.when(digits >= F.lit("69"), "19").otherwise("20")
    return F.try_to_date(F.concat(century, digits), "yyyyMMdd")
