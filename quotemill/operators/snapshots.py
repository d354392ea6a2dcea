"""Which snapshots there are, which are newest, and which sources are stale."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import title_date
from .rejects import REASON


def stale_sources(
    expected: DataFrame,
    catalog: DataFrame,
    as_of: dt.datetime | Column,
    key: str = "title",
    mtime: str = "modificationTime",
) -> DataFrame:
    """``expected`` keys with ``stale``: no file, or all files older than 24 hours before ``as_of``."""
    newest = catalog.groupBy(key).agg(F.max(mtime).alias("newest"))
    limit = F.lit(as_of) - F.expr("interval 24 hours")
    return (
        expected.select(key)
        .join(newest, key, "left")
        .select(key, "newest", (F.col("newest").isNull() | (F.col("newest") < limit)).alias("stale"))
    )


def dated_titles(catalog: DataFrame, markers: list[str], title: str = "title") -> DataFrame:
    """Each title once per marker it contains, with the date it states.

    A title that contains a marker but is not exactly ``<marker>yymmdd.zip`` is a
    reject.
    """
    found = F.filter(
        F.array(*[F.lit(m) for m in markers]), lambda m: F.contains(F.col(title), m)
    )
    rows = catalog.select("*", F.explode(found).alias("category"))
    return rows.withColumn("snap_date", title_date(F.col(title), F.col("category"))).withColumn(
        REASON, F.when(F.col("snap_date").isNull(), "no date in the title")
    )


def by_title_date(dated: DataFrame, title: str = "title") -> DataFrame:
    """Newest first."""
    return dated.orderBy(F.col("snap_date").desc(), title)


def latest_snapshot(dated: DataFrame, title: str = "title") -> DataFrame:
    """The newest title of each category, without a sort over the titles."""
    return dated.groupBy("category").agg(
        F.max_by(title, F.struct("snap_date", title)).alias("title"),
        F.max("snap_date").alias("snap_date"),
    )
