"""Snapshot intake and export."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.exports import (
    export_by_mtime,
    export_daily,
    export_missing,
    intake,
    read_landings,
    select_for,
)
from ..operators.rejects import accepted
from ..operators.snapshots import dated_titles, latest_snapshot
from ..schemas import BROKER_DESTINATION, BROKER_MARKER, SNAPSHOT_CATEGORIES
from ..sources.catalog import in_folder, snapshot_catalog

__all__ = ["export_by_mtime", "export_daily", "export_missing", "select_snapshots", "snapshot_intake"]


def select_snapshots(
    catalog: DataFrame,
    categories: list[tuple[str, str]] = SNAPSHOT_CATEGORIES,
    everything: list[tuple[str, str]] = [(BROKER_MARKER, BROKER_DESTINATION)],
) -> DataFrame:
    """What to take from the catalog: ``(destination, title, path)``.

    The newest title of each of ``categories``, and all titles of ``everything``.
    At most one title per category reaches the driver.
    """
    destinations = dict(categories)
    dated = accepted(dated_titles(catalog.select("title"), list(destinations)))
    newest = latest_snapshot(dated).collect()
    needles = [(destination, marker) for marker, destination in everything]
    needles += [(destinations[row["category"]], row["title"]) for row in newest]
    return select_for(catalog, needles)


def snapshot_intake(
    spark: SparkSession,
    path: str,
    dst: str,
    as_of: dt.datetime,
    glob: str = "*.zip",
    encoding: str = "utf-8",
    delimiter: str = ",",
) -> DataFrame:
    """Land what is new in the folder ``path`` below ``dst``; the outcome of this run's archives.

    Archives with a defect carry a ``reject_reason`` and are taken again next time. Members
    are text in ``encoding``, with fields between ``delimiter``.
    """
    catalog = in_folder(snapshot_catalog(spark, path, glob, recursive=False), path)
    outcome = None
    for batch in intake(select_snapshots(catalog), dst, as_of, encoding=encoding, delimiter=delimiter):
        outcome = batch if outcome is None else outcome.unionByName(batch)
    if outcome is None:
        empty = read_landings(spark, dst).where(F.lit(False))
        outcome = empty.withColumn("reject_reason", F.lit(None).cast("string"))
    return outcome
