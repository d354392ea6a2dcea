"""Exports and intakes that do only the missing work.

What is done is written in a manifest table after the data: an interrupted run
leaves nothing there and is repeated. Of runs that overlap and did the same work, the first
to finish counts: readers elect it from the manifest, and what the others wrote is never read.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..functions.dates import snap_label
from ..session import read_or_empty, staged, staging
from ..sources.archives import MEMBER_ROWS, expand_archives, spread
from .columns import require
from .keys import missing, present
from .order import with_row_index
from .rejects import REASON, accepted, rejected

LABEL = "snap"
_DONE = [
    StructField("run", StringType()),
    StructField("n_rows", LongType()),
    StructField("finished_at", TimestampType()),
]
_COMMITTED = "committed_at"
_UNIT = ["destination", "title"]
_LANDED = "destination string, title string, intake string, n_rows bigint, finished_at timestamp"


def _first_finished(manifest: DataFrame, key: list[str], run: str) -> DataFrame:
    """One row per key: that of the run which wrote its manifest first, the smaller ``run`` of equal ones.

    Rows without a time of commitment are from before there was one, and come first.
    """
    rest = [c for c in manifest.columns if c not in (*key, _COMMITTED)]
    first = F.min_by(F.struct(*rest), F.struct(_COMMITTED, run)).alias("first")
    return manifest.groupBy(*key).agg(first).select(*key, "first.*")


def _committed_now() -> Column:
    """When the manifest of a run is written, by the clock; ``finished_at`` is what the caller says."""
    return F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp").alias(_COMMITTED)


def _manifest_rows(df: DataFrame, key: str, path: str) -> DataFrame:
    """What all runs wrote, also several for one key.

    Every run writes to a folder of its own: two writes to one folder at a time take away each other's files.
    """
    schema = StructType([df.schema[key], *_DONE, StructField(_COMMITTED, TimestampType())])
    return read_or_empty(df.sparkSession, f"{path}/manifest", schema, recursiveFileLookup=True)


def read_manifest(df: DataFrame, key: str, path: str) -> DataFrame:
    """key, run, n_rows, finished_at: a row for each key that is done, of the run that counts."""
    return _first_finished(_manifest_rows(df, key, path), [key], "run")


def read_export(df: DataFrame, key: str, path: str) -> DataFrame:
    """The exported rows, with the columns and types of ``df``: of each key, those of the run that counts."""
    schema = StructType([*df.schema.fields, StructField("run", StringType())])
    rows = read_or_empty(df.sparkSession, f"{path}/data", schema)
    return present(rows, read_manifest(df, key, path), ["run", key]).select(*df.columns)


def export_missing(
    df: DataFrame, key: str, path: str, as_of: dt.datetime, wanted: DataFrame | None = None
) -> DataFrame:
    """Write one partition per key, for the keys that are not in the manifest yet.

    Returns the manifest rows of this run, without keys that another run finished before it. Each run has a folder of its own, which counts
    through the manifest only; rows are counted there, not in what was exported before.
    A rerun with nothing to do reads the key column only, or nothing if ``wanted`` names
    the keys. REBALANCE gives every key few files, and AQE splits a key that is too
    large for one task.
    """
    require(df, key)
    named = F.col(key).isNotNull() & (F.col(key).cast("string") != "")
    keys = (df if wanted is None else wanted).select(
        F.when(named, F.col(key)).otherwise(F.raise_error(F.lit(f"no {key}"))).alias(key)
    )
    with staging(df.sparkSession):
        todo = staged(missing(keys.distinct(), _manifest_rows(df, key, path), key), "export-keys")
        if todo.isEmpty():
            return read_manifest(df, key, path).where(F.lit(False))
        return _export_run(present(df, todo, key).hint("rebalance", key), todo, key, path, as_of)


def run_counts(rows: DataFrame, key: str, folder: str) -> DataFrame:
    """The number of rows of each key in one run's folder; only that folder is listed."""
    written = read_or_empty(rows.sparkSession, folder, rows.schema)
    return written.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def _export_run(rows: DataFrame, todo: DataFrame, key: str, path: str, as_of: dt.datetime) -> DataFrame:
    run = uuid.uuid4().hex
    folder = f"{path}/data/run={run}"
    rows.write.partitionBy(key).parquet(folder)
    todo.join(run_counts(rows, key, folder), key, "left").select(
        key,
        F.lit(run).alias("run"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.lit(as_of).alias("finished_at"),
        _committed_now(),
    ).write.parquet(f"{path}/manifest/{run}")
    return read_manifest(rows, key, path).where(F.col("run") == run)


def _export_labelled(df: DataFrame, label: str, path: str, as_of: dt.datetime) -> DataFrame:
    """All rows under one label. Nothing is to be brought together by key, so nothing is shuffled."""
    rows = df.withColumn(LABEL, F.lit(label))
    manifest = read_manifest(rows, LABEL, path)
    if not _manifest_rows(rows, LABEL, path).where(F.col(LABEL) == label).isEmpty():
        return manifest.where(F.lit(False))
    todo = df.sparkSession.createDataFrame([(label,)], f"{LABEL} string")
    return _export_run(rows, todo, LABEL, path, as_of)


def export_daily(df: DataFrame, path: str, as_of: dt.datetime) -> DataFrame:
    """Once per day: the partition is named by ``as_of`` and written if it is not there yet."""
    return _export_labelled(df, as_of.strftime("%y%m%d"), path, as_of)


def export_by_mtime(
    df: DataFrame, catalog: DataFrame, path: str, as_of: dt.datetime
) -> DataFrame:
    """Once per source change: named by the newest modification day in ``catalog``."""
    label = catalog.agg(snap_label(F.max("modificationTime"))).first()[0]
    if label is None:
        raise FileNotFoundError("no file to take the modification day from")
    return _export_labelled(df, label, path, as_of)


def select_for(catalog: DataFrame, needles: list[tuple[str, str]]) -> DataFrame:
    """Catalog entries per destination, for ``(destination, needle)`` pairs.

    An entry goes to every destination one of whose needles its title contains;
    of several entries with one title the first by path is taken.
    """
    pairs = F.array(
        *[F.struct(F.lit(d).alias("destination"), F.lit(n).alias("needle")) for d, n in needles]
    )
    hits = F.filter(pairs, lambda p: F.contains(F.col("title"), p["needle"]))
    return (
        catalog.select("title", "path", F.explode(hits).alias("hit"))
        .groupBy(F.col("hit.destination").alias("destination"), "title")
        .agg(F.min("path").alias("path"))
    )


def read_landings(spark: SparkSession, dst: str) -> DataFrame:
    """The manifest: one row per destination and title that landed whole, of the intake that counts."""
    manifest = read_or_empty(spark, f"{dst}/manifest", f"{_LANDED}, {_COMMITTED} timestamp", recursiveFileLookup=True)
    return _first_finished(manifest, _UNIT, "intake")


def _rows_of_landed(spark: SparkSession, dst: str) -> DataFrame:
    schema = MEMBER_ROWS.replace("archive string, ", "") + ", intake string, destination string, title string"
    rows = read_or_empty(spark, f"{dst}/rows", schema)
    return present(rows, read_landings(spark, dst), ["intake", *_UNIT])


def landed_rejects(spark: SparkSession, dst: str) -> DataFrame:
    """The members of landed archives that could not be read, with the reason."""
    return rejected(_rows_of_landed(spark, dst)).select("intake", *_UNIT, "member", REASON)


def landed_rows(spark: SparkSession, dst: str) -> DataFrame:
    """Rows of all archives that landed, without those of members that could not be read to their ends."""
    rows = accepted(_rows_of_landed(spark, dst))
    return missing(rows, landed_rejects(spark, dst), ["intake", *_UNIT, "member"]).drop("intake")


def land(
    units: DataFrame, dst: str, as_of: dt.datetime, encoding: str = "utf-8", delimiter: str = ","
) -> DataFrame:
    """Expand one batch of archives ``units(destination, title, path)`` below ``dst``.

    Archives are opened by their paths in the tasks. The batch has a folder of its own,
    which counts only through the manifest. An archive that cannot be opened or is damaged
    is left out there, so that the next run takes it again, and the others land; so do the
    other members beside one that is no text in ``encoding``. Archives that another intake landed
    meanwhile are not in the outcome.
    """
    spark = units.sparkSession
    intake = uuid.uuid4().hex
    folder = f"{dst}/rows/intake={intake}"
    (
        expand_archives(spread(units.select("path").distinct()), encoding, delimiter)
        .withColumnRenamed("archive", "path")
        .join(units, "path")
        .drop("path")
        .write.partitionBy(*_UNIT)
        .parquet(folder)
    )
    schema = f"member string, {REASON} string, destination string, title string"
    found = read_or_empty(spark, folder, schema).groupBy(*_UNIT).agg(
        F.count_if(F.col(REASON).isNull()).alias("n_rows"),
        F.max(F.when(F.col("member").isNull(), F.col(REASON))).alias(REASON),
    )
    outcome = units.join(found, _UNIT, "left").select(
        *_UNIT,
        F.lit(intake).alias("intake"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.lit(as_of).alias("finished_at"),
        REASON,
    )
    outcome = staged(outcome, "intake-outcome")
    whole = outcome.where(F.col(REASON).isNull())
    whole.drop(REASON).withColumn(_COMMITTED, _committed_now()).coalesce(1).write.parquet(f"{dst}/manifest/{intake}")
    own = read_landings(spark, dst).where(F.col("intake") == intake)
    return rejected(outcome).unionByName(present(whole, own, _UNIT))


def intake(
    selected: DataFrame,
    dst: str,
    as_of: dt.datetime,
    archives_per_batch: int = 10_000,
    encoding: str = "utf-8",
    delimiter: str = ",",
) -> Iterator[DataFrame]:
    """Land the ``selected(destination, title, path)`` entries that have not landed yet.

    They are landed in batches, and each finished batch is kept if a later one fails;
    no path passes through the driver. Yields the outcome of every batch as it is done.
    """
    spark = selected.sparkSession
    todo = with_row_index(missing(selected, read_landings(spark, dst), _UNIT), *_UNIT, name="place")
    last = todo.agg(F.max("place")).first()[0]
    for first in range(0, 0 if last is None else last + 1, archives_per_batch):
        batch = F.col("place").between(first, first + archives_per_batch - 1)
        yield land(todo.where(batch).drop("place"), dst, as_of, encoding, delimiter)
