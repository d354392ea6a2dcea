"""Appends that happen once, whatever is repeated or lost on the way.

A batch is written beside the table's files first, in a folder that readers of the table do not
see. The commit is one file, created only if it is not there yet: it names the folder, and
from then on the batch belongs to the table. Its files are then moved in. A run that is lost before the
commit leaves nothing in the table; one lost after it leaves a commit that the next append, or
``finish_appends``, carries out. All of this lies below the table's own folder and goes with it.
"""

from __future__ import annotations

import hashlib
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_FOLDER = "_batches"
#: Seconds after which a commit that names no folder counts as lost.
_GRACE = 2.0


def _files(spark: SparkSession, folder: str):
    """The folder's path, and the file system it is in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _location(spark: SparkSession, table: str) -> str:
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "Num Buckets" in details or "# Partition Information" in details:
        raise ValueError(f"{table} has buckets or partitions; batches are for tables without")
    return details["Location"].rstrip("/")


def _listed(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _files(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []


def _read(spark: SparkSession, name: str) -> str:
    path, fs = _files(spark, name)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _created(spark: SparkSession, name: str, content: str) -> bool:
    """Create a file that is not there yet; False if it is."""
    path, fs = _files(spark, name)
    try:
        stream = fs.create(path, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName() or "already exists" in str(e.java_exception.getMessage()):
            return False
        raise
    stream.write(bytearray(content.encode()))
    stream.close()
    return True


def _moved(spark: SparkSession, name: str, to: str) -> None:
    """Move a file, if no one else did."""
    (path, fs), (target, _) = _files(spark, name), _files(spark, to)
    try:
        done = fs.rename(path, target)
    except Py4JJavaError:
        done = False
    if not done and not fs.exists(target):
        raise OSError(f"{name} cannot be moved to {to}")


def _publish(spark: SparkSession, location: str, key: str) -> None:
    """Move the files of a committed batch into the table.

    May be repeated after a part of it was done, and be done by several at once. A commit that came
    when its batch was done already, by another folder, is thrown away.
    """
    log = f"{location}/{_FOLDER}"
    commit, done = f"{log}/{key}.commit", f"{log}/{key}.done"
    (path, fs), (marked, _) = _files(spark, commit), _files(spark, done)
    folder = _read(spark, commit) if fs.exists(path) else None
    if folder == "":
        time.sleep(_GRACE)
        folder = _read(spark, commit) if fs.exists(path) else None
    if folder and (not fs.exists(marked) or _read(spark, done) == folder):
        for name in _listed(spark, f"{log}/{folder}"):
            if not name.startswith(("_", ".")):
                _moved(spark, f"{log}/{folder}/{name}", f"{location}/{key}-{name}")
        _created(spark, done, folder)
    if folder is not None:  # without a folder's name it was lost before its first byte: nothing is committed
        fs.delete(path, False)
    if folder:
        _discard(spark, f"{log}/{folder}")


def finish_appends(spark: SparkSession, table: str) -> None:
    """Carry out what earlier appends to ``table`` committed and did not finish."""
    location = _location(spark, table)
    unfinished = [n.removesuffix(".commit") for n in _listed(spark, f"{location}/{_FOLDER}") if n.endswith(".commit")]
    for key in unfinished:
        _publish(spark, location, key)
    if unfinished:
        spark.catalog.refreshTable(table)


def append_once(df: DataFrame, table: str, batch: str) -> bool:
    """Append ``df`` by position as the batch of that name; False if ``table`` has that batch already.

    The values are checked as by any insert. Of two runs that append one batch at the same time, one
    does; the other's rows are thrown away.
    """
    spark = df.sparkSession
    finish_appends(spark, table)
    location = _location(spark, table)
    log, key = f"{location}/{_FOLDER}", hashlib.sha256(batch.encode()).hexdigest()[:32]
    if f"{key}.done" in _listed(spark, log):
        return False
    folder = f"{key}-{uuid.uuid4().hex}"
    beside = f"{table}__{uuid.uuid4().hex}"
    quoted = f"{log}/{folder}".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {beside} LIKE {table} LOCATION '{quoted}'")
    try:
        df.write.insertInto(beside)
    except BaseException:
        _discard(spark, f"{log}/{folder}")
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
    if not _created(spark, f"{log}/{key}.commit", folder):
        _discard(spark, f"{log}/{folder}")
    _publish(spark, location, key)
    spark.catalog.refreshTable(table)
    return _read(spark, f"{log}/{key}.done") == folder


def _discard(spark: SparkSession, folder: str) -> None:
    path, fs = _files(spark, folder)
    fs.delete(path, True)
