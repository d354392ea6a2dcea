"""The snapshot catalog: what lies in a folder, and since when."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import file_name
from ..session import staged
from .locations import locator

_FILE = "path string, modificationTime timestamp, length bigint, content binary"
_ENTRY = "path string, modificationTime timestamp, length bigint, is_folder boolean"
_BATCH_ROWS = 65_536
#: Folders that a task lists, and tasks at most.
_TASK_FOLDERS, _TASKS = 64, 10_000
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def _listing():
    """What tasks do with the paths of folders: list what is in them."""
    located = locator()

    def hidden(name):  # what Spark's file sources leave out
        return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")

    def listed(batches):
        import pyarrow as pa
        from pyarrow import fs

        for folders in batches:
            for folder in folders.column(0).to_pylist():
                system, name, before = located(folder)
                # a folder deleted since is empty
                found = system.get_file_info(fs.FileSelector(name, allow_not_found=True))
                found = [f for f in found if not hidden(f.base_name)]
                for first in range(0, len(found), _BATCH_ROWS):
                    some = found[first : first + _BATCH_ROWS]
                    columns = {
                        "path": pa.array([before + f.path for f in some], pa.string()),
                        "modificationTime": pa.array([(f.mtime_ns or 0) // 1_000_000 * 1000 for f in some], pa.timestamp("us", "UTC")),
                        "length": pa.array([f.size or 0 for f in some], pa.int64()),
                        "is_folder": pa.array([f.type == fs.FileType.Directory for f in some], pa.bool_()),
                    }
                    yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return listed


def _start(spark: SparkSession, path: str) -> list[tuple]:
    """(path, modificationTime, length, is_folder) of ``path`` itself, or of what it matches as a glob."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [system.getFileStatus(top)] if system.exists(top) else system.globStatus(top)
    if not found:
        raise FileNotFoundError(path)
    moment = lambda f: dt.datetime.fromtimestamp(f.getModificationTime() / 1000, dt.timezone.utc)
    return [(f.getPath().toString(), moment(f), f.getLen(), f.isDirectory()) for f in found]


def _tree(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """All files below ``path``, listed in tasks: the folders of one depth after those of the one above."""
    level = spark.createDataFrame(_start(spark, path), _ENTRY)
    levels = [level]
    while n := (folders := level.where("is_folder").select("path")).count():
        tasks = min(-(-n // _TASK_FOLDERS), _TASKS)
        level = staged(folders.repartition(tasks).mapInArrow(_listing(), _ENTRY), "listing")
        levels.append(level)
    files = reduce(DataFrame.unionByName, levels).where("not is_folder")
    return files.where(file_name(F.col("path")).rlike(glob_pattern(glob)))


def glob_pattern(glob: str) -> str:
    """A regular expression for whole names that ``glob`` matches: ``* ? [a-c] [^a] {a,b}`` and ``\\`` before what is meant as such."""
    out, at, depth = [], 0, 0
    while at < len(glob):
        c = glob[at]
        end = glob.find("]", at + (3 if glob[at + 1 : at + 2] in ("!", "^") else 2)) if c == "[" else -1
        if end > 0:
            inner = glob[at + 1 : end]
            negated = "^" if inner[0] in "!^" else ""
            members = re.sub(r"([\[\]&^\\])", r"\\\1", inner[len(negated) :])
            out.append(f"[{negated}{members}]")
            at = end
        elif c == "\\" and at + 1 < len(glob):
            at += 1
            out.append(re.escape(glob[at]))
        elif c == "{" and "}" in glob[at:]:
            depth += 1
            out.append("(?:")
        elif c == "}" and depth:
            depth -= 1
            out.append(")")
        else:
            out.append({"*": ".*", "?": ".", ",": "|" if depth else ","}.get(c) or re.escape(c))
        at += 1
    return rf"(?s)^{''.join(out)}\z"


def snapshot_catalog(
    spark: SparkSession, path: str, glob: str = "*.zip", recursive: bool = True
) -> DataFrame:
    """Files below ``path``, or without ``recursive`` only those in it: no folder below is listed then.

    Their content is not read. A tree is listed in tasks when this is called, a job for each depth, and the
    listing is staged: neither folders nor files go through the driver. A folder is listed by one task. Where
    ``path`` is a glob, all that it matches is listed; a ``path`` that is not there is a FileNotFoundError. As in
    Spark's file sources, names that begin with ``.`` or ``_`` are left out, folders too. Empty files are in the
    listing of a tree, and not in that of one folder.
    """
    if recursive:
        files = _tree(spark, path, glob)
    else:
        reader = spark.read.format("binaryFile").schema(_FILE)
        folder = re.sub(r"([\\*?{}\[\]])", r"\\\1", path.rstrip("/"))
        try:
            files = reader.option("recursiveFileLookup", True).load(f"{folder}/{glob}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            files = spark.createDataFrame([], _FILE)
    return (
        files.select(
            file_name(F.col("path")).alias("title"),
            "path",
            "modificationTime",
            "length",
            F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("parent"),
            F.lit(False).alias("trashed"),
        )
    )


def in_folder(catalog: DataFrame, parent: str) -> DataFrame:
    """Entries directly in ``parent`` that are not trashed; the scheme of a path does not count."""
    folder = re.sub(_SCHEME, "", parent).rstrip("/")
    return catalog.where((F.regexp_replace("parent", _SCHEME, "") == folder) & ~F.col("trashed"))
