"""Members and rows of ZIP archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rejects import REASON
from ..session import staged
from .locations import locator

MEMBER_ROWS = (
    f"archive string, member string, row_pos bigint, cells array<string>, {REASON} string"
)
_MEMBERS = f"path string, place bigint, bytes bigint, {REASON} string"
_BATCH_ROWS = 4096
_BATCH_CHARS = 4 << 20
#: Uncompressed bytes that a task reads, and tasks at most.
_TASK_BYTES = 32 << 20
_TASKS = 10_000


def _in_tasks(encoding: str, delimiter: str):
    """What tasks do with archives: (list the members of paths, read members by place, read contents whole).

    Nested here, so that executors need nothing but Python and Arrow.
    """

    def batch(archive, member, first, rows, reason=None):
        import pyarrow as pa

        n = len(rows)
        columns = {
            "archive": pa.array([archive] * n, pa.string()),
            "member": pa.array([member] * n, pa.string()),
            "row_pos": pa.array([None] if reason else range(first, first + n), pa.int64()),
            "cells": pa.array(rows, pa.list_(pa.string())),
            "reject_reason": pa.array([reason] * n, pa.string()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def why(e):
        return f"{type(e).__name__}: {e}"

    def rows_of(archive, zf, info):
        import csv
        import io
        import sys

        csv.field_size_limit(sys.maxsize)
        if info.is_dir():
            return
        with zf.open(info) as raw:
            try:
                rows, first, chars = [], 0, 0
                for row in csv.reader(io.TextIOWrapper(raw, encoding=encoding, newline=""), delimiter=delimiter):
                    rows.append(row)
                    chars += sum(map(len, row))
                    if len(rows) == _BATCH_ROWS or chars > _BATCH_CHARS:
                        yield batch(archive, info.filename, first, rows)
                        first += len(rows)
                        rows, chars = [], 0
                if rows:
                    yield batch(archive, info.filename, first, rows)
            except (UnicodeError, csv.Error) as e:
                yield batch(archive, info.filename, 0, [None], why(e))

    located = locator()

    def opened(path):
        system, name, _ = located(path)
        return system.open_input_file(name)

    def expanded(archive, open_stream, places):
        """Rows of the members at ``places`` (all of them, if None)."""
        import zipfile

        try:
            with open_stream() as stream, zipfile.ZipFile(stream) as zf:
                infos = zf.infolist()
                for place in range(len(infos)) if places is None else places:
                    yield from rows_of(archive, zf, infos[place])
        except Exception as e:  # any defect of the archive: keep it as a reject
            yield batch(archive, None, 0, [None], why(e))

    def list_members(batches):
        import zipfile

        import pyarrow as pa

        def listed(path, places, sizes, reason):
            columns = {
                "path": pa.array([path] * len(places), pa.string()),
                "place": pa.array(places, pa.int64()),
                "bytes": pa.array(sizes, pa.int64()),
                "reject_reason": pa.array([reason] * len(places), pa.string()),
            }
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        for files in batches:
            for path in files.column(0).to_pylist():
                try:
                    with opened(path) as stream, zipfile.ZipFile(stream) as zf:
                        infos = zf.infolist()
                        for first in range(0, len(infos), _BATCH_ROWS):
                            some = infos[first : first + _BATCH_ROWS]
                            yield listed(path, list(range(first, first + len(some))), [i.file_size for i in some], None)
                except Exception as e:
                    yield listed(path, [None], [0], why(e))

    def read_members(batches):
        for members in batches:
            rows = list(zip(*(members.column(c).to_pylist() for c in ("path", "place", "reject_reason")), strict=True))
            first = 0
            for last in range(1, len(rows) + 1):  # the members of one archive after the other
                if last < len(rows) and rows[last][0] == rows[first][0]:
                    continue
                path, place, reason = rows[first]
                if place is None:
                    yield batch(path, None, 0, [None], reason)
                else:
                    yield from expanded(path, lambda path=path: opened(path), [r[1] for r in rows[first:last]])
                first = last

    def read_contents(batches):
        import pyarrow as pa

        for files in batches:
            contents = files.column(1)
            for i, path in enumerate(files.column(0).to_pylist()):
                yield from expanded(path, lambda i=i: pa.BufferReader(contents[i].as_buffer()), None)

    return list_members, read_members, read_contents


def expand_archives(
    files: DataFrame, encoding: str = "utf-8", delimiter: str = ","
) -> DataFrame:
    """CSV rows of all members of the archives in ``files``: ``path``, and ``content`` or not.

    Without ``content``, archives are opened by path, as seekable streams. Tasks first read their directories;
    then the members, not the archives, are dealt out by their sizes, so an archive of any size
    spreads over many tasks, each of which opens it and reads its own members only. A member is read as a
    stream and leaves in batches of rows.

    What cannot be read yields one more row with the reason, and the rest goes on: a
    member that is no text in ``encoding``, or no CSV, names itself; a row without member says
    that the archive itself cannot be opened, or is damaged. Each task that finds so says it once.
    """
    list_members, read_members, read_contents = _in_tasks(encoding, delimiter)
    if "content" in files.columns:
        return files.select("path", "content").mapInArrow(read_contents, MEMBER_ROWS)
    members = staged(files.select("path").mapInArrow(list_members, _MEMBERS), "members")
    n, size = members.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(-(-size // _TASK_BYTES), min(n, files.sparkSession.sparkContext.defaultParallelism), 1)
    dealt = members.repartition(min(tasks, _TASKS), "path", "place").sortWithinPartitions("path", "place")
    return dealt.mapInArrow(read_members, MEMBER_ROWS)


def archive_rows(
    spark: SparkSession,
    path: str | list[str],
    glob: str = "*.zip",
    encoding: str = "utf-8",
    delimiter: str = ",",
) -> DataFrame:
    """Rows of all archives below ``path``; they are listed by Spark and opened in the tasks."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path")
    )
    return expand_archives(spread(files), encoding, delimiter)


def spread(files: DataFrame, most: int = _TASKS) -> DataFrame:
    """``files`` dealt out so that no task opens many archives: one each, up to ``most`` tasks."""
    return files.repartition(max(1, min(most, files.count())))
