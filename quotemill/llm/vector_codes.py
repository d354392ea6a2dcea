"""Operator 11, vector code compression: product quantization by active-entry Lloyd rounds.

A vector of whole numbers is cut into equal parts, and each part position has a codebook. A round
assigns every part to its nearest entry and moves the entries to the means of their parts. Every part
keeps its entry and the exact distance to it from round to round: where that entry has not
moved, only the moved entries can have come nearer, so only they are compared with the
stored distance. Parts whose entry has moved are compared with all entries again.

Rounds run as Spark jobs over the whole table; the codebooks, whose size does not depend on the
table, go to the tasks, and each task returns one sum for each entry and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from ..session import staged
from .common import sound, whole

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Vectors compared at a time.
BLOCK = 4096


class Codes(NamedTuple):
    """``rows``: record (all columns but the vector), code (an entry's index for each part), error
    (the squared distances of all parts, summed). ``codebooks``: integers by part, entry, component."""

    rows: DataFrame
    codebooks: np.ndarray


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, exact."""
    return (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)


def assign_all(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row of ``x``, the lower index of equal ones, and its distance."""
    d = _distances(x, entries)
    code = d.argmin(1)
    return code, np.take_along_axis(d, code[:, None], 1)[:, 0]


def assign_active(
    x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """As ``assign_all``, from the ``code`` and ``distance`` before the entries in ``moved`` moved."""
    code, distance = code.copy(), distance.copy()
    rescan = moved[code]
    if rescan.any():
        code[rescan], distance[rescan] = assign_all(x[rescan], entries)
    active, fixed = np.flatnonzero(moved), np.flatnonzero(~rescan)
    if len(active) and len(fixed):
        best, d = assign_all(x[fixed], entries[active])
        best = active[best]
        nearer = (d < distance[fixed]) | ((d == distance[fixed]) & (best < code[fixed]))
        code[fixed[nearer]], distance[fixed[nearer]] = best[nearer], d[nearer]
    return code, distance


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.reshape(-1), kind))


def _assigned(state: DataFrame, books: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """``state`` (record, vector, and from the second time on code and distance) with its parts assigned."""
    parts, _, width = books.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for first in range(0, len(whole_batch), BLOCK):
                batch = whole_batch.slice(first, BLOCK)
                n = len(batch)
                x = _matrix(batch.column("vector"), n)
                code, distance = np.empty((n, parts), np.int64), np.empty((n, parts), np.int64)
                if moved is not None:
                    code[:], distance[:] = _matrix(batch.column("code"), n), _matrix(batch.column("distance"), n)
                for p in range(parts):
                    part = x[:, p * width : (p + 1) * width]
                    if moved is None:
                        code[:, p], distance[:, p] = assign_all(part, books[p])
                    else:
                        code[:, p], distance[:, p] = assign_active(part, books[p], moved[p], code[:, p], distance[:, p])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("record"), batch.column("vector"), _lists(code, pa.int32()), _lists(distance, pa.int64())],
                    ["record", "vector", "code", "distance"],
                )

    schema = StructType([state.schema["record"], state.schema["vector"]])
    schema = schema.add("code", ArrayType(IntegerType())).add("distance", ArrayType(LongType()))
    return state.mapInArrow(assign, schema)


def _means(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks with each used entry at the floored mean of its parts."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            x, code = _matrix(batch.column("vector"), len(batch)), _matrix(batch.column("code"), len(batch))
            for p in range(parts):
                np.add.at(total[p], code[:, p], x[:, p * width : (p + 1) * width])
                count[p] += np.bincount(code[:, p], minlength=entries)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), _lists(total[p, e], pa.int64())],
            ["part", "entry", "count", "total"],
        )

    rows = state.select("vector", "code").mapInArrow(sums, "part int, entry int, count long, total array<long>")
    added = [F.sum(F.get("total", F.lit(i))) for i in range(width)]
    moved = books.copy()
    for r in rows.groupBy("part", "entry").agg(F.sum("count").alias("count"), F.array(*added).alias("total")).collect():
        moved[r["part"], r["entry"]] = [t // r["count"] for t in r["total"]]
    return moved


def compress(
    df: DataFrame, vector: str, order: list[str | Column], parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = 256
) -> Codes:
    """Codes of all rows of ``df`` whose ``vector`` is sound, and the codebooks they refer to.

    Components x become floor(``scale`` * x), within 2 ** 27 either way. Codebooks start as the parts of the
    first ``entries`` rows in ``order`` (then by the vector), all rows if there are fewer. Rows whose
    vector is null, or holds a null or non-finite component, are left out. A vector that is shorter
    than the longest, or an empty one, counts as filled up with zeros, and so does the last part of
    vectors that can't be cut into equal ones. Repeated rows count as often as they stand there. Without
    rows there are no codes, and codebooks without entries.
    """
    kept = [c for c in df.columns if c != vector]
    if not kept or entries < 1 or parts < 1:
        raise ValueError("rows need a column besides the vector, and codes some parts and entries")
    record = F.struct(*[F.col(f"`{c}`") for c in kept])
    given = F.col(f"`{vector}`")
    places = [(F.col(c) if isinstance(c, str) else c).alias(f"place{i}") for i, c in enumerate(order)]
    rows = df.where(sound(given)).select(record.alias("record"), whole(given, scale).alias("vector"), *places)
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    missing = F.array_repeat(F.lit(0).cast("long"), F.lit(width * parts) - F.size("vector"))
    rows = staged(rows.withColumn("vector", F.concat("vector", missing)), "whole-vectors")
    by = [F.col(f"place{i}").asc_nulls_last() for i in range(len(order))]
    first = [r["vector"] for r in rows.orderBy(*by, "vector").limit(entries).select("vector").collect()]
    books = np.array(first, np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    state, moved = rows.select("record", "vector"), None
    if not first:
        none = state.select("record", F.array().cast("array<int>").alias("code"), F.lit(0).cast("long").alias("error"))
        return Codes(none, books)
    for _ in range(rounds):
        state = staged(_assigned(state, books, moved), "assigned")
        means = _means(state, books)
        moved, books = (means != books).any(2), means
    error = F.aggregate("distance", F.lit(0).cast("long"), lambda a, d: a + d)
    return Codes(staged(_assigned(state, books, moved).select("record", "code", error.alias("error")), "codes"), books)


def codebooks_text(books: np.ndarray) -> str:
    """All components of all entries by part, entry and component, joined by commas."""
    return ",".join(map(str, books.reshape(-1).tolist()))


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(codebooks_text(books).encode()).hexdigest()


def decoded(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """The whole vectors that ``codes`` (a row of indexes each) stand for."""
    return np.concatenate([books[p][codes[:, p]] for p in range(books.shape[0])], axis=1)
