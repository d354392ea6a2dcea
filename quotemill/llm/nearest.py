"""Operator 2, approximate nearest neighbours: cross-polytope hashing.

Three rounds of random signs and a fast Hadamard transform rotate a unit vector; its hash is the
signed axis nearest to the result. An index entry goes to one bucket of each table, a
query also looks into the buckets of the next nearest axes. All vectors of a bucket are scored
in blocks; what may be among the best, but for rounding, is scored again exactly, so that ties
go to smaller ids in every block, and the best of all buckets are ranked.

Largest inner products become smallest angles when each vector gets one more coordinate that
brings it to the length of the longest one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

TABLES = 24
#: Buckets of each table that a query looks into.
PROBES = 4
#: Hashes that make a bucket together; more of them for more vectors.
HASHES = 1
#: Vectors, and queries, that are scored together.
BLOCK = 4096
#: Queries of a block whose candidates are scored again together.
EXACT_QUERIES = 256


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


@functools.cache
def _signs(seed: int, dimension: int, number: int) -> np.ndarray:
    return np.random.default_rng([seed, dimension, number]).choice([-1.0, 1.0], (3, dimension))


def _axes(x: np.ndarray, seed: int, number: int) -> np.ndarray:
    """Values of the rotated vectors along all signed axes."""
    for signs in _signs(seed, x.shape[1], number):
        x = _hadamard(x * signs)
    x = x[:, : x.shape[1] // 2]
    return np.concatenate([x, -x], axis=1)


def buckets(vectors: np.ndarray, longest: float, query: bool, seed: int, tables: int, probes: int, hashes: int) -> np.ndarray:
    """Bucket numbers of each vector, ``probes`` for each table, nearest first.

    An index vector of length up to ``longest`` gets the coordinate that it lacks; a query is scaled to length 1.
    """
    d = vectors.shape[1]
    size = 1 << d.bit_length()  # room for one more coordinate
    x = np.zeros((len(vectors), size))
    length = np.linalg.norm(vectors, axis=1)
    if query:
        x[:, :d] = vectors / length[:, None]
    else:
        x[:, :d] = vectors / longest
        x[:, d] = np.sqrt(np.clip(1 - (length / longest) ** 2, 0, None))
    found = []
    for t in range(tables):
        number = np.zeros((len(x), 1), np.int64)
        loss = np.zeros((len(x), 1))
        for h in range(hashes):
            axes = _axes(x, seed, t * hashes + h)
            wide = min(probes, axes.shape[1])
            top = axes.argmax(axis=1)[:, None] if wide == 1 else np.argsort(-axes, axis=1, kind="stable")[:, :wide]
            values = np.take_along_axis(axes, top, 1)
            # the best combinations of what the hashes before gave and the axes of this one
            number = (number[:, :, None] * axes.shape[1] + top[:, None, :]).reshape(len(x), -1)
            loss = (loss[:, :, None] + ((values[:, :1] - values) ** 2)[:, None, :]).reshape(len(x), -1)
            best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
            number, loss = np.take_along_axis(number, best, 1), np.take_along_axis(loss, best, 1)
        found.append(number * tables + t)
    return np.concatenate(found, axis=1)


def _hashed(vectors: DataFrame, longest: float, query: bool, seed: int, tables: int, probes: int, hashes: int) -> DataFrame:
    """(id, vector, dimension, bucket), a row for each bucket; each vector is hashed once."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 1024):
                part = batch.slice(first, 1024)
                lengths = np.asarray(part.column("dimension"))
                for d in np.unique(lengths):
                    some = part.take(pa.array(np.flatnonzero(lengths == d)))
                    x = some.column("vector").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
                    numbers = buckets(x, longest, query, seed, tables, probes, hashes)
                    yield pa.RecordBatch.from_arrays(
                        [*some.columns, pa.array(list(numbers), pa.list_(pa.int64()))], [*some.schema.names, "buckets"]
                    )

    kind = vectors.schema["vector"].dataType.simpleString()
    rows = vectors.select("id", "vector", F.size("vector").alias("dimension"))
    found = staged(rows.mapInArrow(hashed, f"id long, vector {kind}, dimension int, buckets array<long>"), "hashed")
    return found.select("id", "vector", "dimension", F.explode("buckets").alias("bucket"))


def _best_pairs(queries: np.ndarray, entries: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places of queries, ids, scores) of each query's best ``k`` entries, ties to the smaller id.

    Scores are added up component by component, as the final ranking does it. The product of
    matrices only tells which pairs cannot be among them: those below the k-th by more than both can be off.
    """
    d = queries.shape[1]
    longest = np.linalg.norm(entries, axis=1).max()
    for first in range(0, len(queries), EXACT_QUERIES):
        some = queries[first : first + EXACT_QUERIES]
        rough = some @ entries.T
        if len(entries) > k:
            off = 4 * d * np.finfo(float).eps * longest * np.linalg.norm(some, axis=1)
            least = np.partition(rough, len(entries) - k, axis=1)[:, len(entries) - k] - off
            rows, columns = np.nonzero(~(rough < least[:, None]))
        else:
            rows, columns = map(np.ravel, np.indices(rough.shape))
        exact = np.zeros(len(rows))
        for j in range(d):
            exact += some[rows, j] * entries[columns, j]
        order = np.lexsort((ids[columns], -exact, rows))
        rows, columns, exact = rows[order], columns[order], exact[order]
        top = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        yield rows[top] + first, ids[columns[top]], exact[top]


def _best_of_block(k: int):
    def best(queries: pa.Table, entries: pa.Table) -> pa.Table:
        none = pa.table({"query": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not len(queries) or not len(entries):
            return none
        matrix = lambda t: t["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(t), -1)
        asked = np.asarray(queries["id"])
        found = _best_pairs(matrix(queries), matrix(entries), np.asarray(entries["id"]), k)
        return pa.concat_tables(pa.table({"query": asked[rows], "id": ids, "score": scores}) for rows, ids, scores in found)

    return best


def _candidates(queries: DataFrame, entries: DataFrame, longest: float, k: int, seed: int, tables: int, probes: int, hashes: int) -> DataFrame:
    """(query, id, score): for each query (id, vector) the best ``k`` of the buckets it looks into, ties to the smaller id."""
    entries = _hashed(entries, longest, False, seed, tables, 1, hashes)
    queries = _hashed(queries, longest, True, seed, tables, probes, hashes)
    key = ["dimension", "bucket"]
    # a bucket with many entries or queries is cut into parts, and each two parts meet
    parts = lambda df, name: df.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    grid = parts(entries, "rows").join(parts(queries, "columns"), key)
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    entries = entries.join(grid, key).withColumn("i", part("rows")).withColumn("j", every("columns"))
    queries = queries.join(grid, key).withColumn("j", part("columns")).withColumn("i", every("rows"))
    cell = [*key, "i", "j"]
    found = (
        queries.select(*cell, "id", "vector")
        .groupBy(*cell)
        .cogroup(entries.select(*cell, "id", "vector").groupBy(*cell))
        .applyInArrow(_best_of_block(k), "query long, id long, score double")
    )
    top = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return (
        found.groupBy("query", "id").agg(F.max("score").alias("score")).withColumn("_n", F.row_number().over(top)).where(F.col("_n") <= k).drop("_n")
    )


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, tables: int = TABLES, probes: int = PROBES, hashes: int = HASHES, seed: int = 0
) -> DataFrame:
    """The ``k`` largest inner products of each query row with the other rows of ``vectors`` (vec_id, vector).

    Returns query_id, rank (from 1), vec_id and score (double), ties to the smaller vec_id. Rows
    without vec_id take no part, nor do vectors that are null, empty, all zero, or that hold a null, NaN or infinite
    component. Vectors are compared with those of the same dimension. Rows with a query's
    vec_id count as the query itself; where these have different vectors, there is one list for the vec_id, in which
    each other row has the best of its scores with them. Repeated rows are listed as often as they occur. A query that finds fewer than ``k`` candidates in its
    buckets, though there are more, is compared with all vectors, in blocks.

    Equal vectors are searched as one; of each only the k + 1 smallest vec_ids can be in a result.
    """
    value = F.col("vector")
    sound = (F.size(value) > 0) & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & value.isNotNull() & F.coalesce(sound, F.lit(False)))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "vector", is_query.alias("asked"))
    first = Window.partitionBy("vector").orderBy("vec_id")
    members = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)
    classes = staged(
        members.groupBy("vector").agg(F.min("vec_id").alias("id"), F.sort_array(F.collect_list("vec_id")).alias("members")), "vectors"
    )
    asked = staged(
        rows.where("asked").select("vec_id", "vector").join(classes.select("vector", "id"), "vector").select("vec_id", "id").distinct(), "queries"
    )
    queries = staged(asked.select("id").distinct().join(classes, "id").select("id", "vector"), "query-vectors")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    longest, n = classes.agg(F.max(norm), F.count(F.lit(1))).first()
    longest = longest or 1.0
    entries, wide = classes.select("id", "vector"), k + 1
    found = staged(_candidates(queries, entries, longest, wide, seed, tables, probes, hashes), "candidates")

    enough = classes.groupBy(F.size("vector").alias("dimension")).agg(F.least(F.count(F.lit(1)), F.lit(k + 1)).alias("enough"))
    short = (
        queries.join(found.groupBy(F.col("query").alias("id")).agg(F.count(F.lit(1)).alias("n")), "id", "left")
        .withColumn("dimension", F.size("vector"))
        .join(enough, "dimension")
        .where(F.coalesce("n", F.lit(0)) < F.col("enough"))
        .select("id", "vector")
    )
    if n and not short.isEmpty():
        everything = _candidates(short, entries, longest, wide, seed, 1, 1 << 30, 1)
        found = found.join(short.select(F.col("id").alias("query")), "query", "left_anti").unionByName(everything)

    # exact products of the original vectors, added up in one order
    pairs = found.join(queries.select(F.col("id").alias("query"), F.col("vector").alias("q")), "query").join(classes, "id")
    product = F.aggregate(
        F.zip_with("q", "vector", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda a, x: a + x
    )
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = (
        pairs.select("query", "id", product.alias("score"), F.posexplode("members").alias("member", "vec_id"))
        .withColumn("_n", F.row_number().over(ranked))
        .where(F.col("_n") <= k + 1)
    )
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.select(F.col("vec_id").alias("query_id"), F.col("id").alias("query"))
        .join(listed, "query")
        .where("vec_id != query_id")
        .groupBy("query_id", "id", "member", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
