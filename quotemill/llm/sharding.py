"""Operator 1, sharding: a two-pass external shuffle.

The first pass scatters records by a seeded hash into buckets that fit into memory; the
second one runs a Fisher-Yates shuffle in each bucket. Read one bucket after the other,
the records are in a uniformly random order, and the shards are equal pieces of it: the
row counts of two shards differ by one at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import stage_path

#: Fewer buckets would leave executors idle; a bucket is then just smaller.
LEAST_BUCKETS = 64


def external_shuffle(
    df: DataFrame, keys: list[Column], size: Column, shards: int, seed: int = 0, bucket_bytes: int = 16 << 20
) -> DataFrame:
    """Deal all rows of ``df`` to ``shards`` shards in random order.

    Returns ``shard`` int, ``slot`` long (place in the shard, from 0 without a gap) and
    ``record`` (struct of all input columns, so that names can't clash).

    ``keys`` identify a row: they and the seed decide its bucket, and its place in it.
    Nulls are values like others. Rows with the same keys share a bucket, so keys should
    tell apart also repeated rows where there may be many of them. ``size`` is a row's
    size in bytes, null counting as 0; a bucket holds about ``bucket_bytes``, or one record
    where that is larger. An empty input gives no rows.
    """
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    buckets = max(LEAST_BUCKETS, int(total) // bucket_bytes + 1)
    hashed = df.select(F.xxhash64(F.lit(seed), *keys).alias("_h"), record.alias("record")).withColumn(
        "_bucket", F.pmod("_h", F.lit(buckets))
    )
    counts = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # one row per bucket, summed in two levels like any other running sum
    group = F.expr("_bucket div 4096")
    inner = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = (
        counts.groupBy(group.alias("_group"))
        .agg(F.sum("_n").alias("_n"))
        .select("_group", F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_before"))
    )
    offsets = (
        counts.select("_bucket", group.alias("_group"), F.coalesce(F.sum("_n").over(inner), F.lit(0)).alias("_inner"))
        .join(groups, "_group")
        .select("_bucket", (F.col("_inner") + F.col("_before")).alias("_offset"))
    )

    def fisher_yates(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_h")  # the order in which a shuffle delivers rows is not fixed
        bucket, offset = rows["_bucket"][0].as_py(), rows["_offset"][0].as_py()
        order = np.arange(len(rows))
        np.random.default_rng([seed & 0xFFFFFFFF, bucket]).shuffle(order)
        place = offset + np.arange(len(rows), dtype=np.int64)
        shard = place * shards // n
        return pa.table(
            {
                "shard": pa.array(shard.astype(np.int32)),
                "slot": pa.array(place - -(-shard * n // shards)),
                "record": rows["record"].take(pa.array(order)),
            }
        )

    result = StructType().add("shard", "integer").add("slot", "long").add(hashed.schema["record"])
    return hashed.join(offsets, "_bucket").groupBy("_bucket").applyInArrow(fisher_yates, result)


def write_shards(shuffled: DataFrame, path: str | None = None) -> str:
    """Write the rows of :func:`external_shuffle` as Parquet, a folder per shard; returns the path."""
    path = path or stage_path(shuffled.sparkSession, "shards")
    shuffled.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path
