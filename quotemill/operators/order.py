"""Operators that depend on the order of rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .columns import require

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def carry_down(
    df: DataFrame, col: str, part: str | list[str], pos: str, out: str, block: int = 1 << 16
) -> DataFrame:
    """The last non-NULL ``col`` up to each row of its ``part``, ``''`` before the first.

    ``pos`` is an integer, unique within a part. The rows of a part are windowed
    in blocks of ``block`` positions. What a block starts with comes from one summary
    row per block, which goes into the window ahead of the block's rows; so a part of
    any size spreads over tasks, and rows are shuffled once.
    """
    parts = [part] if isinstance(part, str) else list(part)
    rows = df.withColumn("block", F.col(pos) - F.pmod(pos, F.lit(block))).withColumn(out, F.col(col))
    ends = rows.groupBy(*parts, "block").agg(
        F.max_by(col, F.when(F.col(col).isNotNull(), F.col(pos))).alias("block_end")
    )
    earlier = Window.partitionBy(*parts).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(
        *parts,
        "block",
        F.last("block_end", ignorenulls=True).over(earlier).alias(out),
        F.lit(True).alias("block_start"),
    ).where(F.col(out).isNotNull())
    so_far = (
        Window.partitionBy(*parts, "block")
        .orderBy(F.col(pos).asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        rows.unionByName(starts, allowMissingColumns=True)
        .withColumn(out, F.coalesce(F.last(out, ignorenulls=True).over(so_far), F.lit("")))
        .where(F.col("block_start").isNull())
        .select(*df.columns, out)
    )


def with_row_index(df: DataFrame, *order: str | Column, name: str = "row_index") -> DataFrame:
    """0-based position of every row in ``order``, which has to be total.

    The sorted rows are written once, numbered within their range; the sizes of
    the ranges, one number per task, give the offsets. A value shared by many
    rows is split over ranges by the later columns of ``order``.
    """
    place = F.monotonically_increasing_id()
    rows = staged(df.orderBy(*order).withColumn("place", place), "row-index")
    task = F.shiftright("place", _ROW_BITS).cast("int")
    sizes = dict(rows.groupBy(task.alias("task")).agg(F.count(F.lit(1))).collect())
    starts = accumulate((sizes.get(t, 0) for t in range(max(sizes, default=0))), initial=0)
    offsets = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    index = F.get(offsets, task) + F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return rows.select(index.alias(name), *df.columns)


def by_capital(df: DataFrame, value: str, tie: str = "stock") -> DataFrame:
    """Largest first, missing last; equal values by ``tie``."""
    require(df, value, tie)
    return df.orderBy(F.col(value).desc_nulls_last(), tie)


def top_n(df: DataFrame, *order: str | Column, n: int = 3) -> DataFrame:
    """The first ``n`` rows in ``order``; fewer if there are no more."""
    return df.orderBy(*order).limit(n)


def first_row(df: DataFrame, *order: str | Column) -> DataFrame:
    """The first row in ``order``, or none."""
    return top_n(df, *order, n=1)
