"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import staged

#: Characters between words: space, and tab to carriage return. Everything else is part of a word.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of ``text``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD + "+")), F.lit(0)).cast("long")


#: Whole components stay within this, so that their products can be summed in 64 bits.
LARGEST = 1 << 27


def sound(vector: Column) -> Column:
    """Whether ``vector`` is neither null nor holds a null, NaN or infinite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def whole(vector: Column, scale: int = 256) -> Column:
    """floor(``scale`` * x) of each component x, no larger or smaller than LARGEST."""
    return F.transform(vector, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(LARGEST)), F.lit(-LARGEST)))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` written once as (``row``, ``record``): a number per row, and all columns as a struct.

    The number stays the same however often the table is read, also for repeated rows.
    """
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return staged(docs.select(F.monotonically_increasing_id().alias("row"), record.alias("record")), "rows")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores before it where ``df`` has a column of that name."""
    taken, free = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        free.append(name)
    return free


def running_sum(
    df: DataFrame, by: list[str], order: list[str], value: Column, name: str, ties: list[str] = (), slice_rows: int = 50_000
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows before a row among those equal in ``by``.

    The rows of a group stand in the order of a hash of ``order`` (then of ``order`` and
    ``ties`` themselves), so the order is pseudorandom, but the same in each run. With 1 as
    ``value`` the result numbers the rows of each group from 0 without a gap.

    No task gets a whole group: the hash range is cut into slices, and each slice is summed
    in its own window. What the slices before it add up to is one row per group and
    slice, which goes into the window ahead of the slice's rows; so rows are shuffled once.

    Null keys are a group, nulls come first in ``order``, and null values add nothing. Other columns may have any
    names but ``name``. An empty ``df`` stays empty.
    """
    slices = df.count() // slice_rows + 64
    h, summand, real, slice_ = unused(df, "_h", "_value", "_real", "_slice")
    quoted = [f"`{c}`" for c in df.columns]
    hashed = df.select(*quoted, F.xxhash64(*order).alias(h), value.cast("long").alias(summand), F.lit(1).alias(real))
    hashed = hashed.withColumn(slice_, F.expr(f"shiftrightunsigned({h}, 33) * {slices} div {1 << 31}"))
    keys = [*by, slice_]
    before = Window.partitionBy(*by).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy(*keys)
        .agg(F.sum(summand).alias("sum"))
        .select(*keys, F.coalesce(F.sum("sum").over(before), F.lit(0)).alias(summand), F.lit(0).alias(real))
    )
    within = Window.partitionBy(*keys).orderBy(real, h, *order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    summed = hashed.unionByName(starts, allowMissingColumns=True).withColumn(name, F.sum(summand).over(within))
    return summed.where(F.col(real) == 1).select(*quoted, name)
