"""Projections, routing and conformance to a declared schema."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructType, VarcharType

from ..functions.text import as_string, strip_chars
from ..schemas import BOOKS, EQUITY_TYPE
from .rejects import REASON


def require(df: DataFrame, *cols: str) -> None:
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"no column {absent} in {df.columns}")


def drop_required(df: DataFrame, col: str) -> DataFrame:
    """Drop a column that has to be there."""
    require(df, col)
    return df.drop(col)


def clean_code(df: DataFrame, src: str, dst: str = "stock") -> DataFrame:
    """Replace ``src``, a code wrapped as ``="…"``, by the bare code as last column ``dst``."""
    require(df, src)
    return df.withColumn(dst, as_string(strip_chars(F.col(src), '="'))).drop(src)


def code_list(df: DataFrame, col: str = "code") -> DataFrame:
    """The codes as a one-column DataFrame."""
    require(df, col)
    return df.select(col)


def book_of(source: Column) -> Column:
    """The market book a row belongs to: ``tpex`` by name, anything else ``twse``."""
    twse, tpex = BOOKS
    return F.when(source == tpex, tpex).otherwise(twse)


def route(df: DataFrame, book: str) -> DataFrame:
    """The rows of one market book, all security types."""
    return df.where(F.col("book") == book)


def equities(df: DataFrame) -> DataFrame:
    return df.where(F.col("type") == EQUITY_TYPE)


def _readable(col: Column, dtype: DataType) -> Column:
    """``col`` as ``dtype``, or in a type wide enough to test its range."""
    if isinstance(dtype, VarcharType):
        return as_string(col)
    if isinstance(dtype, DecimalType):
        return col.try_cast(DecimalType(max(dtype.precision, 18), dtype.scale))
    return col.try_cast(dtype)


def _in_range(col: Column, dtype: DataType) -> Column:
    if isinstance(dtype, VarcharType):
        return F.when(F.char_length(col) <= dtype.length, col)
    if isinstance(dtype, DecimalType) and dtype.precision < 18:
        limit = F.lit(Decimal(10) ** (dtype.precision - dtype.scale))
        return F.when(F.abs(col) < limit, col.try_cast(dtype))
    return col


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to the types of a table, by column name.

    What does not fit becomes NULL, and ``reject_reason`` names the column: a
    value out of range, a text too long, a NULL where none is allowed.

    Decimals are tested in a wider type before the cast, as ``try_cast`` throws and
    catches an exception for every overflow, which costs more than all the rest.
    """
    fields, names = schema.fields, schema.fieldNames()
    require(df, *names)
    given = [F.col(f.name).isNotNull().alias(f"given_{f.name}") for f in fields]
    typed = df.select(*given, *[_readable(F.col(f.name), f.dataType).alias(f.name) for f in fields])
    typed = typed.withColumns({f.name: _in_range(F.col(f.name), f.dataType) for f in fields})
    # Through a generator of one element: a filter on the reason would otherwise be
    # pushed down to the input and do all the casts a second time.
    typed = typed.select(F.inline(F.array(F.struct(*typed.columns))))
    reasons = []
    for f in fields:
        is_given = F.col(f"given_{f.name}")
        if not f.nullable:
            reasons.append(F.when(~is_given, f"{f.name} is NULL"))
        reasons.append(F.when(is_given & F.col(f.name).isNull(), f"{f.name} does not fit"))
    return typed.select(*names, F.nullif(F.concat_ws("; ", *reasons), F.lit("")).alias(REASON))
