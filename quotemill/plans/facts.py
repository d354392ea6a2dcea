"""The two fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import compact_date
from ..operators.columns import conform
from ..operators.order import first_row
from ..operators.rejects import accepted, rejected
from ..operators.tables import append_rows, create_brokerage_avg_price, create_tdcc, drop_table
from ..schemas import BROKERAGE_AVG_PRICE, TDCC
from ..session import staged
from ..sources.tables import scan


def reset_fact_tables(
    spark: SparkSession, brokerage: str = "BrokerageAvgPrice", tdcc: str = "TDCC"
) -> None:
    for table in (brokerage, tdcc):
        drop_table(spark, table)
    create_brokerage_avg_price(spark, brokerage)
    create_tdcc(spark, tdcc)


def load_brokerage(df: DataFrame, table: str = "BrokerageAvgPrice", batch: str | None = None) -> DataFrame:
    """Append the rows that fit the table, laid out by stock and date; returns the others.

    With ``batch``, a name, a repeated load of it appends nothing (see ``append_rows``).
    """
    return _load(df, table, BROKERAGE_AVG_PRICE, batch)


def load_tdcc(df: DataFrame, table: str = "TDCC", batch: str | None = None) -> DataFrame:
    return _load(df, table, TDCC, batch)


def _load(df: DataFrame, table: str, schema, batch: str | None) -> DataFrame:
    rows = staged(conform(df, schema), "conformed")  # read for the ranges, the write, and the rejects
    append_rows(accepted(rows), table, schema, cluster_by=["stock", "date"], batch=batch)
    return rejected(rows)


def date_list(spark: SparkSession, table: str, condition: str, field: str = "date") -> DataFrame:
    """``field`` of the matching rows as ``yyyymmdd`` text."""
    rows = scan(spark, table, [field], condition)
    return rows.select(compact_date(F.col(field)).alias("date"))


def first_match(
    spark: SparkSession, table: str, fields: list[str], condition: str, *order: str | Column
) -> DataFrame:
    """The first matching row in ``order``, or none."""
    return first_row(scan(spark, table, ["*"], condition), *order).select(*fields)
