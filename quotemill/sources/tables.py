"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, table: str, fields: list[str], condition: str = "true") -> DataFrame:
    """``fields`` of the rows that meet ``condition``, a SQL predicate of the caller's own."""
    return spark.table(table).where(F.expr(condition)).select(*fields)
