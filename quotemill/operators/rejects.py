"""The rejects channel: parsers add ``reject_reason``, NULL for a good row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNull()).drop(REASON)


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNotNull())
