"""Daily closing report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import compact_date, trade_date
from ..operators.columns import code_list, drop_required
from ..operators.rejects import accepted, rejected
from ..schemas import REPORT_CHANGE_SIGN, REPORT_CODE
from ..sources.report import report_rows


def daily_report(
    raw: DataFrame,
    columns: list[str],
    day: Column | None = None,
    value_col: str = "value",
) -> tuple[DataFrame, DataFrame]:
    """Report rows without the change sign, and the rejects.

    With ``day``, only the report of that day, or of the Friday before a weekend.
    """
    rows = report_rows(raw, columns, value_col)
    report = drop_required(accepted(rows), REPORT_CHANGE_SIGN)
    if day is not None:
        report = report.where(F.col("date") == compact_date(trade_date(day)))
    return report, rejected(rows)


def report_codes(report: DataFrame) -> DataFrame:
    return code_list(report, REPORT_CODE)
