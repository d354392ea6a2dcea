"""Share-capital ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import report_line, thousands
from ..operators.columns import clean_code
from ..operators.order import top_n, with_row_index
from ..operators.rejects import REASON, accepted, rejected
from ..schemas import CAPITAL_CODE, CAPITAL_NAME, CAPITAL_VALUE
from ..sources.csv_files import ORDER, read_capital, with_input_place


def capital_table(rows: DataFrame) -> DataFrame:
    """``rows`` of the capital CSV with bare code and decimal capital.

    A text that is neither empty nor a number that DECIMAL(18,2) holds as it is makes
    a reject, which keeps the text as its reason.
    """
    table = clean_code(rows, CAPITAL_CODE, "stock")
    given, value = F.coalesce(CAPITAL_VALUE, F.lit("")), thousands(F.col(CAPITAL_VALUE))
    # The reason first, from the text: the number takes the text's place after it.
    bad = (F.trim(given) != "") & value.isNull()
    reason = F.when(bad, F.concat(F.lit("no number that fits: "), given))
    return table.withColumn(REASON, reason).withColumn(CAPITAL_VALUE, value)


def capital_ranking(
    spark: SparkSession, path: str, multi_line: bool | None = None, place: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The table by capital, largest first, with the rank as ``row_index``; and the rejects.

    ``index`` is the place in the input, as a second row index, which counts rejects too.
    """
    rows = read_capital(spark, path, multi_line)
    table = capital_table(with_input_place(rows, "index") if place else rows)
    order = [F.col(CAPITAL_VALUE).desc_nulls_last(), "stock", ORDER]
    return with_row_index(accepted(table), *order).drop(ORDER), rejected(table).drop(ORDER)


def top_lines(table: DataFrame, n: int = 3) -> DataFrame:
    """Report lines of the ``n`` largest, without ranking the rest."""
    largest = top_n(table, F.col(CAPITAL_VALUE).desc_nulls_last(), "stock", n=n)
    return largest.select(
        CAPITAL_VALUE, "stock", report_line(F.col(CAPITAL_NAME), F.col(CAPITAL_VALUE)).alias("line")
    )
