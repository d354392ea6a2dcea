"""Daily closing reports: JSON documents that carry their own column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rejects import REASON
from ..schemas import REPORT_JSON

_OWN_COLUMNS = ("date", "stat", "pos", REASON)


def report_columns(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """The column names of all reports (``name``), with the first ``place`` of each.

    This reads the input once; ``report_rows`` takes the names that are wanted.
    """
    header = F.from_json(value_col, "fields5 array<string>")["fields5"]
    return (
        raw.select(F.posexplode(header).alias("place", "name"))
        .groupBy("name")
        .agg(F.min("place").alias("place"))
        .select("place", "name")
    )


def report_rows(
    raw: DataFrame, columns: list[str], value_col: str = "value"
) -> DataFrame:
    """One row per entry of ``data5``, under the names of ``fields5``.

    ``date`` and ``stat`` of the report stay on every row; ``pos`` is the row's
    place in its report. Reports that are not JSON, not ``OK``, without header or
    data or with a doubled column name are rejects, and so are rows whose length is
    not that of the header. The place of each wanted column is looked up once per
    report, not per row.
    """
    clash = [c for c in columns if c in _OWN_COLUMNS]
    if clash:
        raise ValueError(f"report columns named like the report's own: {clash}")

    # A generator of one element, so that the JSON is parsed once per report.
    docs = raw.select(F.explode(F.array(F.from_json(value_col, REPORT_JSON))).alias("doc")).select(
        "doc.*"
    )
    header_reason = (
        F.when(F.coalesce("stat", "date").isNull() & F.col("fields5").isNull(), "no report")
        .when(F.coalesce("stat", F.lit("")) != "OK", F.concat(F.lit("stat "), F.coalesce("stat", F.lit(""))))
        .when(F.col("fields5").isNull() | F.col("data5").isNull(), "no fields5 or data5")
        .when(F.size(F.array_distinct("fields5")) != F.size("fields5"), "doubled column name")
    )
    # A rejected report without rows still has to show up as one reject.
    no_rows = F.coalesce(F.size("data5"), F.lit(0)) <= 0  # -1 for NULL without ANSI mode
    entries = F.when(
        F.col("header_reason").isNotNull() & no_rows,
        F.array(F.lit(None).cast("array<string>")),
    ).otherwise(F.col("data5"))
    places = F.array(*[F.array_position("fields5", F.lit(c)).cast("int") - 1 for c in columns])
    rows = (
        docs.withColumn("header_reason", header_reason)
        .select(
            "date",
            "stat",
            "header_reason",
            F.size("fields5").alias("width"),
            places.alias("places"),
            F.posexplode(entries).alias("pos", "entry"),
        )
    )
    reason = F.coalesce(
        F.col("header_reason"),
        F.when(
            F.coalesce(F.size("entry"), F.lit(-1)) != F.col("width"), "row length is not the header's"
        ),
    )
    return rows.withColumn(REASON, reason).select(
        "date",
        "stat",
        "pos",
        *[
            F.when(
                F.col(REASON).isNull(), F.get("entry", F.get("places", F.lit(i)))
            ).alias(c)
            for i, c in enumerate(columns)
        ],
        REASON,
    )
