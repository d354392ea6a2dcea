"""Table and CSV writes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import csv_line
from ..schemas import BROKERAGE_AVG_PRICE, LISTING_FIELDS, REPORT_SUFFIX, TDCC
from .batches import append_once
from .columns import require


def write_lines(df: DataFrame, line: Column, header: str, path: str, line_sep: str = "\r\n") -> None:
    """``line`` of every row as text; every file starts with ``header``, also where there are no rows."""
    row_of_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    with_header = F.concat(F.lit(header + line_sep), line)
    lines = df.select(F.when(row_of_task == 0, with_header).otherwise(line).alias("value"))
    if lines.isEmpty():
        lines = df.sparkSession.createDataFrame([(header,)], "value string").coalesce(1)
    (
        lines.write.mode("overwrite")
        .option("lineSep", line_sep)
        .option("maxRecordsPerFile", 0)  # one file per task, so one header
        .text(path)
    )


def write_master(df: DataFrame, path: str, fields: list[str] = LISTING_FIELDS) -> None:
    """Master as CSV: header, minimal quoting, doubled quotes, CRLF, NULL as empty.

    The records are built as text, because the CSV writer with CRLF turns a line
    feed inside a field into CRLF as well.
    """
    require(df, *fields)
    write_lines(df, csv_line([F.col(f) for f in fields]), ",".join(fields), path)


def write_report(df: DataFrame, path: str) -> str:
    """Report rows as CSV, one folder per report date, the row position as unnamed first column.

    The position is the one ``report_rows`` gives, so nothing is numbered again. A
    date with very many rows is split into several files.
    """
    require(df, "date", "pos")
    columns = [c for c in df.columns if c not in ("date", "stat", "pos")]
    target = f"{path.rstrip('/')}/{REPORT_SUFFIX}"
    (
        df.hint("rebalance", "date")
        .sortWithinPartitions("date", "pos")
        .select(F.col("pos").alias(""), *columns, "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy("date")
        .csv(target)
    )
    return target


def replace_table(df: DataFrame, table: str) -> None:
    """Drop and recreate ``table`` with the columns of ``df``, which may read the table itself.

    The rows are written beside the table; only then the names are changed. A write that fails leaves
    the table as it was. For the moment between the two changes of names there is no table; a run lost in
    it leaves the old one as ``<table>__old``, from where the next replacement takes it back.
    """
    spark, old, new = df.sparkSession, f"{table}__old", f"{table}__{uuid.uuid4().hex}"
    exists = spark.catalog.tableExists
    if exists(old):
        if exists(table):
            drop_table(spark, old)
        else:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
    try:
        df.write.saveAsTable(new)
    except BaseException:
        drop_table(spark, new)
        raise
    if exists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    drop_table(spark, old)


def append_rows(
    df: DataFrame,
    table: str,
    schema: StructType | None = None,
    cluster_by: list[str] | None = None,
    batch: str | None = None,
) -> bool:
    """Append by position. Wrong arity and values that do not fit raise.

    With ``batch``, a name for what is appended, its rows come into the table once, however
    often that is repeated: False says that they were there already. A run that is lost
    leaves either none of them, or all after the next append.

    With ``schema``, a NULL in a column declared NOT NULL raises too: Parquet
    tables do not check that. ``cluster_by`` writes the batch in ranges of these
    columns, so that a lookup by them skips row groups by their min and max; a hash of
    the whole row comes last, so that many rows equal in them spread over tasks.
    """
    if schema is not None:
        if len(df.columns) != len(schema):
            raise ValueError(f"{len(df.columns)} values for {len(schema)} columns of {table}")
        df = df.select(
            *[
                F.col(c) if f.nullable else _not_null(F.col(c), f.name).alias(c)
                for c, f in zip(df.columns, schema.fields)
            ]
        )
    if cluster_by:
        row = F.xxhash64(*df.columns)
        df = df.repartitionByRange(*cluster_by, row).sortWithinPartitions(*cluster_by)
    if batch is not None:
        return append_once(df, table, batch)
    df.write.insertInto(table)
    return True


def _not_null(col: Column, name: str) -> Column:
    return F.when(col.isNull(), F.raise_error(F.lit(f"NULL in {name}"))).otherwise(col)


def _create(spark: SparkSession, table: str, schema: StructType, buckets: int | None) -> None:
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
    layout = (
        f"CLUSTERED BY (stock) SORTED BY (stock) INTO {int(buckets)} BUCKETS" if buckets else ""
    )
    # Bloom filters, as large as each file needs: a lookup of a stock that a row group lacks does not read it
    filters = "OPTIONS ('parquet.bloom.filter.enabled#stock'='true', 'parquet.bloom.filter.adaptive.enabled'='true')"
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {filters} {layout}")


def create_brokerage_avg_price(spark: SparkSession, table: str = "BrokerageAvgPrice") -> None:
    _create(spark, table, BROKERAGE_AVG_PRICE, None)


def create_tdcc(spark: SparkSession, table: str = "TDCC", buckets: int | None = None) -> None:
    """``stock`` is the lookup column: it has Bloom filters; append with ``cluster_by=["stock", "date"]``.

    ``buckets`` fixes a hash layout instead, for joins by stock. All rows of a
    stock then share a bucket, so use it only where no stock dominates.
    """
    _create(spark, table, TDCC, buckets)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
