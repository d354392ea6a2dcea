"""CSV scans, with the order of the input kept as a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.rejects import REASON
from ..schemas import LISTING, LISTING_FIELDS
from ..session import staged

ORDER = "source_order"
_CORRUPT = "_corrupt_record"

# One line that is a whole record: every field either starts without a quote, or
# is quoted and closed.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+)?+'
_WHOLE_RECORD = f"^{_FIELD}(?:,{_FIELD})*+$"
# One line that begins in a quoted field, closes it, and ends its record.
_CLOSING = f'^[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{_FIELD})*+$'


_NUMBER_WIDTH = 40


def _numbers_compared(name: Column) -> Column:
    """``name`` so that its numbers sort as numbers: ``9.csv`` before ``10.csv``."""
    runs = F.regexp_extract_all(name, F.lit(r"\d+|\D+"), F.lit(0))
    wide = F.transform(
        runs, lambda x: F.when(x.rlike(r"^\d{1,39}$"), F.lpad(x, _NUMBER_WIDTH, "0")).otherwise(x)
    )
    return F.array_join(wide, "")


def source_order(snapshot: Column | None = None) -> Column:
    """The place of a row in its input; take it directly after the scan.

    ``snapshot`` (a date, or ``_metadata.file_modification_time``) puts the files in order;
    files equal in it, or all of them without one, follow by name, numbers in names as numbers.
    """
    path = F.col("_metadata.file_path")
    return F.struct(
        *([] if snapshot is None else [snapshot.alias("snapshot")]),
        _numbers_compared(path).alias("name"),
        path.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def with_input_place(rows: DataFrame, name: str) -> DataFrame:
    """Add the 0-based place of every row in its ``source_order``, without a sort.

    The rows of a block of a file come from one task, one after the other. So a block's
    first number gives the place within it, and one row per block the offset of the block.
    """
    order = rows.schema[ORDER].dataType.fieldNames()
    block = [F.col(f"{ORDER}.{f}").alias(f) for f in order[:-1]]
    earlier = Window.orderBy(*order[:-1]).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        rows.select(*block, F.col(f"{ORDER}.row").alias("row"))
        .groupBy(*order[:-1])
        .agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
        .select(F.struct(*order[:-1]).alias("of"), "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    )
    own = F.struct(*block)
    placed = rows.join(blocks, own.eqNullSafe(F.col("of")))
    place = F.col("offset") + F.col(f"{ORDER}.row") - F.col("first")
    return placed.select(place.cast("long").alias(name), *rows.columns)


def goes_over_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> bool:
    """Whether some record goes over a line end (a quoted line break). Ends at the first one found."""
    reader = spark.read.option("lineSep", line_sep) if line_sep else spark.read
    return not reader.text(path).where(~F.col("value").rlike(_WHOLE_RECORD)).isEmpty()


def records(spark: SparkSession, path: str, snapshot: Column | None = None, line_sep: str | None = None) -> DataFrame:
    """(record, header, source_order) of the CSV files at ``path``, also where records go over line ends.

    Files are split among tasks at line ends. What a line does to the state, in a quoted field or not, depends on
    the state before it: it may keep it, change it, or end in one of the two from either. So a block of
    lines can be summed up without knowing where it starts: its last line of the last kind, and the
    changes after it. One row per block then tells how each block starts, and with that every line whether
    a record begins there. Lines of one record are put together by a line feed, also over blocks. Lines end
    with a line feed, and a carriage return before it belongs to the line end, unless ``line_sep`` is given.

    ``header`` marks the first record of a file. Blank records are dropped.
    """
    place = source_order(snapshot)
    lines = spark.read.option("lineSep", "\n").text(path).select("value", place.alias("place")).select(
        "value",
        F.col("place").dropFields("block", "row").alias("file"),
        "place.block",
        "place.row",
        (~F.col("value").rlike(_WHOLE_RECORD)).alias("opens"),
        (~F.col("value").rlike(_CLOSING)).alias("stays"),
    )
    block = ["file", "block"]
    before = Window.partitionBy(*block).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    odd = lambda n: F.pmod(n, F.lit(2)) == 1
    none = F.lit(0).cast("long")
    changes = (F.col("opens") & ~F.col("stays")).cast("long")
    lines = lines.withColumn("changed", F.coalesce(F.sum(changes).over(before), none))
    sets = F.when(F.col("opens") == F.col("stays"), F.struct(F.col("opens").alias("to"), F.col("changed").alias("at")))
    lines = lines.withColumn("set", F.last(sets, ignorenulls=True).over(before))

    # how blocks end, and from that how they start
    ends = lines.groupBy(*block).agg(
        F.max_by(F.struct(sets.alias("set"), F.col("set").alias("earlier"), (F.col("changed") + changes).alias("changed")), "row").alias("last"),
        F.max(F.trim("value") != "").alias("text"),
    )
    last_set = F.coalesce("last.set", "last.earlier")
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = ends.select(*block, "text", F.col("last.changed").alias("n"), last_set.alias("set")).withColumn(
        "so_far", F.coalesce(F.sum("n").over(in_file), none)
    )
    earlier_text = F.coalesce(F.max("text").over(in_file), F.lit(False))
    known = F.when(F.col("set").isNotNull(), F.struct(F.col("set.to").alias("to"), (F.col("so_far") + F.col("set.at")).alias("at")))
    blocks = blocks.withColumn("known", F.last(known, ignorenulls=True).over(in_file))
    inside = lambda known, n: F.coalesce(known["to"], F.lit(False)) != odd(n - F.coalesce(known["at"], none))
    starts = blocks.select(*block, inside(F.col("known"), F.col("so_far")).alias("starts_inside"), earlier_text.alias("late"))

    # a block is no larger than a task reads, and its lines are together already
    lines = lines.join(starts, block).withColumn(
        "inside",
        F.when(F.col("set").isNotNull(), inside(F.col("set"), F.col("changed"))).otherwise(F.col("starts_inside") != odd(F.col("changed"))),
    )
    up_to = Window.partitionBy(*block).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("record_no", F.sum((~F.col("inside")).cast("long")).over(up_to))
    first = F.min(F.when(F.trim("value") != "", F.col("record_no"))).over(Window.partitionBy(*block))
    lines = lines.withColumn("header", ~F.col("late") & F.coalesce(F.col("record_no") == first, F.lit(False)))
    lines = staged(lines.select(*block, "row", "value", "opens", "inside", "record_no", "header"), "csv-lines")
    # a block may begin with the rest of a record that began in an earlier one
    counts = lines.groupBy(*block).agg(F.max("record_no").alias("records"))
    owners = counts.withColumn(
        "owner", F.last(F.when(F.col("records") > 0, F.struct("block", "records")), ignorenulls=True).over(in_file)
    ).select(F.struct(*block).alias("of_block"), "owner")
    rest = lines.where("record_no = 0").join(owners, F.struct(*block) == F.col("of_block"))
    rest = rest.select("file", F.col("owner.block").alias("own"), F.col("owner.records").alias("record_no"), "header", "block", "row", "value")
    alone = lines.where("not inside and not opens").select("file", "block", "record_no", "header", F.col("value").alias("record"))
    parts = lines.where("record_no > 0 and (inside or opens)").select("file", F.col("block").alias("own"), "record_no", "header", "block", "row", "value")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "row", "value"))), lambda part: part["value"]), "\n")
    joined = parts.unionByName(rest).groupBy("file", F.col("own").alias("block"), "record_no").agg(F.max("header").alias("header"), text.alias("record"))
    found = alone.unionByName(joined)
    if line_sep is None:
        found = found.withColumn("record", F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), r"\r\z", ""))
    order = F.struct("file.*", "block", F.col("record_no").alias("row"))
    return found.where(F.trim("record") != "").select("record", "header", order.alias(ORDER))


def _read_lines(rows: DataFrame, schema: StructType, named: bool, options: dict[str, str]) -> DataFrame:
    """``records`` as columns. With ``named``, the header of every file has to name the columns of ``schema``."""
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)
    parsed = rows.select(F.from_csv("record", ddl, options).alias("cells"), "header", ORDER)
    if named:
        names = F.array(*[F.lit(n) for n in schema.fieldNames()])
        other = F.array(*[F.col("cells")[n] for n in schema.fieldNames()]) != names
        wrong = F.raise_error(F.concat(F.lit("another header in "), F.col(f"{ORDER}.file"))).cast("boolean")
        parsed = parsed.where(F.when(F.col("header") & F.coalesce(other, F.lit(True)), wrong).otherwise(F.lit(True)))
    return parsed.where(~F.col("header")).select("cells.*", ORDER)


def read_master(
    spark: SparkSession, path: str, book: str, multi_line: bool | None = None, snapshot: Column | None = None
) -> DataFrame:
    """The eight text fields of a security master, by position; the header line is skipped.

    A record with more or fewer fields is a reject. ``multi_line=None`` looks for a record that goes
    over a line end; if there is one, files are put together from their lines, which spread over tasks
    (see ``records``), while True reads every file whole in one task. An empty field is NULL, and a CRLF inside
    a field is read as a line feed. ``snapshot`` is what files are ordered by before their names.
    """
    schema = StructType([*LISTING.fields, StructField(_CORRUPT, StringType())])
    options = {"escape": '"', "columnNameOfCorruptRecord": _CORRUPT, "columnPruning": "false"}  # with pruning, fields are not counted
    # Written so that a test of the reason reads a data column too: Spark refuses
    # queries on nothing but the corrupt-record column.
    reason = F.nullif(
        F.when(
            F.col(_CORRUPT).isNotNull(),
            F.concat(F.lit("not 8 fields, code "), F.coalesce("code", F.lit("missing"))),
        ).otherwise(""),
        F.lit(""),
    )
    columns = [*LISTING_FIELDS, F.lit(book).alias("book")]
    if multi_line is None and goes_over_lines(spark, path):
        return _read_lines(records(spark, path, snapshot), schema, False, options).select(*columns, ORDER, reason.alias(REASON))
    reader = spark.read.schema(schema).options(header=True, multiLine=bool(multi_line), **options)
    return reader.csv(path).select(*columns, source_order(snapshot).alias(ORDER), reason.alias(REASON))


def read_capital(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """The share-capital table: text columns named by the header line.

    "NA" stays text, fields beyond the header are dropped. Of several files, one with
    another header raises instead of being read under the wrong names. ``multi_line`` as in ``read_master``.
    """
    options = {"escape": '"', "lineSep": "\n"}
    reader = spark.read.options(header=True, enforceSchema=False, multiLine=bool(multi_line), **options)
    table = reader.csv(path)
    if multi_line is None and goes_over_lines(spark, path, "\n"):
        return _read_lines(records(spark, path, line_sep="\n"), table.schema, True, {"escape": '"'})
    return table.select("*", source_order().alias(ORDER))
