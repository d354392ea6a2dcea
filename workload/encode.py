"""Input formats made out of driver tables.

Pages, reports, archives and CSV folders are built by Spark from whole tables, so
that the parsers have something of the tables' size to read. No unit grows with
the data: a page, report or archive holds rows of one block of keys, and keys are
unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.functions.dates import compact_date
from quotemill.functions.text import IDEOGRAPHIC_SPACE

PAGE_KEYS = 10_000
REPORT_KEYS = 100_000
ARCHIVE_KEYS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def block(key: str, size: int):
    """The start of the block of ``size`` keys that ``key`` lies in."""
    return F.col(key) - F.pmod(F.col(key), F.lit(size))


def cell(value):
    return F.concat(F.lit("<td>"), value, F.lit("</td>"))


def listing_pages(part: DataFrame, name_cell=None, last_cells: int = 1) -> DataFrame:
    """``(url, chunk, html)``: brands as pages, part types as sections, parts as rows."""
    if name_cell is None:
        name_cell = F.concat(F.col("p_partkey").cast("string"), F.lit(IDEOGRAPHIC_SPACE), F.col("p_name"))
    row = F.concat(
        F.lit("<tr><td bgcolor=#FAFAD2>"),
        name_cell,
        F.lit("</td>"),
        cell(F.col("p_size").cast("string")),
        cell(F.lit("1962/02/09")),
        cell(F.col("p_brand")),
        cell(F.lit("R&amp;D")),
        cell(F.lit("ESVUFR")),
        *[cell(F.lit(""))] * last_cells,
        F.lit("</tr>\n"),
    )
    keys = ["url", "chunk"]
    sections = (
        part.select(
            F.col("p_brand").alias("url"),
            block("p_partkey", PAGE_KEYS).alias("chunk"),
            "p_type",
            row.alias("row"),
        )
        .groupBy(*keys, "p_type")
        .agg(F.array_join(F.collect_list("row"), "").alias("rows"))
    )
    section = F.concat(
        F.lit("<tr><td bgcolor=#FAFAD2 colspan=7 ><B> "), "p_type", F.lit(" <B> </td></tr>\n"), "rows"
    )
    return (
        sections.groupBy(*keys)
        .agg(F.array_join(F.collect_list(section), "").alias("body"))
        .select(
            *keys,
            F.concat(
                F.lit("<html><table class='h4'><TR align=center><td>code and name</td></TR>\n"),
                "body",
                F.lit("</table><center><b>x</b></center></html>"),
            ).alias("html"),
        )
    )


def report_documents(
    orders: DataFrame, fields: list[str], values: list, stat=None, day="o_orderdate"
) -> DataFrame:
    """``(value)``: one report per day and block of order keys, entries sorted."""
    entry = F.array(*[v.cast("string") for v in values])
    docs = orders.groupBy(
        F.to_date(day).alias("day"), block("o_orderkey", REPORT_KEYS).alias("chunk")
    ).agg(F.array_sort(F.collect_list(entry)).alias("data5"))
    report = F.struct(
        (F.lit("OK") if stat is None else stat).alias("stat"),
        compact_date(F.col("day")).alias("date"),
        F.array(*[F.lit(f) for f in fields]).alias("fields5"),
        "data5",
    )
    return docs.select(F.to_json(report).alias("value"))


def order_texts(orders: DataFrame, title, keys: int = ARCHIVE_KEYS) -> DataFrame:
    """``(path, text)``: orders as CSV, one text per block of keys, ``title(start of the block)``."""
    line = F.concat_ws(",", "o_orderkey", "o_orderpriority")
    return (
        orders.select(title(block("o_orderkey", keys)).alias("path"), line.alias("line"))
        .groupBy("path")
        .agg(F.array_join(F.collect_list("line"), "\r\n").alias("text"))
    )


def archives(texts: DataFrame, encoding: str = "utf-8") -> DataFrame:
    """``(path, content)``: an LZMA archive per text, with a folder entry and one member."""

    def compress(batches):
        import io
        import zipfile

        import pyarrow as pa

        for batch in batches:
            contents = []
            for text in batch.column(1):
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", compression=zipfile.ZIP_LZMA) as zf:
                    zf.writestr("orders/", "")
                    zf.writestr("orders/rows.csv", (text.as_py() + "\r\n").encode(encoding))
                contents.append(buffer.getvalue())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), pa.array(contents, pa.binary())],
                names=["path", "content"],
            )

    return texts.mapInArrow(compress, "path string, content binary")


def write_files(files: DataFrame, folder: str) -> int:
    """Write ``files(path, content)`` into ``folder``, from the tasks; the number of files.

    A repeated task writes the same files again.
    """

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs

        target, base = fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
        target.create_dir(base, recursive=True)
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                with target.open_output_stream(f"{base}/{path.as_py()}") as out:
                    out.write(content.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return files.mapInArrow(write, "n bigint").agg(F.sum("n")).first()[0]
