"""One query per operator or job, each beside the SQL that gives the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.functions import dates, text
from quotemill.operators import columns, exports, keys, order, snapshots, tables
from quotemill.operators.rejects import accepted, rejected
from quotemill.plans import capital, facts, master, report
from quotemill.plans import snapshots as snapshot_plans
from quotemill.schemas import (
    BROKER_MARKER,
    BROKERAGE_AVG_PRICE,
    EQUITY_TYPE,
    LISTING_FIELDS,
    REPORT_CHANGE_SIGN,
    REPORT_CODE,
    TDCC,
    TDCC_BRACKETS,
)
from quotemill.session import stage_path
from quotemill.sources import archives, catalog, csv_files, listing
from quotemill.sources import report as report_source
from quotemill.sources.tables import scan

from . import encode
from .encode import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = dt.datetime(2024, 2, 1)


def query(sql: str):
    def register(fn):
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = sql
        return fn

    return register


def _view(spark: SparkSession, sf: str, name: str) -> str:
    view = f"quotemill_{name}"
    table(spark, sf, name).createOrReplaceTempView(view)
    return view


def _database(spark: SparkSession) -> str:
    path = stage_path(spark, "db")
    name = "db_" + path[-32:]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


# --- listing pages and the master ---------------------------------------------------------


@query("""
select p_brand as url, p_type as "type", cast(p_partkey as varchar) as code,
       replace(p_name, ' ', '') as name, cast(p_size as varchar) as isin,
       '1962/02/09' as "start", p_brand as market, 'R&D' as "group", 'ESVUFR' as cfi
from part
""")
def listing_rows(spark, sf):
    pages = encode.listing_pages(table(spark, sf, "part"))
    rows = accepted(listing.listing_rows(pages, ["url", "chunk"]))
    return rows.select(
        "url", "type", "code", "name", F.col("ISIN").alias("isin"), "start", "market", "group",
        F.col("CFI").alias("cfi"),
    )


@query("""
select p_brand as url, p_type as "type", cast(p_partkey as varchar) || sep || p_name as cell,
       'no single U+3000 in the name cell' as reject_reason
from (select *, case when p_size < 10 then ' ' when p_size > 40 then '　　' else '　' end as sep from part)
where p_size < 10 or p_size > 40
""")
def listing_rejects(spark, sf):
    part = table(spark, sf, "part")
    size = F.col("p_size")
    sep = F.when(size < 10, " ").when(size > 40, "　　").otherwise("　")
    cell = F.concat(F.col("p_partkey").cast("string"), sep, F.col("p_name"))
    rows = listing.listing_rows(encode.listing_pages(part, cell), ["url", "chunk"])
    return rejected(rows).select("url", "type", F.get("cells", F.lit(1)).alias("cell"), "reject_reason")


@query("""
select cast(p_partkey as varchar) || chr(160) || '1' as code, '台灣<' || replace(p_name, ' ', '') || '>&lt;' as name
from part
""")
def listing_entities(spark, sf):
    """Named and numeric entities: a no-break space stays one, an escaped ampersand escapes nothing."""
    part = table(spark, sf, "part")
    cell = F.concat(
        F.col("p_partkey").cast("string"), F.lit("&nbsp;1&#12288;&#21488;&#x7063;&#60;"), "p_name", F.lit("&#62;&#38;lt;")
    )
    rows = listing.listing_rows(encode.listing_pages(part, cell), ["url", "chunk"])
    return accepted(rows).select("code", "name")


@query("""
with rows as (
  select case when p_type = 'ECONOMY' then '股票' else p_type end as "type",
         cast(p_partkey as varchar) as code,
         replace(p_name, ' ', '') || case when p_size > 25 then '*' else '' end as name,
         case when p_brand like '%2' then 'tpex' else 'twse' end as book
  from part)
select 'codes' as set_name, * from rows where "type" = '股票'
union all select book as set_name, * from rows
""")
def build_master(spark, sf):
    """Two captures; the later one has the larger parts only, under new names."""
    part = table(spark, sf, "part").withColumn(
        "p_type", F.when(F.col("p_type") == "ECONOMY", EQUITY_TYPE).otherwise(F.col("p_type"))
    )
    later = part.where("p_size > 25").withColumn("p_name", F.concat("p_name", F.lit("*")))
    captures = [(dt.datetime(2024, 1, 1), part), (dt.datetime(2024, 1, 2), later)]
    pages = [
        encode.listing_pages(rows).select(
            F.when(F.col("url").endswith("2"), "tpex").otherwise("twse").alias("source"),
            F.concat_ws("?", "url", "chunk").alias("url"),
            F.lit(captured).alias("captured"),
            "html",
        )
        for captured, rows in captures
    ]
    sets, _ = master.build_master(keys.union_lists(*pages), AS_OF)
    return keys.union_lists(
        *[
            df.select(F.lit(name).alias("set_name"), "type", "code", "name", "book")
            for name, df in sets.items()
        ]
    )


@query("""
select cast(p_partkey as varchar) as code, replace(p_name, ' ', '') as name, p_size as size
from part where p_type = 'ECONOMY' order by p_size desc, code limit 3
""")
def top_equities(spark, sf):
    """Flagship: pages to rows, equities only, last row per code, the three largest."""
    pages = encode.listing_pages(table(spark, sf, "part"))
    rows = accepted(listing.listing_rows(pages, ["url", "chunk"])).where("type = 'ECONOMY'")
    codes = keys.last_wins(rows, "code", F.struct("url", "chunk", "pos"))
    size = F.col("ISIN").cast("int")
    return order.top_n(codes, size.desc(), "code").select("code", "name", size.alias("size"))


@query("""
select user_id, event_type, value from events
qualify row_number() over (partition by user_id order by event_id desc) = 1
""")
def master_last_wins(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "value", "event_id")
    return keys.last_wins(events, "user_id", "event_id").drop("event_id")


@query("""
select user_id, event_id, case event_type when 'purchase' then cast(value as varchar) end as head,
       coalesce(last_value(case event_type when 'purchase' then cast(value as varchar) end ignore nulls)
         over (partition by user_id order by event_id
               rows between unbounded preceding and current row), '') as carried
from events
""")
def carry_down(spark, sf):
    head = F.when(F.col("event_type") == "purchase", F.col("value").cast("string"))
    events = table(spark, sf, "events").select("user_id", "event_id", head.alias("head"))
    return order.carry_down(events, "head", "user_id", "event_id", "carried", block=4096)


@query("""
select p_partkey, case when p_size > 25 then 'tpex' else 'twse' end as book,
       p_type = 'ECONOMY' as is_equity
from part
""")
def route_books(spark, sf):
    source = F.when(F.col("p_size") > 25, "tpex")
    part = table(spark, sf, "part").select(
        "p_partkey",
        columns.book_of(source).alias("book"),
        F.when(F.col("p_type") == "ECONOMY", EQUITY_TYPE).otherwise(F.col("p_type")).alias("type"),
    )
    books = keys.union_lists(columns.route(part, "tpex"), columns.route(part, "twse"))
    return books.select("p_partkey", "book", (F.col("type") == EQUITY_TYPE).alias("is_equity"))


@query("""
select p_type as "type", cast(p_partkey as varchar) as code, '="' || p_name || '"' as name,
       cast(null as varchar) as isin, p_brand || ',"' || p_type as market, ' x ' as "group",
       'two' || chr(10) || 'lines' as cfi
from part
""")
def csv_round_trip(spark, sf):
    part = table(spark, sf, "part").select(
        F.col("p_type").alias("type"),
        F.col("p_partkey").cast("string").alias("code"),
        F.concat(F.lit('="'), "p_name", F.lit('"')).alias("name"),
        F.lit(None).cast("string").alias("ISIN"),
        F.lit("").alias("start"),
        F.concat("p_brand", F.lit(',"'), "p_type").alias("market"),
        F.lit(" x ").alias("group"),
        F.lit("two\nlines").alias("CFI"),
    )
    path = stage_path(spark, "master-csv")
    tables.write_master(part, path)
    return accepted(csv_files.read_master(spark, path, "twse")).select(
        *[F.col(c).alias(c.lower() if c in ("ISIN", "CFI") else c) for c in LISTING_FIELDS if c != "start"]
    )


@query("""
select cast(o_orderkey as varchar) as code, o_orderpriority as name,
       case when o_orderstatus <> 'F' then 'not 8 fields, code ' || o_orderkey end as reject_reason
from orders
""")
def master_csv_rejects(spark, sf):
    """Records of 8, 7 and 9 fields."""
    seven = ["o_orderstatus", "o_orderkey", "o_orderpriority", *["o_custkey"] * 4]
    status = F.col("o_orderstatus")
    rest = F.when(status == "F", ",z").when(status == "O", "").otherwise(",z,z")
    path = stage_path(spark, "orders-csv")
    line = F.concat(F.concat_ws(",", *seven), rest)
    tables.write_lines(table(spark, sf, "orders"), line, ",".join(LISTING_FIELDS), path)
    return csv_files.read_master(spark, path, "twse").select("code", "name", "reject_reason")


@query("select cast(p_partkey as varchar) as code, p_name || '*' as name from part")
def file_order(spark, sf):
    """The last row wins over files whose names sort otherwise as text: 9 before 10."""
    block = encode.block("p_partkey", encode.PAGE_KEYS)
    files = []
    for number, name in ((9, F.col("p_name")), (10, F.concat("p_name", F.lit("*")))):
        line = text.csv_line([F.lit("t"), F.col("p_partkey"), name, *[F.lit("x")] * 5])
        files.append(
            table(spark, sf, "part")
            .groupBy(F.concat(block.cast("string"), F.lit(f"-{number}.csv")).alias("path"))
            .agg(F.concat(F.lit(",".join(LISTING_FIELDS) + "\n"), F.array_join(F.collect_list(line), "\n")).alias("text"))
        )
    folder = stage_path(spark, "numbered-files")
    encode.write_files(files[0].union(files[1]).select("path", F.col("text").cast("binary").alias("content")), folder)
    rows = accepted(csv_files.read_master(spark, folder, "twse"))
    return keys.last_wins(rows, "code", csv_files.ORDER).select("code", "name")


# --- daily reports ------------------------------------------------------------------------

_REPORT = [REPORT_CODE, REPORT_CHANGE_SIGN, "status"]
_REPORT_SQL = """
select strftime(day, '%Y%m%d') as date, cast(o_orderkey as varchar) as code, o_orderstatus as status,
       cast(row_number() over (partition by day, o_orderkey // 100000
                               order by cast(o_orderkey as varchar)) - 1 as integer) as pos
from (select *, {day} as day from orders)
"""


def _reports(spark, sf, stat=None, day="o_orderdate"):
    values = [F.col("o_orderkey"), F.lit("+"), F.col("o_orderstatus")]
    return encode.report_documents(table(spark, sf, "orders"), _REPORT, values, stat, day)


@query(_REPORT_SQL.format(day="o_orderdate"))
def report_rows(spark, sf):
    rows = accepted(report_source.report_rows(_reports(spark, sf), _REPORT))
    return rows.select("date", F.col(REPORT_CODE).alias("code"), "status", "pos")


@query("""
select strftime(o_orderdate, '%Y%m%d') as date, 'stat no data' as reject_reason, count(*) as n
from orders where isodow(o_orderdate) > 5 group by 1
""")
def report_rejects(spark, sf):
    stat = F.when(F.weekday("day") > 4, "no data").otherwise("OK")
    rows = report_source.report_rows(_reports(spark, sf, stat), _REPORT)
    return rejected(rows).groupBy("date", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query("""
select strftime(o_orderdate, '%Y%m%d') as date, 'OK' as stat, cast(o_orderkey as varchar) as code,
       o_orderstatus as status
from orders
""")
def daily_report(spark, sf):
    """The column names come from the reports themselves; the change sign is dropped."""
    reports = _reports(spark, sf)
    names = [r.name for r in report_source.report_columns(reports).orderBy("place", "name").collect()]
    rows, _ = report.daily_report(reports, names)
    rows = rows.withColumnRenamed(REPORT_CODE, "code")
    return rows.select("date", "stat", "code", *[c for c in rows.columns[3:] if c != "code"])


@query("select cast(o_orderkey as varchar) as code from orders")
def report_codes(spark, sf):
    rows, _ = report.daily_report(_reports(spark, sf), columns=_REPORT)
    return report.report_codes(rows).withColumnRenamed(REPORT_CODE, "code")


@query(_REPORT_SQL.format(day="date_trunc('month', o_orderdate)"))
def report_export(spark, sf):
    """Reports by month, to have fewer folders than days."""
    month = F.trunc("o_orderdate", "month")
    rows, _ = report.daily_report(_reports(spark, sf, day=month), columns=_REPORT)
    target = tables.write_report(rows, stage_path(spark, "reports"))
    schema = "pos int, code string, status string, date string"
    rows = spark.read.schema(schema).option("header", True).csv(target)
    return rows.select("date", "code", "status", "pos")


@query("""
select o_orderkey, cast(o_orderdate as date) - cast(greatest(isodow(o_orderdate) - 5, 0) as integer) as trade_date
from orders
""")
def trade_date(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.trade_date(F.col("o_orderdate")).alias("trade_date")
    )


# --- capital ------------------------------------------------------------------------------


def _capital_csv(spark, sf, capital_text=None):
    """Suppliers in key order as a capital CSV, those of the first nations without a number."""
    if capital_text is None:
        capital_text = F.when(F.col("s_nationkey") > 2, F.format_number("s_acctbal", 2))
    code = F.concat(F.lit('="'), "s_suppkey", F.lit('"'))
    line = text.csv_line([code, F.col("s_name"), capital_text, F.lit("NA")])
    path = stage_path(spark, "capital-csv")
    suppliers = table(spark, sf, "supplier").orderBy("s_suppkey")
    tables.write_lines(suppliers, line, "代號,名稱,股本(億),備註", path, "\n")
    return path


_CAPITAL_SQL = """
select cast(s_suppkey as varchar) as stock, s_name as name, 'NA' as note,
       case when s_nationkey > 2 then cast(s_acctbal as decimal(18, 2)) end as capital,
       row_number() over (order by s_suppkey) - 1 as place
from supplier
"""


@query(f"""
with t as ({_CAPITAL_SQL})
select *, row_number() over (order by capital desc nulls last, stock) - 1 as rank from t
""")
def capital_ranking(spark, sf):
    ranked, _ = capital.capital_ranking(spark, _capital_csv(spark, sf))
    return ranked.select(
        "stock",
        F.col("名稱").alias("name"),
        F.col("備註").alias("note"),
        F.col("股本(億)").alias("capital"),
        F.col("index").alias("place"),
        F.col("row_index").alias("rank"),
    )


@query("""
select cast(s_suppkey as varchar) as stock, s_name as name, row_number() over (order by s_suppkey) - 1 as place,
       'no number that fits: ' || case s_nationkey % 4 when 0 then '--' when 1 then s_suppkey || ' 億'
         else s_suppkey || '.125' end as reject_reason
from supplier qualify s_nationkey % 4 < 3
""")
def capital_rejects(spark, sf):
    """Texts that are no number, or one that two decimals can't hold; the others are ranked."""
    kind, key = F.col("s_nationkey") % 4, F.col("s_suppkey").cast("string")
    capital_text = (
        F.when(kind == 0, "--").when(kind == 1, F.concat(key, F.lit(" 億"))).when(kind == 2, F.concat(key, F.lit(".125")))
    )
    _, rejects = capital.capital_ranking(spark, _capital_csv(spark, sf, capital_text))
    return rejects.select("stock", F.col("名稱").alias("name"), F.col("index").alias("place"), "reject_reason")


@query(f"""
with t as ({_CAPITAL_SQL})
select stock, format('{{:<8}}股本 {{:>5}} (億)', name, cast(capital as varchar)) as line
from t order by capital desc nulls last, stock limit 3
""")
def capital_report(spark, sf):
    rows = csv_files.read_capital(spark, _capital_csv(spark, sf))
    return capital.top_lines(accepted(capital.capital_table(rows))).select("stock", "line")


@query("select s_name, s_acctbal from supplier order by s_acctbal desc nulls last, s_suppkey limit 3")
def capital_top3(spark, sf):
    ranked = order.by_capital(table(spark, sf, "supplier"), "s_acctbal", tie="s_suppkey")
    return ranked.limit(3).select("s_name", "s_acctbal")


@query("""
select s_suppkey, format('{:<8}股本 {:>5} (億)', s_name, cast(cast(s_acctbal as decimal(12, 2)) as varchar)) as line
from supplier
""")
def capital_lines(spark, sf):
    number = F.col("s_acctbal").cast("decimal(12,2)")
    return table(spark, sf, "supplier").select(
        "s_suppkey", text.report_line(F.col("s_name"), number).alias("line")
    )


@query("select c_custkey, cast(c_acctbal as decimal(18, 2)) as v from customer")
def thousands(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", text.thousands(F.format_number("c_acctbal", 2)).alias("v")
    )


@query("select c_custkey, c_name as stock from customer")
def clean_code(spark, sf):
    wrapped = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit('="'), "c_name", F.lit('"')).alias("code")
    )
    return columns.clean_code(wrapped, "code")


@query("select row_number() over (order by o_totalprice desc, o_orderkey) - 1 as row_index, o_orderkey from orders")
def row_index(spark, sf):
    orders = table(spark, sf, "orders").select("o_totalprice", "o_orderkey")
    return order.with_row_index(orders, F.col("o_totalprice").desc(), "o_orderkey").drop("o_totalprice")


# --- snapshots ----------------------------------------------------------------------------


def _event_titles(spark, sf):
    title = F.concat("event_type", F.lit("_day_"), dates.snap_label(F.col("ts")), F.lit(".zip"))
    return table(spark, sf, "events").select(title.alias("title"))


_EVENT_MARKERS = [f"{kind}_day_" for kind in ("signup", "purchase", "error", "view", "click")]


@query(r"""
select category, title, snap_date
from (select title, regexp_extract(title, '^(.*_day_)', 1) as category,
             cast(strptime(regexp_extract(title, '_day_(\d{6})', 1), '%y%m%d') as date) as snap_date
      from (select distinct concat(event_type, '_day_', strftime(ts, '%y%m%d'), '.zip') as title from events))
qualify row_number() over (partition by category order by snap_date desc, title desc) = 1
""")
def latest_snapshot(spark, sf):
    dated = accepted(snapshots.dated_titles(_event_titles(spark, sf), _EVENT_MARKERS))
    return snapshots.latest_snapshot(dated).select("category", "title", "snap_date")


@query(r"""
select distinct '3大法人_' || strftime(o_orderdate, '%y%m%d') || suffix as title,
       case when suffix = '.zip' then cast(o_orderdate as date) end as snap_date,
       case when suffix <> '.zip' then 'no date in the title' end as reject_reason
from (select o_orderdate, case o_orderstatus when 'F' then '.zip' when 'O' then ' (1).zip' else '0.zip' end as suffix
      from orders)
""")
def title_dates(spark, sf):
    status = F.col("o_orderstatus")
    suffix = F.when(status == "F", ".zip").when(status == "O", " (1).zip").otherwise("0.zip")
    title = F.concat(F.lit("3大法人_"), dates.snap_label(F.col("o_orderdate")), suffix)
    titles = table(spark, sf, "orders").select(title.alias("title")).distinct()
    return snapshots.dated_titles(titles, ["3大法人_"]).select("title", "snap_date", "reject_reason")


@query("""
select distinct concat(event_type, '_day_', strftime(ts, '%y%m%d'), '.zip') as title, cast(ts as date) as snap_date
from events
""")
def title_order(spark, sf):
    """All titles by the date they state, newest first."""
    dated = accepted(snapshots.dated_titles(_event_titles(spark, sf).distinct(), _EVENT_MARKERS))
    return snapshots.by_title_date(dated).select("title", "snap_date")


@query("select user_id, strftime(max(ts), '%y%m%d') as snap from events group by user_id")
def snapshot_label(spark, sf):
    events = table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("ts"))
    return events.select("user_id", dates.snap_label(F.col("ts")).alias("snap"))


@query("""
select c_custkey, m is null or m < timestamp '2001-07-01 00:00:00' - interval 24 hours as stale
from customer left join (select o_custkey, max(o_orderdate) as m from orders group by 1) on o_custkey = c_custkey
""")
def stale_sources(spark, sf):
    newest = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    as_of = F.lit("2001-07-01 00:00:00").cast("timestamp_ntz")
    customers = table(spark, sf, "customer")
    stale = snapshots.stale_sources(customers, newest, as_of, "c_custkey", "o_orderdate")
    return stale.select("c_custkey", "stale")


def _month_texts(spark, sf):
    """A title and a line for each month: its first day, and the number of its orders."""
    month = F.trunc("o_orderdate", "month").alias("month")
    months = table(spark, sf, "orders").groupBy(month).agg(F.count(F.lit(1)).alias("n"))
    label = dates.snap_label(F.col("month"))
    return months.select(
        F.concat(F.lit("3大法人_"), label, F.lit(".zip")).alias("path"),
        F.concat_ws(",", dates.compact_date(F.col("month")), "n").alias("text"),
    )


def _month_folder(spark, sf, before="9"):
    """A folder with an archive for each month before ``before`` (yyyymm), and its catalog."""
    folder = stage_path(spark, "months")
    texts = _month_texts(spark, sf).where(F.col("text") < before)
    encode.write_files(encode.archives(texts), folder)
    return catalog.in_folder(catalog.snapshot_catalog(spark, folder), folder)


@query("""
select distinct '3大法人_' || strftime(date_trunc('month', o_orderdate), '%y%m%d') || '.zip' as title
from orders where o_orderdate >= date '1997-01-01'
""")
def stale_master_sources(spark, sf):
    """Of the files expected, those from 1997 on are not in the folder; the others have just been written."""
    listed = _month_folder(spark, sf, before="199701")
    expected = _month_texts(spark, sf).select(F.col("path").alias("title"))
    return master.stale_master_sources(expected, listed, F.current_timestamp()).select("title")


@query("select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)")
def missing_units(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return keys.missing(table(spark, sf, "orders").select("o_orderkey"), lines, "o_orderkey")


@query("select p_partkey from part where contains(p_name, 'ring') or contains(p_name, 'et')")
def contains_semi(spark, sf):
    return keys.containing(table(spark, sf, "part"), ["ring", "et"], "p_name").select("p_partkey")


@query("""
select c_custkey from customer
where exists (select 1 from supplier where contains(c_name, substr(s_name, 10)))
""")
def contains_many(spark, sf):
    """Needles of a table: joined with the pieces of the names that have their lengths."""
    needles = table(spark, sf, "supplier").select(F.substr("s_name", F.lit(10)).alias("needle"))
    return keys.matching(table(spark, sf, "customer"), needles, "c_name").select("c_custkey")


@query("select distinct strftime(ts, '%y%m%d') || '.zip' as name from events")
def strip_prefix(spark, sf):
    path = F.concat(F.lit("./zips/"), dates.snap_label(F.col("ts")), F.lit(".zip"))
    paths = table(spark, sf, "events").select(path.alias("path")).distinct()
    return paths.select(text.strip_prefix(F.col("path"), 7).alias("name"))


def _order_title(start):
    return F.concat(F.lit(BROKER_MARKER + "_"), start, F.lit(".zip"))


@query("select cast(o_orderkey as varchar) as o_orderkey, o_orderpriority from orders")
def archive_rows(spark, sf):
    packed = encode.archives(encode.order_texts(table(spark, sf, "orders"), _order_title))
    return accepted(archives.expand_archives(packed)).select(
        F.get("cells", F.lit(0)).alias("o_orderkey"), F.get("cells", F.lit(1)).alias("o_orderpriority")
    )


@query("""
select o_orderkey // 50000 * 50000 as block, '台' || o_orderpriority as a, cast(o_orderkey as varchar) as b,
       cast(0 as bigint) as n
from orders
union all
select distinct o_orderkey // 50000 * 50000, 'long', '', cast(140000 as bigint) from orders
""")
def archive_encoding(spark, sf):
    """Members in another encoding, with a field longer than a CSV reader takes by default."""
    block = encode.block("o_orderkey", encode.ARCHIVE_KEYS)
    line = F.concat_ws(";", F.concat(F.lit("台"), "o_orderpriority"), "o_orderkey", F.lit(""))
    texts = (
        table(spark, sf, "orders")
        .groupBy(_order_title(block).alias("path"))
        .agg(F.array_join(F.collect_list(line), "\r\n").alias("text"))
        .select("path", F.concat("text", F.lit("\r\nlong;;"), F.repeat(F.lit("x"), F.lit(140_000))).alias("text"))
    )
    folder, dst = stage_path(spark, "cp950"), stage_path(spark, "cp950-landed")
    encode.write_files(encode.archives(texts, "cp950"), folder)
    snapshot_plans.snapshot_intake(spark, folder, dst, AS_OF, encoding="cp950", delimiter=";")
    cell = lambda i: F.get("cells", F.lit(i))
    return exports.landed_rows(spark, dst).select(
        F.regexp_extract("title", r"_(\d+)\.zip", 1).cast("bigint").alias("block"),
        cell(0).alias("a"),
        cell(1).alias("b"),
        F.char_length(cell(2)).cast("bigint").alias("n"),
    )


def _landing_folder(spark, sf):
    """All orders as broker archives, and the number of orders of each month as dated ones."""
    texts = encode.order_texts(table(spark, sf, "orders"), _order_title).unionByName(_month_texts(spark, sf))
    folder = stage_path(spark, "landing")
    encode.write_files(encode.archives(texts), folder)
    return folder


_FOLDER_SQL = """
select '全台卷商交易資料_' || (o_orderkey // 50000 * 50000) || '.zip' as title, 'Broker' as destination from orders
union
select '3大法人_' || strftime(date_trunc('month', o_orderdate), '%y%m%d') || '.zip' as title,
       'Investors' as destination
from orders
"""


@query(f"select title from ({_FOLDER_SQL})")
def snapshot_catalog(spark, sf):
    folder = _landing_folder(spark, sf)
    listed = catalog.in_folder(catalog.snapshot_catalog(spark, folder), folder)
    return listed.where("length > 0").select("title")


@query(f"""
select destination, title from ({_FOLDER_SQL}) where destination = 'Broker'
union all
select 'Investors', '3大法人_' || strftime(max(o_orderdate), '%y%m%d') || '.zip' from orders
""")
def snapshot_selection(spark, sf):
    orders = table(spark, sf, "orders")
    broker = orders.select(_order_title(encode.block("o_orderkey", encode.ARCHIVE_KEYS)).alias("title"))
    label = dates.snap_label(F.col("o_orderdate"))
    daily = orders.select(F.concat(F.lit("3大法人_"), label, F.lit(".zip")).alias("title"))
    listed = keys.union_lists(broker, daily).select(
        "title", F.concat(F.lit("/landing/"), "title").alias("path"),
        F.lit("/landing").alias("parent"), F.lit(False).alias("trashed"),
    )
    chosen = snapshot_plans.select_snapshots(catalog.in_folder(listed, "/landing"))
    return chosen.select("destination", "title")


@query("""
select 'Broker' as destination, cast(o_orderkey as varchar) as a, o_orderpriority as b from orders
union all
select 'Investors', strftime(max(month), '%Y%m%d'), cast(max_by(n, month) as varchar)
from (select date_trunc('month', o_orderdate) as month, count(*) as n from orders group by month)
""")
def snapshot_intake(spark, sf):
    """Run twice: the second run finds nothing to do."""
    folder, dst = _landing_folder(spark, sf), stage_path(spark, "landed")
    snapshot_plans.snapshot_intake(spark, folder, dst, AS_OF)
    snapshot_plans.snapshot_intake(spark, folder, dst, AS_OF)
    return exports.landed_rows(spark, dst).select(
        "destination", F.get("cells", F.lit(0)).alias("a"), F.get("cells", F.lit(1)).alias("b")
    )


@query("select o_orderkey, o_totalprice, strftime(o_orderdate, '%Y%m') as month from orders")
def export_missing(spark, sf):
    """Three runs: the first years, the rest, nothing."""
    month = F.date_format("o_orderdate", "yyyyMM")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", month.alias("month"))
    path = stage_path(spark, "export")
    for part in (orders.where("month < '199801'"), orders, orders):
        snapshot_plans.export_missing(part, "month", path, AS_OF)
    return exports.read_export(orders, "month", path)


@query("select c_custkey, c_acctbal, '240201' as snap from customer")
def export_daily(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    path = stage_path(spark, "daily")
    for _ in range(2):
        snapshot_plans.export_daily(customers, path, AS_OF)
    return exports.read_export(customers.withColumn("snap", F.lit("")), "snap", path)


@query("select s_suppkey, s_name, true as of_newest_file from supplier")
def export_by_mtime(spark, sf):
    """Twice by the files of a folder, which have just been written."""
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    listed, path = _month_folder(spark, sf), stage_path(spark, "by-mtime")
    for _ in range(2):
        snapshot_plans.export_by_mtime(suppliers, listed, path, AS_OF)
    newest = listed.agg(dates.snap_label(F.max("modificationTime"))).first()[0]
    rows = exports.read_export(suppliers.withColumn("snap", F.lit("")), "snap", path)
    return rows.select("s_suppkey", "s_name", (F.col("snap") == newest).alias("of_newest_file"))


# --- fact tables --------------------------------------------------------------------------


def _prices(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").cast("string").alias("stock"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("avg_buy_price"),
        F.col("l_quantity").alias("avg_sell_price"),
        F.col("l_discount").alias("rate"),
    )


_PRICES_SQL = """
select l_orderkey, l_linenumber, cast(l_partkey as varchar) as stock, cast(l_shipdate as date) as date,
       try_cast(l_extendedprice as decimal(6, 2)) as avg_buy_price,
       try_cast(l_quantity as decimal(6, 2)) as avg_sell_price,
       cast(l_discount as decimal(3, 2)) as rate
from lineitem
"""


@query(f"""
select stock, date, avg_buy_price, avg_sell_price, rate,
       case when avg_buy_price is null then 'avg_buy_price does not fit' end as reject_reason
from ({_PRICES_SQL})
""")
def conform_prices(spark, sf):
    return columns.conform(_prices(spark, sf), BROKERAGE_AVG_PRICE)


@query(f"""
select stock, date, avg_buy_price, avg_sell_price, rate from ({_PRICES_SQL}) where avg_buy_price is not null
""")
def brokerage_prices(spark, sf):
    name = f"{_database(spark)}.BrokerageAvgPrice"
    tables.drop_table(spark, name)
    tables.create_brokerage_avg_price(spark, name)
    facts.load_brokerage(_prices(spark, sf), name)
    return scan(spark, name, BROKERAGE_AVG_PRICE.fieldNames())


@query(f"""
select stock, date, avg_buy_price, avg_sell_price, rate from ({_PRICES_SQL}) where avg_buy_price is not null
""")
def brokerage_batches(spark, sf):
    """The same rows in four batches, each of them loaded twice."""
    name = f"{_database(spark)}.BrokerageBatches"
    tables.drop_table(spark, name)
    tables.create_brokerage_avg_price(spark, name)
    rows = _prices(spark, sf)
    for part in (0, 1, 1, 0, 2, 3, 3, 2):
        facts.load_brokerage(rows.where(F.pmod(F.xxhash64("stock"), F.lit(4)) == part), name, batch=f"part {part}")
    return scan(spark, name, BROKERAGE_AVG_PRICE.fieldNames())


@query("select o_orderkey, o_orderstatus, count(*) over (partition by o_orderstatus) as of_status from orders")
def table_replaced_by_itself(spark, sf):
    """A table replaced by a query on itself."""
    name = f"{_database(spark)}.orders"
    tables.replace_table(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), name)
    rows = spark.table(name)
    counts = rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("of_status"))
    tables.replace_table(rows.join(counts, "o_orderstatus").select("o_orderkey", "o_orderstatus", "of_status"), name)
    return spark.table(name)


def _tdcc_value(i: int, measure: str) -> str:
    return f"p_size + {i}" if measure != "Proportion" else f"(p_size + {i}) / 4.0"


@query(
    "select cast(p_partkey as varchar) as stock, date '2024-01-05' as date, "
    + ", ".join(
        f"cast({_tdcc_value(i, measure)} as {kind}) as Share_Rating_{measure}_{bracket}"
        for i, bracket in enumerate(TDCC_BRACKETS)
        for measure, kind in (
            ("People", "decimal(18, 0)"), ("Unit", "decimal(18, 0)"), ("Proportion", "decimal(5, 2)"),
        )
    )
    + " from part"
)
def tdcc_rows(spark, sf):
    name = f"{_database(spark)}.TDCC"
    tables.create_tdcc(spark, name)
    values = [
        F.expr(_tdcc_value(i, measure)).alias(f"Share_Rating_{measure}_{bracket}")
        for i, bracket in enumerate(TDCC_BRACKETS)
        for measure in ("People", "Unit", "Proportion")
    ]
    part = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("stock"), F.lit(dt.date(2024, 1, 5)).alias("date"), *values
    )
    facts.load_tdcc(part, name)
    return scan(spark, name, TDCC.fieldNames())


@query("select strftime(o_orderdate, '%Y%m%d') as date from orders where o_orderstatus = 'F'")
def date_list(spark, sf):
    return facts.date_list(spark, _view(spark, sf, "orders"), "o_orderstatus = 'F'", "o_orderdate")


@query("""
select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'
order by o_totalprice desc, o_orderkey limit 1
""")
def first_row(spark, sf):
    return facts.first_match(
        spark, _view(spark, sf, "orders"), ["o_orderkey", "o_totalprice"], "o_orderstatus = 'F'",
        F.col("o_totalprice").desc(), "o_orderkey",
    )


@query("select * from nation union all select * from nation")
def table_replace_append(spark, sf):
    name = f"{_database(spark)}.nation"
    tables.drop_table(spark, name)
    tables.replace_table(table(spark, sf, "region"), name)
    tables.replace_table(table(spark, sf, "nation"), name)
    tables.append_rows(table(spark, sf, "nation").toDF("a", "b", "c"), name)
    return spark.table(name)


@query("select p_type, count(*) as n from lineitem join part on l_partkey = p_partkey group by p_type")
def key_lookup(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("code"))
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("code"), "p_type")
    return keys.lookup(lines, parts).groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))


@query("select count(distinct l_partkey) as n from lineitem")
def key_count(spark, sf):
    return keys.key_count(table(spark, sf, "lineitem"), "l_partkey")


@query("select c_name as name from customer union all select s_name from supplier")
def union_lists(spark, sf):
    return keys.union_lists(
        table(spark, sf, "customer").select(F.col("c_name").alias("name")),
        table(spark, sf, "supplier").select(F.col("s_name").alias("name")),
    )
