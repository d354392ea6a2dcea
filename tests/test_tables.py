import datetime as dt
import hashlib
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quotemill.operators import batches, columns, tables
from quotemill.operators.rejects import accepted, rejected
from quotemill.plans import facts
from quotemill.schemas import BROKERAGE_AVG_PRICE, TDCC
from quotemill.sources.tables import scan

DAY = dt.date(2024, 1, 2)


def prices(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "stock string, date date, avg_buy_price string, avg_sell_price string, rate string",
    )


def test_tdcc_has_the_declared_columns(spark, database):
    assert len(TDCC) == 47
    for buckets in (None, 4):
        name = f"{database}.tdcc_{buckets}"
        tables.create_tdcc(spark, name, buckets)
        described = spark.table(name).dtypes
        assert [n for n, _ in described] == TDCC.fieldNames()
        assert described[0] == ("stock", "string") and described[1] == ("date", "date")
        assert described[2:5] == [
            ("Share_Rating_People_1_999", "decimal(18,0)"),
            ("Share_Rating_Unit_1_999", "decimal(18,0)"),
            ("Share_Rating_Proportion_1_999", "decimal(5,2)"),
        ]
        assert described[-1] == ("Share_Rating_Proportion_Up_1000001", "decimal(5,2)")
        row = ["2330", DAY, *[Decimal(i) for i in range(45)]]
        tables.append_rows(spark.createDataFrame([row], spark.table(name).schema), name, TDCC)
        assert list(spark.table(name).first()) == row


def test_conform(spark):
    rows = columns.conform(
        prices(
            spark,
            ("2330", DAY, "9999.99", "1", "9.99"),
            ("1", DAY, "10000.00", "1", "10.00"),
            (None, DAY, "1", None, None),
            ("12345678901", DAY, "x", "1", "1"),
        ),
        BROKERAGE_AVG_PRICE,
    )
    assert [tuple(r) for r in accepted(rows).collect()] == [
        ("2330", DAY, Decimal("9999.99"), Decimal("1.00"), Decimal("9.99"))
    ]
    assert [r.reject_reason for r in rejected(rows).collect()] == [
        "avg_buy_price does not fit; rate does not fit",
        "stock is NULL",
        "stock does not fit; avg_buy_price does not fit",
    ]


def test_append_refuses_what_does_not_fit(spark, database):
    name = f"{database}.b"
    tables.create_brokerage_avg_price(spark, name)
    typed = spark.table(name).schema
    good = spark.createDataFrame([("2330", DAY, Decimal("1.50"), None, None)], typed)
    tables.append_rows(good, name, BROKERAGE_AVG_PRICE)
    tables.append_rows(good.toDF("a", "b", "c", "d", "e"), name, BROKERAGE_AVG_PRICE)
    assert spark.table(name).count() == 2
    for bad in (
        good.drop("rate"),
        good.withColumn("stock", F.lit(None).cast("string")),
        good.withColumn("stock", F.lit("12345678901")),
        good.withColumn("avg_buy_price", F.lit(10000).cast("decimal(7,2)")),
        good.withColumn("rate", F.lit(10).cast("decimal(4,2)")),
    ):
        with pytest.raises((ValueError, PySparkException)):
            tables.append_rows(bad, name, BROKERAGE_AVG_PRICE)
    with pytest.raises(PySparkException):
        tables.append_rows(good.drop("rate"), name)
    assert spark.table(name).count() == 2


def test_fact_job(spark, database):
    brokerage, tdcc = f"{database}.b", f"{database}.t"
    for _ in range(2):  # a reset empties the tables
        facts.reset_fact_tables(spark, brokerage, tdcc)
        rejects = facts.load_brokerage(
            prices(
                spark,
                ("2330", dt.date(2024, 1, 3), "2", "2", "1"),
                ("2330", DAY, "1", "2", "1"),
                ("1101", DAY, "99999", "2", "1"),
            ),
            brokerage,
        )
        assert rejects.count() == 1
    days = facts.date_list(spark, brokerage, "stock = '2330'").collect()
    assert sorted(r[0] for r in days) == ["20240102", "20240103"]
    assert facts.date_list(spark, brokerage, "stock = 'none'").count() == 0
    first = facts.first_match(spark, brokerage, ["avg_buy_price"], "stock = '2330'", "date")
    assert [tuple(r) for r in first.collect()] == [(Decimal("1.00"),)]
    assert facts.first_match(spark, brokerage, ["rate"], "rate > 5", "date").count() == 0


def test_replace_takes_the_new_columns(spark, database):
    name = f"{database}.r"
    tables.replace_table(spark.range(3), name)
    tables.replace_table(spark.createDataFrame([("x", 1)], "a string, b int"), name)
    assert spark.table(name).columns == ["a", "b"] and spark.table(name).count() == 1
    tables.drop_table(spark, name)
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_a_table_replaced_by_a_query_on_itself(spark, database):
    name = f"{database}.t"
    tables.replace_table(spark.range(10), name)
    tables.replace_table(spark.table(name).select((F.col("id") * 2).alias("twice")), name)
    assert sorted(r.twice for r in spark.table(name).collect()) == list(range(0, 20, 2))
    assert [t.name for t in spark.catalog.listTables(database)] == ["t"]


def test_a_failing_replacement_leaves_the_table(spark, database):
    name = f"{database}.t"
    tables.replace_table(spark.range(10), name)
    bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException, match="lost"):
        tables.replace_table(bad, name)
    assert spark.table(name).count() == 10
    assert [t.name for t in spark.catalog.listTables(database)] == ["t"]


def test_a_replacement_lost_between_the_names_is_taken_back(spark, database):
    name = f"{database}.t"
    tables.replace_table(spark.range(10), name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    bad = spark.range(1).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(PySparkException, match="lost"):
        tables.replace_table(bad, name)
    assert spark.table(name).count() == 10
    tables.replace_table(spark.range(3), name)
    assert spark.table(name).count() == 3 and [t.name for t in spark.catalog.listTables(database)] == ["t"]


def batch_table(spark, database):
    name = f"{database}.prices"
    tables.create_brokerage_avg_price(spark, name)
    return name


def batch_of(spark, first, n):
    kind = "stock string, date date, avg_buy_price decimal(6,2), avg_sell_price decimal(6,2), rate decimal(3,2)"
    rows = [(str(i), DAY, Decimal(i), Decimal(1), Decimal(1)) for i in range(first, first + n)]
    return spark.createDataFrame(rows, kind).repartition(3)


def stocks(spark, name):
    return sorted(int(r.stock) for r in spark.table(name).collect())


def test_a_batch_is_appended_once(spark, database):
    name = batch_table(spark, database)
    append = lambda first, n, batch: tables.append_rows(batch_of(spark, first, n), name, BROKERAGE_AVG_PRICE, ["stock"], batch)
    assert [append(0, 5, "a"), append(0, 5, "a"), append(5, 5, "b"), append(0, 5, "a"), append(10, 0, "none"), append(10, 0, "none")] == [
        True, False, True, False, True, False
    ]
    assert stocks(spark, name) == list(range(10))
    tables.append_rows(batch_of(spark, 0, 1), name)  # without a batch: as often as it is called
    assert stocks(spark, name) == [0, *range(10)]
    assert [t.name for t in spark.catalog.listTables(database)] == ["prices"]


def test_a_batch_lost_while_it_is_written_leaves_nothing(spark, database):
    name = batch_table(spark, database)
    tables.append_rows(batch_of(spark, 0, 3), name, batch="a")
    last = F.when(F.col("stock") == "99", F.raise_error(F.lit("lost"))).otherwise(F.col("stock")).alias("stock")
    lost = batch_of(spark, 50, 50).select(last, "date", "avg_buy_price", "avg_sell_price", "rate")
    for rows in (lost, batch_of(spark, 50, 2).withColumn("rate", F.lit(10).cast("decimal(5,2)"))):
        with pytest.raises(PySparkException):
            tables.append_rows(rows, name, batch="b")
        assert stocks(spark, name) == [0, 1, 2]
    assert tables.append_rows(batch_of(spark, 50, 2), name, batch="b")
    assert stocks(spark, name) == [0, 1, 2, 50, 51]
    assert [t.name for t in spark.catalog.listTables(database)] == ["prices"]


@pytest.mark.parametrize("moved", [0, 1, 99])
def test_a_batch_lost_after_its_commit_is_finished_later(spark, database, monkeypatch, moved):
    name = batch_table(spark, database)
    listed = batches._listed

    def lost_on_the_way(session, folder):
        names = listed(session, folder)
        if not folder.endswith(batches._FOLDER):  # the folder of the batch: some files are moved, then the run is lost
            location = folder.split(f"/{batches._FOLDER}/")[0]
            key = folder.split("/")[-1].split("-")[0]
            path, fs = batches._files(session, folder)
            for n in [n for n in names if n.startswith("part-")][:moved]:
                fs.rename(*[batches._files(session, f)[0] for f in (f"{folder}/{n}", f"{location}/{key}-{n}")])
            raise KeyboardInterrupt
        return names

    monkeypatch.setattr(batches, "_listed", lost_on_the_way)
    with pytest.raises(KeyboardInterrupt):
        tables.append_rows(batch_of(spark, 0, 9), name, batch="a")
    monkeypatch.setattr(batches, "_listed", listed)
    if moved == 1:
        batches.finish_appends(spark, name)
    else:
        assert not tables.append_rows(batch_of(spark, 0, 9), name, batch="a")
    assert stocks(spark, name) == list(range(9))
    batches.finish_appends(spark, name)
    assert stocks(spark, name) == list(range(9))


def test_a_commit_without_a_folder_is_none(spark, database, monkeypatch):
    monkeypatch.setattr(batches, "_GRACE", 0)
    name = batch_table(spark, database)
    key = hashlib.sha256(b"a").hexdigest()[:32]
    assert batches._created(spark, f"{batches._location(spark, name)}/{batches._FOLDER}/{key}.commit", "")
    assert tables.append_rows(batch_of(spark, 0, 2), name, batch="a")
    assert stocks(spark, name) == [0, 1]


def test_one_batch_appended_by_two_at_once(spark, database):
    name = batch_table(spark, database)
    with ThreadPoolExecutor(3) as pool:
        done = list(pool.map(lambda _: tables.append_rows(batch_of(spark, 0, 20), name, batch="a"), range(3)))
    assert sorted(done) == [False, False, True] and stocks(spark, name) == list(range(20))


def test_batches_are_for_plain_tables(spark, database):
    tables.create_tdcc(spark, f"{database}.tdcc", 4)
    with pytest.raises(ValueError, match="buckets"):
        tables.append_rows(spark.table(f"{database}.tdcc"), f"{database}.tdcc", batch="a")


def test_a_lookup_of_an_absent_stock_reads_no_row_group(spark, database):
    name = batch_table(spark, database)
    # too many different stocks for a dictionary, of one range: only the filter can tell
    rows = spark.range(1_200_000).select(
        F.concat(F.lit("s"), F.lpad((F.col("id") * 2).cast("string"), 9, "0")).alias("stock"),
        F.lit(DAY).alias("date"),
        *[F.lit(1).cast(t).alias(c) for c, t in spark.table(name).dtypes[2:]],
    )
    tables.append_rows(rows, name, BROKERAGE_AVG_PRICE, ["stock", "date"])

    files = f"{batches._location(spark, name).removeprefix('file:')}/*.parquet"
    chunks = duckdb.sql(f"select path_in_schema, bloom_filter_offset, encodings from parquet_metadata('{files}')").fetchall()
    assert all((offset is not None) == (column == "stock") for column, offset, _ in chunks)
    assert all("PLAIN" in encodings.split(", ") for column, _, encodings in chunks if column == "stock")

    def rows_read(stock):
        found = scan(spark, name, ["rate"], f"stock = '{stock}'")
        plan = found._jdf.queryExecution().executedPlan()
        n = found._jdf.queryExecution().executedPlan().executeCollect()
        while plan.children().size():
            plan = plan.children().head()
        return len(list(n)), plan.metrics().get("numOutputRows").get().value()

    assert rows_read("s000200000")[0] == 1
    misses = [rows_read(f"s{200_001 + 2 * i:09}")[1] for i in range(10)]
    assert sorted(misses)[8] == 0  # a filter errs now and then


def test_scan_prunes_and_pushes(spark, database):
    name = f"{database}.s"
    tables.replace_table(spark.range(100).selectExpr("id", "id * 2 AS v", "id AS w"), name)
    df = scan(spark, name, ["v"], "id = 7")
    assert [r.v for r in df.collect()] == [14]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,7)" in plan and "ReadSchema: struct<id:bigint,v:bigint>" in plan


def test_clustered_append_is_ranged(spark, database, all_partitions):
    name = f"{database}.t"
    tables.create_brokerage_avg_price(spark, name)
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, "2330").otherwise((F.col("id") % 900).cast("string")).alias("stock"),
        F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("date"),
        *[F.lit(None).cast(t).alias(c) for c, t in spark.table(name).dtypes[2:]],
    )
    tables.append_rows(rows, name, BROKERAGE_AVG_PRICE, cluster_by=["stock", "date"])
    per_file = (
        spark.table(name).groupBy(F.input_file_name().alias("f"))
        .agg(F.count("*").alias("n"), F.min("stock").alias("lo"), F.max("stock").alias("hi"))
        .orderBy("lo", "hi").collect()
    )
    assert max(r.n for r in per_file) < 40_000 / 3  # the hot stock is split
    assert all(a.hi <= b.lo for a, b in zip(per_file, per_file[1:]))


def test_rows_equal_in_stock_and_date_spread(spark, database, all_partitions):
    name = f"{database}.t"
    tables.create_brokerage_avg_price(spark, name)
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, "2330").otherwise(F.col("id").cast("string")).alias("stock"),
        F.lit(DAY).alias("date"),
        (F.col("id") % 9_000 / 100).cast("decimal(6,2)").alias("avg_buy_price"),
        F.lit(None).cast("decimal(6,2)").alias("avg_sell_price"),
        F.lit(None).cast("decimal(3,2)").alias("rate"),
    )
    tables.append_rows(rows, name, BROKERAGE_AVG_PRICE, cluster_by=["stock", "date"])
    per_file = spark.table(name).where("stock = '2330'").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in per_file) == 20_000 and max(r["count"] for r in per_file) < 8_000


def test_columns(spark):
    df = spark.createDataFrame([('="2330"', "股票", "tpex")], "c string, type string, source string")
    assert columns.clean_code(df, "c").columns == ["type", "source", "stock"]
    assert columns.clean_code(df, "c").first().stock == "2330"
    routed = df.withColumn("book", columns.book_of(F.col("source")))
    assert columns.route(routed, "tpex").count() == 1 and columns.route(routed, "twse").count() == 0
    assert df.select(columns.book_of(F.lit(None))).first()[0] == "twse"
    assert columns.equities(df).count() == 1
    with pytest.raises(ValueError):
        columns.drop_required(df, "absent")
    assert columns.code_list(df, "c").columns == ["c"]
