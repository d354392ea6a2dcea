import csv
import datetime as dt
import io
import os
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from quotemill.operators.keys import last_wins
from quotemill.operators.rejects import accepted, rejected
from quotemill.operators.tables import write_master
from quotemill.plans.capital import capital_ranking, capital_table, top_lines
from quotemill.plans.master import build_master, master_sets
from quotemill.schemas import LISTING_FIELDS
from quotemill.sources.csv_files import ORDER, goes_over_lines, read_capital, read_master, records, with_input_place

HEADER = ",".join(LISTING_FIELDS)


def write(path, *lines, sep="\r\n"):
    path.write_bytes((sep.join(lines) + sep).encode())
    return str(path)


@pytest.fixture
def master(tmp_path):
    return write(
        tmp_path / "twse.csv",
        HEADER,
        "股票,1101,舊名,TW1,1962/02/09,上市,水泥,ESVUFR",
        "ETF,0050,元大,TW2,2003/06/30,上市,,CEOGEU",
        '股票,1102,"亞,""泥""",TW3,1962/06/08,上市,水泥,ESVUFR',
        "股票,1101,台泥,TW1,1962/02/09,上市,水泥,ESVUFR",
        "股票,too,few,fields,a,b,c",
        "股票,too,many,fields,a,b,c,d,e",
    )


@pytest.mark.parametrize("multi_line", [None, False, True])
def test_read_master(spark, master, multi_line):
    rows = read_master(spark, master, "twse", multi_line)
    assert accepted(rows).count() == 4
    bad = rejected(rows)
    assert bad.count() == 2
    assert {r.reject_reason for r in bad.collect()} == {"not 8 fields, code too"}

    sets = master_sets(accepted(rows), ORDER)
    codes = {r.code: r.name for r in sets["codes"].collect()}
    assert codes == {"1101": "台泥", "1102": '亞,"泥"'}
    assert {r.code for r in sets["twse"].collect()} == {"1101", "1102", "0050"}
    assert sets["tpex"].count() == 0


def test_an_equity_row_is_not_hidden_by_a_later_row_of_another_type(spark, tmp_path):
    path = write(tmp_path / "m.csv", HEADER, "股票,1,a,i,s,m,g,c", "ETF,1,b,i,s,m,g,c")
    sets = master_sets(accepted(read_master(spark, path, "tpex")), ORDER)
    assert [r.name for r in sets["codes"].collect()] == ["a"]
    assert [r.name for r in sets["tpex"].collect()] == ["b"]


def test_written_master_is_what_csv_writer_writes(spark, tmp_path):
    rows = [
        ("股票", "1101", 'q"u,o', "", None, "two\nlines", " sp ", "ESVUFR"),
        ("ETF", "0050", "元大", "TW", "s", "m", "g", "c"),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"`{f}` string" for f in LISTING_FIELDS)).coalesce(1)
    write_master(df, str(tmp_path / "out"))
    got = next((tmp_path / "out").glob("part-*")).read_bytes().decode()

    with open(tmp_path / "expect.csv", "w", newline="", encoding="utf_8") as f:
        writer = csv.writer(f)
        writer.writerow(LISTING_FIELDS)
        writer.writerows(rows)
    assert got == (tmp_path / "expect.csv").read_bytes().decode()

    back = accepted(read_master(spark, str(tmp_path / "out"), "twse"))
    expect = [tuple(v or None for v in r) for r in rows]
    assert sorted(tuple(r)[:8] for r in back.select(*LISTING_FIELDS).collect()) == sorted(expect)


@pytest.mark.parametrize(
    "record, spans",
    [
        ("a,b,c", False),
        ('="2330",x,"2,593",', False),
        ('"a ""quoted"" word",b', False),
        ('a"b,c', False),
        ('"closed"tail,b', False),
        ("", False),
        ('a,"first\nsecond",c', True),
        ('a"b,"first\nsecond","x"', True),
        ('"a""\nb"', True),
    ],
)
def test_records_over_line_ends_are_noticed(spark, tmp_path, record, spans):
    path = write(tmp_path / "x.csv", "h1,h2,h3", record, "a,b,c", sep="\n")
    assert goes_over_lines(spark, path) == spans


@pytest.fixture
def small_blocks(spark):
    """Files are split every few hundred bytes, also in the middle of a record."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_with_records_over_lines_are_split(spark, tmp_path, small_blocks, all_partitions):
    folder = tmp_path / "台 %[1]"
    folder.mkdir()
    write(folder / "1 {x}+y.csv", HEADER, *[f't,{i},"two\nlines, ""{i}""",i,s,m,g,c' for i in range(300)])
    write(folder / "2.csv", HEADER, *[f"t,{i},{i},i,s,m,g,c" for i in range(300, 600)])
    lines = records(spark, str(tmp_path) + "/*")
    assert lines.where("header").count() == 2
    rows = accepted(read_master(spark, str(tmp_path) + "/*", "twse"))
    found = rows.select("code", "name", F.spark_partition_id().alias("task")).collect()
    assert len({r.task for r in found}) > 4
    assert sorted((int(r.code), r.name) for r in found) == [(i, f'two\nlines, "{i}"' if i < 300 else str(i)) for i in range(600)]
    placed = with_input_place(rows, "place").select("code", "place").collect()
    assert sorted((r.place, int(r.code)) for r in placed) == [(i, i) for i in range(600)]


@pytest.mark.parametrize("seed", range(4))
def test_lines_put_together_are_what_a_whole_read_gives(spark, tmp_path, small_blocks, seed):
    rng = random.Random(seed)
    quoted = lambda: '"' + "".join(rng.choice(["x", ",", '""', "\n", "\r\n", " ", "\n\n", "é"]) for _ in range(rng.randint(0, 25))) + '"'
    plain = lambda: rng.choice(["", "a", 'b"c', "  ", '=x"', "1'"])
    for name in "ab":
        rows = [",".join(quoted() if rng.random() < 0.15 else plain() for _ in range(8 if rng.random() < 0.9 else rng.randint(1, 10))) for _ in range(150)]
        rows = [r if r.strip() else "a" for r in rows]  # a record of spaces only is dropped, as by a read that splits files
        rows[0] = 't,1,"first\nrecord",i,s,m,g,c'
        write(tmp_path / f"{name}.csv", HEADER, *rows, sep=rng.choice(["\n", "\r\n"]))
    columns = [*LISTING_FIELDS, "reject_reason"]
    rows, whole = (read_master(spark, str(tmp_path), "twse", multi_line) for multi_line in (None, True))
    read = lambda df: [tuple(v and v.replace("\r\n", "\n") for v in r) for r in df.orderBy(ORDER).select(*columns).collect()]
    assert read(rows) == read(whole)


def test_header_after_blank_lines(spark, tmp_path, small_blocks):
    write(tmp_path / "m.csv", *[""] * 500, HEADER, 't,1,"two\nlines",i,s,m,g,c', "", "t,2,b,i,s,m,g,c", sep="\n")
    rows = read_master(spark, str(tmp_path), "twse")
    assert [(r.code, r.name) for r in rows.orderBy(ORDER).collect()] == [("1", "two\nlines"), ("2", "b")]


def test_capital_with_names_over_lines(spark, tmp_path, small_blocks):
    header = "代號,名稱,股本(億)"
    rows = [f'="{i:04}","name\nof {i}","1,{i:03}.5",' for i in range(100)]
    write(tmp_path / "1.csv", header, *rows, sep="\n")
    table, rejects = capital_ranking(spark, str(tmp_path))
    got = [(r["row_index"], r["index"], r["stock"], r["名稱"], str(r["股本(億)"])) for r in table.orderBy("row_index").collect()]
    assert got == [(n, i, f"{i:04}", f"name\nof {i}", f"1{i:03}.50") for n, i in enumerate(reversed(range(100)))]
    assert rejects.count() == 0
    write(tmp_path / "2.csv", "代號,other,股本(億)", *rows, sep="\n")
    with pytest.raises(Exception, match="another header"):
        read_capital(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("first, second", [("9.csv", "10.csv"), ("part-99999-a.csv", "part-100000-a.csv"), ("2/x.csv", "10/x.csv")])
def test_numbers_in_names_are_compared_as_numbers(spark, tmp_path, first, second):
    for name, row in ((first, "old"), (second, "new")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        write(tmp_path / name, HEADER, f"t,1,{row},i,s,m,g,c")
    path = str(tmp_path / "*.csv") if "/" not in first else str(tmp_path / "*")
    assert last_wins(accepted(read_master(spark, path, "twse")), "code", ORDER).first().name == "new"


def test_a_snapshot_goes_before_the_names(spark, tmp_path):
    for name, row, time in (("b.csv", "old", 1_700_000_000), ("a.csv", "new", 1_700_000_100)):
        os.utime(write(tmp_path / name, HEADER, f"t,1,{row},i,s,m,g,c"), (time, time))
    written = F.col("_metadata.file_modification_time")
    rows = accepted(read_master(spark, str(tmp_path), "twse", snapshot=written))
    assert last_wins(rows, "code", ORDER).first().name == "new"


def test_a_master_without_rows_has_a_header(spark, tmp_path):
    empty = spark.createDataFrame([], ", ".join(f"`{f}` string" for f in LISTING_FIELDS))
    write_master(empty, str(tmp_path / "out"))
    (file,) = (tmp_path / "out").glob("part-*")
    assert file.read_bytes() == (HEADER + "\r\n").encode()
    assert read_master(spark, str(tmp_path / "out"), "twse").count() == 0


def test_source_order_over_splits(spark, tmp_path):
    lines = [f"t,{i % 7},{i:06d},i,s,m,g,c" for i in range(5000)]
    path = write(tmp_path / "big.csv", HEADER, *lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = accepted(read_master(spark, path, "twse"))
        assert rows.rdd.getNumPartitions() > 5
        got = {r.code: r.name for r in last_wins(rows, "code", ORDER).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {str(i % 7): f"{i:06d}" for i in range(4993, 5000)}


CAPITAL = (pathlib.Path(__file__).parent / "fixtures" / "capital.csv").read_text("utf-8").splitlines()


def test_capital(spark, tmp_path):
    path = write(tmp_path / "c.csv", *CAPITAL, sep="\n")
    ranked, rejects = capital_ranking(spark, path)
    assert rejects.count() == 0
    assert ranked.columns == ["row_index", "index", "名稱", "股本(億)", "備註", "stock"]
    got = [
        (r["row_index"], r["index"], r.stock, None if r["股本(億)"] is None else str(r["股本(億)"]), r["備註"])
        for r in ranked.orderBy("row_index").collect()
    ]
    assert got == [
        (0, 1, "2330", "2593.00", None),
        (1, 0, "0050", "100.50", "NA"),
        (2, 3, "9999", "5.00", "y"),
        (3, 2, "1101", None, "x"),
    ]
    lines = top_lines(accepted(capital_table(read_capital(spark, path)))).collect()
    assert [r.line for r in lines] == [
        "台積電     股本 2593.00 (億)",
        "元大      股本 100.50 (億)",
        "額外      股本  5.00 (億)",
    ]


    unplaced, _ = capital_ranking(spark, path, place=False)
    assert unplaced.columns == [c for c in ranked.columns if c != "index"]
    assert unplaced.orderBy("row_index").collect() == ranked.drop("index").orderBy("row_index").collect()


def test_capital_files_with_different_headers(spark, tmp_path):
    write(tmp_path / "1.csv", "代號,名稱,股本(億)", "1,a,2", sep="\n")
    write(tmp_path / "2.csv", "代號,股本(億),名稱", "1,2,a", sep="\n")
    with pytest.raises(Exception, match="header"):
        capital_ranking(spark, str(tmp_path))


def test_capital_with_fewer_than_three_rows(spark, tmp_path):
    path = write(tmp_path / "c.csv", CAPITAL[0], CAPITAL[1], sep="\n")
    assert top_lines(accepted(capital_table(read_capital(spark, path)))).count() == 1


def test_capital_that_is_no_number_is_a_reject(spark, tmp_path):
    texts = ["--", "5 億", "12345678901234567", "12.345", '"2,593.5"', "", "12.30", "NA", "1e400"]
    path = write(tmp_path / "c.csv", "代號,名稱,股本(億)", *[f"{i},n,{t}" for i, t in enumerate(texts)], sep="\n")
    ranked, rejects = capital_ranking(spark, path)
    assert {r.stock: r.reject_reason for r in rejects.collect()} == {
        str(i): f"no number that fits: {texts[i]}" for i in (0, 1, 2, 3, 7, 8)
    }
    assert [(r.stock, str(r["股本(億)"]), r["index"]) for r in ranked.orderBy("row_index").collect()] == [
        ("4", "2593.50", 4), ("6", "12.30", 6), ("5", "None", 5)
    ]


def test_places_over_splits_and_files(spark, tmp_path):
    for name, first in (("10.csv", 300), ("9.csv", 0)):
        write(tmp_path / name, "代號,名稱,股本(億)", *[f"{first + i},n,{i % 7}" for i in range(300)], sep="\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        ranked, _ = capital_ranking(spark, str(tmp_path))
        assert {r.stock: r["index"] for r in ranked.collect()} == {str(i): i for i in range(600)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_build_master_from_pages(spark):
    row = "<tr><td>{}　{}<td>i<td>s<td>m<td>g<td>c<td></tr>".format
    section = "<tr><td><b>{}<b></tr>".format
    first, later = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    pages = spark.createDataFrame(
        [
            ("twse", "u", first, "<tr>h</tr>" + section("股票") + row(1, "old") + row(2, "two")),
            ("twse", "u", later, "<tr>h</tr>" + section("股票") + row(1, "new") + "<tr><td>bad</tr>"),
            ("tpex", "v", first, "<tr>h</tr>" + section("ETF") + row(3, "etf")),
        ],
        "source string, url string, captured timestamp, html string",
    )
    sets, rejects = build_master(pages)
    names = lambda df: {r.code: r.name for r in df.collect()}
    assert names(sets["codes"]) == names(sets["twse"]) == {"1": "new", "2": "two"}
    assert names(sets["tpex"]) == {"3": "etf"}
    assert rejects.count() == 1
    sets, _ = build_master(pages, as_of=first)
    assert names(sets["codes"]) == {"1": "old", "2": "two"}


@pytest.mark.parametrize("partitions", [1, 50])
def test_last_wins_does_not_depend_on_partitions(spark, partitions):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100).alias("code"),
        "id",
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id")).alias("v"),
    )
    got = last_wins(df.repartition(partitions), "code", "id").collect()
    expect = {}
    for i in range(10_000):
        expect[0 if i % 3 == 0 else i % 100] = (i, None if i % 2 == 0 else i)
    assert {r.code: (r.id, r.v) for r in got} == expect and len(got) == len(expect)


def test_random_text_survives_the_master_csv(spark, tmp_path):
    rng = random.Random(5)
    field = lambda: "".join(rng.choice('",\r\n aé　=\'\\') for _ in range(rng.randint(0, 6)))
    rows = [(f"t{i}", *[field() for _ in range(7)]) for i in range(1500)]
    schema = ", ".join(f"`{f}` string" for f in LISTING_FIELDS)
    path = str(tmp_path / "out")
    write_master(spark.createDataFrame(rows, schema).coalesce(1), path)

    expect = io.StringIO(newline="")
    csv.writer(expect).writerows([LISTING_FIELDS, *rows])
    assert next((tmp_path / "out").glob("part-*")).read_bytes().decode() == expect.getvalue()

    back = {r[0]: tuple(r) for r in accepted(read_master(spark, path, "twse")).select(*LISTING_FIELDS).collect()}
    as_read = lambda v: v.replace("\r\n", "\n") or None
    wrong = [(r, back.get(r[0])) for r in rows if back.get(r[0]) != tuple(map(as_read, r))]
    assert not wrong, (len(wrong), wrong[:3])
