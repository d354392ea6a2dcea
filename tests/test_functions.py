import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotemill.functions import dates, text


def values(spark, expr, inputs, dtype="string"):
    df = spark.createDataFrame([(v,) for v in inputs], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_strip_chars_takes_a_set_from_both_ends(spark):
    cases = ['="2330"', '"=x="', "2330", '=""', None]
    got = values(spark, lambda c: text.strip_chars(c, '="'), cases)
    assert got == [None if c is None else c.strip('="') for c in cases]


def test_spaces(spark):
    assert values(spark, text.strip_spaces, [" a b ", "\ta "]) == ["a b", "\ta"]
    assert values(spark, text.drop_spaces, [" a b ", "　a"]) == ["ab", "　a"]


@pytest.mark.parametrize(
    "cell, code, name",
    [
        ("1101 　台 泥", "1101", "台泥"),
        ("9999台", None, None),
        ("1　2　3", None, None),
        ("", None, None),
        ("　", "", ""),
    ],
)
def test_code_and_name(spark, cell, code, name):
    pair = lambda c: F.struct(*[x.alias(n) for x, n in zip(text.code_and_name(c), "cn")])
    assert tuple(values(spark, pair, [cell])[0]) == (code, name)


def test_thousands(spark):
    got = values(spark, text.thousands, ["2,593", "100.5", "", "NA", None, "-1,234,567.89", "1.005", "1.500", "9" * 17])
    assert [None if v is None else str(v) for v in got] == [
        "2593.00", "100.50", None, None, None, "-1234567.89", None, "1.50", None,
    ]


@pytest.mark.parametrize("name", ["台積電", "a name longer than eight", "", "𠮷野家"])
@pytest.mark.parametrize("number", ["5", "1234567", "2593.00"])
def test_report_line_pads_and_never_cuts(spark, name, number):
    row = spark.createDataFrame([(name, number)], "n string, v string")
    line = row.select(text.report_line(F.col("n"), F.col("v"))).first()[0]
    assert line == "{0:<8}股本 {1:>5} (億)".format(name, number)


def test_prefix_and_file_name(spark):
    assert values(spark, lambda c: text.strip_prefix(c, 2), ["./3大法人.zip", "x"]) == ["3大法人.zip", ""]
    assert values(spark, text.file_name, ["file:/a/b/c.zip", "c.zip"]) == ["c.zip", "c.zip"]


def test_entities_are_decoded_once(spark):
    both = lambda c: text.decode_markup_entities(text.decode_plain_entities(c))
    got = values(spark, both, ["a&amp;b", "&amp;lt;", "&lt;", "&amp;quot;", "&quot;", "plain", None])
    assert got == ["a&b", "&lt;", "<", "&quot;", '"', "plain", None]


@pytest.mark.parametrize(
    "entity, char",
    [
        ("&nbsp;", "\u00a0"), ("&#160;", "\u00a0"), ("&#21488;", "台"), ("&#x53F0;", "台"), ("&#X1d11e;", "𝄞"),
        ("&#12288;", "　"), ("&#39;", "'"), ("&#60;", "<"), ("&#38;", "&"), ("&#38;lt;", "&lt;"), ("&#38;#65;", "&#65;"),
        ("&#0;", "\ufffd"), ("&#xD800;", "\ufffd"), ("&#x110000;", "\ufffd"), ("&#65", "&#65"), ("&#;", "&#;"),
    ],
)
def test_entities(spark, entity, char):
    both = lambda c: text.decode_markup_entities(text.decode_plain_entities(c))
    assert values(spark, both, [f"a{entity}b&#65;{entity}"]) == [f"a{char}bA{char}"]


def test_trade_date_rolls_weekends_back(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(8)]
    friday = dt.date(2024, 1, 5)
    assert values(spark, dates.trade_date, days, "date") == [*days[:5], friday, friday, days[7]]


def test_trade_date_over_years(spark):
    days = [dt.date(1999, 12, 25) + dt.timedelta(days=i) for i in range(800)]
    for day, moved in zip(days, values(spark, dates.trade_date, days, "date")):
        assert moved.weekday() < 5 and 0 <= (day - moved).days <= 2


@pytest.mark.parametrize(
    "title, expect",
    [
        ("m_690101.zip", dt.date(1969, 1, 1)),
        ("m_680101.zip", dt.date(2068, 1, 1)),
        ("m_240229.zip", dt.date(2024, 2, 29)),
        ("m_230229.zip", None),
        ("m_249999.zip", None),
        ("m_2311.zip", None),
        ("m_240102 (1).zip", None),
        ("m_240102.zip\n", None),
        ("xm_240102.zip", None),
        ("m_240102.ZIP", None),
    ],
)
def test_title_date(spark, title, expect):
    assert values(spark, lambda c: dates.title_date(c, F.lit("m_")), [title]) == [expect]


def test_labels(spark):
    assert values(spark, dates.compact_date, [dt.date(2017, 11, 3)], "date") == ["20171103"]
    stamp = [dt.datetime(2002, 1, 1, 23, 59)]
    assert values(spark, dates.snap_label, stamp, "timestamp_ntz") == ["020101"]
