"""Schemas and fixed values of the data model."""

from pyspark.sql.types import (
    DateType,
    DecimalType,
    StringType,
    StructField,
    StructType,
    VarcharType,
)

# Names, markers and brackets that the data itself uses.
LISTING_FIELDS = ["type", "code", "name", "ISIN", "start", "market", "group", "CFI"]
EQUITY_TYPE = "股票"
BOOKS = ["twse", "tpex"]
REPORT_CODE = "證券代號"
REPORT_CHANGE_SIGN = "漲跌(+/-)"
REPORT_SUFFIX = "個股收盤.csv"
CAPITAL_CODE = "代號"
CAPITAL_NAME = "名稱"
CAPITAL_VALUE = "股本(億)"
BROKER_MARKER = "全台卷商交易資料"
BROKER_DESTINATION = "Broker"
SNAPSHOT_CATEGORIES = [
    # marker in the title, destination folder
    ("技術指標_day_", "Tech"),
    ("技術指標_week_", "Tech"),
    ("3大法人_", "Investors"),
    ("融資融卷_", "Margin"),
]
TDCC_BRACKETS = [
    "1_999",
    "1000_5000",
    "5001_10000",
    "10001_15000",
    "15001_20000",
    "20001_30000",
    "30001_40000",
    "40001_50000",
    "50001_100000",
    "100001_200000",
    "200001_400000",
    "400001_600000",
    "600001_800000",
    "800001_1000000",
    "Up_1000001",
]
TDCC_MEASURES = [
    ("People", DecimalType(18, 0)),
    ("Unit", DecimalType(18, 0)),
    ("Proportion", DecimalType(5, 2)),
]

LISTING = StructType([StructField(f, StringType()) for f in LISTING_FIELDS])

_STOCK_DATE = [
    StructField("stock", VarcharType(10), nullable=False),
    StructField("date", DateType(), nullable=False),
]

BROKERAGE_AVG_PRICE = StructType(
    _STOCK_DATE
    + [
        StructField("avg_buy_price", DecimalType(6, 2)),
        StructField("avg_sell_price", DecimalType(6, 2)),
        StructField("rate", DecimalType(3, 2)),
    ]
)

TDCC = StructType(
    _STOCK_DATE
    + [
        StructField(f"Share_Rating_{measure}_{bracket}", dtype)
        for bracket in TDCC_BRACKETS
        for measure, dtype in TDCC_MEASURES
    ]
)

REPORT_JSON = "stat string, date string, fields5 array<string>, data5 array<array<string>>"
