import pytest
from pyspark.sql import functions as F

from tidemark.functions import origin, parsing


def column(spark, texts, build):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    return [r["v"] for r in rows.select("i", build(F.col("t")).alias("v")).orderBy("i").collect()]


def test_numbers(spark):
    texts = ["1,234", " 5 ", "-", "--", "N/A", "na", "", None, "12.5%", "0"]
    assert column(spark, texts, parsing.parse_number) == [1234.0, 5.0, None, None, None, None, None, None, None, 0.0]
    assert column(spark, ["12.5%", " 7 % ", "--", "0"], parsing.parse_weight) == [12.5, 7.0, None, 0.0]
    assert column(spark, ["0.00%", "1.2", "--"], parsing.parse_aggregator_weight) == [0.004, 1.2, None]


def test_dates(spark):
    got = column(spark, ["2026-06-20", "2026/6/2", " 2026/06/20 ", "20260620", "2026-13-01", None], parsing.parse_date)
    assert [str(d) if d else None for d in got] == ["2026-06-20", "2026-06-02", "2026-06-20", None, None, None]
    pages = ["x 2026/01/01 資料日期： 2026/06/20", "on 2026/01/02 only", "none"]
    assert column(spark, pages, parsing.labelled_date) == ["2026/06/20", "2026/01/02", None]


def test_assets(spark):
    texts = ["台積電(2330.TW)", "x(2330.tw)", "Cash", "台幣現金", "TX Futures", "選擇權", "公債", "other", "2330.TW"]
    got = column(spark, texts, parsing.classify_asset)
    assert [(r["asset_type"], r["stock_code"], r["stock_name"]) for r in got] == [
        ("stock", "2330", "台積電"), ("stock", "2330", "x"), ("cash", None, None), ("cash", None, None),
        ("futures", None, None), ("options", None, None), ("bond", None, None), ("unknown", None, None), ("unknown", None, None),
    ]


def test_config_text(spark):
    got = column(spark, ["a=1; b = x=y ;junk;a=2", "", None], parsing.config_map)
    assert got == [{"a": "2", "b": "x=y"}, {}, {}]


@pytest.mark.parametrize(
    "source, priority, family",
    [("moneydj_primary", 40, "moneydj"), ("moneydj_browser", 38, "moneydj"), ("official_fallback", 35, "official"),
     ("official_browser", 35, "official"), ("official_static", 30, "official"), ("mine", 10, "mine"), ("", 10, "unknown"), (None, 10, "unknown")],
)
def test_sources(spark, source, priority, family):
    assert column(spark, [source], origin.source_priority) == [priority]
    assert column(spark, [source], origin.source_family) == [family]
