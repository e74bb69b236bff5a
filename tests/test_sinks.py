"""Affected dates are replaced whole: what is gone from them is gone from the tables."""

from build import day, holdings
from pyspark.sql import functions as F

from tidemark.sources import sinks

ONE, TWO, THREE = "2026-01-02", "2026-01-03", "2026-01-04"


def stocks(spark, date, fund, n, source="official_fallback"):
    return [(date, fund, f"{1000 + i}", i, 1.0) for i in range(n)]


def dates(spark, *of):
    return spark.createDataFrame([(day(d),) for d in of], "date date")


def changes(spark, *rows):
    return spark.createDataFrame([(day(d), "F1", code) for d, code in rows], "date date, etf_code string, stock_code string")



def test_a_date_without_new_rows_becomes_empty(spark, tmp_path):
    rows = changes(spark, (ONE, "1101"), (TWO, "1101"), (TWO, "2330"), (THREE, "1101"))
    sinks.derived_sink(rows, str(tmp_path), "etf_holding_changes")
    again = changes(spark, (TWO, "9999"))
    for _ in range(2):  # a rerun changes nothing more
        sinks.derived_sink(again, str(tmp_path), "etf_holding_changes", dates(spark, ONE, TWO))
        got = sinks.read_back(spark, f"{tmp_path}/etf_holding_changes", rows.schema).collect()
        assert sorted((str(r["date"]), r["stock_code"]) for r in got) == [(TWO, "9999"), (THREE, "1101")]


def test_stock_and_cash_of_a_date_change_together(spark, tmp_path):
    stock = holdings(spark, stocks(spark, ONE, "F1", 5) + stocks(spark, TWO, "F1", 5))
    cash = spark.createDataFrame([(day(ONE), "F1", "cash"), (day(TWO), "F1", "cash")], "date date, etf_code string, asset_name string")
    sinks.snapshot_sink(stock, cash, str(tmp_path))
    sinks.snapshot_sink(holdings(spark, stocks(spark, ONE, "F1", 6)), cash.where("false"), str(tmp_path), dates(spark, ONE))
    left = sinks.read_back(spark, f"{tmp_path}/etf_daily_non_stock_assets", cash.schema).collect()
    assert [str(r["date"]) for r in left] == [TWO]
    held = sinks.read_back(spark, f"{tmp_path}/etf_daily_holdings", stock.schema).groupBy("date").count().collect()
    assert sorted((str(r["date"]), r["count"]) for r in held) == [(ONE, 6), (TWO, 5)]


def test_report_section_is_archived_and_current(spark, tmp_path):
    section = changes(spark, (ONE, "a"), (TWO, "b"))
    sinks.report_sink(section, str(tmp_path), "movers", "s1")
    sinks.report_sink(section.where(F.col("date") == F.lit(TWO).cast("date")), str(tmp_path), "movers", "s2", dates(spark, ONE, TWO))
    assert sinks.read_back(spark, f"{tmp_path}/current/movers", section.schema).count() == 1
    assert sinks.read_back(spark, f"{tmp_path}/archive/s1/movers", section.schema).count() == 2
