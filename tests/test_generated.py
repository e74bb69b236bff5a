from datetime import datetime

from tidemark.sources import generated

LINES = (  # supplier, part, line number, quantity, price, day
    (5, 1, 1, 2.0, 10.0, 1), (5, 21, 4, 3.0, 20.0, 2), (5, 2, 5, 1.0, 70.0, 3),
    (6, 1, 1, 4.0, 25.0, 4), (None, 1, 1, 4.0, 25.0, 4), (10, 3, 3, None, None, 5),
)


def lineitem(spark, tmp_path):
    rows = [(*line, datetime(1996, 1, day)) for *line, day in LINES]
    frame = spark.createDataFrame(rows, "l_suppkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp")
    frame.write.parquet(f"{tmp_path}/lineitem.parquet")
    return generated.holdings(spark, str(tmp_path))


def test_holdings_of_both_sources(spark, tmp_path):
    got = {(r["etf_code"], r["source_type"], r["stock_code"]): (r["shares"], r["weight_pct"]) for r in lineitem(spark, tmp_path).collect()}
    assert got == {
        ("F00005", "official_fallback", "1001"): (5.0, 95.0 * 3000 / 10000),
        ("F00005", "official_fallback", "1002"): (1.0, 95.0 * 7000 / 10000),
        ("F00005", "official_static", "1001"): (2.0, 95.0),
        ("F00006", "moneydj_primary", "1001"): (4.0, 95.0),
        (None, "moneydj_primary", "1001"): (None, 95.0),
        ("F00010", "moneydj_primary", "1003"): (None, None),
        ("F00010", "official_static", "1003"): (None, None),
    }


def test_lines_are_summed_before_they_part_by_source(spark, tmp_path, capsys):
    lineitem(spark, tmp_path).explain()
    plan = capsys.readouterr().out
    assert plan.index("Generate") < plan.index("HashAggregate") and "HashAggregate(keys=[date" in plan
