"""The gates of the nightly run, on tiny stored tables."""

import pytest
from build import day, holdings
from pyspark.sql import functions as F

from tidemark.sources.tables import read_tables
from tidemark.streaming import incremental as N

D, LATER, FUTURE = "2026-06-18", "2026-06-19", "2026-06-30"


def offer(spark, date, fund, n, source="moneydj_primary", weight=2.0, shares=10, missing=False):
    rows = [(date, fund, f"{1100 + i}", shares, weight) for i in range(n)]
    df = holdings(spark, rows).withColumn("source_type", F.lit(source))
    if missing:
        df = df.withColumn("weight_pct", F.when(F.col("stock_code") != "1100", F.col("weight_pct")))
    return df.withColumn("run_date", F.col("date")).withColumn("candidate_id", F.concat_ws("|", F.col("date").cast("string"), "etf_code", "source_type"))


@pytest.fixture()
def root(spark, tmp_path):
    universe = spark.createDataFrame([], "code string")
    N.init_tables(spark, str(tmp_path), universe)
    store(spark, str(tmp_path), offer(spark, D, "A", 8).unionByName(offer(spark, D, "B", 10)))
    return str(tmp_path)


def store(spark, root, rows):
    got = N.store_candidates(spark, root, rows, "b", expected=F.lit(day(LATER)))
    return {(str(r["data_date"]), r["etf_code"]): (r["decision"], r["chosen_source_type"], r["outcome"]) for r in got.collect()}


def stored(spark, root):
    rows = read_tables(spark, root).holdings.groupBy("date", "etf_code", "source_type").agg(F.count("*").alias("n"), F.max("weight_pct").alias("w"))
    return {(str(r["date"]), r["etf_code"]): (r["source_type"], r["n"], r["w"]) for r in rows.collect()}


def test_a_missing_weight_keeps_what_is_stored(spark, root):
    before = stored(spark, root)
    assert store(spark, root, offer(spark, D, "A", 9, missing=True)) == {}
    assert stored(spark, root) == before == {(D, "A"): ("moneydj_primary", 8, 2.0), (D, "B"): ("moneydj_primary", 10, 2.0)}


def test_a_future_date_is_refused(spark, root):
    assert store(spark, root, offer(spark, FUTURE, "A", 9)) == {}
    assert (FUTURE, "A") not in stored(spark, root)


def test_a_stale_equivalent_is_not_written_again(spark, root):
    assert store(spark, root, offer(spark, D, "A", 8, weight=2.05))[D, "A"][0] == "skip_rewrite"
    assert store(spark, root, offer(spark, D, "B", 10, weight=5.0))[D, "B"][0] == "replace"
    assert stored(spark, root) == {(D, "A"): ("moneydj_primary", 8, 2.0), (D, "B"): ("moneydj_primary", 10, 5.0)}


def test_a_low_row_count_yields_to_the_official_source(spark, root):
    both = offer(spark, LATER, "B", 5).unionByName(offer(spark, LATER, "B", 9, source="official_fallback"))
    assert store(spark, root, both)[LATER, "B"] == ("replace", "official_fallback", "success")
    assert stored(spark, root)[LATER, "B"] == ("official_fallback", 9, 2.0)


def test_outcomes_of_every_batch_are_stored(spark, root):
    both = offer(spark, LATER, "B", 9, source="official_fallback").unionByName(offer(spark, FUTURE, "A", 9))
    for _ in range(2):  # a batch that is run again replaces its outcomes
        N.store_candidates(spark, root, both, "batch-7", expected=F.lit(day(LATER)))
    told = N.stored_outcomes(spark, root).where("batch = 'batch-7'").collect()
    assert sorted((r["etf_code"], r["outcome"], r["inserted"]) for r in told) == [("A", "failed", False), ("B", "success", True)]
    assert {r["outcome_reason"] for r in told} == {None, "source_date_after_expected_data_date"}


def test_a_batch_counts_whole_or_not_at_all(spark, root, monkeypatch):
    before = stored(spark, root)
    monkeypatch.setattr(N.Rebuild, "run", lambda self, *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        N.process_candidates(spark, root, offer(spark, LATER, "B", 9), "x", expected=F.lit(day(LATER)))
    assert stored(spark, root) == before
    assert N.stored_outcomes(spark, root).where("batch = 'x'").count() == 0


def test_a_batch_is_laid_out_by_format(spark, tmp_path):
    schema = "payload_id STRING, etf_code STRING, source_type STRING, format STRING, expected_fund_no STRING, body STRING"
    rows = [("a", "F", "s", "text_block", None, "x"), ("b", "F", "s", "html_table", "N", None), ("c", "F", "s", None, "N", "y"), ("b", "F", "s", "html_table", "N", None)]
    batch = spark.createDataFrame(rows, schema)
    laid = N.by_format(batch, str(tmp_path), "b")
    assert sorted(map(str, laid.select(*batch.columns).collect())) == sorted(map(str, batch.collect()))
    one = laid.where("format = 'text_block'").inputFiles()
    assert one and len(one) < len(laid.inputFiles()) or "format=" in laid.inputFiles()[0]
