import math

from pyspark.sql import functions as F

from build import day, holdings, rows_by
from tidemark import schemas
from tidemark.operators import ingest, snapshots

D = "2026-06-20"


def candidate(cid, n=5, **over):
    rows = []
    for i in range(n):
        row = dict(date=D, etf_code="A", asset_type="stock", stock_code=f"{1000 + i}", stock_name="N", shares=1.0,
                   weight_pct="10", source_type="moneydj_primary")
        for key, value in over.items():
            if i == 0 or key in ("asset_type_all",):
                row[key.replace("_all", "")] = value
        rows.append(row)
    names = schemas.columns(schemas.CANDIDATES)
    return [tuple(dict(r, candidate_id=cid, run_date=day(D), asset_name="x", source_url="", extraction_method="t")[n] for n in names) for r in rows]


def test_first_failing_rule_wins(spark):
    cases = {
        "ok": candidate("ok"),
        "missing_weight_pct": candidate("missing_weight_pct", weight_pct=None),
        "invalid_weight_pct": candidate("invalid_weight_pct", weight_pct="abc"),
        "not_finite": candidate("not_finite", weight_pct="NaN"),
        "missing_or_unparseable_date": candidate("missing_or_unparseable_date", date="20260620"),
        "inconsistent_dates": candidate("inconsistent_dates", date="2026/06/21"),
        "inconsistent_etf_codes": candidate("inconsistent_etf_codes", etf_code=""),
        "inconsistent_source_types": candidate("inconsistent_source_types", source_type="official_static"),
        "fewer_than_5_rows": candidate("fewer_than_5_rows", n=4),
        "fewer_than_5_taiwan_stock_rows": candidate("fewer_than_5_taiwan_stock_rows", asset_type="cash"),
        "invalid_taiwan_stock_row": candidate("invalid_taiwan_stock_row", stock_code="233"),
        "blank_name": candidate("blank_name", stock_name="  "),
        "duplicate_stock_codes": candidate("duplicate_stock_codes", stock_code="1001"),
        "two_faults": candidate("two_faults", n=3, weight_pct=None),
    }
    rows = spark.createDataFrame([r for c in cases.values() for r in c], schemas.CANDIDATES)
    headers = rows.select("candidate_id").union(spark.createDataFrame([("empty_rows",)], "candidate_id STRING"))
    got = rows_by(snapshots.snapshot_profile(rows, ["candidate_id"], headers=headers), "candidate_id")
    aliases = {"not_finite": "invalid_weight_pct", "blank_name": "invalid_taiwan_stock_row", "two_faults": "missing_weight_pct"}
    for name in [*cases, "empty_rows"]:
        assert got[name]["reason"] == aliases.get(name, name)
        assert got[name]["valid"] == (name == "ok")
    assert got["ok"]["total_weight"] == 50.0 and got["ok"]["shares_coverage"] == 1.0
    assert got["fewer_than_5_taiwan_stock_rows"]["non_stock_count"] == 1


def test_profile_keeps_no_ends_of_its_key_and_sorts_by_fund_first(spark):
    rows = spark.createDataFrame(
        [(None if n < 6 else day(D), fund, "stock", f"{1000 + n % 6}", "N", 1.0, 10.0, "official_static")
         for fund in ("A", None) for n in range(12)],
        "date DATE, etf_code STRING, asset_type STRING, stock_code STRING, stock_name STRING, shares DOUBLE, weight_pct DOUBLE, source_type STRING",
    )
    got = snapshots.snapshot_profile(rows)
    assert got.columns[:3] == list(snapshots.SNAPSHOT)
    assert {(r["date"], r["etf_code"]): r["reason"] for r in got.collect()} == {
        (day(D), "A"): "ok", (None, "A"): "missing_or_unparseable_date", (day(D), None): "inconsistent_etf_codes",
        (None, None): "missing_or_unparseable_date",
    }
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [etf_code" in plan and "first_etf" not in plan and "first_date" not in plan
    # Without these columns in the key the ends are still compared.
    by_source = snapshots.snapshot_profile(rows.where("etf_code = 'A'"), ["source_type"])
    assert "first_etf" in by_source._jdf.queryExecution().analyzed().toString()


def profile(spark, fund, source, stocks, weight=10.0, shares=True):
    return [(D, fund, f"{1000 + i}", 1 if shares else None, weight, source) for i in range(stocks)]


def test_arbitration(spark):
    stored = holdings(spark, (
        profile(spark, "UP", "official_fallback", 5) + profile(spark, "KEEP", "moneydj_primary", 5)
        + profile(spark, "WEAK", "moneydj_primary", 4) + profile(spark, "SAME", "moneydj_primary", 6)
    ))
    incoming = holdings(spark, (
        profile(spark, "UP", "moneydj_primary", 5) + profile(spark, "KEEP", "official_fallback", 9)
        + profile(spark, "WEAK", "official_fallback", 5) + profile(spark, "SAME", "moneydj_primary", 5)
        + profile(spark, "BAD", "moneydj_primary", 2)
    )).withColumn("run_date", F.col("date")).withColumn("candidate_id", F.col("etf_code"))
    canonical = snapshots.canonical_snapshot(snapshots.snapshot_profile(stored))
    profiles = ingest.candidate_profiles(incoming)
    got = {k: r["decision"] for k, r in rows_by(snapshots.arbitrate(profiles, canonical), "etf_code").items()}
    assert got == {
        "UP": "replace", "KEEP": "existing_higher_priority_source_preserved", "WEAK": "replace", "SAME": "replace",
        "BAD": "invalid_snapshot:fewer_than_5_rows",
    }
    decisions = snapshots.arbitrate(profiles, canonical)
    merged = ingest.merge_snapshots(stored, incoming, decisions).groupBy("etf_code", "source_type").count()
    assert {(r["etf_code"], r["source_type"], r["count"]) for r in merged.collect()} == {
        ("UP", "moneydj_primary", 5), ("KEEP", "moneydj_primary", 5), ("WEAK", "official_fallback", 5), ("SAME", "moneydj_primary", 5),
    }


def test_preserving_drops_the_weaker_stored_source(spark):
    stored = holdings(spark, profile(spark, "A", "moneydj_primary", 5) + profile(spark, "A", "official_static", 5))
    incoming = holdings(spark, profile(spark, "A", "official_fallback", 5)).withColumn("run_date", F.col("date")).withColumn("candidate_id", F.lit("c"))
    canonical = snapshots.canonical_snapshot(snapshots.snapshot_profile(stored))
    decisions = snapshots.arbitrate(ingest.candidate_profiles(incoming), canonical)
    left = {r["source_type"] for r in ingest.merge_snapshots(stored, incoming, decisions).collect()}
    assert left == {"moneydj_primary"}


def test_equivalence_boundary(spark):
    def total(fund, extra):
        return [(D, fund, f"{1000 + i}", 1, 10.0 + (extra if i == 0 else 0)) for i in range(5)]

    stored = holdings(spark, total("JUST", 0) + total("ONE", 0))
    incoming = holdings(spark, total("JUST", 0.99) + total("ONE", 1.0)).withColumn("run_date", F.col("date")).withColumn("candidate_id", F.col("etf_code"))
    canonical = snapshots.canonical_snapshot(snapshots.snapshot_profile(stored))
    got = rows_by(snapshots.equivalence(ingest.candidate_profiles(incoming), canonical), "etf_code")
    assert got["JUST"]["equivalent"] is True and got["ONE"]["equivalent"] is False
    assert math.isclose(got["ONE"]["weight_delta_pct_points"], 1.0)


def test_canonical_prefers_priority_then_size(spark):
    rows = profile(spark, "A", "official_static", 9) + profile(spark, "A", "official_fallback", 5) + profile(spark, "A", "official_browser", 5, shares=False)
    best = snapshots.canonical_snapshot(snapshots.snapshot_profile(holdings(spark, rows))).first()
    assert best["source_type"] == "official_fallback"


def test_oversized_snapshot_changes_nothing(spark):
    """Most rows in one invalid snapshot: they leave with their verdict, whatever their number."""
    good = [(D, f"F{k}", f"{1000 + i}", i, 1.0) for k in range(40) for i in range(50)]
    huge = spark.range(12_000).select(F.lit(D).cast("date").alias("date"), F.lit("HOT").alias("etf_code"), F.lit("x").alias("asset_name"),
        F.lit("stock").alias("asset_type"), F.lpad((F.col("id") % 10_000).cast("string"), 4, "0").alias("stock_code"), F.lit("n").alias("stock_name"),
        F.lit(1.0).alias("shares"), F.lit(0.01).alias("weight_pct"), F.lit("").alias("source_url"), F.lit("moneydj_primary").alias("source_type"),
        F.lit("t").alias("extraction_method"), F.current_timestamp().alias("scraped_at"))
    rows = holdings(spark, good).unionByName(huge)
    profiles = snapshots.snapshot_profile(rows).persist()
    assert rows_by(profiles, "etf_code")["HOT"]["reason"] == "duplicate_stock_codes"
    canonical = snapshots.canonical_snapshot(profiles)
    ranked = snapshots.ranked_holdings(rows, canonical)
    assert ranked.count() == 2000 and ranked.where("etf_code = 'HOT'").count() == 0
    assert ranked.exceptAll(snapshots.ranked_holdings(holdings(spark, good), canonical)).count() == 0


def test_ranks_move_rows_once_and_send_no_entries_through_the_driver(spark, capsys, tmp_path):
    rows = holdings(spark, [(D, "A", f"{1000 + i}", i, 1.0) for i in range(6)])
    snapshots.canonical_snapshot(snapshots.snapshot_profile(rows)).write.parquet(f"{tmp_path}/entries")
    ranked = snapshots.ranked_holdings(rows, spark.read.parquet(f"{tmp_path}/entries"), tasks=50)
    ranked.explain()
    plan = capsys.readouterr().out
    assert "Broadcast" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert [r["stock_code"] for r in ranked.orderBy("rank").collect()] == [f"{1000 + i}" for i in range(6)]


def test_codes_are_read_once_a_row(spark, capsys):
    snapshots.snapshot_profile(holdings(spark, [(D, "A", "2330", 1, 1.0)])).explain()
    plan = capsys.readouterr().out
    assert "partial_collect_set(code_number#" in plan and plan.count("[0-9]{4}") == 1
