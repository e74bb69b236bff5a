import datetime as dt

from pyspark.sql import functions as F

from build import SMALL, change, changes, day, history, holdings, non_stock, rows_by, universe
from tidemark.operators import calendar, report, snapshots, universe as U


def profiles(spark, stock, other=()):
    from tidemark.sources.tables import scan_holdings

    return snapshots.snapshot_profile(scan_holdings(holdings(spark, stock), non_stock(spark, other)), params=SMALL)


def test_retirement_candidates(spark):
    funds = universe(spark, [("GONE", "I"), ("STOCK", "I"), ("CASH", "I"), ("FOUND", "I"), ("LATE", "I", "2026-06-20"), ("OUT", "I", "2020-01-01", 0, "trades_offshore_instruments=true"),
                             ("DONE", "I", "2020-01-01", 1)])
    snaps = profiles(spark, [("2026-06-18", "GONE", "2330", 1, 1.0), ("2026-06-19", "FOUND", "2330", 1, 1.0), ("2026-06-20", "STOCK", "2330", 1, 1.0)],
                     [("2026-06-19", "CASH", "Cash", 5, "moneydj_primary")])
    found = spark.createDataFrame([("found",)], "code STRING")
    seen = F.lit("2026-06-20").cast("date")
    markets = spark.createDataFrame([("TWSE",), ("TPEx",)], "market STRING")
    complete = U.discovery_status(markets, markets)
    got = {(r["code"], r["outcome"]) for r in U.retirement_candidates(funds, found, snaps, seen, complete).collect()}
    assert got == {("GONE", "retirement_candidate")}
    partial = U.discovery_status(markets.where("market = 'TWSE'"), markets)
    told = U.retirement_candidates(funds, found, snaps, seen, partial).collect()
    skipped = {r["code"] for r in told if r["outcome"] == "retirement_skipped"}
    assert len(told) == 5 and skipped == {"GONE", "STOCK", "CASH", "LATE", "OUT"}
    one_date = snaps.where("date = date '2026-06-20'")
    assert U.retirement_candidates(funds, found, one_date, seen, complete).count() == 0


def test_upsert_keeps_absent_and_overwrites_present(spark):
    base = universe(spark, [("A", "Old"), ("B", "Keep")])
    updates = spark.createDataFrame([("a", ["issuer", "last_active_date"], None, "New name"), ("c", ["issuer"], "X", None)],
                                    "code STRING, present ARRAY<STRING>, issuer STRING, name STRING")
    now = F.lit("2026-07-01 00:00:00").cast("timestamp")
    got = rows_by(U.universe_upsert(base, updates, now), "code")
    assert got["A"]["issuer"] is None and got["A"]["name"] == "Fund A" and str(got["A"]["created_at"]) == "2026-06-30 12:00:00"
    assert got["B"]["issuer"] == "Keep" and str(got["B"]["updated_at"]) == "2026-06-30 12:00:00"
    assert got["C"]["name"] == "C" and got["C"]["retired"] == 0 and str(got["C"]["created_at"]) == "2026-07-01 00:00:00"


def test_of_several_updates_of_a_code_each_field_takes_the_last(spark):
    base = universe(spark, [("F1", "Old")])
    updates = spark.createDataFrame([(2, "f1", ["issuer"], "Second", None), (1, "F1", ["issuer", "name"], "First", "Named")],
                                    "seq INT, code STRING, present ARRAY<STRING>, issuer STRING, name STRING")
    got = U.universe_upsert(base, updates, F.lit("2026-07-01 00:00:00").cast("timestamp")).collect()
    assert [(r["code"], r["issuer"], r["name"]) for r in got] == [("F1", "Second", "Named")]


def test_discovery(spark):
    rows = [("主動台灣優選", "00980A", None), ("主動全球", "00981A", None), ("主動中國信託台股", "00982A", None), ("主動中國信託成長", "00983A", None),
            ("主動中國", "00984A", None), ("台灣50", "0050A", None), ("主動台灣", "00985B", None), ("主動成長", "00986A", "US海外")]
    listed = spark.createDataFrame([("TWSE", c, n, i) for n, c, i in rows], "market STRING, code STRING, name STRING, isin STRING")
    assert {r["code"] for r in U.discovery_filter(listed).collect()} == {"00980A", "00982A", "00983A"}
    markets = spark.createDataFrame([("TWSE",), ("TPEx",)], "market STRING")
    got = rows_by(U.discovery_status(listed, markets), "market")
    assert got["TWSE"]["completed"] and not got["TPEx"]["completed"] and not got["TWSE"]["discovery_complete"]


def test_cutoff_hour(spark):
    days = spark.createDataFrame([(day("2026-06-10"),), (day("2026-06-24"),)], "date DATE")
    holidays = spark.createDataFrame([(2026, "0619", "holiday")], "year INT, mmdd STRING, kind STRING")
    last = calendar.last_trading_day(calendar.trading_days(calendar.full_calendar(days), holidays))
    # 15:00 in Taipei is 07:00 UTC.
    at = {"before": "2026-06-24 06:59:59", "at": "2026-06-24 07:00:00", "monday": "2026-06-22 06:00:00", "late": "2026-06-23 18:00:00"}
    runs = spark.createDataFrame([(k, dt.datetime.fromisoformat(v)) for k, v in at.items()], "id STRING, run_at TIMESTAMP")
    got = {k: str(r["expected_data_date"]) for k, r in rows_by(calendar.expected_data_date(runs, last), "id").items()}
    assert got == {"before": "2026-06-23", "at": "2026-06-24", "monday": "2026-06-18", "late": "2026-06-23"}
    plain = rows_by(calendar.expected_data_date(runs, None), "id")
    assert str(plain["late"]["expected_data_date"]) == "2026-06-24"


def test_long_closure_has_no_trading_day(spark):
    days = spark.createDataFrame([(day("2026-06-01"),), (day("2026-06-30"),)], "date DATE")
    closed = spark.createDataFrame([(2026, f"06{d:02d}", "holiday") for d in range(10, 31)], "year INT, mmdd STRING, kind STRING")
    last = rows_by(calendar.last_trading_day(calendar.trading_days(calendar.full_calendar(days), closed)), "date")
    assert str(last["2026-06-18"]["last_trading_day"]) == "2026-06-09"
    assert last["2026-06-19"]["last_trading_day"] is None


D = "2026-06-24"


def test_new_positions_need_two_funds(spark):
    rows = [change(D, f, s, "add", is_new_position=1, weight_pct=w, prev_weight_pct=None, position_change_type="new_position")
            for f, s, w in [("A", "2330", 1.25), ("B", "2330", 0.75), ("A", "2454", 3.0)]]
    groups = report.new_position_groups(report.new_positions(changes(spark, rows))).collect()
    assert [(g["stock_code"], g["etf_count"], g["total_weight"], g["etf_codes"]) for g in groups] == [("2330", 2, 2.0, ["A", "B"])]


def test_movers(spark):
    def row(stock, pct, kind):
        return change(D, "A", stock, active_shares_delta_pct_1d=pct, position_change_type=kind, weight_delta_1d=1.0)

    table = changes(spark, [row("1", 15.0, "confirmed_active_add"), row("2", 25.0, "passive_weight_increase"), row("3", 9.99, "confirmed_active_add")])
    assert [r["stock_code"] for r in report.top_movers(table).collect()] == ["1"]


def test_quality_flags(spark):
    funds = [("A", "I"), ("B", "I"), ("NEVER", "I")]
    rows = [("2026-06-20", "A", "2330", 1, 90.0), ("2026-06-20", "B", "2330", 1, 95.0), ("2026-06-21", "A", "2330", 1, 70.0)]
    h = history(spark, rows, funds)
    got = rows_by(h.quality, "date")["2026-06-21"]
    assert (got["expected_count"], got["actual_count"], got["stale_count"], got["unknown_count"]) == (3, 1, 1, 1)
    assert got["status"] == "Degraded" and got["provisional"] == 1 and got["warning_count"] == 2
    last = {r["etf_code"]: r["latest_date"] for r in h.available.where("date = date '2026-06-21'").collect()}
    assert str(last["B"]) == "2026-06-20" and last["NEVER"] is None
