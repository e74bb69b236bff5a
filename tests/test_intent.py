
import pytest
from pyspark.sql import functions as F

from build import change, changes, day, rows_by
from tidemark.operators import intent

DAYS = [f"2026-06-{d}" for d in (15, 16, 17, 18, 19)]
FUNDS = {"A1": "A", "A2": "A", "A3": "A", "B1": "B", "C1": "C", "D1": "D", "GONE": "A"}


def run(spark, rows, held_days=DAYS, stocks=("2330",), windows=(5,)):
    """Every fund holds the stocks on the given days; the changes are the given rows."""
    members = spark.createDataFrame(
        [(f, i, day("2020-01-01"), day(DAYS[1]) if f == "GONE" else None) for f, i in FUNDS.items()],
        "etf_code STRING, issuer STRING, eligible_from DATE, eligible_to DATE")
    entries = spark.createDataFrame([(day(d), f) for d in DAYS for f in FUNDS if f != "GONE"], "date DATE, etf_code STRING")
    ranked = spark.createDataFrame(
        [(day(d), f, s, f"N{s}", "stock", FUNDS[f]) for d in held_days for f in FUNDS if f != "GONE" for s in stocks],
        "date DATE, etf_code STRING, stock_code STRING, stock_name STRING, asset_type STRING, issuer STRING")
    diagnostics = spark.createDataFrame([], "date DATE, etf_code STRING, status STRING")
    out = intent.manager_intent(changes(spark, rows), ranked, entries, diagnostics, members, windows)
    return rows_by(out.where(F.col("date") == F.lit(DAYS[-1]).cast("date")), "entity_level", "stock_code", "issuer_key")


def act(i, fund, direction, stock="2330", **over):
    return change(DAYS[i], fund, stock, direction, issuer=FUNDS[fund], **over)


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        # 1001 one add, one reduce, two issuers
        act(4, "A1", "add", "1001"), act(4, "B1", "reduce", "1001"),
        # 1002 two funds of one issuer add on one day
        act(4, "A1", "add", "1002"), act(4, "A2", "add", "1002"),
        # 1003 / 1004 two issuers add / reduce
        act(4, "A1", "add", "1003"), act(4, "B1", "add", "1003"),
        act(4, "A1", "reduce", "1004"), act(4, "B1", "reduce", "1004"),
        # 1005 two issuers add, two reduce
        act(4, "A1", "add", "1005"), act(4, "B1", "add", "1005"), act(4, "C1", "reduce", "1005"), act(4, "D1", "reduce", "1005"),
        # 1006 three adds on a streak
        *[act(i, "A1", "add", "1006", consecutive_active_add_days=3) for i in (2, 3, 4)],
        # 1007 same issuer: two add day one, two reduce day two
        act(3, "A1", "add", "1007"), act(3, "A2", "add", "1007"), act(4, "A1", "reduce", "1007"), act(4, "A2", "reduce", "1007"),
        # 1008 rotation; 1009 rotation with an earlier add
        act(4, "A1", "add", "1008"), act(4, "A2", "reduce", "1008"),
        act(3, "A1", "add", "1009"), act(4, "A1", "add", "1009"), act(4, "A2", "reduce", "1009"),
        # 1010 only after the fund has left
        act(4, "GONE", "add", "1010"),
    ]
    return run(spark, rows, stocks=tuple(str(s) for s in range(1001, 1012)))


def test_net_and_gross(table):
    r = table[("stock", "1001", "")]
    assert (r["cum_active_buy_score"], r["cum_active_sell_score"], r["net_active_score"], r["gross_active_score"], r["net_to_gross"]) == (2, 2, 0, 4, 0)


def test_day_counts(table):
    r = table[("issuer_stock", "1002", "A")]
    assert (r["buy_days"], r["buy_day_pct"], r["buy_etf_count"], r["buy_issuer_count"], r["eligible_days"]) == (1, 0.2, 2, 1, 5)


def test_states(table):
    state = {k: (r["primary_intent_state"], r["net_active_score"], r["gross_active_score"]) for k, r in table.items()}
    assert state[("stock", "1003", "")] == ("accumulation", 4, 4)
    assert state[("stock", "1004", "")] == ("distribution", -4, 4)
    assert state[("stock", "1005", "")] == ("contested", 0, 8)
    assert state[("issuer_stock", "1007", "A")] == ("high_activity_unclear", 0, 8)
    assert state[("issuer_stock", "1008", "A")][0] == "cross_fund_rotation"
    assert state[("issuer_stock", "1009", "A")][:2] == ("cross_fund_rotation_accumulation", 2)
    assert state[("stock", "1011", "")][0] == "neutral" and table[("stock", "1011", "")]["tags"] == []
    rotation, net = table[("issuer_stock", "1008", "A")], table[("issuer_stock", "1009", "A")]
    assert (rotation["rotation_buy_etf_count"], rotation["rotation_sell_etf_count"], rotation["cross_fund_offset_ratio"]) == (1, 1, 1.0)
    assert net["cross_fund_offset_ratio"] == 0.5


def test_streak_score_and_departed_fund(table):
    assert table[("stock", "1006", "")]["cum_active_buy_score"] == 4.5
    assert table[("stock", "1010", "")]["gross_active_score"] == 0


def test_evidence_order(table):
    got = [(str(e["date"]), e["etf_code"]) for e in table[("issuer_stock", "1009", "A")]["evidence"]]
    assert got == [(DAYS[3], "A1"), (DAYS[4], "A1"), (DAYS[4], "A2")]


def test_short_history(spark):
    got = run(spark, [act(4, "A1", "add")], held_days=DAYS[3:])
    assert got[("stock", "2330", "")]["primary_intent_state"] == "insufficient_data"


def test_window_is_checked():
    with pytest.raises(ValueError):
        intent.check_windows([7])
