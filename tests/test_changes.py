import math
import random

import pytest
from pyspark.sql import functions as F

from build import SMALL, history, rows_by
from tidemark.functions.carried import pack, unpack
from tidemark.operators import changes, signals, snapshots, universe
from tidemark.plans.staging import ROWS_PER_TASK, task_count

DAYS = ["2026-06-20", "2026-06-21", "2026-06-22", "2026-06-23"]
OTHERS = ["2308", "2383", "2454", "3711"]


def fund(code, series):
    """series: stock -> list of (shares, weight) or None per day."""
    return [(DAYS[i], code, stock, *point) for stock, points in series.items() for i, point in enumerate(points) if point]


def flat_others(*shares, weight=10):
    return {s: [(x, weight) for x in shares] for s in OTHERS}


@pytest.fixture(scope="module")
def cases(spark):
    two = {
        "SCALED": {"2330": [(100, 10), (110, 10)], **flat_others(100, 110)},
        "EXCESS": {"2330": [(100, 10), (130, 11)], **flat_others(100, 110)},
        "HIDDEN": {"2330": [(100, 10), (100, 9)], **flat_others(100, 110)},
        "MEDIAN": {"2330": [(100, 10), (200, 12)], **flat_others(100, 110)},
        "NOSCALE": {"2330": [(100, 10), (110, 11)]},
        "SMALLMOVE": {"2330": [(100, 10), (110.5, 10)], **flat_others(100, 110)},
        "MATERIAL": {"2330": [(100, 10), (112, 10.3)], **flat_others(100, 110)},
        "SWAP": {"2330": [(100, 10), (110, 12)], "2308": [(200, 5), (190, 4)], "2383": [(300, 3), None], "6669": [None, (50, 6)]},
        "STREAK": {"2330": [(100, 10), (130, 10.5), (160, 11), (190, 11.5)],
                   **{s: [(x, 10) for x in (100, 110, 121, 133.1)] for s in OTHERS}},
        "GROWING": {s: [(x, 10) for x in (100, 110, 121, 133.1)] for s in ["2330", *OTHERS]},
        "WEIGHTS": {"2330": [(None, 1), (None, 2), (None, 4)], "2317": [(None, 4), (None, 2), (None, 1)]},
        "ORPHAN": {"2330": [(100, 10), (110, 11)]},
    }
    rows = [r for code, series in two.items() for r in fund(code, series)]
    # Every fund reports every day, so that all days are valid.
    for code, series in two.items():
        days = {r[0] for r in rows if r[1] == code}
        rows += [(d, code, s, *points[-1]) for d in DAYS if d not in days for s, points in series.items() if points[-1]]
    funds = [(code, None if code == "ORPHAN" else f"I{code}") for code in two]
    h = history(spark, rows, funds)
    return h, rows_by(h.changes, "date", "etf_code", "stock_code")


def at(cases, code, stock, i=1):
    return cases[1][(DAYS[i], code, stock)]


def test_flow_adjustment(cases):
    scaled = at(cases, "SCALED", "2330")
    assert math.isclose(scaled["etf_scale_factor"], 1.1) and scaled["active_shares_delta_1d"] == 0
    assert scaled["position_change_type"] == "flow_scaled_increase"
    excess = at(cases, "EXCESS", "2330")
    assert math.isclose(excess["active_shares_delta_1d"], 20) and math.isclose(excess["active_shares_delta_pct_1d"], 20 / 110 * 100)
    assert excess["position_change_type"] == "confirmed_active_add"
    hidden = at(cases, "HIDDEN", "2330")
    assert math.isclose(hidden["active_shares_delta_1d"], -10) and hidden["position_change_type"] == "confirmed_active_reduce"
    median = at(cases, "MEDIAN", "2330")
    assert math.isclose(median["etf_scale_factor"], 1.1) and math.isclose(median["active_shares_delta_1d"], 90)
    alone = at(cases, "NOSCALE", "2330")
    assert alone["etf_scale_factor"] is None and alone["active_shares_delta_1d"] == 10
    assert alone["position_change_type"] == "confirmed_active_add"


def test_materiality(cases):
    small, big = at(cases, "SMALLMOVE", "2330"), at(cases, "MATERIAL", "2330")
    assert math.isclose(small["active_shares_delta_pct_1d"], 0.5 / 110 * 100)
    assert small["position_change_type"] == "immaterial_active_increase" and small["is_active_add"] == 0
    assert math.isclose(big["active_shares_delta_pct_1d"], 2 / 110 * 100)
    assert big["position_change_type"] == "confirmed_active_add"


def test_new_removed_kept(cases):
    new, gone, kept = at(cases, "SWAP", "6669"), at(cases, "SWAP", "2383"), at(cases, "SWAP", "2330")
    assert (new["is_new_position"], new["rank"], new["prev_rank"], new["prev_weight_pct"]) == (1, 2, None, None)
    assert (gone["is_removed_position"], gone["weight_pct"], gone["weight_delta_1d"], gone["prev_rank"]) == (1, 0.0, -3.0, 3)
    assert kept["weight_delta_1d"] == 2.0 and kept["shares_delta_1d"] == 10.0
    assert at(cases, "SWAP", "2308")["weight_delta_1d"] == -1.0


def test_streaks(cases):
    assert at(cases, "STREAK", "2330", 3)["consecutive_active_add_days"] == 3
    assert at(cases, "GROWING", "2330", 3)["consecutive_active_add_days"] == 0
    up, down = at(cases, "WEIGHTS", "2330", 2), at(cases, "WEIGHTS", "2317", 2)
    assert (up["consecutive_add_days"], up["consecutive_reduce_days"]) == (2, 0)
    assert (down["consecutive_add_days"], down["consecutive_reduce_days"]) == (0, 2)


def test_streak_signal(cases):
    found = {(r["etf_code"], r["signal_type"]) for r in signals.single_signals(cases[0].changes).collect()}
    assert ("STREAK", "consecutive_add_3d") in found
    assert not any(code in ("GROWING", "SMALLMOVE") for code, _ in found)


def test_missing_issuer_is_empty(cases):
    assert at(cases, "ORPHAN", "2330")["issuer"] == ""


def test_valid_dates(spark):
    funds = [f"F{i:02d}" for i in range(19)]
    counts = {"2026-06-20": 15, "2026-06-21": 16, "2026-06-22": 16}
    rows = [(d, f, "2330", 1, 1.0) for d, n in counts.items() for f in funds[:n]]
    h = history(spark, rows, [(f, "I") for f in funds])
    got = rows_by(h.dates, "date")
    assert {d: r["date_valid"] for d, r in got.items()} == {"2026-06-20": False, "2026-06-21": True, "2026-06-22": True}
    assert str(got["2026-06-22"]["prev_date"]) == "2026-06-21"
    assert got["2026-06-20"]["expected_count"] == 19


def test_partial_source_is_skipped(spark):
    first = [("2026-06-20", "A", f"{1000 + i}", 1, 10.0) for i in range(6)]
    second = [("2026-06-21", "A", "1000", 1, 10.0, "official_static")]
    h = history(spark, first + second, [("A", "I")], params=SMALL.__class__())
    assert h.changes.count() == 0
    row = h.diagnostics.collect()
    assert [r["reason"] for r in row] in ([], ["missing_current_source"])


def test_comparability_thresholds(spark):
    def snapshot(d, code, stocks, source="moneydj_primary"):
        return [(d, code, str(s), 1, 1.0, source) for s in stocks]

    rows = (
        snapshot("2026-06-20", "HALF", range(1000, 1010)) + snapshot("2026-06-21", "HALF", range(1005, 1015))
        + snapshot("2026-06-20", "LESS", range(1000, 1010)) + snapshot("2026-06-21", "LESS", range(1006, 1016))
        + snapshot("2026-06-20", "NINE", range(1000, 1010)) + snapshot("2026-06-21", "NINE", range(1001, 1011), "official_static")
        + snapshot("2026-06-20", "CROSS", range(1000, 1010)) + snapshot("2026-06-21", "CROSS", range(1002, 1012), "official_static")
    )
    h = history(spark, rows, [(c, "I") for c in ("HALF", "LESS", "NINE", "CROSS")])
    got = {k: r["status"] for k, r in rows_by(h.diagnostics, "etf_code").items()}
    assert got == {"HALF": "included", "LESS": "skipped", "NINE": "included", "CROSS": "skipped"}


def brute_streak(points, i, sign, shares):
    """Plain definition: walk back over the fund's own dates."""
    count = 0
    for j in range(i, 0, -1):
        now, before = points[j], points[j - 1]
        if not shares:
            now, before = now or 0.0, before or 0.0
        if now is None or before is None or not sign * (now - before) > 1e-9:
            break
        count += 1
    return count


def test_streaks_against_plain_loops(spark):
    """Random histories with gaps, invalid dates, missing shares and missing scales."""
    rng = random.Random(7)
    days = [f"2026-05-{i:02d}" for i in range(1, 29)]
    funds = [f"R{i:02d}" for i in range(12)]
    stocks = ["1001", "1002", "1003", "1004"]
    absent = {d for d in days[2:] if rng.random() < 0.2}
    rows = []
    for f in funds:
        for d in days:
            if d in absent and funds.index(f) % 2:
                continue
            for s in stocks:
                if rng.random() < 0.85:
                    shares = None if rng.random() < 0.1 else rng.choice([100, 101, 110, 121, 130])
                    rows.append((d, f, s, shares, rng.choice([1.0, 2.0, 3.0])))
    h = history(spark, rows, [(f, "I") for f in funds])
    valid = {str(r["date"]): (r["date_valid"], str(r["prev_date"]) if r["prev_date"] else None) for r in h.dates.collect()}
    assert any(not v for v, _ in valid.values())
    held = {(d, f, s): (sh, w) for d, f, s, sh, w in rows}
    own = {f: [d for d in days if any((d, f, s) in held for s in stocks)] for f in funds}
    got = rows_by(h.changes, "date", "etf_code", "stock_code")
    assert len(got) > 500
    flow = {}
    for (d, f, s), row in sorted(got.items()):
        i = own[f].index(d)
        weights = [held[(x, f, s)][1] if (x, f, s) in held else None for x in own[f]]
        shares = [held[(x, f, s)][0] if (x, f, s) in held else None for x in own[f]]
        for side, sign in (("add", 1), ("reduce", -1)):
            assert row[f"consecutive_{side}_days"] == brute_streak(weights, i, sign, False), (d, f, s)
            by_shares = brute_streak([None if x is None else float(x) for x in shares], i, sign, True)
            before = flow.get((valid[d][1], f, s, side))
            if row["etf_scale_factor"] is None:
                want = by_shares
            elif not row[f"is_active_{side}"]:
                want = 0
            else:
                want = before[1] + 1 if before and before[0] else 1
            assert row[f"consecutive_active_{side}_days"] == want, (d, f, s, side)
            flow[(d, f, s, side)] = (row[f"is_active_{side}"], want)


def test_order_and_partitions_do_not_matter(spark, cases):
    h, expected = cases
    shuffled = h.tables.holdings.orderBy(F.rand(3)).repartition(13)
    other = history(spark, [], [], params=SMALL)
    other.tables = h.tables.__class__(shuffled, h.tables.non_stock, h.tables.universe)
    assert rows_by(other.changes, "date", "etf_code", "stock_code") == expected


def test_coverage_sweep_equals_grid(spark):
    funds = [("A", "I", "2026-06-20", 0, None), ("B", "I", "2026-06-22", 0, None), ("C", "I", "2026-06-19", 1, None),
             ("D", "I", "2026-06-20", 0, "excluded_from_taiwan_stock_universe"), ("E", "I", None, 0, "x")]
    rows = [(d, c, "2330", 1, 1.0) for d in DAYS for c in "ABDE"] + [(d, "C", "2330", 1, 1.0) for d in DAYS[:2]]
    h = history(spark, rows, funds)
    grid = {str(r["date"]): r["n"] for r in h.eligible.groupBy("date").agg(F.count("*").alias("n")).collect()}
    sweep = {str(r["date"]): r["expected_count"] for r in h.coverage.collect()}
    assert sweep == grid == {DAYS[0]: 2, DAYS[1]: 2, DAYS[2]: 2, DAYS[3]: 2}
    assert universe.missing_funds(h.eligible, h.entries).count() == 0


def test_held_rows_move_once_on_the_way_to_changes(spark, capsys):
    h = history(spark, fund("A", {"2330": [(100, 10), (110, 10)], **flat_others(100, 110)}), [("A", "I")])
    ranked, dates = (spark.createDataFrame([], f.schema) for f in (h.ranked, h.dates))
    changes.holding_changes(ranked, dates).explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1


def test_tasks_grow_with_the_rows(spark):
    assert [task_count(n) for n in (None, 0, 1, ROWS_PER_TASK, ROWS_PER_TASK + 1)] == [1, 1, 1, 1, 2]
    rows = spark.range(100).selectExpr("cast(id as string) as etf_code")
    assert snapshots.by_fund(rows, 7).rdd.getNumPartitions() == 7


def test_windows_hand_on_other_columns_in_one_piece(spark, capsys):
    h = history(spark, fund("A", {"2330": [(100, 10), (110, 10)], **flat_others(100, 110)}), [("A", "I")])
    ranked, dates = (spark.createDataFrame([], f.schema) for f in (h.ranked, h.dates))
    changes.holding_changes(ranked, dates).explain()
    plan = capsys.readouterr().out
    sorts = [line for line in plan.splitlines() if "Sort [etf_code" in line]
    below = plan[plan.index(sorts[-1]):].splitlines()[1]
    assert "AS carried#" in below and "confidence#" not in below.split("struct(")[0]
    assert "max(prev_date" not in plan


def test_packed_columns_come_back(spark):
    rows = spark.createDataFrame([(1, "x", None), (2, None, 3.0)], "a int, b string, c double")
    assert pack(rows, ("a",)).columns == ["a", "carried"]
    assert unpack(pack(rows, ("a",))).exceptAll(rows).count() == 0 == rows.exceptAll(unpack(pack(rows, ("a",)))).count()
    assert pack(rows, rows.columns).columns == rows.columns
