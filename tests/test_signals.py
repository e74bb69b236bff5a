from types import SimpleNamespace

import pytest

from build import change, changes, rows_by
from tidemark.operators import report, signals
from tidemark.params import DEFAULT
from tidemark.plans.backfill import range_signals

D = ["2026-06-21", "2026-06-22", "2026-06-23", "2026-06-24"]


def acts(stock, plan):
    """plan: date -> list of (issuer, direction or None)."""
    return [
        change(d, f"{issuer}{stock}", stock, direction, issuer=issuer)
        for d, events in plan.items() for issuer, direction in events
    ]


@pytest.fixture(scope="module")
def table(spark):
    quiet = [(i, None) for i in "AB"]
    both = [(i, "add") for i in "AB"]
    rows = (
        acts("NEW1", {D[2]: [("A", "add")], D[3]: [("B", "add")]})
        + acts("PERS", {D[2]: both, D[3]: both})
        + acts("FADE", {D[0]: [(i, "add") for i in "ABCD"], D[1]: both, D[2]: both, D[3]: both})
        + acts("STAL", {D[0]: both, D[1]: quiet, D[2]: quiet})
        + acts("REVE", {D[0]: [(i, "reduce") for i in "AB"], D[1]: quiet, D[2]: both})
        + acts("ONE1", {D[3]: [("A", "add")]})
        + [change(D[3], "C1", "NOIS", "add", issuer=""), change(D[3], "C2", "NOIS", "add", issuer="A")]
        + [
            change(D[3], "X", "6669", "add", is_new_position=1, weight_pct=3.2, prev_weight_pct=None, position_change_type="new_position"),
            change(D[3], "X", "2383", "reduce", is_removed_position=1, weight_pct=0.0, prev_weight_pct=3.5, position_change_type="removed_position"),
            change(D[3], "X", "2308", "add", is_new_position=1, weight_pct=1.9, prev_weight_pct=None, position_change_type="new_position"),
        ]
    )
    return changes(spark, rows).persist()


def test_freshness(table):
    got = {(str(r["date"]), r["stock_code"], r["signal_type"]): r for r in signals.signal_facts(table).collect() if r["signal_type"].startswith("consensus")}
    assert got[(D[3], "NEW1", "consensus_add_3d")]["signal_freshness"] == "new"
    assert got[(D[3], "PERS", "consensus_add_3d")]["signal_freshness"] == "persistent"
    fading = got[(D[3], "FADE", "consensus_add_3d")]
    assert fading["signal_freshness"] == "fading" and fading["freshness_reason"] == "issuer count declined from 4 to 2"
    assert got[(D[2], "STAL", "consensus_add_3d")]["signal_freshness"] == "stale"
    assert got[(D[2], "REVE", "consensus_add_3d")]["signal_freshness"] == "reversal"
    assert not any(stock in ("ONE1", "NOIS") for _, stock, _ in got)
    assert got[(D[2], "FADE", "consensus_add_3d")]["signal_score"] == 6.0 and fading["signal_score"] == 4.0


def test_core_positions(table):
    got = {(r["stock_code"], r["signal_type"], r["signal_score"]) for r in signals.single_signals(table).collect()}
    assert got == {("6669", "new_core_position", 4.0), ("2383", "removed_core_position", -5.0)}


def test_ids_lists_and_evidence(table):
    rows = rows_by(signals.manager_signals(table), "signal_id")
    one = rows[f"{D[3]}:consensus_add_3d:PERS:APERS-BPERS"]
    assert one["etf_codes"] == ["APERS", "BPERS"] and one["issuers"] == ["A", "B"]
    assert [str(e["date"]) for e in one["evidence"]] == [D[2], D[2], D[3], D[3]]
    stored = signals.to_storage(signals.manager_signals(table)).first()
    assert '"prev_weight_pct"' in stored["evidence_json"]


def test_long_evidence_equals_lists(table):
    long_rows = signals.signal_evidence(table).count()
    assert long_rows == sum(len(r["evidence"]) for r in signals.manager_signals(table).collect())


def test_ranking_and_sections(spark):
    base = dict(date="2026-06-24", stock_name="n", etf_count=1, issuer_count=3, confidence="high", freshness_reason="", avg_active_pct=None, explanation="")
    rows = [
        dict(base, signal_type="consensus_add_3d", signal_score=s, stock_code=c, signal_freshness=f)
        for s, c, f in [(6.0, "B", "persistent"), (5.0, "C", "new"), (-6.0, "A", "new"), (-5.0, "D", "new"), (6.0, "E", "reversal"), (6.0, "F", "stale")]
    ] + [dict(base, signal_type="consensus_add_3d", signal_score=6.0, stock_code=f"N{i:02d}", signal_freshness="new") for i in range(10)]
    names = list(rows[0])
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows],
        "date STRING, stock_name STRING, etf_count INT, issuer_count INT, confidence STRING, freshness_reason STRING, avg_active_pct DOUBLE, "
        "explanation STRING, signal_type STRING, signal_score DOUBLE, stock_code STRING, signal_freshness STRING")
    ranked = [r["stock_code"] for r in report.signal_ranking(df).collect()]
    assert ranked == ["A", *[f"N{i:02d}" for i in range(10)], "E", "B", "F"]
    sections = report.signal_sections(df).collect()
    first = [r for r in sections if r["section"] == 1]
    assert len(first) == 8 and {r["remaining"] for r in first} == {3}
    assert {r["section"] for r in sections} == {1, 2, 3, 4}
    summary = report.signal_summary(df).first()
    assert (summary["fresh_consensus"], summary["reversals"], summary["persistent_consensus"], summary["stale_or_fading"]) == (11, 1, 1, 1)


def test_evidence_moves_events_before_they_are_laid_out(spark, table, capsys):
    rows = spark.createDataFrame([], table.schema)
    signals.signal_evidence(rows).explain()
    plan = capsys.readouterr().out.splitlines()
    # In the plan an operator stands above its input: no exchange of whole events may have a Generate over windows below it.
    wide = [line for line in plan if "Generate" in line and "sequence" in line and "prev_weight_pct" in line]
    assert not wide


def test_lists_of_a_range_and_in_tasks_equal_those_of_all_dates(table):
    whole = {r["signal_id"]: r for r in signals.manager_signals(table).collect()}
    assert {r["signal_id"]: r for r in signals.manager_signals(table, tasks=3).collect()} == whole
    history = SimpleNamespace(changes=table, params=DEFAULT, tasks=2)
    told = range_signals(history, D[3], D[3])
    assert {r["signal_id"]: r for r in told.where(f"date = '{D[3]}'").collect()} == {k: r for k, r in whole.items() if str(r["date"]) == D[3]}
    early = range_signals(history, D[0], D[0])
    assert {r["signal_id"] for r in early.collect()} == {k for k, r in whole.items() if str(r["date"]) == D[0]}


def test_lists_keep_their_number_of_tasks(table, capsys):
    signals.manager_signals(table, tasks=37).explain()
    assert "direction#" in (plan := capsys.readouterr().out) and ", 37)" in plan
