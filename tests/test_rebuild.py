"""A limited rebuild gives what a whole one gives, and reads no more than a correction can reach."""

import random

import pytest
from build import SMALL, STAMP, day, holdings, universe
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans.rebuild import CHANGES, DIAGNOSTICS, EVIDENCE, SIGNALS, STATE, Rebuild
from tidemark.sources.sinks import day_list, snapshot_frames
from tidemark.sources.store import Store

DATES = [f"2026-{m:02d}-{d:02d}" for m in (3, 4, 5) for d in (2, 9, 16, 23)]
FUNDS = ["F1", "F2", "F3", "F4", "F5"]
SCHEMAS = {CHANGES: schemas.CHANGES, DIAGNOSTICS: schemas.DIAGNOSTICS, STATE: schemas.STREAK_STATE, SIGNALS: schemas.SIGNAL_FACTS, EVIDENCE: schemas.SIGNAL_EVIDENCE}


def snapshot(rng, date, fund, source="moneydj_primary"):
    stocks = [s for s in range(1101, 1109) if rng.random() < 0.85]
    return [(date, fund, str(s), rng.choice([None, 90, 100, 100, 110, 120, 150]), float(rng.randint(1, 9)), source) for s in stocks]


def facts(spark, rows):
    none = spark.createDataFrame([], schemas.NON_STOCK)
    return (holdings(spark, rows) if rows else spark.createDataFrame([], schemas.HOLDINGS)), none


def begin(spark, root, rows, since=None):
    store = Store(spark, root)
    store.replace(snapshot_frames(*facts(spark, rows)))
    store.put("etf_universe", universe(spark, [(f, f"issuer {i}") for i, f in enumerate(FUNDS)]))
    Rebuild(store, SMALL, F.lit(STAMP)).run()
    store.commit()


def correct(spark, root, content, keys):
    """Replace the snapshots of ``keys`` in one transaction and rebuild what they reach."""
    store = Store(spark, root)
    touched = spark.createDataFrame([(day(d), f) for d, f in keys], "date date, etf_code string")
    days = day_list(touched)
    rows = [r for key, rs in content.items() for r in rs if key[0] in days]
    store.replace(snapshot_frames(*facts(spark, rows)), days)
    rebuild = Rebuild(store, SMALL, F.lit(STAMP))
    rebuild.run(touched)
    store.commit()
    return rebuild


def stored(spark, root):
    store = Store(spark, root)
    return {t: sorted(map(str, store.read(t, s).drop("created_at").collect())) for t, s in SCHEMAS.items()}


@pytest.mark.parametrize("seed", range(2))
def test_corrections_equal_a_whole_rebuild(spark, tmp_path, seed):
    rng = random.Random(seed)
    content = {(d, f): snapshot(rng, d, f) for d in DATES[:-1] for f in FUNDS if rng.random() < 0.9}
    begin(spark, f"{tmp_path}/a", [r for rs in content.values() for r in rs])
    for _ in range(2):
        # New content, another source, a late snapshot, one that vanishes, a new date at the end.
        keys = {(rng.choice(DATES), rng.choice(FUNDS)) for _ in range(rng.choice([1, 1, 3]))}
        for key in keys:
            if key in content and rng.random() < 0.25:
                del content[key]
            else:
                content[key] = snapshot(rng, *key, source=rng.choice(["moneydj_primary", "official_fallback"]))
        correct(spark, f"{tmp_path}/a", content, keys)
    begin(spark, f"{tmp_path}/b", [r for rs in content.values() for r in rs])
    got, want = stored(spark, f"{tmp_path}/a"), stored(spark, f"{tmp_path}/b")
    for table in SCHEMAS:
        assert got[table] == want[table], table
    assert len(want[CHANGES]) > 100 and want[SIGNALS] and want[STATE]


def test_a_correction_of_one_fund_reads_and_writes_only_what_it_reaches(spark, tmp_path):
    rng = random.Random(11)
    content = {(d, f): snapshot(rng, d, f) for d in DATES for f in FUNDS}
    begin(spark, str(tmp_path), [r for rs in content.values() for r in rs])
    content[DATES[8], "F3"] = [(*r[:3], r[3], r[4] + 0.5, r[5]) for r in content[DATES[8], "F3"]]
    rebuild = correct(spark, str(tmp_path), content, [(DATES[8], "F3")])
    assert rebuild.first == DATES[7]
    # The weights of one date count on it and on the next one, and in the weight streaks after it.
    assert 0 < len(rebuild.written[CHANGES]) < len(DATES[8:]) + 1 and set(rebuild.written[CHANGES] + rebuild.written[SIGNALS]) <= set(DATES[8:])
    facts_read = rebuild.store.read("etf_daily_holdings", schemas.HOLDINGS, first=rebuild.first)
    assert {f.split("/date=")[1][:10] for f in facts_read.inputFiles()} == set(DATES[7:])


def test_nothing_differs_nothing_is_written(spark, tmp_path):
    rng = random.Random(5)
    content = {(d, f): snapshot(rng, d, f) for d in DATES[:6] for f in FUNDS}
    begin(spark, str(tmp_path), [r for rs in content.values() for r in rs])
    before = Store(spark, str(tmp_path)).state
    rebuild = correct(spark, str(tmp_path), content, [(DATES[3], "F2")])
    after = Store(spark, str(tmp_path)).state
    assert all(rebuild.written[t] == [] for t in (CHANGES, DIAGNOSTICS, STATE)) and SIGNALS not in rebuild.written
    assert all(before[t] == after[t] for t in SCHEMAS)


def test_differing_days_are_found_where_the_rows_lie(spark, monkeypatch, capsys):
    from tidemark.plans import rebuild

    schema = "date date, etf_code string, a int, b int, w double"
    same = [(day(DATES[0]), "F1", 1, 2, 0.5), (day(DATES[0]), "F1", 1, 2, 0.5), (day(DATES[1]), "F2", None, None, None)]
    old = same + [(day(DATES[2]), "F1", 5, None, 1.0), (day(DATES[3]), "F1", 1, 1, 1.0), (day(DATES[4]), "F1", 1, 1, 1.0)]
    new = same + [(day(DATES[2]), "F1", None, 5, 1.0), (day(DATES[3]), "F1", 1, 1, 1.0), (day(DATES[3]), "F1", 1, 1, 1.0), (day(DATES[5]), "F1", 1, 1, 1.0)]
    old, new = spark.createDataFrame(old, schema), spark.createDataFrame(new[::-1], schema)
    seen = []
    monkeypatch.setattr(rebuild, "day_list", lambda frame: seen.append(frame) or day_list(frame))
    assert sorted(rebuild._differing_days(new, old)) == DATES[2:6]
    assert sorted(rebuild._differing_days(new, old, ("a", "b"))) == DATES[3:6]
    seen[0].explain()
    moved = [line for line in capsys.readouterr().out.splitlines() if "hashpartitioning" in line]
    assert moved and not any("etf_code" in line for line in moved)
