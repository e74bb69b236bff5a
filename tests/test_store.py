"""A transaction counts whole or not at all, wherever it stops."""

import pytest
from build import day

from tidemark.sources import sinks
from tidemark.sources.store import Files, Store

SCHEMA = "date date, etf_code string, stock_code string"


class Crash(Exception):
    pass


def rows(spark, *of):
    return spark.createDataFrame([(day(d), "F", c) for d, c in of], SCHEMA)


def content(spark, root):
    store = Store(spark, root)
    return {t: sorted((str(r["date"]), r["stock_code"]) for r in store.read(t, SCHEMA).collect()) for t in ("a", "b")}


def crashing(monkeypatch, after):
    """Every file operation that changes something counts; the one after ``after`` fails, before or halfway through."""
    left = [after]
    for name in ("write", "rename", "delete"):
        def step(self, *args, do=getattr(Files, name), name=name):
            left[0] -= 1
            if left[0] < 0:
                if name == "write":
                    do(self, args[0], args[1][: len(args[1]) // 2])
                raise Crash(name)
            return do(self, *args)
        monkeypatch.setattr(Files, name, step)
    return left


def test_old_or_new_after_a_crash_anywhere(spark, tmp_path, monkeypatch):
    root, seen = str(tmp_path), set()
    one = ("2026-01-01", "x")
    sinks.replace_dates({"a": (rows(spark, one, ("2026-01-02", "y")), ()), "b": (rows(spark, one), ())}, root)
    old = content(spark, root)
    for steps in range(9):
        for attempt in ("stopped", "again"):
            new_rows = rows(spark, ("2026-01-02", f"{attempt}{steps}"))
            new = {t: [one, ("2026-01-02", f"{attempt}{steps}")] for t in ("a", "b")}
            with monkeypatch.context() as m:
                if attempt == "stopped":
                    crashing(m, steps)
                try:
                    sinks.replace_dates({"a": (new_rows, ()), "b": (new_rows, ())}, root)
                    crashed = False
                except Crash:
                    crashed = True
            got = content(spark, root)
            assert got in (old, new), (steps, attempt)
            seen.add((crashed, got == new))
            old = got
    # Stopped before the manifest was in place, stopped in the clean-up after it, and not stopped at all.
    assert seen == {(True, False), (True, True), (False, True)}


def test_left_overs_go_with_later_commits(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for turn in range(3):
        with monkeypatch.context() as m:
            crashing(m, 0)
            with pytest.raises(Crash):
                sinks.replace_dates({"a": (rows(spark, ("2026-01-01", f"lost{turn}")), ())}, root)
    assert content(spark, root) == {"a": [], "b": []}
    for turn in range(4):
        sinks.replace_dates({"a": (rows(spark, ("2026-01-01", f"{turn}"), ("2026-01-02", f"{turn}")), ())}, root, rows(spark, ("2026-01-03", "")))
    assert content(spark, root)["a"] == [("2026-01-01", "3"), ("2026-01-02", "3")]
    assert len([p for p in (tmp_path / "a").iterdir() if p.name.startswith("gen=")]) == 2
    assert len([p for p in (tmp_path / "_manifest").iterdir() if p.suffix == ".json"]) == 2


def test_a_frame_keeps_the_state_it_was_read_in(spark, tmp_path):
    root = str(tmp_path)
    sinks.replace_dates({"a": (rows(spark, ("2026-01-01", "1")), ())}, root)
    before = Store(spark, root).read("a", SCHEMA)
    sinks.replace_dates({"a": (rows(spark, ("2026-01-01", "2")), ())}, root)
    assert [r["stock_code"] for r in before.collect()] == ["1"]
    assert [r["stock_code"] for r in Store(spark, root).read("a", SCHEMA).collect()] == ["2"]


def test_only_the_wanted_partitions_are_read(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace({"a": (rows(spark, *[(f"2026-01-0{i}", str(i)) for i in range(1, 8)]), ())})
    store.put("whole", rows(spark, ("2026-02-01", "w")))
    assert content(spark, str(tmp_path))["a"] == []  # not committed
    store.commit()
    days = lambda frame: sorted(r["date"].day for r in frame.collect())
    assert days(store.read("a", SCHEMA, first="2026-01-03", last="2026-01-05")) == [3, 4, 5]
    assert days(store.read("a", SCHEMA, values=[day("2026-01-02"), "2026-01-09"])) == [2]
    assert len(store.read("a", SCHEMA, first="2026-01-07").inputFiles()) == 1
    assert store.read("whole", SCHEMA).count() == 1 and store.read("none", SCHEMA).count() == 0


def test_a_second_writer_is_refused(spark, tmp_path):
    one, two = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    for store in (one, two):
        store.replace({"a": (rows(spark, ("2026-01-01", "1")), ())})
    one.commit()
    with pytest.raises(RuntimeError, match="another writer"):
        two.commit()


def test_plain_tables_are_read_as_they_are(spark, tmp_path):
    rows(spark, ("2026-01-01", "1")).write.partitionBy("date").parquet(f"{tmp_path}/a")
    assert content(spark, str(tmp_path))["a"] == [("2026-01-01", "1")]


def test_a_table_of_a_failed_first_run_is_not_read(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace({"a": (rows(spark, ("2026-01-01", "1")), ())})
    assert Store(spark, str(tmp_path)).read("a", SCHEMA).count() == 0
