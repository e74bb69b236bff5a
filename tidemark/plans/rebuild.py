"""Recomputing stored tables only where a correction can reach.

A correction changes snapshots of some funds on some dates. What depends on them:

* the profile of the touched dates, and with it canonical entries and the date dimension. Both come
  from the stored profiles (one row per snapshot), before and after; their differences are the start;
* changes of a fund from its first differing date on: its pairs there, the pairs that look back to
  them, and the streaks that run through them. If the validity or the previous date of any date
  differs, all funds from that date on;
* signals of the dates whose window, or the one before it, holds a date with differing changes.

Streaks go on from stored counts: of the fund's own last date before the start, and of the last valid
date before it. So facts are read from the earlier of these two dates on, of the funds concerned, and
of later dates only those are written again on which a row of the fund really differs. With nothing
stored, everything differs and the rebuild is a whole one. Nothing counts before the caller commits.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable
from datetime import date as Day

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import changes as C
from tidemark.operators import snapshots as P
from tidemark.operators.signals import listed_signals, signal_evidence, signal_facts
from tidemark.operators.streaks import held_seeds, linked_seeds, with_streaks
from tidemark.params import DEFAULT, Params
from tidemark.plans.history import History
from tidemark.plans.staging import Staging, task_count
from tidemark.sources.sinks import day_list
from tidemark.sources.store import Store
from tidemark.sources.tables import Tables, scan_holdings, stored_tables

FEW_FUNDS = 1000  # up to so many fund codes become a filter of the scan
CHANGES, DIAGNOSTICS = "etf_holding_changes", "etf_change_diagnostics"
SIGNALS, EVIDENCE = "etf_signal_facts", "etf_signal_evidence"  # in long form: no row is as long as a list of funds
PROFILES, STATE, USED = "etf_snapshots", "etf_streak_state", "etf_universe_used"


def _from_profiles(tables: Tables, profiles: DataFrame, params: Params, staging: Staging) -> History:
    """The derivation whose snapshot level is the stored profiles."""
    history = History(tables, params, staging)
    history.__dict__["snapshots"] = profiles
    return history


def _differing(a: DataFrame, b: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys whose values differ between two frames, or that only one of them has."""
    left, right = (f.select(*keys, F.struct(*values).alias(side)) for f, side in ((a, "left"), (b, "right")))
    return left.join(right, keys, "full").where(~F.col("left").eqNullSafe(F.col("right"))).select(*keys)


def _differing_days(new: DataFrame, old: DataFrame, ignore: tuple[str, ...] = ()) -> list[str]:
    """Dates on which two frames of one table do not hold the same rows.

    Rows are told apart by 128 bits of hash over all their columns and by which of them are null. The sums of a date
    are made inside each task, so no row moves.
    """
    columns = [c for c in new.columns if c not in ignore]
    # Shares and weights may differ in the last bit only if their inputs do: rows are compared as they are.
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    hashes = [F.xxhash64(F.lit(seed), nulls, *columns) for seed in (1, 2)]
    # Halves of a hash, so that a sum of long integers holds two thousand million of them.
    halves = [h.alias(f"h{i}") for i, h in enumerate(
        x for h in hashes for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))))]
    sides = [f.select("date", F.lit(n).cast("bigint").alias("n"), *halves) for f, n in ((new, 1), (old, -1))]
    sums = sides[0].unionByName(sides[1]).groupBy("date").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col(f"h{i}")).alias(f"h{i}") for i in range(len(halves))])
    return day_list(sums.where(" OR ".join(f"{c} <> 0" for c in sums.columns if c != "date")).select("date"))


def _previous(starts: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """``starts (..., start)`` with ``before``, the last ``date`` of ``known`` under the same key before the start."""
    marks = known.select(*key, "date", F.col("date").alias("seen"), F.lit(0).alias("asked"))
    asked = starts.select(*key, F.col("start").alias("date"), F.lit(None).cast("date").alias("seen"), F.lit(1).alias("asked")).distinct()
    window = W.partitionBy(*key).orderBy("date", F.desc("asked")).rowsBetween(W.unboundedPreceding, -1)
    found = marks.unionByName(asked).withColumn("before", F.max("seen").over(window)).where("asked = 1")
    return starts.join(found.select(*key, F.col("date").alias("start"), "before"), [*key, "start"], "left")


class Rebuild:
    """One limited rebuild inside the transaction of ``store``."""

    def __init__(self, store: Store, params: Params = DEFAULT, created_at: Column | None = None):
        self.store, self.params, self.spark = store, params, store.spark
        self.created_at = F.current_timestamp() if created_at is None else created_at
        # Before, after, and the rebuild itself keep frames of the same names.
        self.stagings = [Staging(store.spark) for _ in range(3)]
        self.staging = self.stagings[-1]
        self.first: str | None = None  # of the facts that were read
        self.written: dict[str, list[str]] = {}

    def run(self, touched: DataFrame | None = None, since: str | None = None, signals: bool = True) -> None:
        """``touched``: (date, etf_code) whose stored snapshots were replaced in this transaction, all dates if not
        given. ``since``: recompute every fund from this date on, whether anything differs or not."""
        try:
            days = self.store_profiles(touched)
            starts = self.starts(touched, since)
            if starts is not None:
                old_days = self.store.parts(CHANGES)
                changed = self.positions(starts)
                if signals:
                    self.signals(changed, old_days)
            elif signals and SIGNALS not in self.store.state:
                self.signals(self.store.parts(CHANGES), [])
            self.written[PROFILES] = days
            self.store.put(USED, self.store.read("etf_universe", schemas.UNIVERSE))
        finally:
            for staging in self.stagings:
                staging.release()

    def _profiles(self) -> DataFrame:
        return self.store.read(PROFILES, schemas.SNAPSHOTS)

    def store_profiles(self, touched: DataFrame | None) -> list[str]:
        """Profile the touched dates anew; keeps the dimension before and after."""
        universe = self.store.read("etf_universe", schemas.UNIVERSE)
        used = self.store.read(USED, schemas.UNIVERSE)
        before = self.staging.keep(self._profiles(), "profiles-before")
        days = None if touched is None or PROFILES not in self.store.state else day_list(touched)
        facts = stored_tables(self.store, values=days)
        fresh = P.snapshot_profile(scan_holdings(facts.holdings, facts.non_stock), params=self.params)
        columns = schemas.columns(schemas.SNAPSHOTS)
        gone = self.store.parts(PROFILES) if days is None else days
        self.store.replace({PROFILES: (fresh.select(*columns), ("etf_code",))}, gone)
        none = Tables(facts.holdings.limit(0), facts.non_stock.limit(0), universe)
        self.old = _from_profiles(Tables(none.holdings, none.non_stock, used), before, self.params, self.stagings[0])
        self.new = _from_profiles(none, self.staging.keep(self._profiles(), "profiles-after"), self.params, self.stagings[1])
        return gone

    def starts(self, touched: DataFrame | None, since: str | None) -> DataFrame | None:
        """(etf_code, start): the first date from which each fund concerned is computed again; None if there is none."""
        values = [c for c in self.new.entries.columns if c not in ("date", "etf_code", "ti")]
        funds = _differing(self.new.entries, self.old.entries, ["date", "etf_code"], values)
        if touched is not None:  # rows may differ where every measure of the snapshot is the same
            funds = funds.unionByName(touched.select("date", "etf_code"))
        dates = _differing(self.new.dates, self.old.dates, ["date"], ["has_holdings", "date_valid", "prev_date"])
        everyone = dates.agg(F.min("date").alias("d")).first()["d"]
        if since is not None:
            everyone = min(Day.fromisoformat(since), everyone or Day.max)
        starts = funds.groupBy("etf_code").agg(F.min("date").alias("start"))
        if everyone is not None:
            every = self.new.entries.select("etf_code").union(self.old.entries.select("etf_code")).distinct()
            starts = starts.unionByName(every.withColumn("start", F.lit(everyone))).groupBy("etf_code").agg(F.min("start").alias("start"))
        starts = _previous(starts, self.new.entries, ["etf_code"]).withColumnRenamed("before", "own")
        starts = _previous(starts, self.new.dates.where("date_valid").select("date"), []).withColumnRenamed("before", "valid")
        starts = self.staging.keep(starts.withColumn("lower", F.least("start", "own", "valid")), "starts")
        self.first = starts.agg(F.min("lower").cast("string").alias("d")).first()["d"]
        return starts if self.first is not None else None

    def _of_funds(self, frame: DataFrame, starts: DataFrame) -> DataFrame:
        """Rows of the funds concerned; few of them are told to the scan."""
        few = [r["etf_code"] for r in starts.select("etf_code").limit(FEW_FUNDS + 1).collect()]
        if len(few) <= FEW_FUNDS:
            frame = frame.where(F.col("etf_code").isin(few))
        return frame.join(starts, "etf_code")

    def positions(self, starts: DataFrame) -> list[str]:
        """Changes, diagnostics and streak state of the funds concerned; the dates with differing changes."""
        store, dates, first_start = self.store, self.new.dates, starts.agg(F.min("start").cast("string").alias("d")).first()["d"]
        entries = self._of_funds(self.new.entries, starts).where("date >= lower")
        entries = self.staging.keep(entries.select(*self.new.entries.columns), "entries-concerned")
        facts = self._of_funds(store.read("etf_daily_holdings", schemas.HOLDINGS, first=self.first), starts).where("date >= lower")
        tasks = task_count(entries.agg(F.sum("row_count").alias("n")).first()["n"])
        ranked = self.staging.keep(P.ranked_holdings(facts.drop(*[c for c in starts.columns if c != "etf_code"]), entries, tasks), "ranked-concerned")
        begun = starts.select("etf_code", "start")
        paired = C.paired_positions(ranked, dates, tasks).join(begun, "etf_code").where("date >= start").drop("start")
        timed = self.staging.keep(with_streaks(
            C.with_position_change(C.with_fund_measures(paired, self.params), self.params), self.params, self.seeds(ranked, starts)), "timed")
        ratios = C.pair_ratios(timed, self.params)  # every paired row is among them
        diagnosed = C.change_diagnostics(entries, dates, ratios, self.created_at).join(begun, "etf_code").where("date >= start")
        kinds = ("consecutive_add_days", "consecutive_reduce_days", "share_add_days", "share_reduce_days")
        state = timed.where((F.col("in_now") == 1) & (F.greatest(*kinds) > 0)).select(
            "date", "etf_code", "stock_code", *[F.col(c).cast("int").alias(k) for c, k in zip(kinds, ("wa", "wr", "sa", "sr"))])
        self._merge(STATE, state, schemas.STREAK_STATE, begun, first_start, ("etf_code", "stock_code"))
        self._merge(DIAGNOSTICS, diagnosed, schemas.DIAGNOSTICS, begun, first_start, ("etf_code",), ignore=("created_at",))
        return self._merge(CHANGES, C.compared_rows(timed), schemas.CHANGES, begun, first_start, ("etf_code", "stock_code"))

    def seeds(self, ranked: DataFrame, starts: DataFrame) -> tuple[DataFrame, ...]:
        """What is stored of the last own and the last valid date before each fund's start."""
        own, valid = (starts.where(f"{c} IS NOT NULL").select("etf_code", F.col(c).alias("date")) for c in ("own", "valid"))
        counts = self.store.read(STATE, schemas.STREAK_STATE, values=day_list(own))
        key = ["date", "etf_code", "stock_code"]
        kept = ranked.join(own, ["date", "etf_code"]).join(counts, key, "left").select(
            *key, "ti", F.col("weight_pct").alias("now_weight"), "shares", *[F.coalesce(k, F.lit(0)).alias(k) for k in ("wa", "wr", "sa", "sr")])
        linked = self.store.read(CHANGES, schemas.CHANGES, values=day_list(valid)).join(valid, ["date", "etf_code"])
        indexed = linked.join(F.broadcast(self.new.dates.select("date", "vi")), "date")
        return held_seeds(kept), linked_seeds(indexed)

    def _merge(self, table: str, new: DataFrame, schema: str, begun: DataFrame, first: str, sort: tuple[str, ...], ignore: tuple[str, ...] = ()) -> list[str]:
        """Put the new rows of the funds concerned in place of the stored ones, on the dates where they differ."""
        names = schemas.columns(schema)
        new = self.staging.keep(new.select(*names), f"{table}-new")
        stored = self.store.read(table, schema, first=first)
        concerned = F.col("start").isNotNull() & (F.col("date") >= F.col("start"))
        told = stored.join(begun, "etf_code", "left")
        nothing_yet = not self.store.parts(table)
        days = day_list(new) if nothing_yet else _differing_days(new, told.where(concerned).select(*names), ignore)
        if days or table not in self.store.state:
            others = self.store.read(table, schema, values=days).join(begun, "etf_code", "left").where(~concerned).select(*names)
            rows = others.unionByName(new.where(F.col("date").isin([Day.fromisoformat(d) for d in days])))
            self.store.replace({table: (rows, sort)}, days)
        self.written[table] = days
        return days

    def signals(self, changed: Iterable[str], old_days: list[str]) -> None:
        """Signals of the dates that can see a date with differing changes."""
        days, reach = self.store.parts(CHANGES), self.params.signal_window
        if SIGNALS not in self.store.state:
            changed = sorted({*changed, *days})
        told, needed = set(changed), set()
        for day in changed:
            at = bisect_left(days, day)
            told.update(days[at:at + reach + 1])
        for i, day in enumerate(days):
            if day in told:
                needed.update(days[max(0, i - reach):i + 1])
        if not told:
            return
        indexed = [(Day.fromisoformat(d), i) for i, d in enumerate(days) if d in needed]
        index = self.spark.createDataFrame(indexed, "date date, ci int")
        changes, wanted = self.store.read(CHANGES, schemas.CHANGES, values=needed), [Day.fromisoformat(d) for d in told]
        facts = signal_facts(changes, self.params, index).select(*schemas.columns(schemas.SIGNAL_FACTS))
        evidence = signal_evidence(changes, self.params, index).select(*schemas.columns(schemas.SIGNAL_EVIDENCE))
        self.store.replace({SIGNALS: (facts.where(F.col("date").isin(wanted)), ("stock_code", "signal_type"))}, told)
        self.store.replace(
            {EVIDENCE: (evidence.where(F.col("signal_date").isin(wanted)), ("stock_code", "signal_type"))}, told, by="signal_date")
        self.written[SIGNALS] = sorted(told)


def stored_signals(store: Store) -> tuple[DataFrame, DataFrame]:
    """Signals with their scalar columns, and their evidence, one row per signal and change."""
    return store.read(SIGNALS, schemas.SIGNAL_FACTS), store.read(EVIDENCE, schemas.SIGNAL_EVIDENCE)


def stored_signal_lists(store: Store) -> DataFrame:
    """The stored signals with id and lists: as wide as the funds of a signal, for those who ask for it."""
    return listed_signals(*stored_signals(store))
