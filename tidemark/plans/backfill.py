"""Recomputing derived tables over a date range, from the full history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import change_run_summary
from tidemark.operators.signals import change_dates, manager_signals, to_storage
from tidemark.plans.history import History
from tidemark.sources.sinks import day_list, derived_frame
from tidemark.sources.store import Store
from tidemark.sources.tables import range_filter


def backfill(
    history: History,
    root: str,
    from_date: str | None = None,
    to_date: str | None = None,
    regenerate_signals: bool = False,
) -> DataFrame:
    """Write changes and diagnostics (and signals) of the range; returns the run summary.

    Previous dates, streaks and windows come from the whole history; only the written dates
    are limited. A date of the range that has no rows (any more) becomes empty; the tables change
    together. Stored tables are brought up to date by ``tidemark.plans.rebuild``, which reads only what
    a correction can reach.
    """
    asked = day_list(range_filter(history.dates.select("date"), from_date, to_date))
    frames = {
        **derived_frame(range_filter(history.changes, from_date, to_date), "etf_holding_changes"),
        **derived_frame(range_filter(history.diagnostics, from_date, to_date), "etf_change_diagnostics"),
    }
    if regenerate_signals:
        signals = range_filter(range_signals(history, from_date, to_date), from_date, to_date)
        frames |= derived_frame(to_storage(signals), "etf_manager_signals")
    store = Store(history.snapshots.sparkSession, root)
    store.replace(frames, asked)
    store.commit()
    return backfill_summary(history, from_date, to_date)


def range_signals(history: History, from_date: str | None, to_date: str | None) -> DataFrame:
    """Signals from the changes that the windows of the range, and the one before it, can see.

    The dates of the range come out right; those before it are incomplete.
    """
    reach = history.params.signal_window
    days = change_dates(history.changes)
    indexes = range_filter(days, from_date, to_date).agg((F.min("ci") - reach).alias("from_ci"), F.max("ci").alias("to_ci"))
    seen = days.join(F.broadcast(indexes), F.col("ci").between(F.col("from_ci"), F.col("to_ci"))).select(*days.columns)
    changes = history.changes.join(F.broadcast(seen.select("date")), "date", "left_semi")
    return manager_signals(changes, history.params, seen, history.tasks)


def backfill_summary(history: History, from_date: str | None = None, to_date: str | None = None) -> DataFrame:
    """Per date of the range: processed, skipped as first date, or without comparable funds."""
    runs = range_filter(change_run_summary(history.dates, history.changes, history.diagnostics), from_date, to_date)
    return runs.withColumn(
        "outcome",
        F.when(F.col("prev_date").isNull(), "skipped_first").when(F.col("ok"), "processed").otherwise("nothing_comparable"),
    )
