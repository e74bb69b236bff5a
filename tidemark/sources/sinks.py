"""Writing tables: whole date partitions are replaced, so a rerun gives the same table.

The caller names the affected dates; those without new rows become empty, all others stay. All
tables of one call change together (see ``tidemark.sources.store``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.store import Store

KEYS = {
    "etf_daily_holdings": ("date", "etf_code", "stock_code", "source_type"),
    "etf_daily_non_stock_assets": ("date", "etf_code", "asset_name", "source_type"),
    "etf_holding_changes": ("date", "etf_code", "stock_code"),
    "etf_change_diagnostics": ("date", "prev_date", "etf_code"),
    "etf_manager_signals": ("signal_id",),
}


def day_list(dates: DataFrame | None) -> list[str]:
    """The distinct dates of a frame: one row per calendar date reaches the driver."""
    return [] if dates is None else [str(r["date"]) for r in dates.select("date").distinct().collect()]


def replace_dates(frames: dict[str, tuple[DataFrame, Sequence[str]]], root: str, dates: DataFrame | None = None) -> None:
    """Replace the affected dates of several tables below ``root``, all at once.

    ``frames``: table name to rows and sort columns. ``dates``: column ``date``, the affected dates;
    without it, the dates that have new rows in any of the tables.
    """
    store = Store(next(iter(frames.values()))[0].sparkSession, root)
    store.replace(frames, day_list(dates))
    store.commit()


def snapshot_frames(stock_rows: DataFrame, other_rows: DataFrame) -> dict[str, tuple[DataFrame, Sequence[str]]]:
    return {
        "etf_daily_holdings": (stock_rows, ("etf_code", "stock_code")),
        "etf_daily_non_stock_assets": (other_rows, ("etf_code", "asset_name")),
    }


def snapshot_sink(stock_rows: DataFrame, other_rows: DataFrame, root: str, dates: DataFrame | None = None) -> None:
    """Store the merged content of the affected dates, stock and other assets together."""
    replace_dates(snapshot_frames(stock_rows, other_rows), root, dates)


def derived_frame(rows: DataFrame, table: str) -> dict[str, tuple[DataFrame, Sequence[str]]]:
    """Rows of a derived table without repeated keys, in the order in which they are stored."""
    unique = rows.dropDuplicates(list(KEYS[table]))
    return {table: (unique, tuple(k for k in KEYS[table] if k != "date" and k in rows.columns))}


def derived_sink(rows: DataFrame, root: str, table: str, dates: DataFrame | None = None) -> None:
    """Replace the affected dates of a derived table after removing repeated keys."""
    replace_dates(derived_frame(rows, table), root, dates)


def table_sink(rows: DataFrame, root: str, table: str) -> None:
    """Replace a small unpartitioned table."""
    store = Store(rows.sparkSession, root)
    store.put(table, rows)
    store.commit()


def report_sink(section: DataFrame, root: str, name: str, stamp: str, dates: DataFrame | None = None) -> None:
    """An archive copy under the run stamp, and the current section by date, made from that copy."""
    store = Store(section.sparkSession, f"{root}/archive/{stamp}")
    store.replace({name: (section, ())}, store.parts(name))
    store.commit()
    replace_dates({name: (store.read(name, section.schema), ())}, f"{root}/current", dates)


def read_back(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table by its path ``root/name``."""
    root, _, name = path.rpartition("/")
    return Store(spark, root).read(name, schema)
