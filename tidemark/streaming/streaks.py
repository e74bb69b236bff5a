"""Flow streaks carried from one micro-batch to the next, one state per (fund, stock)."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# JSON text: a list per date, of date, prev_date, valid, scaled, add, reduce, share_add, share_reduce, add_days,
# reduce_days, revision. One value, so that a key costs one read and one write of the store, however many dates it has.
STATE = "dates STRING"
KEPT = 60  # newest dates that a position remembers
OUTPUT = (
    "date STRING, etf_code STRING, stock_code STRING, consecutive_active_add_days INT, consecutive_active_reduce_days INT, "
    "revision INT"
)
INPUT = (
    "date", "prev_date", "date_valid", "etf_code", "stock_code", "etf_scale_factor",
    "is_active_add", "is_active_reduce", "share_add_days", "share_reduce_days",
)
OUT = Row(*[field.split()[0] for field in OUTPUT.split(", ")])
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# Workers get the processor by value, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _days(scaled: bool, flag: int, shares: int, linked: bool, was_flag: int, was_days: int) -> int:
    if not scaled:
        return shares
    if not flag:
        return 0
    return was_days + 1 if linked and was_flag else 1


class StreakProcessor(StatefulProcessor):
    """Keeps the newest dates of a position with their flags and counts.

    A row goes on from the valid row of its previous date, whenever that one arrives. A late row, or a row
    that is sent again, therefore also corrects the dates after it: each date whose counts are new or differ
    comes out once more, with the next ``revision``. A row older than everything kept is past correction: it
    comes out with revision -1 and no counts, for a rebuild from the stored tables.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._kept = handle.getValueState("kept", STATE)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        # A key receives at most one row per date, so a batch of one key is small.
        kept = self._kept.get()
        known = {} if kept is None else {date: tuple(rest) for date, *rest in json.loads(kept[0])}
        full, oldest = len(known) >= KEPT, min(known, default="")
        out, touched = [], set()
        etf_code, stock_code = key
        for row in rows:
            if full and row.date < oldest:
                out.append((row.date, etf_code, stock_code, None, None, -1))
                continue
            flags = int(row.is_active_add), int(row.is_active_reduce), int(row.share_add_days), int(row.share_reduce_days)
            scale = row.etf_scale_factor
            revision = known[row.date][-1] if row.date in known else -1
            known[row.date] = (row.prev_date, bool(row.date_valid), scale is not None and scale == scale, *flags, None, None, revision)
            touched.add(row.date)
        first = min(touched, default="")
        for date in sorted(d for d in known if touched and d >= first):
            prev, valid, scaled, add, reduce, share_add, share_reduce, add_days, reduce_days, revision = known[date]
            before = known.get(prev)
            linked = before is not None and before[1]
            was = (before[3], before[7], before[4], before[8]) if linked else (0, 0, 0, 0)
            now = _days(scaled, add, share_add, linked, *was[:2]), _days(scaled, reduce, share_reduce, linked, *was[2:])
            if now != (add_days, reduce_days):
                known[date] = (prev, valid, scaled, add, reduce, share_add, share_reduce, *now, revision + 1)
                out.append((date, etf_code, stock_code, *now, revision + 1))
        if touched:
            self._kept.update((json.dumps([(date, *known[date]) for date in sorted(known)[-KEPT:]]),))
        for values in out:
            yield OUT(*values)

    def close(self) -> None:
        pass


def stateful_streaks(changes: DataFrame) -> DataFrame:
    """Streaming change rows (columns ``INPUT``, dates as ISO text) to flow streaks, in any order of arrival.

    The row with the highest revision counts for a date. Needs ``spark.sql.streaming.stateStore.providerClass``
    set to ``STATE_STORE``.
    """
    return changes.groupBy("etf_code", "stock_code").transformWithState(
        statefulProcessor=StreakProcessor(),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="None",
    )
