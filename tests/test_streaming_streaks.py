"""Flow streaks of a stream that arrives in any order end in those of the whole table."""

import random
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.streaming import streaks as Y

SCHEMA = (
    "date string, prev_date string, date_valid boolean, etf_code string, stock_code string, etf_scale_factor double, "
    "is_active_add int, is_active_reduce int, share_add_days int, share_reduce_days int"
)
DATES = [f"2026-01-{d:02d}" for d in range(1, 15)]


def table(rng):
    """Change rows of a few positions, linked along valid dates, some of them missing."""
    valid = {d: rng.random() < 0.8 for d in DATES}
    rows = []
    for stock in ("1101", "1102", "1103"):
        prev = None
        for d in DATES:
            if rng.random() < 0.9:
                side = rng.choice([(1, 0), (1, 0), (0, 1), (0, 0)])
                rows.append((d, prev, valid[d], "F", stock, rng.choice([1.0, 1.1, 1.2, None]), *side, rng.randint(0, 3), rng.randint(0, 3)))
            prev = d if valid[d] else prev
    return rows


def plain(rows):
    out, last = {}, {}
    for d, prev, valid, fund, stock, scale, add, reduce, share_add, share_reduce in sorted(rows):
        before = last.get((stock, prev))
        days = []
        for side, flag, shares in ((0, add, share_add), (1, reduce, share_reduce)):
            on = before is not None and before[0][side]
            days.append(shares if scale is None else 0 if not flag else before[1][side] + 1 if on else 1)
        out[d, stock] = tuple(days)
        if valid:
            last[stock, d] = ((add, reduce), days)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_arrival(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = table(rng)
    arrivals = [[], [], []]
    for row in rows:
        arrivals[rng.randrange(3)].append(row)
    arrivals[2].append(arrivals[0][0])  # sent again
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, Y.STATE_STORE)
    try:
        for part in arrivals:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            stream = Y.stateful_streaks(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"))
            (stream.writeStream.outputMode("append").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True)
             .format("parquet").option("path", f"{tmp_path}/out").start().awaitTermination())
            time.sleep(0.1)
    finally:
        spark.conf.set(provider, before)
    told = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")
    newest = told.groupBy("date", "stock_code").agg(F.max_by(F.struct(*told.columns[3:5]), "revision").alias("days"), F.count("*").alias("n")).collect()
    assert {(r["date"], r["stock_code"]): tuple(r["days"]) for r in newest} == plain(rows)
    assert any(r["n"] > 1 for r in newest)


def test_one_read_and_one_write_of_the_store_per_key():
    calls = []

    class Kept:
        value = None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

    kept = Kept()
    processor = Y.StreakProcessor()
    processor.init(type("Handle", (), {"getValueState": lambda self, name, schema: kept})())
    row = Row(*Y.INPUT)
    days = [row(d, p, True, "F", "1101", 1.0, 1, 0, 0, 0) for p, d in zip([None, *DATES], DATES)]
    out = [r for part in (days[:7], days[7:]) for r in processor.handleInputRows(("F", "1101"), iter(part), None)]
    assert calls == ["get", "update"] * 2
    assert [r.consecutive_active_add_days for r in out] == list(range(1, len(DATES) + 1))
