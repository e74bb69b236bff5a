"""Headline queries at one scale; prints one JSON line.

Each query starts from the parquet tables with nothing kept from the query before it: the
whole derivation (snapshots, dates, changes, ...) is inside its time. One untimed pass over a
small scale warms the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from checks.session import local_session
from tidemark.operators.intent import manager_intent
from tidemark.operators.signals import manager_signals
from tidemark.plans.history import History
from tidemark.plans.staging import Staging
from tidemark.sources import generated

HEADLINES = {
    "canonical_snapshot": lambda h: h.canonical,
    "holding_changes": lambda h: h.changes,
    "manager_signals": lambda h: manager_signals(h.changes, h.params),
    "manager_intent": lambda h: manager_intent(h.changes, h.ranked, h.entries, h.diagnostics, h.members, params=h.params),
    "net_active_flow": lambda h: h.flow,
    "data_quality": lambda h: h.quality,
}


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def run(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    times = {}
    for name, build in HEADLINES.items():
        start = time.perf_counter()
        staging = Staging(spark)
        history = History(generated.tables(spark, sf_dir, staging.keep), staging=staging)
        drain(build(history))
        times[name] = round(time.perf_counter() - start, 3)
        history.staging.release()
    return times


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        run(spark, small)
    times = run(spark, sf_dir)
    line = {
        "metric": "headline queries, total time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0), "cpus": int(cpus),
    }
    print(json.dumps(line))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
