"""Nightly arrivals as a file stream: parse, judge, arbitrate, store, rebuild what depends on them.

A batch is one transaction: snapshots, all that is derived from them, and the outcomes of the run
count together or not at all, so a batch that is run again after a failure gives the same tables.
Late files need no watermark: a correction of any age is stored, and what it can reach is rebuilt
(see ``tidemark.plans.rebuild``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.operators.calendar import expected_data_date, full_calendar, last_trading_day, local_run_time, trading_days
from tidemark.operators.ingest import (
    candidate_profiles,
    candidate_selection,
    dedupe_rows,
    merge_snapshots,
    min_weight_filter,
    row_count_check,
    scrape_outcome,
    split_assets,
    store_decision,
    stored_row_counts,
)
from tidemark.operators.snapshots import canonical_snapshot, snapshot_profile
from tidemark.params import DEFAULT, Params
from tidemark.plans.rebuild import Rebuild
from tidemark.sources.payloads import payload_rows
from tidemark.sources.sinks import day_list, snapshot_frames
from tidemark.sources.store import Store
from tidemark.sources.tables import Tables, scan_holdings, stored_tables


def init_tables(spark: SparkSession, root: str, universe: DataFrame) -> None:
    """Empty fact tables and the given universe."""
    store = Store(spark, root)
    stock, other = (spark.createDataFrame([], schema) for schema in (schemas.HOLDINGS, schemas.NON_STOCK))
    store.replace(snapshot_frames(stock, other))
    store.put("etf_universe", universe)
    store.commit()


def candidates_from_payloads(payloads: DataFrame) -> DataFrame:
    """Landed payloads as candidate rows; the payload is the candidate."""
    return payload_rows(payloads).select(
        F.col("payload_id").alias("candidate_id"),
        F.col("date").alias("run_date"),
        "date", "etf_code", "asset_name", "asset_type", "stock_code", "stock_name",
        F.col("shares").cast("double").alias("shares"),
        F.col("weight_pct").cast("double").alias("weight_pct"),
        F.lit("").alias("source_url"),
        "source_type",
        F.lit("payload").alias("extraction_method"),
        F.current_timestamp().alias("scraped_at"),
    )


def by_format(payloads: DataFrame, root: str, batch: str) -> DataFrame:
    """The payloads of a batch, laid out by format beside the tables: each parser reads its own part, once.

    A streamed batch is read whole, with every body, by each branch of a plan over it.
    """
    path = f"{root}/_staging/{batch}-{uuid.uuid4().hex}/payloads"
    payloads.write.partitionBy("format").parquet(path)
    return payloads.sparkSession.read.schema(payloads.schema).parquet(path)


def expected_date(spark: SparkSession, run_at: str | None = None, holidays: DataFrame | None = None, params: Params = DEFAULT) -> Column:
    """The data date that a run at this UTC time (now, if not given) should see."""
    at = F.lit(run_at).cast("timestamp") if run_at else F.current_timestamp()
    runs = spark.range(1).select(at.alias("run_at"))
    last_days = None
    if holidays is not None:
        near = runs.select(F.to_date(local_run_time(F.col("run_at"))).alias("date"))
        last_days = last_trading_day(trading_days(full_calendar(near), holidays), params)
    return F.lit(expected_data_date(runs, last_days, params).first()["expected_data_date"])


def nightly_decisions(
    rows: DataFrame,
    stored: Tables,
    expected: Column,
    params: Params = DEFAULT,
    keep: Callable[[DataFrame, str], DataFrame] = lambda frame, name: frame,
) -> tuple[DataFrame, DataFrame]:
    """The outcome of each fund of the run, and what becomes of each landed snapshot, by the gates of the nightly run.

    The candidates are judged on all their rows, before light rows are dropped: a weight that is
    missing makes a snapshot invalid. Each date is a run of its own: one candidate per date and fund
    is chosen among the channels, after their row counts were held against the stored history.
    A date after the expected one is refused, an equivalent of what is stored is not written again,
    and the rest is arbitrated against the stored snapshot. ``keep`` may stage what is read several
    times, one row per snapshot.
    """
    profiles = keep(candidate_profiles(rows, params=params), "profiles")
    touched = profiles.where("data_date IS NOT NULL")
    history = stored.holdings.join(touched.select("etf_code", "source_type").distinct(), ["etf_code", "source_type"], "left_semi")
    checked = row_count_check(profiles, stored_row_counts(history), params)
    chosen = candidate_selection(checked.withColumn("target_date", F.col("run_date")))
    outcomes = keep(scrape_outcome(chosen.withColumn("target_date", expected), profiles), "outcomes")
    days = touched.select(F.col("data_date").alias("date")).distinct()
    on_dates = scan_holdings(stored.holdings, stored.non_stock).join(F.broadcast(days), "date", "left_semi")
    canonical = keep(canonical_snapshot(snapshot_profile(on_dates, params=params)), "canonical")
    return outcomes, store_decision(outcomes, canonical, params)


def stage_candidates(store: Store, candidates: DataFrame, batch: str, params: Params = DEFAULT, expected: Column | None = None) -> DataFrame:
    """Decide on candidate rows against the stored dates and replace those dates in the store's transaction.

    Parsed rows and decisions are first written beside the tables, so that they stay the same when a task
    is run again. The outcome of every fund of the batch is kept with it.
    """
    spark, stored = store.spark, stored_tables(store)
    staged = f"{store.root}/_staging/{batch}-{uuid.uuid4().hex}"

    def written(frame: DataFrame, name: str) -> DataFrame:
        path = f"{staged}/{name}"
        frame.write.mode("overwrite").parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    rows = written(dedupe_rows(candidates), "rows")
    expected = expected_date(spark) if expected is None else expected
    outcomes, judged = nightly_decisions(rows, stored, expected, params, written)
    decisions = written(judged, "decisions")
    stock, other = split_assets(min_weight_filter(rows, params))
    affected = decisions.where("inserted OR stored_source_type IS NOT NULL").select(F.col("data_date").alias("date"))
    store.replace(
        snapshot_frames(merge_snapshots(stored.holdings, stock, decisions), merge_snapshots(stored.non_stock, other, decisions)),
        day_list(affected))
    told = decisions.select("run_date", "candidate_id", "decision", "inserted")
    kept = outcomes.join(told, ["run_date", "candidate_id"], "left").withColumns({
        "batch": F.lit(batch), "inserted": F.coalesce("inserted", F.lit(False)), "run_date": F.col("run_date").cast("date")})
    store.replace({"run_outcomes": (kept.select(*schemas.columns(schemas.OUTCOMES)), ("etf_code",))}, [batch], by="batch")
    return decisions


def store_candidates(
    spark: SparkSession, root: str, candidates: DataFrame, batch: str, params: Params = DEFAULT, expected: Column | None = None
) -> DataFrame:
    """Decide on candidate rows and store what was decided, without rebuilding anything."""
    store = Store(spark, root)
    decisions = stage_candidates(store, candidates, batch, params, expected)
    store.commit()
    return decisions


def rebuild_from(spark: SparkSession, root: str, first_date: str | None = None, params: Params = DEFAULT, signals: bool = True) -> Rebuild:
    """Profile all stored facts anew and recompute what differs, and every fund from ``first_date`` on if it is given."""
    store = Store(spark, root)
    rebuild = Rebuild(store, params)
    rebuild.run(since=first_date, signals=signals)
    store.commit()
    return rebuild


def process_candidates(
    spark: SparkSession,
    root: str,
    candidates: DataFrame,
    batch: str,
    params: Params = DEFAULT,
    signals: bool = True,
    expected: Column | None = None,
) -> Rebuild:
    """Store what a batch brings and rebuild what it can reach, in one transaction."""
    store = Store(spark, root)
    decisions = stage_candidates(store, candidates, batch, params, expected)
    touched = decisions.where("inserted").select(F.col("data_date").alias("date"), "etf_code").distinct()
    rebuild = Rebuild(store, params)
    rebuild.run(touched, signals=signals)
    store.commit()
    return rebuild


def stored_outcomes(spark: SparkSession, root: str) -> DataFrame:
    """The outcome of every fund in every batch so far."""
    return Store(spark, root).read("run_outcomes", schemas.OUTCOMES)


def incremental_ingest(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    params: Params = DEFAULT,
    signals: bool = True,
    files_per_batch: int | None = None,
    run_at: str | None = None,
    holidays: DataFrame | None = None,
) -> StreamingQuery:
    """Start a run over all payload files that have landed and not been taken yet.

    ``run_at`` (UTC, now if not given) and ``holidays`` set the expected data date.
    """
    source = spark.readStream.schema(schemas.PAYLOADS)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)

    def take(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        expected = expected_date(session, run_at, holidays, params)
        name = f"batch-{batch_id}"
        process_candidates(session, root, candidates_from_payloads(by_format(batch, root, name)), name, params, signals, expected)

    return (
        source.parquet(landing)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(take)
        .start()
    )
