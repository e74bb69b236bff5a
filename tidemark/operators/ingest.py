"""From landed candidate rows to the decision of what is stored.

A candidate is every row sharing a ``candidate_id``. Row-level steps are filters; everything
else works on one profile row per candidate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.origin import AGGREGATOR_SOURCES, source_family
from tidemark.operators.snapshots import arbitrate, equivalence, snapshot_profile
from tidemark.params import DEFAULT, Params

# Accepted total weight per source family, channel of each source type.
WEIGHT_BOUNDS = {"moneydj": (70.0, 140.0), "official": (20.0, 110.0)}
CHANNELS = {
    "moneydj_primary": "aggregator_static",
    "moneydj_browser": "aggregator_browser",
    "official_browser": "official_browser",
    "official_fallback": "official_browser",
    "official_static": "official_static",
}
DEDUPE_KEY = ("etf_code", "date", "asset_name", "weight_pct", "shares")


def dedupe_rows(rows: DataFrame) -> DataFrame:
    """One row per fund, date, asset name, weight and shares within a candidate."""
    keys = [*DEDUPE_KEY]
    if "candidate_id" in rows.columns:
        keys.append("candidate_id")
    return rows.dropDuplicates(keys)


def split_assets(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    stock = F.coalesce(F.col("asset_type") == "stock", F.lit(False))
    return rows.where(stock), rows.where(~stock)


def _heavy_enough(params: Params) -> Column:
    """Rows the minimum-weight gate keeps: other assets may have any weight."""
    stock = F.coalesce(F.col("asset_type") == "stock", F.lit(False))
    return ~stock | (F.coalesce(F.col("weight_pct").try_cast("double"), F.lit(0.0)) >= params.min_weight)


def min_weight_filter(rows: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Drop stock rows below the minimum weight."""
    return rows.where(_heavy_enough(params))


def candidate_profiles(rows: DataFrame, headers: DataFrame | None = None, params: Params = DEFAULT) -> DataFrame:
    """Profile per candidate after the weight gate, in one pass over the rows.

    The candidate keeps its own verdict unless the gate removed stocks from one that had
    enough of them: then what is left is judged again. Fewer rows of a valid candidate still
    agree with each other, so only the two minimum counts can fail.
    """
    keys = ("run_date", "candidate_id")
    kept = _heavy_enough(params)
    stock = F.coalesce(F.col("asset_type") == "stock", F.lit(False)) & kept
    weight = F.coalesce(F.col("weight_pct").try_cast("double"), F.lit(0.0))
    gated = {
        "kept_rows": F.count_if(kept),
        "kept_stocks": F.count_if(stock),
        "kept_weight": F.round(F.sum(F.when(kept, weight).otherwise(0.0)), 10),
        "kept_shares": F.count_if(stock & F.col("shares").isNotNull()),
    }
    before = snapshot_profile(rows, keys, params, headers, gated)
    left = F.when(F.col("kept_rows") == 0, "empty_rows").when(F.col("kept_rows") < params.min_rows, "fewer_than_5_rows").when(
        F.col("kept_stocks") < params.min_stock_rows, "fewer_than_5_taiwan_stock_rows"
    )
    changed = (F.col("stock_count") >= params.min_stock_rows) & (F.col("kept_stocks") < F.col("stock_count"))
    rejected = F.coalesce(F.col("valid") & changed & left.isNotNull(), F.lit(False))
    return before.select(
        *keys,
        "data_date",
        "etf_code",
        "source_type",
        (F.col("valid") & ~rejected).alias("valid"),
        F.when(rejected, F.concat(F.lit("post_filter_invalid_snapshot:"), left)).otherwise(F.col("reason")).alias("reason"),
        F.coalesce("kept_rows", F.lit(0)).alias("row_count"),
        F.coalesce("kept_stocks", F.lit(0)).alias("stock_count"),
        F.coalesce(F.col("kept_rows") - F.col("kept_stocks"), F.lit(0)).alias("non_stock_count"),
        F.coalesce("kept_weight", F.lit(0.0)).alias("total_weight"),
        F.coalesce(F.col("kept_shares") / F.nullif("kept_stocks", F.lit(0)), F.lit(0.0)).alias("shares_coverage"),
    )


def weight_warning(profiles: DataFrame) -> DataFrame:
    """Diagnostic on the total weight of valid candidates, by source family."""
    total, family = F.round("total_weight", 2), source_family(F.col("source_type"))
    reason = F.lit(None).cast("string")
    for name, (low, high) in WEIGHT_BOUNDS.items():
        reason = (
            F.when((family == name) & (total < low), "total_weight_below_expected_range")
            .when((family == name) & (total > high), "total_weight_above_expected_range")
            .otherwise(reason)
        )
    return profiles.where("valid").withColumn("weight_warning", reason).withColumn("source_total_weight", total)


def stored_row_counts(holdings: DataFrame) -> DataFrame:
    return holdings.groupBy("date", "etf_code", "source_type").agg(F.count(F.lit(1)).alias("stock_rows"))


def row_count_history(counts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Mean stock rows over the last dates strictly before each stored date, per fund and source."""
    recent = W.partitionBy("etf_code", "source_type").orderBy("date").rowsBetween(-params.row_count_history, -1)
    return counts.withColumn("mean_rows", F.avg("stock_rows").over(recent))


def row_count_check(profiles: DataFrame, counts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Aggregator candidates with too few stocks against the stored history before their date.

    As-of lookup: stored dates carry the mean that ends with them, asked dates take the latest
    mean from a strictly earlier date. It runs on distinct dates per fund and source, so
    repeated candidates never meet in one group.
    """
    place = ["etf_code", "source_type", "date"]
    order = W.partitionBy("etf_code", "source_type").orderBy(F.unix_date("date").cast("bigint"))
    closing = order.rowsBetween(-(params.row_count_history - 1), W.currentRow)
    stored = counts.select(*place, F.avg("stock_rows").over(closing).alias("mean"), F.lit(0).alias("asked"))
    dated = profiles.where("data_date IS NOT NULL").select("etf_code", "source_type", F.col("data_date").alias("date"))
    asked = dated.distinct().select(*place, F.lit(None).cast("double").alias("mean"), F.lit(1).alias("asked"))
    earlier = order.rangeBetween(W.unboundedPreceding, -1)
    means = (
        stored.unionByName(asked)
        .withColumn("mean_rows", F.last("mean", ignorenulls=True).over(earlier))
        .where("asked = 1")
        .select("etf_code", "source_type", F.col("date").alias("data_date"), "mean_rows")
    )
    aggregator = F.coalesce(F.col("source_type").isin(*AGGREGATOR_SOURCES), F.lit(False))
    minimum = F.when(aggregator & (F.col("mean_rows") > 0), F.col("mean_rows") * params.low_row_count_ratio)
    return (
        profiles.join(means, ["etf_code", "source_type", "data_date"], "left")
        .withColumn("minimum_expected", minimum)
        .withColumn("low_confidence", F.coalesce(F.col("stock_count") < F.col("minimum_expected"), F.lit(False)))
    )


def candidate_selection(checked: DataFrame) -> DataFrame:
    """The candidate to use per run and fund, with the warning attached to it.

    ``checked`` are row-count-checked profiles plus ``target_date``, the freshness target.
    """
    channel = F.lit(None).cast("string")
    for source, name in CHANNELS.items():
        channel = F.when(F.col("source_type") == source, F.lit(name)).otherwise(channel)
    facts = F.struct(
        "data_date", "candidate_id", "stock_count", "low_confidence", "minimum_expected", "source_type"
    )
    usable = checked.withColumn("channel", channel).where("valid")
    names = sorted(set(CHANNELS.values()))
    offers = usable.groupBy("run_date", "etf_code").agg(
        F.max("target_date").alias("target_date"),
        *[F.max(F.when(F.col("channel") == n, facts)).alias(n) for n in names],
    )
    every = checked.where("etf_code IS NOT NULL").groupBy("run_date", "etf_code").agg(F.max("target_date").alias("target_date"))
    sides = every.join(offers.drop("target_date"), ["run_date", "etf_code"], "left").select(
        "run_date",
        "etf_code",
        "target_date",
        F.coalesce("aggregator_static", "aggregator_browser").alias("agg"),
        F.coalesce("official_browser", "official_static").alias("off"),
    )
    agg, off, target = F.col("agg"), F.col("off"), F.col("target_date")
    has_agg, has_off = agg.isNotNull(), off.isNotNull()
    renewed = (agg["data_date"] < target) & has_off & (off["data_date"] == target)
    more = off["stock_count"] > agg["stock_count"]
    enough = off["stock_count"] >= agg["minimum_expected"]

    def pick(choice: str, warning: str | None = None):
        return F.struct(F.lit(choice).alias("choice"), F.lit(warning).cast("string").alias("warning"))

    low = "low_row_count_official_fallback"
    decision = (
        F.when(~has_agg & has_off, pick("official"))
        .when(~has_agg, pick("none", "all sources failed"))
        .when(F.coalesce(renewed, F.lit(False)), pick("official"))
        .when(~agg["low_confidence"], pick("aggregator"))
        .when(~has_off, pick("aggregator", f"{low}_failed"))
        .when(off["stock_count"] == 0, pick("aggregator", f"{low}_zero_rows"))
        .when(off["data_date"] < agg["data_date"], pick("aggregator", f"{low}_stale"))
        .when(agg["data_date"].isNotNull() & off["data_date"].isNull(), pick("aggregator", f"{low}_missing_date"))
        .when(off["stock_count"] == agg["stock_count"], pick("aggregator", "low_row_count_confirmed_by_fallback"))
        .when(more & enough, pick("official"))
        .when(more, pick("official", f"{low}_still_low"))
        .otherwise(pick("aggregator", f"{low}_lower_row_count"))
    )
    chosen = F.when(F.col("d.choice") == "aggregator", agg).when(F.col("d.choice") == "official", off)
    return sides.withColumn("d", decision).withColumn("chosen", chosen).select(
        "run_date", "etf_code", "target_date", "d.choice",
        F.col("chosen.candidate_id").alias("candidate_id"),
        F.col("chosen.source_type").alias("chosen_source_type"),
        F.col("d.warning").alias("row_count_warning"),
    )


def scrape_outcome(selection: DataFrame, profiles: DataFrame) -> DataFrame:
    """failed, stale or success of the chosen candidate of each run and fund, with the reason."""
    facts = profiles.drop("etf_code", "target_date")
    joined = selection.join(facts, ["run_date", "candidate_id"], "left")
    date, target = F.col("data_date"), F.col("target_date")
    reason = (
        F.when(F.col("candidate_id").isNull(), "all sources failed")
        .when(~F.col("valid"), F.concat(F.lit("invalid_snapshot:"), F.col("reason")))
        .when(date.isNull(), "missing_or_unparseable_source_date")
        .when(date > target, "source_date_after_expected_data_date")
        .when(date < target, "source_date_before_expected_data_date")
    )
    return (
        joined.withColumn("outcome_reason", reason)
        .withColumn(
            "outcome",
            F.when(reason.isNull(), "success").when(F.coalesce(F.col("valid") & (date < target), F.lit(False)), "stale")
            .otherwise("failed"),
        )
    )


def store_decision(outcomes: DataFrame, canonical: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """What is stored: nothing for failures, nothing for a stale equivalent, else arbitration."""
    loaded = outcomes.where("outcome <> 'failed'")
    judged = arbitrate(loaded, canonical)
    same = equivalence(loaded, canonical, params).select(
        "run_date", "candidate_id", "existing_snapshot_found", "weight_delta_pct_points", "equivalent"
    )
    skip = (F.col("outcome") == "stale") & F.coalesce("equivalent", F.lit(False))
    return (
        judged.join(same, ["run_date", "candidate_id"])
        .withColumn("decision", F.when(skip, "skip_rewrite").otherwise(F.col("decision")))
        .withColumn("inserted", F.col("decision") == "replace")
    )


def run_summary(outcomes: DataFrame, warnings: DataFrame | None = None) -> DataFrame:
    """Counts of each run by outcome and source, row totals and data date range."""
    loaded = F.col("outcome") != "failed"
    aggregator = F.coalesce(F.col("chosen_source_type").isin(*AGGREGATOR_SOURCES), F.lit(False))
    out = outcomes.groupBy("run_date").agg(
        F.count(F.lit(1)).alias("total_etfs"),
        F.count_if(loaded & aggregator).alias("aggregator_success"),
        F.count_if(loaded & ~aggregator).alias("official_success"),
        F.count_if(~loaded).alias("failed"),
        F.count_if(F.col("outcome") == "success").alias("fresh"),
        F.count_if(F.col("outcome") == "stale").alias("stale"),
        F.count_if(~loaded).alias("unknown"),
        F.sum(F.when(loaded, F.col("stock_count")).otherwise(0)).alias("total_stock_rows"),
        F.sum(F.when(loaded, F.col("non_stock_count")).otherwise(0)).alias("total_non_stock_rows"),
        F.count("row_count_warning").alias("row_count_warnings"),
        F.min(F.when(loaded, F.col("data_date"))).alias("data_date_min"),
        F.max(F.when(loaded, F.col("data_date"))).alias("data_date_max"),
    )
    if warnings is None:
        return out
    counted = warnings.where("weight_warning IS NOT NULL").groupBy("run_date").agg(F.count(F.lit(1)).alias("weight_warnings"))
    return out.join(counted, "run_date", "left").withColumn("weight_warnings", F.coalesce("weight_warnings", F.lit(0)))


def run_failures(outcomes: DataFrame) -> DataFrame:
    """Failed and stale funds of each run as rows: the list side of the run summary."""
    return outcomes.where("outcome <> 'success'").select("run_date", "etf_code", "outcome", "outcome_reason", "data_date")


def preexisting_partition(asked: DataFrame, canonical: DataFrame, force: bool = False) -> DataFrame:
    """Which asked (date, etf_code) already have a valid snapshot; ``force`` loads them all."""
    if force:
        return asked.select("date", "etf_code", F.lit("to_load").alias("status"))
    have = canonical.select("date", "etf_code", F.lit(True).alias("have"))
    return asked.join(have, ["date", "etf_code"], "left").select(
        "date", "etf_code", F.when(F.col("have"), "preexisting").otherwise("to_load").alias("status")
    )


def merge_snapshots(stored: DataFrame, incoming: DataFrame, decisions: DataFrame) -> DataFrame:
    """New content of every affected date: winners, and all rows nothing was decided about.

    ``stored`` and ``incoming`` are rows of one table (stock or other assets); ``decisions``
    holds one row per date and fund.
    """
    affected = decisions.where("inserted OR stored_source_type IS NOT NULL").select(
        F.col("data_date").alias("date")
    ).distinct()
    verdict = decisions.select(
        F.col("data_date").alias("date"), "etf_code", "decision", "inserted", "stored_source_type"
    )
    preserved = F.col("decision") == "existing_higher_priority_source_preserved"
    stays = F.col("decision").isNull() | (
        ~F.col("inserted") & (~preserved | (F.col("source_type") == F.col("stored_source_type")))
    )
    kept = (
        stored.join(F.broadcast(affected), "date", "left_semi")
        .join(verdict, ["date", "etf_code"], "left")
        .where(stays)
        .select(*stored.columns)
    )
    winners = decisions.where("inserted").select("run_date", "candidate_id")
    new = incoming.join(winners, ["run_date", "candidate_id"], "left_semi").select(*stored.columns)
    return kept.unionByName(new)
