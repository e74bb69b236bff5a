"""Report tables, each computed for every date at once.

Top-k tables use ``row_number`` with a limit, which Spark applies inside each task before the
shuffle; totals are separate aggregates, so no window ever holds a whole date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.universe import only_eligible
from tidemark.params import DEFAULT, Params

# Display order of freshness and of intent states, labels and readings.
FRESHNESS_ORDER = ("new", "reversal", "persistent", "current", "fading", "stale")
INTENT_PRIORITY = (
    "cross_fund_rotation_accumulation", "cross_fund_rotation_distribution", "cross_fund_rotation",
    "accumulation", "distribution", "contested", "high_activity_unclear",
)
INTENT_LABELS = {
    "accumulation": "accumulation",
    "distribution": "distribution",
    "cross_fund_rotation_accumulation": "cross-fund rotation accumulation",
    "cross_fund_rotation_distribution": "cross-fund rotation distribution",
    "cross_fund_rotation": "cross-fund rotation / unclear",
    "contested": "issuer disagreement / contested",
    "high_activity_unclear": "high activity unclear",
}
INTENT_READINGS = {
    "accumulation": "broad active accumulation",
    "distribution": "broad active distribution",
    "cross_fund_rotation_accumulation": "same-issuer fund-level rotation while net exposure increased",
    "cross_fund_rotation_distribution": "same-issuer fund-level rotation while net exposure decreased",
    "cross_fund_rotation": "same-issuer fund-level rotation; net direction unclear",
    "contested": "different issuers disagreeing",
    "high_activity_unclear": "high gross activity with low directional clarity",
}
_QUIET_STATES = ("neutral", "insufficient_data")


def _lookup(key: Column, values: dict[str, str], default: Column) -> Column:
    out = default
    for name, value in values.items():
        out = F.when(key == name, F.lit(value)).otherwise(out)
    return out


def _position(key: Column, order: tuple[str, ...], other: int) -> Column:
    at = F.array_position(F.array(*map(F.lit, order)), key)
    return F.when(at > 0, (at - 1).cast("int")).otherwise(F.lit(other))


def _zero(*names: str) -> dict[str, Column]:
    return {n: F.coalesce(n, F.lit(0)) for n in names}


# --- Holdings and coverage ------------------------------------------------------------


def summary_stats(entries: DataFrame, ranked: DataFrame) -> DataFrame:
    """Funds, distinct stocks and non-stock rows on each date, canonical rows only."""
    stocks = (
        ranked.where("asset_type = 'stock'").groupBy("date", "stock_code").count()
        .groupBy("date").agg(F.count(F.lit(1)).alias("stock_count"))
    )
    return (
        entries.groupBy("date")
        .agg(F.count(F.lit(1)).alias("etf_count"), F.sum("non_stock_count").alias("non_stock_count"))
        .join(stocks, "date", "left")
        .withColumns(_zero("stock_count"))
        .select("date", "etf_count", "stock_count", "non_stock_count")
    )


def stock_totals(ranked: DataFrame) -> DataFrame:
    """Canonical weight of each stock over all funds of a date."""
    return ranked.where("asset_type = 'stock'").groupBy("date", "stock_code").agg(
        F.sum(F.coalesce("weight_pct", F.lit(0.0))).alias("total_weight")
    )


def stock_weight_change(ranked: DataFrame, dates: DataFrame) -> DataFrame:
    """Total weight minus that of the previous valid date, where the stock is on both."""
    totals = stock_totals(ranked)
    days = dates.select("date", "prev_date").where("prev_date IS NOT NULL")
    now = totals.join(F.broadcast(days), "date").withColumnRenamed("total_weight", "now_weight")
    before = totals.select(F.col("date").alias("prev_date"), "stock_code", F.col("total_weight").alias("prev_weight"))
    return now.join(before, ["prev_date", "stock_code"]).select(
        "date", "prev_date", "stock_code", (F.col("now_weight") - F.col("prev_weight")).alias("weight_change")
    )


def consensus_holdings(ranked: DataFrame, coverage: DataFrame, min_funds: int | None = None, params: Params = DEFAULT) -> DataFrame:
    """Stocks, by code and name, held by at least ``min_funds`` funds on a date."""
    weight = F.coalesce("weight_pct", F.lit(0.0))
    needed = params.consensus_min_funds if min_funds is None else min_funds
    funds = coverage.select("date", F.col("expected_count").alias("active_etf_count"))
    return (
        ranked.where("asset_type = 'stock'")
        .groupBy("date", "stock_code", "stock_name")
        # A canonical snapshot holds a code once, so rows are funds.
        .agg(
            F.count(F.lit(1)).alias("etf_count"),
            F.avg(weight).alias("avg_weight"),
            F.max(weight).alias("max_weight"),
            F.sum(weight).alias("total_weight"),
        )
        .where(F.col("etf_count") >= needed)
        .join(F.broadcast(funds), "date")
    )


def skipped_diagnostics(diagnostics: DataFrame, members: DataFrame) -> DataFrame:
    """Skipped funds of the latest diagnostic run of each date, eligible funds only."""
    newest = diagnostics.groupBy("date").agg(F.max("created_at").alias("created_at"))
    rows = diagnostics.where("status = 'skipped'").join(F.broadcast(newest), ["date", "created_at"], "left_semi")
    return only_eligible(
        rows.select("date", "etf_code", "reason", "current_source_type", "previous_source_type"),
        members.select("etf_code", "eligible_from", "eligible_to"),
    )


def data_warnings(coverage: DataFrame, ranked: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Coverage shortfalls and funds whose stock weight is too small."""
    short = coverage.where("expected_count > 0 AND actual_count < expected_count").select(
        "date", F.lit("incomplete_coverage").alias("warning"), F.lit("").alias("etf_code"),
        F.col("expected_count").cast("double").alias("expected"), F.col("actual_count").cast("double").alias("actual"),
    )
    light = (
        ranked.where("asset_type = 'stock'").groupBy("date", "etf_code")
        .agg(F.sum(F.coalesce("weight_pct", F.lit(0.0))).alias("actual"))
        .where(F.col("actual") < params.min_fund_weight)
        .select("date", F.lit("low_stock_weight").alias("warning"), "etf_code",
                F.lit(params.min_fund_weight).alias("expected"), "actual")
    )
    return short.unionByName(light)


def data_quality(coverage: DataFrame, available: DataFrame, skips: DataFrame, warnings: DataFrame) -> DataFrame:
    """Trust summary of each date. ``available`` has the last good date of each missing fund."""
    gaps = available.groupBy("date").agg(
        F.count("latest_date").alias("stale_count"),
        F.count_if(F.col("latest_date").isNull()).alias("unknown_count"),
    )
    skipped = skips.groupBy("date").agg(F.count(F.lit(1)).alias("skip_count"))
    warned = warnings.groupBy("date").agg(F.count(F.lit(1)).alias("warning_count"))
    joined = coverage.join(gaps, "date", "left").join(skipped, "date", "left").join(warned, "date", "left")
    filled = joined.withColumns(_zero("stale_count", "unknown_count", "skip_count", "warning_count"))
    degraded = (F.col("missing_count") > 0) | (F.col("skip_count") > 0) | (F.col("warning_count") > 0)
    return filled.select(
        "date", "expected_count", "actual_count", F.col("actual_count").alias("fresh_count"),
        "stale_count", "unknown_count", "missing_count", "skip_count", "warning_count",
        F.when(degraded, "Degraded").otherwise("Clean").alias("status"),
        (F.col("missing_count") > 0).cast("int").alias("provisional"),
    )


# --- Changes --------------------------------------------------------------------------


def change_summary(changes: DataFrame) -> DataFrame:
    kept = (F.col("is_new_position") == 0) & (F.col("is_removed_position") == 0)
    return changes.groupBy("date").agg(
        F.count_if(F.col("is_new_position") == 1).alias("new_count"),
        F.count_if(F.col("is_removed_position") == 1).alias("removed_count"),
        F.count_if(kept & (F.col("weight_delta_1d") > 0)).alias("increased_count"),
        F.count_if(kept & (F.col("weight_delta_1d") < 0)).alias("decreased_count"),
    )


def top_movers(changes: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Largest weight moves of actively traded positions; ties go by fund, then stock."""
    order = [F.abs("weight_delta_1d").desc(), F.col("etf_code"), F.col("stock_code")]
    return (
        changes.where("is_new_position = 0 AND is_removed_position = 0")
        .where(~F.col("position_change_type").isin("passive_weight_increase", "passive_weight_decrease"))
        .where(F.abs("active_shares_delta_pct_1d") >= params.mover_min_pct)
        .withColumn("position", F.row_number().over(W.partitionBy("date").orderBy(*order)))
        .where(F.col("position") <= params.mover_limit)
        .select(
            "date", "position", "stock_code", "stock_name", "etf_code",
            F.col("weight_pct").alias("curr_weight"), F.col("prev_weight_pct").alias("prev_weight"),
            "weight_delta_1d", "shares_delta_1d", "active_shares_delta_pct_1d",
            "position_change_type", "active_direction", "confidence",
        )
    )


def new_positions(changes: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Material new positions in stocks that several funds opened on the date."""
    material = changes.where("is_new_position = 1").where(
        (F.col("weight_pct") >= params.material_weight) | (F.col("rank") <= params.top_rank)
    ).select("date", "etf_code", "stock_code", "stock_name", "weight_pct", "shares", "rank")
    several = (
        material.groupBy("date", "stock_code").agg(F.count(F.lit(1)).alias("funds"))
        .where(F.col("funds") >= params.min_new_funds)
    )
    return material.join(several.select("date", "stock_code"), ["date", "stock_code"], "left_semi")


def new_position_groups(positions: DataFrame) -> DataFrame:
    """Funds, largest and total weight per newly opened stock; the fund list goes by weight."""
    listed = F.array_sort(F.collect_list(F.struct((-F.col("weight_pct")).alias("order"), F.col("etf_code"))))
    return positions.groupBy("date", "stock_code").agg(
        F.min("stock_name").alias("stock_name"),
        F.count(F.lit(1)).alias("etf_count"),
        F.max("weight_pct").alias("max_weight"),
        F.sum("weight_pct").alias("total_weight"),
        F.transform(listed, lambda x: x["etf_code"]).alias("etf_codes"),
    )


def removed_positions(changes: DataFrame, params: Params = DEFAULT) -> DataFrame:
    return changes.where("is_removed_position = 1").where(
        (F.col("prev_weight_pct") >= params.material_weight) | (F.col("prev_rank") <= params.top_rank)
    ).select("date", "etf_code", "stock_code", "stock_name", "prev_weight_pct", "prev_shares", "prev_rank")


def removed_position_groups(positions: DataFrame) -> DataFrame:
    listed = F.array_sort(F.collect_list(F.struct((-F.col("prev_weight_pct")).alias("order"), F.col("etf_code"))))
    return positions.groupBy("date", "stock_code").agg(
        F.min("stock_name").alias("stock_name"),
        F.max("prev_weight_pct").alias("max_prev_weight"),
        F.transform(listed, lambda x: x["etf_code"]).alias("etf_codes"),
    )


def hidden_counts(changes: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """New and removed positions too small to show."""

    def small(weight: str, rank: str) -> Column:
        return (F.col(weight) < params.material_weight) & (F.col(rank).isNull() | (F.col(rank) > params.top_rank))

    return changes.groupBy("date").agg(
        F.count_if((F.col("is_new_position") == 1) & small("weight_pct", "rank")).alias("hidden_new"),
        F.count_if((F.col("is_removed_position") == 1) & small("prev_weight_pct", "prev_rank")).alias("hidden_removed"),
    )


# --- Signals --------------------------------------------------------------------------


def _freshness() -> Column:
    return F.coalesce(F.nullif("signal_freshness", F.lit("")), F.lit("current"))


def _is_consensus() -> Column:
    return F.col("signal_type").startswith("consensus_")


def significant(signals: DataFrame, params: Params = DEFAULT) -> DataFrame:
    return signals.where(F.abs("signal_score") >= params.significant_score)


def signal_direction(signals: DataFrame) -> DataFrame:
    kind, score = F.col("signal_type"), F.col("signal_score")
    return signals.withColumn(
        "direction",
        F.when(kind.contains("reduce") | (score < 0), "REDUCE")
        .when(kind.contains("add") | kind.contains("new") | (score > 0), "ADD")
        .otherwise("NEUTRAL"),
    )


def signal_ranking(signals: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Significant signals in report order: one distributed sort, no window per date."""
    ordered = significant(signals, params).withColumn(
        "freshness_order", _position(_freshness(), FRESHNESS_ORDER, 9)
    )
    return ordered.orderBy("date", "freshness_order", F.abs("signal_score").desc(), "stock_code", "signal_type")


def signal_summary(signals: DataFrame, params: Params = DEFAULT) -> DataFrame:
    fresh = _freshness()
    return significant(signals, params).groupBy("date").agg(
        F.count_if(_is_consensus() & (fresh == "new")).alias("fresh_consensus"),
        F.count_if(fresh == "reversal").alias("reversals"),
        F.count_if(_is_consensus() & (fresh == "persistent")).alias("persistent_consensus"),
        F.count_if(fresh.isin("stale", "fading")).alias("stale_or_fading"),
    )


def signal_sections(signals: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Top signals of each report section with the number left out."""
    fresh = _freshness()
    section = (
        F.when(_is_consensus() & (fresh == "new"), 1)
        .when(fresh == "reversal", 2)
        .when(_is_consensus() & (fresh == "persistent"), 3)
        .when(_is_consensus() & fresh.isin("stale", "fading"), 4)
        .when(~_is_consensus() | (fresh == "current"), 5)
    )
    rows = significant(signals, params).withColumn("section", section).where("section IS NOT NULL")
    totals = rows.groupBy("date", "section").agg(F.count(F.lit(1)).alias("total"))
    order = W.partitionBy("date", "section").orderBy(
        _position(_freshness(), FRESHNESS_ORDER, 9), F.abs("signal_score").desc(), "stock_code", "signal_type"
    )
    return (
        rows.withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= params.section_limit)
        .join(F.broadcast(totals), ["date", "section"])
        .withColumn("remaining", F.greatest(F.col("total") - params.section_limit, F.lit(0)))
        .drop("total")
    )


def evidence_avg_active(signals: DataFrame) -> DataFrame:
    """Mean active change over an evidence array, ignoring missing values."""
    values = F.filter(F.transform("evidence", lambda e: e["active_shares_delta_pct_1d"]), lambda v: v.isNotNull())
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return signals.withColumn("avg_active_pct", total / F.nullif(F.size(values), F.lit(0)))


# --- Intent ---------------------------------------------------------------------------


def intent_ranking(intent: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Top intent rows of each date in report order (shortest window, decided states only)."""
    order = W.partitionBy("date").orderBy(
        _position(F.col("primary_intent_state"), INTENT_PRIORITY, 99),
        F.abs("net_active_score").desc(),
        F.col("gross_active_score").desc(),
        "stock_code",
        "issuer_key",
    )
    return (
        intent.where((F.col("window_days") == params.intent_windows[0]) & ~F.col("primary_intent_state").isin(*_QUIET_STATES))
        .withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= params.intent_limit)
    )


def intent_sections(ranking: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Ranked intent rows by section with label and reading; ``remaining`` counts the rest."""
    state = F.col("primary_intent_state")
    section = (
        F.when(state.isin("accumulation", "cross_fund_rotation_accumulation"), 1)
        .when(state.isin("distribution", "cross_fund_rotation_distribution"), 2)
        .when(state == "cross_fund_rotation", 3)
        .when(state.isin("contested", "high_activity_unclear"), 4)
    )
    # The ranking holds at most intent_limit rows per date, so these windows are tiny.
    placed = ranking.withColumn("section", section)
    in_section = W.partitionBy("date", "section").orderBy("position")
    shown = F.coalesce(
        F.col("section").isNotNull() & (F.col("section_position") <= params.intent_section_limit), F.lit(False)
    )
    plain = F.replace(state, F.lit("_"), F.lit(" "))
    return (
        placed.withColumn("section_position", F.row_number().over(in_section))
        .withColumn("shown", shown)
        .withColumn("remaining", F.count_if(~F.col("shown")).over(W.partitionBy("date")))
        .where("shown")
        .withColumn("label", _lookup(state, INTENT_LABELS, plain))
        .withColumn("interpretation", _lookup(state, INTENT_READINGS, plain))
        .drop("shown")
    )


# --- Observations ---------------------------------------------------------------------


def observations(
    consensus: DataFrame,
    weight_changes: DataFrame,
    opened: DataFrame,
    closed: DataFrame,
    movers: DataFrame,
    dates: DataFrame,
    params: Params = DEFAULT,
) -> DataFrame:
    """Short lists: consensus stocks gaining and losing weight, core positions opened and closed,
    funds that dominate the movers."""
    days = dates.where("prev_date IS NOT NULL").select("date")

    def first(rows: DataFrame, kind: str, subject: str, name: str, value: str, *order: Column) -> DataFrame:
        position = F.row_number().over(W.partitionBy("date").orderBy(*order))
        return (
            rows.withColumn("position", position)
            .where(F.col("position") <= params.observation_limit)
            .select(
                "date", F.lit(kind).alias("observation_type"), "position", F.col(subject).alias("subject"),
                F.coalesce(name, F.lit("")).alias("name"), F.col(value).cast("double").alias("value"),
            )
        )

    drift = consensus.select("date", "stock_code", "stock_name").join(weight_changes, ["date", "stock_code"])
    delta = F.col("weight_change")
    gaining = first(drift.where(delta > params.observation_delta), "consensus_gaining", "stock_code", "stock_name",
                    "weight_change", delta.desc(), F.col("stock_code"))
    losing = first(drift.where(delta < -params.observation_delta), "consensus_losing", "stock_code", "stock_name",
                   "weight_change", delta.asc(), F.col("stock_code"))
    new_core = first(opened.where(F.col("weight_pct") >= params.core_weight), "new_core", "stock_code", "stock_name",
                     "weight_pct", F.col("stock_code"), F.col("weight_pct").desc(), F.col("etf_code"))
    gone_core = first(closed.where(F.col("prev_weight_pct") >= params.core_weight), "removed_core", "stock_code",
                      "stock_name", "prev_weight_pct", F.col("prev_weight_pct").desc(), F.col("etf_code"), F.col("stock_code"))
    # Movers are at most mover_limit rows per date.
    active = movers.groupBy("date", "etf_code").agg(F.count(F.lit(1)).alias("moves"), F.min("position").alias("seen"))
    busiest = active.groupBy("date").agg(F.max("moves").alias("lead")).where("lead >= 3").select("date")
    concentrated = first(
        active.join(busiest, "date", "left_semi").withColumn("blank", F.lit("")),
        "mover_concentration", "etf_code", "blank", "moves", F.col("moves").desc(), F.col("seen"),
    )
    every = gaining.unionByName(losing).unionByName(new_core).unionByName(gone_core).unionByName(concentrated)
    return every.join(F.broadcast(days), "date", "left_semi")
