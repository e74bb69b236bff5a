"""Traction: net active flow of each stock over a window of change dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.signals import change_dates
from tidemark.params import DEFAULT, Params

_KEY = ("target", "stock_code")


def traction_window(days: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Start and end date of the window ending at each change date.

    The window reaches back ``traction_window`` dates before its end, so it spans one more.
    """
    start = F.greatest(F.col("ci") - params.traction_window, F.lit(1))
    ends = days.select(F.col("date").alias("end_date"), start.alias("start_ci"))
    starts = days.select(F.col("ci").alias("start_ci"), F.col("date").alias("start_date"))
    return ends.join(starts, "start_ci").select("end_date", "start_date")


def _spread(rows: DataFrame, params: Params) -> DataFrame:
    return rows.withColumn("target", F.explode(F.sequence(F.col("ci"), F.col("ci") + params.traction_window)))


def net_active_flow(changes: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Per end date and stock: adds, reduces, issuers on each side, streaks, positions, end-date weight."""
    days = change_dates(changes)
    rows = changes.join(F.broadcast(days), "date")
    added, reduced = F.col("is_active_add") == 1, F.col("is_active_reduce") == 1
    latest = F.struct("date", "etf_code", "stock_name")
    daily = rows.groupBy("ci", "stock_code").agg(
        F.count_if(added).alias("adds"),
        F.count_if(reduced).alias("reduces"),
        F.count_if(added & (F.col("consecutive_active_add_days") >= 2)).alias("add_streaks"),
        F.count_if(reduced & (F.col("consecutive_active_reduce_days") >= 2)).alias("reduce_streaks"),
        F.sum("is_new_position").alias("opened"),
        F.sum("is_removed_position").alias("closed"),
        F.max(F.when(added, latest)).alias("add_latest"),
        F.max(F.when(reduced, latest)).alias("reduce_latest"),
    )
    flow = _spread(daily, params).groupBy(*_KEY).agg(
        F.sum("adds").alias("active_adds"),
        F.sum("reduces").alias("active_reduces"),
        F.sum("opened").alias("new_positions"),
        F.sum("closed").alias("removed_positions"),
        F.sum("add_streaks").alias("add_streaks_2plus"),
        F.sum("reduce_streaks").alias("reduce_streaks_2plus"),
        F.max("add_latest").alias("add_latest"),
        F.max("reduce_latest").alias("reduce_latest"),
    ).where((F.col("active_adds") >= params.traction_min_events) | (F.col("active_reduces") >= params.traction_min_events))
    # Issuers: distinct per date first, then per window. An empty issuer counts as one.
    side = F.when(added, "add").otherwise("reduce")
    per_day = rows.where((added | reduced) & F.col("issuer").isNotNull()).select("ci", "stock_code", side.alias("side"), "issuer").distinct()
    issuers = (
        _spread(per_day, params).select(*_KEY, "side", "issuer").distinct()
        .groupBy(*_KEY).agg(
            F.count_if(F.col("side") == "add").alias("add_issuers"),
            F.count_if(F.col("side") == "reduce").alias("reduce_issuers"),
        )
    )
    weights = rows.groupBy(F.col("ci").alias("target"), "stock_code").agg(
        F.round(F.sum("weight_pct"), 2).alias("total_weight"),
        F.round(F.avg("weight_pct"), 2).alias("avg_weight"),
    )
    ends = days.select(F.col("ci").alias("target"), F.col("date").alias("end_date"))
    return (
        flow.join(issuers, list(_KEY), "left")
        .join(weights, list(_KEY), "left")
        .join(F.broadcast(ends), "target")
        .select(
            "end_date", "stock_code",
            F.coalesce("add_latest.stock_name", "reduce_latest.stock_name", F.lit("")).alias("stock_name"),
            "active_adds", "active_reduces", "new_positions", "removed_positions",
            F.coalesce("add_issuers", F.lit(0)).alias("add_issuers"),
            F.coalesce("reduce_issuers", F.lit(0)).alias("reduce_issuers"),
            "add_streaks_2plus", "reduce_streaks_2plus",
            F.coalesce("total_weight", F.lit(0.0)).alias("total_weight"),
            F.coalesce("avg_weight", F.lit(0.0)).alias("avg_weight"),
        )
    )


def fund_breakdown(changes: DataFrame, universe: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Active rows of each stock inside the window of every end date, with the fund's name.

    Funds missing from the universe drop out. A row appears once per window that covers its date.
    """
    active = changes.where("is_active_add = 1 OR is_active_reduce = 1").join(F.broadcast(change_dates(changes)), "date")
    ends = change_dates(changes).select(F.col("ci").alias("target"), F.col("date").alias("end_date"))
    return (
        active.join(universe.select(F.col("code").alias("etf_code"), "name"), "etf_code")
        .transform(_spread, params)
        .join(F.broadcast(ends), "target")
        .select(
            "end_date", "date", "etf_code", "name", "issuer", "stock_code", "position_change_type", "active_direction",
            F.round("weight_pct", 2).alias("weight"),
            F.round("active_shares_delta_1d", 0).alias("shares_delta"),
        )
    )


def traction_buckets(flow: DataFrame) -> DataFrame:
    """Gaining, losing and split stocks with the strength of the move."""
    net = F.col("active_adds") - F.col("active_reduces")
    bucket = (
        F.when((net >= 2) & ((F.col("add_issuers") >= 2) | (net >= 4)), "gaining")
        .when((net <= -2) & ((F.col("reduce_issuers") >= 2) | (net <= -4)), "losing")
        .when((F.abs(net) <= 1) & (F.col("active_adds") >= 3) & (F.col("active_reduces") >= 2), "split")
    )
    size = F.abs(net)
    strength = F.when(size >= 6, "strong").when(size >= 4, "medium").otherwise("early")
    return flow.withColumn("net", net).withColumn("bucket", bucket).withColumn(
        "strength", F.when(F.col("bucket").isin("gaining", "losing"), strength)
    )


def traction_stats(buckets: DataFrame) -> DataFrame:
    return buckets.groupBy("end_date").agg(
        F.count(F.lit(1)).alias("stocks"),
        *[F.count_if(F.col("bucket") == b).alias(b) for b in ("gaining", "losing", "split")],
    )
