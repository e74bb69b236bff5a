"""Position changes between each date and its previous valid date, for all dates at once.

Held rows move once, to the task of their fund, and are laid out over the dates that see them
there. Pairs (a group is two valid snapshots of one fund, at most twice the number of four-digit
codes), per-fund measures and streaks (a group has at most one row per date) only sort inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.carried import pack, unpack
from tidemark.functions.positions import active_delta, active_delta_pct, position_class
from tidemark.operators.snapshots import by_fund
from tidemark.operators.streaks import STREAK_INPUT, with_streaks
from tidemark.params import DEFAULT, Params

CLASS_FIELDS = (
    "position_change_type", "active_direction", "is_active_add", "is_active_reduce",
    "is_passive_weight_change", "flow_adjusted_direction", "confidence",
)
# Weekday names, Monday first, and the name of an unknown day.
WEEKDAYS = ("週一", "週二", "週三", "週四", "週五", "週六", "週日")
UNKNOWN_WEEKDAY = "未知"


def with_fund_index(entries: DataFrame) -> DataFrame:
    """Dense index of each fund's own canonical dates (one row per fund and date)."""
    return entries.withColumn("ti", F.row_number().over(W.partitionBy("etf_code").orderBy("date")))


def date_pairs(dates: DataFrame) -> DataFrame:
    """Holdings dates with their previous valid date; the first ones have none and are skipped."""
    return dates.where("has_holdings").select(
        "date",
        "prev_date",
        F.when(F.col("prev_date").isNull(), "skipped_first").otherwise("paired").alias("status"),
    )


def paired_positions(ranked: DataFrame, dates: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per (date, fund, stock) held on the date or on its previous valid date.

    Dates without a previous valid date keep their rows, with nothing on the previous side.
    ``dates`` has one row per calendar date, which bounds its broadcasts.
    """
    days = dates.where("has_holdings").select("date", "prev_date", "date_valid", "vi")
    sides = ("stock_name", "shares", "weight_pct", "rank", "source_family")
    # A held row shows on its own date and on every date that looks back to it.
    own = days.select(F.col("date").alias("held_on"), "date", F.lit(1).alias("now"))
    back = days.where("prev_date IS NOT NULL").select(F.col("prev_date").alias("held_on"), "date", F.lit(0).alias("now"))
    held = ranked.select(F.col("date").alias("held_on"), "etf_code", "stock_code", "issuer", "ti", *sides)
    both = by_fund(held, tasks).join(F.broadcast(own.unionByName(back)), "held_on").withColumn("ti", F.when(F.col("now") == 1, F.col("ti")))

    def side(name: str, now: int, alias: str) -> Column:
        return F.max(F.when(F.col("now") == now, F.col(name))).alias(alias)

    sided = both.groupBy("date", "etf_code", "stock_code").agg(
        F.max("issuer").alias("issuer"),
        F.max("ti").alias("own_ti"),
        F.max("now").alias("in_now"),
        (1 - F.min("now")).alias("in_prev"),
        side("stock_name", 1, "now_name"),
        side("stock_name", 0, "prev_name"),
        side("shares", 1, "shares"),
        side("shares", 0, "prev_shares"),
        side("weight_pct", 1, "now_weight"),
        side("weight_pct", 0, "prev_weight_pct"),
        side("rank", 1, "rank"),
        side("rank", 0, "prev_rank"),
        side("source_family", 1, "now_family"),
        side("source_family", 0, "prev_family"),
    )
    # What depends on the date alone need not go through the aggregate.
    return sided.join(F.broadcast(days), "date")


def comparable_pair(
    overlap: Column, size: Column, same_family: Column, params: Params = DEFAULT
) -> Column:
    strict = (overlap >= params.strict_overlap) & (size >= params.strict_size)
    lenient = same_family & (overlap >= params.family_overlap) & (size >= params.family_size)
    return F.coalesce(strict | lenient, F.lit(False))


def _ratios(now: Column, prev: Column, both: Column) -> tuple[Column, Column]:
    present = (now > 0) & (prev > 0)
    return (
        F.when(present, both / F.nullif(F.greatest(now, prev), F.lit(0))),
        F.when(present, now / F.nullif(prev, F.lit(0))),
    )


def pair_ratios(paired: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Overlap and size ratio of each fund with rows on a pair of dates."""
    counted = (
        paired.where("prev_date IS NOT NULL")
        .groupBy("date", "etf_code")
        .agg(
            F.max("prev_date").alias("prev_date"),
            F.sum("in_now").alias("now_count"),
            F.sum("in_prev").alias("prev_count"),
            F.sum(F.col("in_now") * F.col("in_prev")).alias("both_count"),
            F.max("now_family").alias("now_family"),
            F.max("prev_family").alias("prev_family"),
        )
    )
    overlap, size = _ratios(F.col("now_count"), F.col("prev_count"), F.col("both_count"))
    return (
        counted.withColumn("overlap_ratio", overlap)
        .withColumn("size_ratio", size)
        .withColumn(
            "comparable",
            comparable_pair(
                F.col("overlap_ratio"), F.col("size_ratio"), F.col("now_family") == F.col("prev_family"), params
            ),
        )
    )


def change_diagnostics(entries: DataFrame, dates: DataFrame, ratios: DataFrame, created_at: Column) -> DataFrame:
    """Why each fund of a date pair was compared or skipped, with both sides' metrics."""
    pairs = dates.where("has_holdings AND prev_date IS NOT NULL").select("date", "prev_date")
    metrics = ("source_type", "stock_count", "total_weight")
    current = entries.join(F.broadcast(pairs), "date").select(
        "date", "prev_date", "etf_code", *[F.col(m).alias(f"current_{m}") for m in metrics]
    )
    back = pairs.withColumnRenamed("date", "target")
    previous = entries.join(F.broadcast(back), entries["date"] == back["prev_date"]).select(
        F.col("target").alias("date"), "prev_date", "etf_code", *[F.col(m).alias(f"previous_{m}") for m in metrics]
    )
    measured = ratios.select("date", "prev_date", "etf_code", "overlap_ratio", "size_ratio", "comparable")
    keys = ["date", "prev_date", "etf_code"]
    reason = (
        F.when(F.col("current_source_type").isNull(), "missing_current_source")
        .when(F.col("previous_source_type").isNull(), "missing_previous_source")
        .when(F.coalesce("comparable", F.lit(False)), "comparable_source_pair")
        .otherwise("incompatible_source_pair")
    )
    return (
        current.join(previous, keys, "full")
        .join(measured, keys, "left")
        .withColumn("reason", reason)
        .withColumn("status", F.when(F.col("reason") == "comparable_source_pair", "included").otherwise("skipped"))
        .withColumn("created_at", created_at)
        .select(*schemas.columns(schemas.DIAGNOSTICS))
    )


def with_fund_measures(paired: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Comparability and exact median scale factor of each fund and date on every paired row."""
    fund = W.partitionBy("date", "etf_code")
    now, prev = F.sum("in_now").over(fund), F.sum("in_prev").over(fund)
    both = F.sum(F.col("in_now") * F.col("in_prev")).over(fund)
    same_family = F.max("now_family").over(fund) == F.max("prev_family").over(fund)
    ratio = F.when(F.col("prev_shares") > params.epsilon, F.col("shares") / F.nullif("prev_shares", F.lit(0.0)))
    overlap, size = _ratios(F.col("now_n"), F.col("prev_n"), F.col("both_n"))
    rows = pack(paired.withColumn("ratio", ratio), ("date", "etf_code", "in_now", "in_prev", "now_family", "prev_family", "own_ti", "ratio"))
    return (
        unpack(rows.select(
            "*",
            now.alias("now_n"),
            prev.alias("prev_n"),
            both.alias("both_n"),
            same_family.alias("same_family"),
            F.max("own_ti").over(fund).alias("ti"),
            F.count("ratio").over(fund).alias("ratios"),
            F.median("ratio").over(fund).alias("median_ratio"),
        ))
        .withColumn(
            "compared",
            F.col("prev_date").isNotNull() & comparable_pair(overlap, size, F.col("same_family"), params),
        )
        .withColumn(
            "etf_scale_factor", F.when(F.col("ratios") >= params.min_scale_samples, F.col("median_ratio"))
        )
        .drop("ratio", "ratios", "median_ratio", "now_n", "prev_n", "both_n", "same_family", "own_ti")
    )


def scale_factors(measured: DataFrame) -> DataFrame:
    """Scale factor per compared fund and date (NULL below the sample minimum)."""
    return measured.where("compared").groupBy("date", "etf_code").agg(
        F.max("etf_scale_factor").alias("etf_scale_factor")
    )


def with_position_change(measured: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Deltas, flow-adjusted delta, and the classification of every paired row."""
    return (
        measured.withColumn(
            "weight_delta_1d",
            F.coalesce("now_weight", F.lit(0.0)) - F.coalesce("prev_weight_pct", F.lit(0.0)),
        )
        .withColumn("weight_pct", F.coalesce("now_weight", F.lit(0.0)))
        .withColumn("shares_delta_1d", F.col("shares") - F.col("prev_shares"))
        .withColumn("active_shares_delta_1d", active_delta(params))
        .withColumn("active_shares_delta_pct_1d", active_delta_pct(params))
        .withColumn("is_new_position", ((F.col("in_now") == 1) & (F.col("in_prev") == 0)).cast("int"))
        .withColumn("is_removed_position", ((F.col("in_now") == 0) & (F.col("in_prev") == 1)).cast("int"))
        .withColumn("stock_name", F.coalesce(F.nullif("now_name", F.lit("")), "prev_name"))
        .withColumn("class", position_class(params))
        .select("*", *[f"class.{f}" for f in CLASS_FIELDS])
        .drop("class")
    )


def holding_changes(ranked: DataFrame, dates: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The change table over the whole history."""
    paired = paired_positions(ranked, dates)
    return holding_changes_from_pairs(paired, params)


def holding_changes_from_pairs(paired: DataFrame, params: Params = DEFAULT) -> DataFrame:
    classed = with_position_change(with_fund_measures(paired, params), params)
    wanted = {*schemas.columns(schemas.CHANGES), *STREAK_INPUT}
    return compared_rows(with_streaks(classed.select(*[c for c in classed.columns if c in wanted]), params))


def compared_rows(timed: DataFrame) -> DataFrame:
    """The rows and columns of the change table."""
    return timed.where("compared").select(
        *[
            F.coalesce(c, F.lit("")).alias(c) if c == "issuer" else F.col(c)
            for c in schemas.columns(schemas.CHANGES)
        ]
    )


def change_run_summary(dates: DataFrame, changes: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """Outcome of each date: counts, skipped funds, weekday of the previous date, reason."""
    counts = changes.groupBy("date").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("is_new_position").alias("new_positions"),
        F.sum("is_removed_position").alias("removed_positions"),
    )
    skipped = (
        diagnostics.where("status = 'skipped'")
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("skipped_count"))
    )
    out = date_pairs(dates).join(counts, "date", "left").join(skipped, "date", "left")
    ok = F.coalesce("row_count", F.lit(0)) > 0
    any_skipped = F.coalesce("skipped_count", F.lit(0)) > 0
    names = F.array(*map(F.lit, WEEKDAYS))
    return out.select(
        "date",
        "prev_date",
        F.coalesce(
            F.try_element_at(names, F.weekday("prev_date") + 1), F.lit(UNKNOWN_WEEKDAY)
        ).alias("previous_date_weekday"),
        ok.alias("ok"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("row_count", "new_positions", "removed_positions", "skipped_count")],
        F.when(F.col("prev_date").isNull(), "no previous holdings date")
        .when(ok, F.lit(None).cast("string"))
        .when(any_skipped, "not comparable ETF/date pairs")
        .otherwise("no holdings rows")
        .alias("reason"),
    )


def skipped_funds(diagnostics: DataFrame) -> DataFrame:
    """Skipped funds of each date as rows: the list side of the run summary."""
    return diagnostics.where("status = 'skipped'").select("date", "etf_code", "reason")
