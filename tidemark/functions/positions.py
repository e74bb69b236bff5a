"""Row-level rules on position changes: flow adjustment, classes, event flags and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.params import DEFAULT, Params


def active_delta(params: Params = DEFAULT) -> Column:
    """Share change beyond what fund flows explain; the raw change when flows are unknown."""
    expected = F.col("prev_shares") * F.col("etf_scale_factor")
    raw = F.col("shares") - F.col("prev_shares")
    excess = F.col("shares") - expected
    return (
        F.when(excess.isNull(), raw)
        .when(F.abs(excess) <= params.epsilon, F.lit(0.0))
        .otherwise(excess)
    )


def active_delta_pct(params: Params = DEFAULT) -> Column:
    base = F.coalesce(F.col("prev_shares") * F.col("etf_scale_factor"), F.col("prev_shares"))
    return F.when(
        F.abs(base) >= params.epsilon, F.col("active_shares_delta_1d") / F.nullif(base, F.lit(0.0)) * 100.0
    )


def is_material(params: Params = DEFAULT) -> Column:
    delta, pct = F.col("active_shares_delta_1d"), F.col("active_shares_delta_pct_1d")
    return F.coalesce(
        (F.abs(delta) > params.epsilon) & (pct.isNull() | (F.abs(pct) >= params.min_active_pct)),
        F.lit(False),
    )


def position_class(params: Params = DEFAULT) -> Column:
    """Struct of the seven classification fields for one paired position."""
    eps = params.epsilon
    active, weight = F.col("active_shares_delta_1d"), F.col("weight_delta_1d")
    raw, scale = F.col("shares_delta_1d"), F.col("etf_scale_factor")
    weight_up, weight_down = weight > eps, weight < -eps
    bought, sold = active > eps, active < -eps
    no_shares = active.isNull()
    on_flow = scale.isNotNull() & (F.abs(active) <= eps)
    material = is_material(params)

    def label(kind: str, direction: str, confidence: str, passive: int = 0) -> Column:
        return F.struct(
            F.lit(kind).alias("position_change_type"),
            F.lit(direction).alias("active_direction"),
            F.lit(int(direction == "add")).alias("is_active_add"),
            F.lit(int(direction == "reduce")).alias("is_active_reduce"),
            F.lit(passive).alias("is_passive_weight_change"),
            F.lit(direction).alias("flow_adjusted_direction"),
            F.lit(confidence).alias("confidence"),
        )

    rules = [
        (F.col("is_new_position") == 1, label("new_position", "add", "high")),
        (F.col("is_removed_position") == 1, label("removed_position", "reduce", "high")),
        (no_shares & weight_up, label("weight_only_increase", "unknown", "low")),
        (no_shares & weight_down, label("weight_only_decrease", "unknown", "low")),
        (no_shares, label("unchanged", "none", "low")),
        (on_flow & (raw > eps), label("flow_scaled_increase", "none", "medium")),
        (on_flow & (raw < -eps), label("flow_scaled_decrease", "none", "medium")),
        (~material & bought, label("immaterial_active_increase", "none", "low")),
        (~material & sold, label("immaterial_active_decrease", "none", "low")),
        (bought & ~weight_down, label("confirmed_active_add", "add", "high")),
        (bought, label("mixed_add_but_weight_down", "add", "medium")),
        (sold & ~weight_up, label("confirmed_active_reduce", "reduce", "high")),
        (sold, label("mixed_reduce_but_weight_up", "reduce", "medium")),
        (weight_up, label("passive_weight_increase", "none", "low", passive=1)),
        (weight_down, label("passive_weight_decrease", "none", "low", passive=1)),
    ]
    chain = F.when(*rules[0])
    for condition, value in rules[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(label("unchanged", "none", "high"))


def _truth(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def streak_event(direction: str, params: Params = DEFAULT) -> Column:
    """A run of at least three active days, or of weight days when only raw shares are known."""
    sign = 1 if direction == "add" else -1
    active_run = F.coalesce(F.col(f"consecutive_active_{direction}_days"), F.lit(0))
    weight_run = F.coalesce(F.col(f"consecutive_{direction}_days"), F.lit(0))
    raw, active = F.col("shares_delta_1d"), F.col("active_shares_delta_1d")
    return F.when(
        active_run >= params.event_streak, _truth(F.coalesce(active, raw) * sign > 0)
    ).otherwise(
        _truth(
            (F.coalesce(F.col("is_passive_weight_change"), F.lit(0)) == 0)
            & (active_run == 0)
            & (weight_run >= params.event_streak)
            & active.isNull()
            & (raw * sign > 0)
        )
    )


def direction_event(direction: str, params: Params = DEFAULT) -> Column:
    """Add or reduce event: core position opened or closed, active flag or direction, or a run."""
    if direction == "add":
        core = (F.col("is_new_position") == 1) & (F.col("weight_pct") >= params.core_weight)
    else:
        core = (F.col("is_removed_position") == 1) & (F.col("prev_weight_pct") >= params.core_weight)
    return (
        _truth(core)
        | _truth(F.col(f"is_active_{direction}") == 1)
        | _truth(F.col("active_direction") == direction)
        | streak_event(direction, params)
    )


# Intent score of each kind of event.
NEW_SCORE, REMOVED_SCORE = 4.0, -4.0
ADD_SCORE, REDUCE_SCORE = 2.0, -2.0
STREAK_ADD_SCORE, STREAK_REDUCE_SCORE = 1.5, -1.5


def event_score(params: Params = DEFAULT) -> Column:
    kind = F.coalesce(F.col("position_change_type"), F.lit(""))
    direction = F.coalesce(F.col("active_direction"), F.lit(""))

    def moves(side: str) -> Column:
        flagged = F.coalesce(F.col(f"is_active_{side}"), F.lit(0)) == 1
        return flagged | (direction == side) | kind.contains(f"active_{side}")

    def on_streak(side: str) -> Column:
        return F.coalesce(F.col(f"consecutive_active_{side}_days"), F.lit(0)) >= params.event_streak

    is_new = (F.coalesce(F.col("is_new_position"), F.lit(0)) == 1) | (kind == "new_position")
    is_gone = (F.coalesce(F.col("is_removed_position"), F.lit(0)) == 1) | (kind == "removed_position")
    return (
        F.when(is_new, F.lit(NEW_SCORE))
        .when(is_gone, F.lit(REMOVED_SCORE))
        .when(moves("add") & on_streak("add"), F.lit(STREAK_ADD_SCORE))
        .when(moves("add"), F.lit(ADD_SCORE))
        .when(moves("reduce") & on_streak("reduce"), F.lit(STREAK_REDUCE_SCORE))
        .when(moves("reduce"), F.lit(REDUCE_SCORE))
        .otherwise(F.lit(0.0))
    )


def intent_class(params: Params = DEFAULT) -> Column:
    """Struct of direction, state, tags and confidence for one intent rollup row."""
    window = F.col("window_days")

    def by_window(values: dict[int, float]) -> Column:
        out = F.lit(None).cast("double")
        for days, value in values.items():
            out = F.when(window == days, F.lit(value)).otherwise(out)
        return out

    def label(direction: str, state: str, tags: list[str], confidence: str) -> Column:
        return F.struct(
            F.lit(direction).alias("intent_direction"),
            F.lit(state).alias("primary_intent_state"),
            (F.array(*map(F.lit, tags)) if tags else F.array().cast("array<string>")).alias("tags"),
            F.lit(confidence).alias("confidence"),
        )

    ratio, net, gross = F.col("net_to_gross"), F.col("net_active_score"), F.col("gross_active_score")
    limit, busy = by_window(params.net_threshold), gross >= by_window(params.high_gross)
    lean = params.directional_ratio
    balanced = F.abs(ratio) <= lean
    both_sides = (F.col("buy_issuer_count") >= 2) & (F.col("sell_issuer_count") >= 2)
    rotating = (
        (F.col("rotation_buy_etf_count") > 0)
        & (F.col("rotation_sell_etf_count") > 0)
        & (F.col("cross_fund_offset_ratio") >= params.offset_ratio)
    )
    broad_buy = (F.col("buy_issuer_count") >= 2) | (F.col("buy_etf_count") >= 3)
    broad_sell = (F.col("sell_issuer_count") >= 2) | (F.col("sell_etf_count") >= 3)
    return (
        F.when(
            F.col("eligible_days") < params.min_eligible_days,
            label("neutral", "insufficient_data", ["insufficient_data"], "low"),
        )
        .when((gross == 0) | ratio.isNull(), label("neutral", "neutral", [], "low"))
        .when(
            (F.col("entity_level") == "stock") & both_sides & busy & balanced,
            label("contested", "contested", ["issuer_disagreement", "high_gross_low_net"], "medium"),
        )
        .when(
            rotating & (ratio >= lean),
            label("rotation_accumulation", "cross_fund_rotation_accumulation",
                  ["cross_fund_rotation", "rotation_net_accumulation"], "medium"),
        )
        .when(
            rotating & (ratio <= -lean),
            label("rotation_distribution", "cross_fund_rotation_distribution",
                  ["cross_fund_rotation", "rotation_net_distribution"], "medium"),
        )
        .when(rotating, label("rotation", "cross_fund_rotation", ["cross_fund_rotation"], "medium"))
        .when(
            (net >= limit) & (ratio >= lean) & broad_buy,
            label("accumulation", "accumulation", ["broad_manager_accumulation"], "medium"),
        )
        .when(
            (net <= -limit) & (ratio <= -lean) & broad_sell,
            label("distribution", "distribution", ["broad_manager_distribution"], "medium"),
        )
        .when(busy & balanced, label("unclear", "high_activity_unclear", ["high_gross_low_net"], "low"))
        .otherwise(label("neutral", "neutral", [], "low"))
    )
