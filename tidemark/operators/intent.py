"""Manager intent: rolling scores per stock, and per stock and issuer.

Facts are reduced to one row per (date, entity) and to one row per (window, entity, fund)
before anything is counted, so no distinct aggregate and no per-group list is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.positions import event_score, intent_class
from tidemark.operators.universe import only_eligible
from tidemark.params import DEFAULT, Params

METRIC_VERSION = "manager_intent_mvp_v1"
_ENTITY = ("entity_level", "stock_code", "issuer_key")
_ROLLUP = ("target", "window_days", *_ENTITY)


def check_windows(windows: Sequence[int], params: Params = DEFAULT) -> tuple[int, ...]:
    bad = [w for w in windows if int(w) not in params.intent_windows]
    if bad:
        raise ValueError(f"Unsupported manager intent window: {bad[0]}. Supported windows: {sorted(params.intent_windows)}")
    return tuple(int(w) for w in windows)


def qualifying_dates(entries: DataFrame) -> DataFrame:
    """Dates with at least one eligible, validly covered fund, densely indexed."""
    return entries.select("date").distinct().withColumn("qi", F.row_number().over(W.orderBy("date")))


def _spread(rows: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Rows repeated for each window length and each target index that sees them."""
    lengths = F.explode(F.array(*[F.lit(w) for w in windows]))
    return rows.withColumn("window_days", lengths).withColumn(
        "target", F.explode(F.sequence(F.col("qi"), F.col("qi") + F.col("window_days") - 1))
    )


def intent_window(days: DataFrame, windows: Sequence[int], params: Params = DEFAULT) -> DataFrame:
    """(date, window_days, member_date): the dates each target's window holds."""
    windows = check_windows(windows, params)
    target = days.select(F.col("qi").alias("target"), F.col("date").alias("target_date"))
    return (
        _spread(days, windows).join(target, "target")
        .select(F.col("target_date").alias("date"), "window_days", F.col("date").alias("member_date"))
    )


def comparable_context(diagnostics: DataFrame, entries: DataFrame, members: DataFrame) -> DataFrame:
    """(date, etf_code) that count: compared funds, or every canonical one on dates never diagnosed."""
    diagnosed = diagnostics.select("date").distinct()
    compared = only_eligible(diagnostics.where("status = 'included'").select("date", "etf_code").distinct(), members)
    fallback = entries.select("date", "etf_code").join(F.broadcast(diagnosed), "date", "left_anti")
    return compared.unionByName(fallback)


def scored_events(changes: DataFrame, members: DataFrame, days: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Scored change rows of eligible funds with a known issuer."""
    terms = members.select("etf_code", "eligible_from", "eligible_to")
    return (
        only_eligible(changes.where("issuer <> ''"), terms)
        .withColumn("score", event_score(params))
        .where("score <> 0")
        .join(F.broadcast(days), "date")
        .select(
            "qi", "date", "etf_code", "issuer", "stock_code", "stock_name", "score",
            "position_change_type", "active_direction",
        )
    )


def held_rows(ranked: DataFrame, context: DataFrame, changes: DataFrame, days: DataFrame) -> DataFrame:
    """Canonical stock rows of comparable funds, with the issuer known to the universe or to an event."""
    by_event = changes.where("issuer <> ''").groupBy("etf_code").agg(F.max_by("issuer", "date").alias("event_issuer"))
    known = context.join(by_event, "etf_code", "left")
    return (
        ranked.where("asset_type = 'stock'")
        .join(known, ["date", "etf_code"])
        .withColumn("issuer", F.coalesce(F.nullif("issuer", F.lit("")), "event_issuer"))
        .where("issuer IS NOT NULL")
        .join(F.broadcast(days), "date")
        .select("qi", "date", "etf_code", "issuer", "stock_code", "stock_name")
    )


def entity_days(held: DataFrame, scored: DataFrame) -> DataFrame:
    """One row per date and entity at both levels: held flag, buy and sell score, net score."""
    presence = held.select(
        "qi", "date", "stock_code", "issuer", "stock_name", F.lit(0).alias("late"),
        F.lit(1).alias("held"), F.lit(0.0).alias("score"),
    )
    acted = scored.select(
        "qi", "date", "stock_code", "issuer", "stock_name", F.lit(1).alias("late"),
        F.lit(0).alias("held"), "score",
    )
    # Numbers only in the first, fact-sized aggregate, so it stays a hash aggregate; the name
    # of an entity (earliest date, holdings before events) is chosen from its few rows.
    by_name = (
        presence.unionByName(acted)
        .groupBy("qi", "date", "stock_code", "issuer", "stock_name", "late")
        .agg(
            F.max("held").alias("held"),
            F.sum(F.when(F.col("score") > 0, F.col("score")).otherwise(0.0)).alias("buy"),
            F.sum(F.when(F.col("score") < 0, -F.col("score")).otherwise(0.0)).alias("sell"),
        )
    )
    grouped = by_name.groupingSets(
        [["qi", "stock_code", "issuer"], ["qi", "stock_code"]], "qi", "stock_code", "issuer"
    ).agg(
        F.grouping("issuer").alias("both_levels"),
        F.max("held").alias("held"),
        F.sum("buy").alias("buy"),
        F.sum("sell").alias("sell"),
        F.min(F.when(F.col("stock_name").isNotNull(), F.struct("late", "date", "stock_name"))).alias("named"),
    )
    return grouped.select(
        "qi",
        F.when(F.col("both_levels") == 1, "stock").otherwise("issuer_stock").alias("entity_level"),
        "stock_code",
        F.coalesce("issuer", F.lit("")).alias("issuer_key"),
        "held", "buy", "sell", "named",
    )


def entity_scores(per_day: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Day counts and score sums of every entity and window."""
    net = F.col("buy") - F.col("sell")
    return _spread(per_day, windows).groupBy(*_ROLLUP).agg(
        F.sum("held").alias("eligible_days"),
        F.sum(F.when(net > 0, F.col("held")).otherwise(0)).alias("buy_days"),
        F.sum(F.when(net < 0, F.col("held")).otherwise(0)).alias("sell_days"),
        F.sum("buy").alias("cum_active_buy_score"),
        F.sum("sell").alias("cum_active_sell_score"),
        F.min("named").alias("named"),
    )


def sliding_distinct(
    events: DataFrame, group: Sequence[str], member: Sequence[str], flags: Sequence[str], windows: Sequence[int]
) -> DataFrame:
    """Distinct members per group with each flag, in the window that ends at each target.

    ``events``: qi, group, member and 0/1 flag columns. An event is seen by the targets from its
    own index up to the member's next event or the end of the window, so it is two rows, a step up
    and a step down, whatever the window's length. Steps are summed per group and index before
    they are added up; only these sums are laid out over the targets.
    """
    sides = F.explode(F.array_compact(F.array(*[F.when(F.col(f) == 1, f) for f in flags])))
    order = W.partitionBy(*group, *member, "side").orderBy("qi")
    seen = events.withColumn("side", sides).select(*group, *member, "side", "qi").distinct().withColumn("later", F.lead("qi").over(order))
    steps = F.explode(F.flatten(F.array(*[
        F.array(
            F.struct(F.lit(n).alias("window_days"), F.col("qi").alias("at"), F.lit(1).alias("step")),
            F.struct(F.lit(n).alias("window_days"), F.least(F.col("qi") + n, F.col("later")).alias("at"), F.lit(-1).alias("step")),
        ) for n in windows
    ])))
    summed = seen.select(*group, "side", steps.alias("s")).groupBy(*group, "s.window_days", "s.at").agg(
        *[F.sum(F.when(F.col("side") == f, F.col("s.step")).otherwise(0)).alias(f) for f in flags])
    run = W.partitionBy(*group, "window_days").orderBy("at")
    counted = summed.select(*group, "window_days", "at", F.lead("at").over(run).alias("until"), *[F.sum(f).over(run).alias(f) for f in flags])
    some = F.greatest(F.lit(0), *map(F.col, flags)) > 0
    return counted.where(some).select(
        F.explode(F.sequence("at", F.col("until") - 1)).alias("target"), "window_days", *group, *flags)


def fund_counts(scored: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Distinct buying and selling funds and issuers per entity and window, and rotation counts.

    A fund rotates on a date when another fund of its issuer did the opposite with the stock.
    One fund has one row per date and stock, so the issuer's buyers and sellers are disjoint.
    """
    bought, sold = F.col("score") > 0, F.col("score") < 0
    two_sided = (
        scored.groupBy("qi", "stock_code", "issuer")
        .agg(F.bool_or(bought).alias("any_buy"), F.bool_or(sold).alias("any_sell"))
        .where("any_buy AND any_sell")
        .select("qi", "stock_code", "issuer", F.lit(1).alias("rotating"))
    )
    rotating = F.coalesce("rotating", F.lit(0))
    flagged = scored.join(two_sided, ["qi", "stock_code", "issuer"], "left").select(
        "qi", "stock_code", "issuer", "etf_code",
        bought.cast("int").alias("buy_etf_count"),
        sold.cast("int").alias("sell_etf_count"),
        (rotating * bought.cast("int")).alias("rotation_buy_etf_count"),
        (rotating * sold.cast("int")).alias("rotation_sell_etf_count"),
    )
    etfs = ["buy_etf_count", "sell_etf_count"]
    rotations = ["rotation_buy_etf_count", "rotation_sell_etf_count"]
    by_issuer = sliding_distinct(flagged, ["stock_code", "issuer"], ["etf_code"], etfs + rotations, windows)
    # A fund may change issuer inside a window, so funds are counted again per stock.
    funds = sliding_distinct(flagged, ["stock_code"], ["etf_code"], etfs, windows)
    base = ["target", "window_days", "stock_code"]
    issuers = by_issuer.groupBy(*base).agg(
        F.count_if(F.col("buy_etf_count") > 0).alias("buy_issuer_count"),
        F.count_if(F.col("sell_etf_count") > 0).alias("sell_issuer_count"),
    )
    by_stock = funds.join(issuers, base).select(
        *base, F.lit("stock").alias("entity_level"), F.lit("").alias("issuer_key"),
        *etfs, "buy_issuer_count", "sell_issuer_count", *[F.lit(0).cast("bigint").alias(c) for c in rotations],
    )
    return by_issuer.select(
        *base, F.lit("issuer_stock").alias("entity_level"), F.col("issuer").alias("issuer_key"), *etfs,
        (F.col("buy_etf_count") > 0).cast("bigint").alias("buy_issuer_count"),
        (F.col("sell_etf_count") > 0).cast("bigint").alias("sell_issuer_count"), *rotations,
    ).unionByName(by_stock)


COUNTS = (
    "buy_etf_count", "sell_etf_count", "buy_issuer_count", "sell_issuer_count",
    "rotation_buy_etf_count", "rotation_sell_etf_count",
)


def intent_evidence(scored: DataFrame, windows: Sequence[int], params: Params = DEFAULT) -> DataFrame:
    """First events of each rollup by date and fund.

    Ranked top-k: each task keeps at most ``intent_evidence`` rows of a group before the
    shuffle, first per date, then per window.
    """
    both = scored.withColumn("entity_level", F.explode(F.array(F.lit("issuer_stock"), F.lit("stock")))).withColumn(
        "issuer_key", F.when(F.col("entity_level") == "stock", "").otherwise(F.col("issuer"))
    )
    per_day = W.partitionBy("qi", *_ENTITY).orderBy("etf_code")
    first = both.withColumn("n", F.row_number().over(per_day)).where(F.col("n") <= params.intent_evidence).drop("n")
    per_window = W.partitionBy(*_ROLLUP).orderBy("date", "etf_code")
    item = F.struct(
        "date", "etf_code", "issuer", "score", "position_change_type", "active_direction"
    )
    return (
        _spread(first, windows)
        .withColumn("n", F.row_number().over(per_window))
        .where(F.col("n") <= params.intent_evidence)
        .groupBy(*_ROLLUP)
        .agg(F.array_sort(F.collect_list(item)).alias("evidence"))
    )


def manager_intent(
    changes: DataFrame,
    ranked: DataFrame,
    entries: DataFrame,
    diagnostics: DataFrame,
    members: DataFrame,
    windows: Sequence[int] | None = None,
    params: Params = DEFAULT,
    evidence: bool = True,
) -> DataFrame:
    """Intent rows of every qualifying date, window, and entity."""
    windows = check_windows(windows or params.intent_windows, params)
    days = qualifying_dates(entries)
    context = comparable_context(diagnostics, entries, members)
    scored = scored_events(changes, members, days, params)
    held = held_rows(ranked, context, changes, days)
    # A window without any comparable fund gives no rows.
    live = _spread(
        context.select("date").distinct().join(F.broadcast(days), "date"), windows
    ).select("target", "window_days").distinct()
    target = days.select(F.col("qi").alias("target"), F.col("date").alias("target_date"))
    asked = live.join(target, "target")
    buy, sell = F.col("cum_active_buy_score"), F.col("cum_active_sell_score")
    rotating = (F.col("rotation_buy_etf_count") > 0) & (F.col("rotation_sell_etf_count") > 0)
    days_or_null = F.nullif("eligible_days", F.lit(0))
    out = (
        entity_scores(entity_days(held, scored), windows)
        .join(fund_counts(scored, windows), list(_ROLLUP), "left")
        .join(F.broadcast(asked), ["target", "window_days"])
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in COUNTS})
        .withColumn("net_active_score", buy - sell)
        .withColumn("gross_active_score", buy + sell)
        .withColumn("net_to_gross", F.col("net_active_score") / F.nullif("gross_active_score", F.lit(0.0)))
        .withColumn(
            "cross_fund_offset_ratio",
            F.when(rotating & (buy > 0) & (sell > 0), F.least(buy, sell) / F.nullif(F.greatest(buy, sell), F.lit(0.0))),
        )
        .withColumn("buy_day_pct", F.col("buy_days") / days_or_null)
        .withColumn("sell_day_pct", F.col("sell_days") / days_or_null)
        .withColumn("class", intent_class(params))
    )
    if evidence:
        out = out.join(intent_evidence(scored, windows, params), list(_ROLLUP), "left")
    return out.select(
        F.col("target_date").alias("date"),
        "window_days", "entity_level", "stock_code",
        F.col("named.stock_name").alias("stock_name"),
        F.when(F.col("entity_level") == "issuer_stock", F.col("issuer_key")).alias("issuer"),
        "issuer_key", "eligible_days", "buy_days", "sell_days", "buy_day_pct", "sell_day_pct",
        "cum_active_buy_score", "cum_active_sell_score", "net_active_score", "gross_active_score",
        "net_to_gross", *COUNTS, "cross_fund_offset_ratio",
        "class.intent_direction", "class.primary_intent_state", "class.tags", "class.confidence",
        F.lit(METRIC_VERSION).alias("metric_version"),
        *(["evidence"] if evidence else []),
    )
