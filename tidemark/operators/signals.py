"""Manager signals: single-fund events and rolling agreement among issuers.

Agreement is counted in stages: events reduce to one row per (date, stock, direction,
issuer) before they are spread over the dates whose window they fall in. Spreading is an
``explode`` of at most ``signal_window`` targets and an equality join, never a range join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.positions import direction_event, streak_event
from tidemark.operators.intent import sliding_distinct
from tidemark.params import DEFAULT, Params

DIRECTIONS = ("add", "reduce")
EVIDENCE = (
    "date", "etf_code", "issuer", "stock_code", "stock_name", "weight_pct", "prev_weight_pct",
    "shares_delta_1d", "active_shares_delta_1d", "active_shares_delta_pct_1d",
    "position_change_type", "active_direction", "flow_adjusted_direction", "consecutive_add_days",
    "consecutive_reduce_days", "consecutive_active_add_days", "consecutive_active_reduce_days",
)
SIGNAL_COLUMNS = (
    "date", "signal_type", "signal_score", "stock_code", "stock_name", "etf_count", "issuer_count",
    "explanation", "confidence", "signal_freshness", "freshness_reason", "avg_active_pct",
)
# Reasons attached to each freshness.
STALE_REASON = "consensus remains in the rolling window, but there is no current-day event"
REVERSAL_REASON = "current consensus follows an opposite consensus in the previous window"
NEW_REASON = "first reaches consensus in the rolling window"
PERSISTENT_REASON = "consensus continues with current-day evidence"
_GROUP = ("ci", "stock_code", "direction")


def change_dates(changes: DataFrame) -> DataFrame:
    """Distinct change dates with a dense index: one row per calendar date."""
    return changes.select("date").distinct().withColumn("ci", F.row_number().over(W.orderBy("date")))


def event_flags(changes: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Change rows with the four event flags."""
    return changes.select(
        "*",
        *[direction_event(d, params).alias(f"{d}_event") for d in DIRECTIONS],
        *[streak_event(d, params).alias(f"{d}_streak_event") for d in DIRECTIONS],
    )


def side_events(changes: DataFrame, days: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """One row per event and direction, indexed by change date."""
    sides = F.array_compact(
        F.array(*[F.when(direction_event(d, params), F.lit(d)) for d in DIRECTIONS])
    )
    return changes.withColumn("direction", F.explode(sides)).join(F.broadcast(days), "date")


def spread(rows: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Rows repeated for each date index whose window contains them."""
    reach = F.sequence(F.col("ci"), F.col("ci") + F.lit(params.signal_window - 1))
    spread_rows = rows.select("*", F.explode(reach).alias("target"))
    return spread_rows.withColumnRenamed("ci", "event_ci").withColumnRenamed("target", "ci")


def event_window(changes: DataFrame, days: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """(target date, event date, fund, stock): the change rows visible from each change date."""
    keyed = changes.select("date", "etf_code", "stock_code").join(F.broadcast(days), "date")
    target = days.select("ci", F.col("date").alias("target_date"))
    return (
        spread(keyed, params)
        .join(F.broadcast(target), "ci")
        .select("target_date", "date", "etf_code", "stock_code")
    )


def _agreed(events: DataFrame, params: Params) -> DataFrame:
    """Groups with enough distinct issuers in their window: issuers are few, so their distinct rows are spread."""
    named = events.where(F.col("issuer") != "").select(*_GROUP, "issuer").distinct()
    return (
        spread(named, params).select(*_GROUP, "issuer").distinct()
        .groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("issuer_count"))
        .where(F.col("issuer_count") >= params.min_consensus_issuers)
    )


def _with_fund(events: DataFrame) -> DataFrame:
    return events.where(F.col("etf_code") != "")


def consensus(events: DataFrame, days: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Windows in which enough distinct issuers acted on a stock in one direction."""
    daily = events.groupBy(*_GROUP).agg(
        F.max(F.struct("date", "etf_code", "stock_name", "confidence")).alias("latest"),
        F.sum("active_shares_delta_pct_1d").alias("pct_sum"),
        F.count("active_shares_delta_pct_1d").alias("pct_count"),
    )
    rolled = spread(daily, params).groupBy(*_GROUP).agg(
        F.max("latest").alias("latest"),
        F.max("event_ci").alias("last_ci"),
        F.sum("pct_sum").alias("pct_sum"),
        F.sum("pct_count").alias("pct_count"),
    )

    issuers = _agreed(events, params)
    # A fund counts from its event up to its next one or the end of the window: nothing of fund size is spread.
    acted = _with_fund(events).select(F.col("ci").alias("qi"), "stock_code", "direction", "etf_code", F.lit(1).alias("etf_count"))
    funds = sliding_distinct(acted, ["stock_code", "direction"], ["etf_code"], ["etf_count"], [params.signal_window]).select(
        F.col("target").alias("ci"), "stock_code", "direction", "etf_count")
    target = days.select("ci", F.col("date").alias("date"))
    return (
        issuers.join(rolled, list(_GROUP))
        .join(funds, list(_GROUP))
        .join(F.broadcast(target), "ci")
        .select(
            *_GROUP, "date", "issuer_count", "etf_count",
            F.col("latest.date").alias("representative_date"),
            F.col("latest.etf_code").alias("representative_etf"),
            F.col("latest.stock_name").alias("stock_name"),
            F.col("latest.confidence").alias("confidence"),
            (F.col("last_ci") == F.col("ci")).alias("acted_today"),
            (F.col("pct_sum") / F.nullif("pct_count", F.lit(0))).alias("avg_active_pct"),
        )
    )


def with_freshness(groups: DataFrame) -> DataFrame:
    """Freshness of each consensus against the window ending at the previous change date."""
    prior = groups.select(
        (F.col("ci") + 1).alias("ci"), "stock_code", "direction", F.col("issuer_count").alias("prior_count")
    )
    flipped = F.when(F.col("direction") == "add", "reduce").otherwise("add")
    opposite = prior.select("ci", "stock_code", flipped.alias("direction"), F.lit(True).alias("opposite"))
    joined = groups.join(prior, list(_GROUP), "left").join(opposite, list(_GROUP), "left")
    label = (
        F.when(~F.col("acted_today"), "stale")
        .when(F.col("opposite"), "reversal")
        .when(F.col("prior_count").isNull(), "new")
        .when(F.col("issuer_count") < F.col("prior_count"), "fading")
        .otherwise("persistent")
    )
    decline = F.concat(
        F.lit("issuer count declined from "), F.col("prior_count").cast("string"),
        F.lit(" to "), F.col("issuer_count").cast("string"),
    )
    reason = (
        F.when(F.col("signal_freshness") == "stale", STALE_REASON)
        .when(F.col("signal_freshness") == "reversal", REVERSAL_REASON)
        .when(F.col("signal_freshness") == "new", NEW_REASON)
        .when(F.col("signal_freshness") == "fading", decline)
        .otherwise(PERSISTENT_REASON)
    )
    return joined.withColumn("signal_freshness", label).withColumn("freshness_reason", reason)


def consensus_type() -> Column:
    return F.concat(F.lit("consensus_"), F.col("direction"), F.lit("_3d"))


def consensus_signals(groups: DataFrame, params: Params = DEFAULT) -> DataFrame:
    sign = F.when(F.col("direction") == "add", 1).otherwise(-1)
    strength = F.when(F.col("issuer_count") >= params.strong_consensus_issuers, 6.0).otherwise(4.0)
    return (
        with_freshness(groups)
        .withColumn("signal_type", consensus_type())
        .withColumn("signal_score", strength * sign)
        .withColumn("explanation", consensus_type())
        .withColumn("confidence", _confidence())
        .select(*SIGNAL_COLUMNS, "ci", "direction")
    )


def _confidence() -> Column:
    return F.coalesce(F.nullif("confidence", F.lit("")), F.lit("normal"))


def _single_kinds(params: Params) -> list[tuple[Column, str, float, str]]:
    opened = (F.col("is_new_position") == 1) & (F.col("weight_pct") >= params.core_weight)
    closed = (F.col("is_removed_position") == 1) & (F.col("prev_weight_pct") >= params.core_weight)
    return [
        (opened, "new_core_position", 4.0, "single ETF new core position"),
        (closed, "removed_core_position", -5.0, "single ETF removed core position"),
        (streak_event("add", params), "consecutive_add_3d", 4.0, "single ETF consecutive active add"),
        (streak_event("reduce", params), "consecutive_reduce_3d", -4.0, "single ETF consecutive active reduce"),
    ]


def single_signals(changes: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Signals of one fund; a change row may give several."""
    found = F.array_compact(
        F.array(
            *[
                F.when(
                    condition,
                    F.struct(F.lit(kind).alias("kind"), F.lit(score).alias("score"), F.lit(why).alias("why")),
                )
                for condition, kind, score, why in _single_kinds(params)
            ]
        )
    )
    named = F.coalesce("issuer", F.lit("")) != ""
    return (
        changes.withColumn("signal", F.explode(found))
        .withColumn("signal_type", F.col("signal.kind"))
        .withColumn("signal_score", F.col("signal.score"))
        .withColumn("freshness_reason", F.col("signal.why"))
        .withColumn("explanation", F.col("signal.kind"))
        .withColumn("signal_freshness", F.lit("current"))
        .withColumn("etf_count", F.lit(1).cast("bigint"))
        .withColumn("issuer_count", named.cast("bigint"))
        .withColumn("avg_active_pct", F.col("active_shares_delta_pct_1d"))
        .withColumn("confidence", _confidence())
        .drop("signal")
    )


def signal_facts(changes: DataFrame, params: Params = DEFAULT, days: DataFrame | None = None) -> DataFrame:
    """Every signal with its scalar columns: what rankings and reports read.

    No list is collected, so a stock held by every fund costs no more than its counts. ``days``: change dates
    with their index, where ``changes`` holds only some of them; dates whose window and the one before it are
    whole are right.
    """
    days = change_dates(changes) if days is None else days
    groups = consensus(side_events(changes, days, params), days, params)
    single = single_signals(changes, params).select(*SIGNAL_COLUMNS, F.col("etf_code").alias("only_etf"))
    joint = consensus_signals(groups, params).select(*SIGNAL_COLUMNS, F.lit(None).cast("string").alias("only_etf"))
    return single.unionByName(joint)


def signal_evidence(changes: DataFrame, params: Params = DEFAULT, days: DataFrame | None = None) -> DataFrame:
    """One row per signal and supporting change row: the evidence in long form.

    ``only_etf`` is set for single-fund signals and completes their key.
    """
    days = change_dates(changes) if days is None else days
    events = side_events(changes, days, params)
    # Which signals see the events of a date is found on groups; an event then meets them once and is laid out after.
    acted = spread(_with_fund(events).select(*_GROUP).distinct(), params).select(*_GROUP).distinct()
    groups = _agreed(events, params).join(acted, list(_GROUP)).join(
        F.broadcast(days.select("ci", F.col("date").alias("signal_date"))), "ci")
    reach = F.explode(F.sequence(F.col("ci") - F.lit(params.signal_window - 1), F.col("ci")))
    seen = groups.select(reach.alias("ci"), "stock_code", "direction", "signal_date").groupBy(*_GROUP).agg(
        F.collect_list("signal_date").alias("signal_dates"))
    joint = (
        events.select("ci", "direction", *EVIDENCE)
        .join(seen, list(_GROUP))
        .select(
            F.explode("signal_dates").alias("signal_date"), consensus_type().alias("signal_type"),
            F.lit(None).cast("string").alias("only_etf"), *EVIDENCE,
        )
    )
    single = single_signals(changes, params).select(
        F.col("date").alias("signal_date"), "signal_type", F.col("etf_code").alias("only_etf"), *EVIDENCE
    )
    return single.unionByName(joint)


def listed_signals(facts: DataFrame, evidence: DataFrame) -> DataFrame:
    """Signals with id, fund list, issuer list and evidence, made from the long form for those who ask for lists."""
    key = ("date", "signal_type", "stock_code", "only_etf")
    single = F.coalesce("only_etf", F.lit(""))
    lists = evidence.select("signal_date", "signal_type", "stock_code", single.alias("_only"), F.struct(*EVIDENCE).alias("item")).groupBy(
        F.col("signal_date").alias("date"), "signal_type", "stock_code", "_only").agg(F.array_sort(F.collect_list("item")).alias("evidence"))
    named = F.array_sort(F.array_distinct(F.transform("evidence", lambda e: e["etf_code"])))
    issuers = F.array_sort(F.array_distinct(F.filter(F.transform("evidence", lambda e: e["issuer"]), lambda i: i != "")))
    identified = F.concat_ws(":", F.col("date").cast("string"), "signal_type", "stock_code", F.array_join("etf_codes", "-"))
    return (
        facts.withColumn("_only", single)
        .join(lists, [*key[:3], "_only"])
        .withColumns({"etf_codes": named, "issuers": issuers})
        .withColumn("signal_id", identified)
        .select(*SIGNAL_COLUMNS, "etf_codes", "issuers", "evidence", "signal_id")
    )


def manager_signals(
    changes: DataFrame, params: Params = DEFAULT, days: DataFrame | None = None, tasks: int | None = None
) -> DataFrame:
    """The signal table with lists: scalar columns plus id, fund list, issuer list and evidence.

    The id and the lists name every fund of a signal, so a row is as long as its fund list:
    at most one entry per fund of the universe and window date. Consumers that do not need
    the lists read :func:`signal_facts` and :func:`signal_evidence`. Ids repeat only when a
    change key does; the sink removes repeats by id. ``days`` as for :func:`signal_facts`. ``tasks``:
    into how many tasks the evidence goes, so that the lists of one task do not grow with the table.
    """
    days = change_dates(changes) if days is None else days
    events = side_events(changes, days, params)
    item = F.struct(*EVIDENCE)

    def placed(rows: DataFrame) -> DataFrame:
        return rows.repartition(tasks, *_GROUP) if tasks else rows

    lists = (
        placed(spread(events.select("ci", "stock_code", "direction", item.alias("item")), params))
        .groupBy(*_GROUP)
        .agg(F.array_sort(F.collect_list("item")).alias("evidence"))
    )
    named = F.array_sort(F.array_distinct(F.transform("evidence", lambda e: e["etf_code"])))
    issuers = F.array_sort(
        F.array_distinct(F.filter(F.transform("evidence", lambda e: e["issuer"]), lambda i: i != ""))
    )
    joint = (
        placed(consensus_signals(consensus(events, days, params), params))
        .join(lists, list(_GROUP))
        .select(*SIGNAL_COLUMNS, named.alias("etf_codes"), issuers.alias("issuers"), "evidence")
    )
    own_issuer = F.filter(F.array("issuer"), lambda i: F.coalesce(i, F.lit("")) != "")
    single = single_signals(changes, params).select(
        *SIGNAL_COLUMNS, F.array("etf_code").alias("etf_codes"), own_issuer.alias("issuers"), F.array(item).alias("evidence")
    )
    identified = F.concat_ws(
        ":", F.col("date").cast("string"), "signal_type", "stock_code", F.array_join("etf_codes", "-")
    )
    return single.unionByName(joint).withColumn("signal_id", identified)


def to_storage(signals: DataFrame) -> DataFrame:
    """Lists and evidence as JSON text, NULL fields kept."""
    options = {"ignoreNullFields": "false"}
    return signals.select(
        "date", "signal_id", "signal_type", "signal_score", "stock_code", "stock_name",
        F.to_json("etf_codes").alias("etf_codes"),
        F.to_json("issuers").alias("issuers"),
        "etf_count", "issuer_count", "explanation",
        F.to_json("evidence", options).alias("evidence_json"),
        "confidence", "signal_freshness", "freshness_reason",
    )


def latest_signal_date(signals: DataFrame) -> DataFrame:
    return signals.agg(F.max("date").alias("latest_signal_date"))
