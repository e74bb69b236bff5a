"""Registered queries: one per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.origin import source_family, source_priority
from tidemark.functions.positions import event_score, is_material
from tidemark.operators import changes as C
from tidemark.operators import intent as I
from tidemark.operators import report as R
from tidemark.operators import signals as S
from tidemark.operators import snapshots as P
from tidemark.operators import traction as X
from tidemark.operators import universe as U
from tidemark.operators.streaks import with_streaks
from tidemark.params import DEFAULT
from tidemark.plans.history import History
from tidemark.plans.staging import Staging
from tidemark.sources import generated, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CREATED_AT = "2002-01-02 00:00:00"
_histories: dict[tuple[str, str], History] = {}


def history(spark: SparkSession, sf_dir: str) -> History:
    """One history per session and data folder, so queries share the staged frames."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _histories:
        for (app, _), old in list(_histories.items()):
            if app == key[0]:
                old.staging.release(drop=False)  # results over it may still be waiting
        _histories.clear()
        staging = Staging(spark)
        _histories[key] = History(
            generated.tables(spark, sf_dir, staging.keep),
            staging=staging,
            created_at=F.lit(CREATED_AT).cast("timestamp"),
        )
    return _histories[key]


def tidy(df: DataFrame) -> DataFrame:
    """Engine-neutral output: ISO dates, rounded doubles, 64-bit integers, joined lists."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.BooleanType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str):
    """Register ``fn(history) -> DataFrame`` under a name."""

    def register(fn: Callable[[History], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(history(spark, sf_dir)))
        return fn

    return register


def raw_query(name: str):
    """Register ``fn(spark, sf_dir, history) -> DataFrame`` under a name."""

    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(spark, sf_dir, history(spark, sf_dir)))
        return fn

    return register


# --- A: scans -------------------------------------------------------------------------


@query("scan_holdings")
def _(h):
    return h.rows.select("date", "etf_code", "asset_name", "asset_type", "stock_code", "stock_name",
                         "shares", "weight_pct", "source_type")


@query("scan_dates")
def _(h):
    return tables.scan_dates(h.tables.holdings, h.tables.non_stock)


@query("range_filter")
def _(h):
    return tables.range_filter(h.tables.holdings, "1996-01-01", "1997-12-31").select("date").distinct()


# --- B: snapshots ---------------------------------------------------------------------


@query("snapshot_validity")
def _(h):
    return h.snapshots.select("date", "etf_code", "source_type", "valid", "reason")


@query("snapshot_metrics")
def _(h):
    return h.snapshots.select("date", "etf_code", "source_type", *P.METRICS)


@query("source_priority")
def _(h):
    return h.snapshots.groupBy("source_type").agg(F.count(F.lit(1)).alias("snapshots")).withColumn(
        "priority", source_priority(F.col("source_type")))


@query("source_family")
def _(h):
    return h.snapshots.groupBy("source_type").agg(F.count(F.lit(1)).alias("snapshots")).withColumn(
        "family", source_family(F.col("source_type")))


@query("canonical_snapshot")
def _(h):
    return h.canonical.select("date", "etf_code", "source_type", "priority", *P.METRICS)


@query("canonical_holdings")
def _(h):
    return P.canonical_holdings(h.rows, h.canonical).select(
        "date", "etf_code", "source_type", "asset_name", "stock_code", "shares", "weight_pct")


@query("canonical_stock_codes")
def _(h):
    return P.canonical_stock_codes(h.tables.holdings, h.canonical)


# --- C: universe and coverage ---------------------------------------------------------


@query("scope_excluded")
def _(h):
    return h.tables.universe.select("code", U.scope_excluded(F.col("official_logic")).alias("excluded"))


@query("active_universe")
def _(h):
    return U.active_universe(h.tables.universe, "1996-06-30").select("code", "name", "issuer", "market", "listing_date")


@query("pending_review")
def _(h):
    return U.pending_review(h.tables.universe).select("code", "name", "issuer")


@query("latest_holdings_date")
def _(h):
    return h.latest


@query("eligible_universe")
def _(h):
    return h.eligible


@query("snapshot_codes")
def _(h):
    return h.canonical.select("date", "etf_code")


@query("coverage")
def _(h):
    return h.coverage


@query("latest_available")
def _(h):
    return h.available


@query("missing_candidates")
def _(h):
    target = "1997-07-01"
    return h.available.where(F.col("date") == F.lit(target).cast("date")).select(
        "etf_code", F.col("latest_date").alias("data_date"))


@query("valid_dates")
def _(h):
    return U.valid_dates(h.coverage).select("date", "expected_count", "actual_count")


@query("latest_valid_date")
def _(h):
    return h.dates.where("date_valid").agg(F.max("date").alias("latest_valid_date"))


@query("prev_valid_date")
def _(h):
    return h.dates.select("date", "date_valid", "prev_date")


# --- D: changes -----------------------------------------------------------------------


@query("date_pairs")
def _(h):
    return C.date_pairs(h.dates)


@query("pair_ratios")
def _(h):
    return h.ratios.where("overlap_ratio IS NOT NULL").select("date", "prev_date", "etf_code", "overlap_ratio", "size_ratio")


@query("comparable_pair")
def _(h):
    return h.ratios.where("comparable").select("date", "prev_date", "etf_code")


@query("change_diagnostics")
def _(h):
    return h.diagnostics.drop("created_at")


@query("ranked_holdings")
def _(h):
    return h.ranked.select("date", "etf_code", "stock_code", "stock_name", "shares", "weight_pct", "source_type", "rank")


@query("scale_factor")
def _(h):
    return C.scale_factors(h.measured).where("etf_scale_factor IS NOT NULL")


CHANGE_KEY = ("date", "etf_code", "stock_code")


@query("position_diff")
def _(h):
    return h.changes.select(*CHANGE_KEY, "stock_name", "prev_date", "prev_weight_pct", "weight_pct", "weight_delta_1d",
                            "prev_shares", "shares", "shares_delta_1d", "prev_rank", "rank", "is_new_position", "is_removed_position")


@query("flow_adjusted_delta")
def _(h):
    classed = C.with_position_change(h.measured).where("compared")
    return classed.select(*CHANGE_KEY, "etf_scale_factor", "active_shares_delta_1d", "active_shares_delta_pct_1d")


@query("materiality")
def _(h):
    return h.changes.select(*CHANGE_KEY, is_material().alias("is_material"))


@query("position_class")
def _(h):
    return h.changes.select(*CHANGE_KEY, *C.CLASS_FIELDS)


@query("change_issuer")
def _(h):
    return h.changes.groupBy("etf_code", "issuer").agg(F.count(F.lit(1)).alias("change_rows"))


@query("weight_streak")
def _(h):
    return h.changes.select(*CHANGE_KEY, "consecutive_add_days", "consecutive_reduce_days")


@query("share_streak")
def _(h):
    timed = with_streaks(C.with_position_change(h.measured)).where("compared")
    return timed.select(*CHANGE_KEY, "share_add_days", "share_reduce_days")


@query("flow_streak")
def _(h):
    return h.changes.select(*CHANGE_KEY, "consecutive_active_add_days", "consecutive_active_reduce_days")


@query("holding_changes")
def _(h):
    return h.changes


@query("change_run_summary")
def _(h):
    return C.change_run_summary(h.dates, h.changes, h.diagnostics)


@query("skipped_funds")
def _(h):
    return C.skipped_funds(h.diagnostics)


# --- E: signals -----------------------------------------------------------------------


@query("event_add")
def _(h):
    return S.event_flags(h.changes).where("add_event").select(*CHANGE_KEY)


@query("event_reduce")
def _(h):
    return S.event_flags(h.changes).where("reduce_event").select(*CHANGE_KEY)


@query("event_streak")
def _(h):
    return S.event_flags(h.changes).select(*CHANGE_KEY, "add_streak_event", "reduce_streak_event")


@query("single_signals")
def _(h):
    return S.single_signals(h.changes).select("date", "etf_code", "stock_code", "signal_type", "signal_score", "freshness_reason")


@query("event_window")
def _(h):
    return S.event_window(h.changes, S.change_dates(h.changes))


def _groups(h):
    days = S.change_dates(h.changes)
    return S.consensus(S.side_events(h.changes, days), days)


@query("consensus")
def _(h):
    return _groups(h).select("date", "stock_code", "direction", "issuer_count", "etf_count", "avg_active_pct")


@query("representative")
def _(h):
    return _groups(h).select("date", "stock_code", "direction", "representative_date", "representative_etf", "stock_name", "confidence")


@query("freshness")
def _(h):
    return S.with_freshness(_groups(h)).select("date", "stock_code", "direction", "signal_freshness", "freshness_reason")


@query("signal_rows")
def _(h):
    return h.signals.select("signal_id", "etf_codes", "issuers", "etf_count", "issuer_count",
                            F.size("evidence").alias("evidence_rows"), "confidence")


@query("manager_signals")
def _(h):
    return h.signals.select("date", "signal_id", "signal_type", "signal_score", "stock_code", "stock_name", "etf_count",
                            "issuer_count", "confidence", "signal_freshness", "freshness_reason")


@query("signal_evidence")
def _(h):
    return S.signal_evidence(h.changes).select("signal_date", "signal_type", "date", "etf_code", "stock_code", "weight_pct",
                                               "active_shares_delta_pct_1d", "position_change_type")


@query("latest_signal_date")
def _(h):
    return S.latest_signal_date(h.signal_facts)


# --- F: intent ------------------------------------------------------------------------

WINDOWS = DEFAULT.intent_windows
ENTITY = ("date", "window_days", "entity_level", "stock_code", "issuer_key")


@query("intent_window")
def _(h):
    return I.intent_window(I.qualifying_dates(h.entries), WINDOWS)


@query("event_score")
def _(h):
    return h.changes.select(*CHANGE_KEY, event_score().alias("score"))


@query("comparable_context")
def _(h):
    return I.comparable_context(h.diagnostics, h.entries, h.members)


@query("eligible_days")
def _(h):
    return h.intent.where("eligible_days > 0").select(*ENTITY, "eligible_days")


@query("entity_scores")
def _(h):
    return h.intent.select(*ENTITY, "cum_active_buy_score", "cum_active_sell_score", "net_active_score", "gross_active_score",
                           "net_to_gross", "buy_etf_count", "sell_etf_count", "buy_issuer_count", "sell_issuer_count")


@query("buy_sell_days")
def _(h):
    return h.intent.select(*ENTITY, "buy_days", "sell_days", "buy_day_pct", "sell_day_pct")


@query("rotation_counts")
def _(h):
    return h.intent.select(*ENTITY, "rotation_buy_etf_count", "rotation_sell_etf_count")


@query("offset_ratio")
def _(h):
    return h.intent.select(*ENTITY, "cross_fund_offset_ratio")


@query("intent_class")
def _(h):
    return h.intent.select(*ENTITY, "intent_direction", "primary_intent_state", "tags", "confidence")


@query("manager_intent")
def _(h):
    rows = I.manager_intent(h.changes, h.ranked, h.entries, h.diagnostics, h.members)
    listed = F.transform("evidence", lambda e: F.concat_ws(":", e["date"].cast("string"), e["etf_code"], e["score"].cast("string")))
    return rows.withColumn("evidence", F.coalesce(F.array_join(listed, "|"), F.lit("")))


# --- G: traction ----------------------------------------------------------------------


@query("traction_window")
def _(h):
    return X.traction_window(S.change_dates(h.changes))


@query("net_active_flow")
def _(h):
    return h.flow


@query("fund_breakdown")
def _(h):
    return X.fund_breakdown(h.changes, h.tables.universe)


@query("traction_buckets")
def _(h):
    return X.traction_buckets(h.flow).select("end_date", "stock_code", "net", "bucket", "strength")


@query("traction_stats")
def _(h):
    return X.traction_stats(X.traction_buckets(h.flow))


# --- H: report ------------------------------------------------------------------------


@query("summary_stats")
def _(h):
    return R.summary_stats(h.entries, h.ranked)


@query("change_summary")
def _(h):
    return R.change_summary(h.changes)


@query("skipped_diagnostics")
def _(h):
    return h.skips


@query("data_warnings")
def _(h):
    return h.warnings


@query("data_quality")
def _(h):
    return h.quality


@query("top_movers")
def _(h):
    return h.movers


@query("new_positions")
def _(h):
    return h.opened


@query("new_position_groups")
def _(h):
    return R.new_position_groups(h.opened)


@query("removed_positions")
def _(h):
    return h.closed


@query("removed_position_groups")
def _(h):
    return R.removed_position_groups(h.closed)


@query("hidden_counts")
def _(h):
    return R.hidden_counts(h.changes)


@query("consensus_holdings")
def _(h):
    return R.consensus_holdings(h.ranked, h.coverage, min_funds=5)


@query("stock_weight_change")
def _(h):
    return h.weight_changes


@query("signal_ranking")
def _(h):
    return R.signal_ranking(h.signal_facts).select("date", "signal_type", "stock_code", "signal_score", "signal_freshness", "freshness_order")


@query("signal_summary")
def _(h):
    return R.signal_summary(h.signal_facts)


@query("signal_sections")
def _(h):
    return R.signal_sections(h.signal_facts).select("date", "section", "position", "signal_type", "stock_code", "signal_freshness", "remaining")


@query("signal_direction")
def _(h):
    return R.signal_direction(h.signal_facts).groupBy("date", "signal_type", "direction").agg(F.count(F.lit(1)).alias("signals"))


@query("signal_avg_active")
def _(h):
    return R.evidence_avg_active(h.signals).select("signal_id", "avg_active_pct")


@query("intent_ranking")
def _(h):
    return h.intent_ranking.select("date", "position", "entity_level", "stock_code", "issuer_key", "primary_intent_state",
                                   "net_active_score", "gross_active_score")


@query("intent_sections")
def _(h):
    return R.intent_sections(h.intent_ranking).select("date", "section", "section_position", "position", "stock_code",
                                                      "issuer_key", "label", "interpretation", "remaining")


@query("observations")
def _(h):
    return h.observations


# --- C: calendar, discovery, maintenance ----------------------------------------------

from tidemark.functions import parsing as Z  # noqa: E402
from tidemark.operators import calendar as K  # noqa: E402
from tidemark.operators import ingest as G  # noqa: E402
from tidemark.sources import payloads as B  # noqa: E402

NOW = "2002-02-02 00:00:00"


def _now():
    return F.lit(NOW).cast("timestamp")


def _trading(spark, sf_dir):
    days = generated.ship_days(spark, sf_dir)
    calendar = K.full_calendar(days)
    return days, K.trading_days(calendar, generated.holidays(calendar))


@raw_query("trading_day")
def _(spark, sf_dir, h):
    days, _ = _trading(spark, sf_dir)
    return K.trading_days(days, generated.holidays(days))


@raw_query("last_trading_day")
def _(spark, sf_dir, h):
    days, calendar = _trading(spark, sf_dir)
    return K.last_trading_day(calendar).join(days, "date", "left_semi").select("date", "last_trading_day")


@raw_query("expected_data_date")
def _(spark, sf_dir, h):
    events = generated.read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("run_at"))
    # A run may fall on the next day where the data is published.
    local_days = events.select(F.explode(F.array(F.to_date("run_at"), F.date_add(F.to_date("run_at"), 1))).alias("date"))
    calendar = K.full_calendar(local_days.distinct())
    last = K.last_trading_day(K.trading_days(calendar, generated.holidays(calendar)))
    return K.expected_data_date(events, last).select("event_id", "run_date", "expected_data_date")


UNIVERSE_OUT = ("code", "name", "issuer", "market", "isin", "listing_date", "retired", "first_seen_date",
                "created_at", "updated_at")


@raw_query("universe_upsert")
def _(spark, sf_dir, h):
    key = F.col("s_suppkey")
    text = F.lit(None).cast("string")
    supplier = generated.read(spark, sf_dir, "supplier")
    known = supplier.where(key % 5 == 0).select(
        F.lower(generated.fund_code(key)).alias("code"),
        F.array(F.lit("issuer"), F.lit("listing_date")).alias("present"),
        text.alias("name"), F.lit("New issuer").alias("issuer"), F.lit(None).cast("date").alias("listing_date"), F.lit(2).alias("seq"))
    # The same codes once more, earlier and in the other case: the issuer is sent again later, the name is not.
    before = known.select(F.upper("code").alias("code"), F.array(F.lit("issuer"), F.lit("name")).alias("present"),
                          F.lit("Renamed").alias("name"), F.lit("Old issuer").alias("issuer"), "listing_date", F.lit(1).alias("seq"))
    new = supplier.where(key % 4 == 0).select(
        F.concat(F.lit("x"), key.cast("string")).alias("code"), F.array(F.lit("listing_date")).alias("present"),
        text.alias("name"), text.alias("issuer"), F.lit("2001-01-01").cast("date").alias("listing_date"), F.lit(1).alias("seq"))
    return U.universe_upsert(h.tables.universe, known.unionByName(before).unionByName(new), _now()).select(*UNIVERSE_OUT)


@raw_query("retire")
def _(spark, sf_dir, h):
    codes = h.tables.universe.where(F.substring("code", 2, 5).cast("int") % 9 == 0).select(F.lower("code").alias("code"))
    return U.retire(h.tables.universe, codes, _now()).select("code", "retired", "updated_at")


def _discovered(spark, sf_dir):
    key = F.col("s_suppkey")
    return generated.read(spark, sf_dir, "supplier").where((key % 3 != 0) & (key % 20 != 19)).select(
        F.when(key % 7 == 1, F.concat(F.lit("z"), key.cast("string"))).otherwise(F.lower(generated.fund_code(key))).alias("code"),
        F.concat(F.lit("Found "), key.cast("string")).alias("name"), F.lit(None).cast("string").alias("issuer"),
        F.lit("TWSE").alias("market"), F.when(key % 2 == 0, F.concat(F.lit("ISIN"), key.cast("string"))).alias("isin"),
        F.when(key % 11 == 0, F.lit("1999-09-09").cast("date")).alias("listing_date"))


@raw_query("universe_reconcile")
def _(spark, sf_dir, h):
    seen = F.lit("2001-10-01").cast("date")
    return U.universe_reconcile(h.tables.universe, _discovered(spark, sf_dir), seen, _now()).select(
        *UNIVERSE_OUT, "action")


def _retirement(spark, sf_dir, h, markets):
    unconfirmed = h.tables.universe.withColumn("retired", F.when(F.substring("code", 2, 5).cast("int") % 11 == 0, 1).otherwise(0))
    status = U.discovery_status(generated.securities(spark, sf_dir), markets)
    return U.retirement_candidates(unconfirmed, _discovered(spark, sf_dir), h.snapshots, F.lit("2001-10-01").cast("date"), status)


@raw_query("retirement_candidates")
def _(spark, sf_dir, h):
    return _retirement(spark, sf_dir, h, generated.securities(spark, sf_dir).select("market"))


@raw_query("retirement_skipped")
def _(spark, sf_dir, h):
    """One expected market returned nothing, so discovery is incomplete."""
    markets = generated.securities(spark, sf_dir).select("market").union(generated.read(spark, sf_dir, "region").select("r_name"))
    return _retirement(spark, sf_dir, h, markets)


@raw_query("discovery_filter")
def _(spark, sf_dir, h):
    return U.discovery_filter(generated.securities(spark, sf_dir))


@raw_query("discovery_status")
def _(spark, sf_dir, h):
    markets = h.tables.universe.select("market").union(generated.read(spark, sf_dir, "region").select("r_name"))
    return U.discovery_status(generated.securities(spark, sf_dir), markets)


# --- B, I: arbitration and ingest -----------------------------------------------------

GATE = DEFAULT.__class__(min_weight=1.0)


def _candidates(h):
    return generated.candidates(h.tables.holdings, h.tables.non_stock)


def _profiles(h):
    if not hasattr(h, "_profiles"):
        h._profiles = h.staging.keep(G.candidate_profiles(_candidates(h)), "candidate_profiles")
    return h._profiles


def _counts(h):
    return G.stored_row_counts(h.tables.holdings)


def _selection(h):
    # A strict ratio, so that thinned candidates of ordinary size count as low.
    strict = DEFAULT.__class__(low_row_count_ratio=1.0)
    checked = G.row_count_check(_profiles(h), _counts(h), strict)
    return G.candidate_selection(checked.withColumn("target_date", F.col("run_date")))


def _outcomes(h):
    return G.scrape_outcome(_selection(h), _profiles(h))


@query("snapshot_arbitration")
def _(h):
    return P.arbitrate(_profiles(h), h.canonical).select("candidate_id", "stored_source_type", "decision", "inserted")


@query("snapshot_equivalence")
def _(h):
    return P.equivalence(_profiles(h), h.canonical).select(
        "candidate_id", "existing_source_type", "existing_snapshot_found", "weight_delta_pct_points", "equivalent")


@query("dedupe_rows")
def _(h):
    rows = _candidates(h)
    twice = rows.unionByName(rows.where(generated.fund_number() % 3 == 0))
    return G.dedupe_rows(twice).groupBy("candidate_id").agg(F.count(F.lit(1)).alias("row_count"))


@query("split_assets")
def _(h):
    stock, other = G.split_assets(_candidates(h))
    a = stock.groupBy("candidate_id").agg(F.count(F.lit(1)).alias("rows")).withColumn("kind", F.lit("stock"))
    b = other.groupBy("candidate_id").agg(F.count(F.lit(1)).alias("rows")).withColumn("kind", F.lit("non_stock"))
    return a.unionByName(b)


@query("min_weight_gate")
def _(h):
    return G.candidate_profiles(_candidates(h), params=GATE).select("candidate_id", "valid", "reason", "row_count", "stock_count")


@query("weight_warning")
def _(h):
    return G.weight_warning(_profiles(h)).select("candidate_id", "source_total_weight", "weight_warning")


@query("row_count_history")
def _(h):
    return G.row_count_history(_counts(h))


@query("row_count_check")
def _(h):
    return G.row_count_check(_profiles(h), _counts(h)).select("candidate_id", "mean_rows", "minimum_expected", "low_confidence")


@query("candidate_selection")
def _(h):
    return _selection(h)


@query("scrape_outcome")
def _(h):
    return _outcomes(h).select("run_date", "etf_code", "candidate_id", "data_date", "outcome", "outcome_reason")


@query("stale_decision")
def _(h):
    return G.store_decision(_outcomes(h), h.canonical).select("run_date", "etf_code", "candidate_id", "outcome", "equivalent", "decision")


@query("run_summary")
def _(h):
    return G.run_summary(_outcomes(h), G.weight_warning(_profiles(h)))


@query("run_failures")
def _(h):
    return G.run_failures(_outcomes(h))


@query("preexisting_partition")
def _(h):
    live = h.tables.universe.where("retired = 0").select(F.col("code").alias("etf_code"))
    return G.preexisting_partition(h.eligible.join(live, "etf_code", "left_semi"), h.canonical)


@query("config_text_map")
def _(h):
    parsed = h.tables.universe.withColumn("m", Z.config_map(F.col("official_logic")))
    return parsed.select("code", F.size("m").alias("entries"), F.try_element_at("m", F.lit("fund_no")).alias("fund_no"),
                         F.try_element_at("m", F.lit("lang")).alias("lang"))


@raw_query("classify_asset")
def _(spark, sf_dir, h):
    key = F.col("p_partkey")
    names = F.array(
        F.concat(F.lit("STK"), key.cast("string"), F.lit("(1"), F.lpad((key % 1000).cast("string"), 3, "0"), F.lit(".tw)")),
        F.lit("Cash USD"), F.lit("台指 期貨"), F.lit("TX Options"), F.lit("公司債"), F.col("p_name"))
    named = generated.read(spark, sf_dir, "part").withColumn("asset_name", F.element_at(names, (key % 6 + 1).cast("int")))
    return named.withColumn("c", Z.classify_asset(F.col("asset_name"))).select("p_partkey", "asset_name", "c.*")


@raw_query("parse_numbers")
def _(spark, sf_dir, h):
    key = F.col("p_partkey")
    whole = F.floor("p_retailprice")
    texts = F.array(F.format_number(whole * 1000, 0), F.lit("-"), F.lit("n/a"), F.concat(F.col("p_retailprice").cast("string"), F.lit("%")),
                    F.lit("0"), F.concat(F.lit("  "), whole.cast("string"), F.lit(" ")))
    shown = generated.read(spark, sf_dir, "part").withColumn("shown", F.element_at(texts, (key % 6 + 1).cast("int")))
    return shown.select("p_partkey", Z.parse_number(F.col("shown")).alias("number"), Z.parse_weight(F.col("shown")).alias("weight"),
                        Z.parse_aggregator_weight(F.when(key % 6 != 2, F.col("shown"))).alias("aggregator_weight"))


ROW_OUT = ("payload_id", "date", "etf_code", "stock_code", "stock_name", "shares", "weight_pct")


def _payloads(h):
    return generated.payloads(h.tables.holdings)


@query("json_payload_rows")
def _(h):
    return B.json_payload_rows(_payloads(h)).select(*ROW_OUT)


@query("payload_rejects")
def _(h):
    return B.payload_rejects(_payloads(h))


@raw_query("fund_options")
def _(spark, sf_dir, h):
    k = F.substring("code", 2, 10).cast("bigint")
    entry = lambda code, number: F.struct(code.alias("SecuritiesCode"), number.cast("string").alias("FundNo"))
    own, blank = entry(F.concat(F.lit(" "), F.lower("code")), k), entry(F.col("code"), F.lit(" "))
    entries = F.when(k % 5 == 1, F.array(entry(F.lit("OTHER"), k))).when(k % 5 == 2, F.array(own, own)).when(k % 5 == 3, F.array(blank)).otherwise(
        F.array(entry(F.lit("OTHER"), k), own))
    body = F.to_json(F.struct(F.when(k % 5 == 0, 1).otherwise(0).alias("StatusCode"), entries.alias("Entries")))
    return B.fund_options(h.tables.universe.select(F.col("code").alias("etf_code"), body.alias("body")))


@query("html_table_rows")
def _(h):
    landed = _payloads(h)
    return B.html_table_rows(landed).unionByName(B.aggregator_table_rows(landed)).select(*ROW_OUT, "asset_name", "asset_type")


@query("text_block_rows")
def _(h):
    return B.text_block_rows(_payloads(h)).select(*ROW_OUT)


@raw_query("security_master_rows")
def _(spark, sf_dir, h):
    return B.security_master_rows(generated.market_pages(generated.securities(spark, sf_dir)))


@query("payload_date")
def _(h):
    return B.payload_dates(_payloads(h).where(F.col("format").isin("html_table", "text_block", "aggregator_table")))


# --- A, D17, K: sinks, backfill, incremental runs -------------------------------------

import re  # noqa: E402
import tempfile  # noqa: E402
import uuid  # noqa: E402

from tidemark.plans.backfill import backfill  # noqa: E402
from tidemark.plans.rebuild import stored_signal_lists  # noqa: E402
from tidemark.sources.store import Store  # noqa: E402
from tidemark.plans.staging import shared_dir  # noqa: E402
from tidemark.sources import sinks  # noqa: E402
from tidemark.streaming import incremental as N  # noqa: E402
from tidemark.streaming import streaks as Y  # noqa: E402


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for a query that writes: the cluster's shared one; a temporary one only in a single JVM."""
    base = shared_dir(spark)
    if base is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def _store(spark, root, h, stock=None, other=None):
    sinks.snapshot_sink(h.tables.holdings if stock is None else stock, h.tables.non_stock if other is None else other, root)
    sinks.table_sink(h.tables.universe, root, "etf_universe")


STORED = ("date", "etf_code", "asset_name", "stock_code", "source_type", "weight_pct")


@raw_query("snapshot_sink")
def _(spark, sf_dir, h):
    root = scratch(spark, "snapshot-sink")
    _store(spark, root, h)
    stored = tables.read_tables(spark, root)
    rows = G.min_weight_filter(_candidates(h).withColumn("scraped_at", F.lit(CREATED_AT).cast("timestamp")))
    decisions = h.staging.keep(G.store_decision(_outcomes(h), h.canonical), "decisions")
    stock, other = G.split_assets(rows)
    affected = decisions.where("inserted OR stored_source_type IS NOT NULL").select(F.col("data_date").alias("date"))
    sinks.snapshot_sink(G.merge_snapshots(stored.holdings, stock, decisions), G.merge_snapshots(stored.non_stock, other, decisions), root, affected)
    again = tables.read_tables(spark, root)
    return tables.scan_holdings(again.holdings, again.non_stock).select(*STORED)


@raw_query("derived_sink")
def _(spark, sf_dir, h):
    root = scratch(spark, "derived-sink")
    sinks.derived_sink(h.changes, root, "etf_holding_changes")
    # A rerun of two years in which one date has no changes any more.
    asked = tables.range_filter(h.dates.select("date"), "1998-01-01", "1999-12-31")
    again = tables.range_filter(h.changes, "1998-01-01", "1999-12-31").where("date <> '1999-01-01'")
    sinks.derived_sink(again, root, "etf_holding_changes", asked)
    return sinks.read_back(spark, f"{root}/etf_holding_changes", h.changes.schema).select(
        *CHANGE_KEY, "position_change_type", "weight_delta_1d")


@raw_query("report_sink")
def _(spark, sf_dir, h):
    root = scratch(spark, "report-sink")
    section = R.change_summary(h.changes)
    for stamp in ("20020101_000000", "20020102_000000"):
        sinks.report_sink(section, root, "change_summary", stamp)
    return sinks.read_back(spark, f"{root}/current/change_summary", section.schema)


@raw_query("backfill")
def _(spark, sf_dir, h):
    root = scratch(spark, "backfill")
    backfill(h, root, "1996-01-01", "1997-12-31", regenerate_signals=True)
    changed = sinks.read_back(spark, f"{root}/etf_holding_changes", h.changes.schema).groupBy("date").agg(F.count(F.lit(1)).alias("change_rows"))
    signals = S.to_storage(h.signals)
    told = sinks.read_back(spark, f"{root}/etf_manager_signals", signals.schema).groupBy("date").agg(F.count(F.lit(1)).alias("signal_rows"))
    return changed.join(told, "date", "left")


@raw_query("incremental_ingest")
def _(spark, sf_dir, h):
    root = scratch(spark, "incremental")
    landing = f"{root}/landing"
    N.init_tables(spark, root, h.tables.universe)
    landed = _payloads(h)
    # The later half arrives first, the earlier half is late.
    for early in (False, True):
        half = landed.where((F.substring("payload_id", 1, 10) < "1998-07-01") == F.lit(early))
        half.write.mode("append").parquet(landing)
        N.incremental_ingest(spark, landing, root, f"{root}/checkpoint").awaitTermination()
    return sinks.read_back(spark, f"{root}/etf_holding_changes", schemas.CHANGES).select(
        *CHANGE_KEY, "prev_date", "position_change_type", "consecutive_add_days", "consecutive_active_add_days", "weight_delta_1d")


_late: dict[int, str] = {}


def _after_late_snapshots(spark, h) -> str:
    """Folder of tables into which half of the funds of one date came late; one run serves both queries below."""
    if id(h) not in _late:
        root = scratch(spark, "late")
        late = (F.col("date") == F.lit("1999-01-01").cast("date")) & (generated.fund_number() % 2 == 1)
        _store(spark, root, h, h.tables.holdings.where(~late), h.tables.non_stock.where(~late))
        N.rebuild_from(spark, root)
        arrived = h.rows.where(late).withColumn("run_date", F.col("date")).withColumn(
            "candidate_id", F.concat_ws("|", "etf_code", "source_type"))
        N.process_candidates(spark, root, arrived, "late")
        _late.clear()
        _late[id(h)] = root
    return _late[id(h)]


@raw_query("late_snapshot")
def _(spark, sf_dir, h):
    root = _after_late_snapshots(spark, h)
    return sinks.read_back(spark, f"{root}/etf_holding_changes", schemas.CHANGES).select(
        *CHANGE_KEY, "prev_date", "position_change_type", "consecutive_add_days", "consecutive_active_add_days", "weight_delta_1d")


@raw_query("late_signals")
def _(spark, sf_dir, h):
    root = _after_late_snapshots(spark, h)
    return stored_signal_lists(Store(spark, root)).select(
        "date", "signal_id", "signal_type", "signal_score", "stock_code", "stock_name", "etf_count", "issuer_count",
        "confidence", "signal_freshness", "freshness_reason")


@raw_query("stateful_streak")
def _(spark, sf_dir, h):
    root = scratch(spark, "streak")
    rows = with_streaks(C.with_position_change(h.measured)).where("compared").select(*Y.INPUT).withColumns(
        {"date": F.col("date").cast("string"), "prev_date": F.col("prev_date").cast("string")})
    rows = h.staging.keep(rows, "streak_rows")  # both arrivals are cut from it
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, Y.STATE_STORE)
    try:
        # Two arrivals in date order; the state carries the runs across.
        for late in (False, True):
            rows.where((F.col("date") >= "1998-07-01") == F.lit(late)).write.mode("append").parquet(f"{root}/in")
            stream = Y.stateful_streaks(spark.readStream.schema(rows.schema).parquet(f"{root}/in"))
            (stream.writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
             .trigger(availableNow=True).format("parquet").option("path", f"{root}/out").start().awaitTermination())
    finally:
        spark.conf.set(provider, before)
    return spark.read.schema(stream.schema).parquet(f"{root}/out").drop("revision")
