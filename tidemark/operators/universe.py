"""Fund universe: scope, as-of membership, coverage, reconciliation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.params import DEFAULT, Params

# Scope markers, discovery words, keys no longer stored.
SCOPE_MARKERS = ("excluded_from_taiwan_stock_universe", "trades_offshore_instruments=true")
ACTIVE_WORD = "主動"
DOMESTIC_ISSUERS = ("中國信託",)
DOMESTIC_WORDS = ("台灣", "臺灣", "台股", "臺股")
OFFSHORE_WORDS = ("境外", "海外", "全球", "美國", "日本", "中國", "越南", "印度", "歐洲", "亞洲")
LEGACY_KEYS = ("last_active_date", "last_seen_date", "retired_since", "pending_retirement_since")
UPSERT_COLUMNS = (
    "name", "issuer", "market", "isin", "listing_date", "retired", "first_seen_date",
    "official_url", "official_method", "official_logic",
)


def scope_excluded(official_logic: Column) -> Column:
    text = F.coalesce(official_logic, F.lit(""))
    first, *others = [text.contains(marker) for marker in SCOPE_MARKERS]
    for other in others:
        first = first | other
    return first


def active_universe(universe: DataFrame, as_of: Column | str) -> DataFrame:
    """Funds in scope, listed on or before the date and not retired, ordered by code."""
    day = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return universe.where(
        (F.col("retired") == 0) & (F.col("listing_date") <= day) & ~scope_excluded(F.col("official_logic"))
    ).orderBy("code")


def pending_review(universe: DataFrame) -> DataFrame:
    return universe.where((F.col("retired") == 0) & F.col("listing_date").isNull()).orderBy("code")


def latest_holdings_date(snapshots: DataFrame) -> DataFrame:
    """Last date of each fund in either table, valid or not."""
    return snapshots.groupBy("etf_code").agg(F.max("date").alias("latest_date"))


def membership(universe: DataFrame, latest: DataFrame) -> DataFrame:
    """One row per fund that was ever eligible, with its closed date range (open end = NULL)."""
    retired = F.coalesce(F.col("retired"), F.lit(0)) != 0
    return (
        universe.where(~scope_excluded(F.col("official_logic")) & F.col("listing_date").isNotNull())
        .join(latest.withColumnRenamed("etf_code", "code"), "code", "left")
        .where(~retired | F.col("latest_date").isNotNull())
        .select(
            F.col("code").alias("etf_code"),
            F.coalesce("issuer", F.lit("")).alias("issuer"),
            F.col("listing_date").alias("eligible_from"),
            F.when(retired, F.col("latest_date")).alias("eligible_to"),
        )
        .where(F.col("eligible_to").isNull() | (F.col("eligible_from") <= F.col("eligible_to")))
    )


def only_eligible(rows: DataFrame, members: DataFrame, carry: Iterable[str] = ()) -> DataFrame:
    """Rows (date, etf_code, ...) of funds that belonged to the universe on their date.

    An equality join on the fund with a range filter, never a date-by-fund product.
    """
    terms = members.select("etf_code", "eligible_from", "eligible_to", *carry)
    return (
        rows.join(terms, "etf_code")
        .where(
            (F.col("date") >= F.col("eligible_from"))
            & (F.col("eligible_to").isNull() | (F.col("date") <= F.col("eligible_to")))
        )
        .drop("eligible_from", "eligible_to")
    )


def eligible_universe(dates: DataFrame, members: DataFrame) -> DataFrame:
    """(date, etf_code) for every date a fund was eligible.

    Each fund is expanded to the months it spans and joined to the dates of those months,
    so the work is the size of the result. ``dates`` holds one row per calendar date, which
    is what bounds its broadcast.
    """
    last = dates.agg(F.max("date")).scalar()
    end = F.least(F.coalesce(F.col("eligible_to"), last), last)
    months = (
        members.withColumn("end", end)
        .where(F.col("eligible_from") <= F.col("end"))
        .select(
            "etf_code",
            "eligible_from",
            "end",
            F.explode(
                F.sequence(
                    F.trunc("eligible_from", "month"), F.trunc("end", "month"), F.expr("interval 1 month")
                )
            ).alias("month"),
        )
    )
    by_month = dates.select("date", F.trunc("date", "month").alias("month"))
    return (
        months.join(F.broadcast(by_month), "month")
        .where(F.col("date").between(F.col("eligible_from"), F.col("end")))
        .select("date", "etf_code")
    )


def coverage(dates: DataFrame, members: DataFrame, entries: DataFrame) -> DataFrame:
    """Expected and actual fund counts per date.

    Expected counts come from a sweep over listing and closing days, so no date-by-fund
    grid is formed. The running sum runs over one row per calendar date.
    """
    opens = members.groupBy(F.col("eligible_from").alias("date")).agg(F.count(F.lit(1)).alias("step"))
    closes = (
        members.where("eligible_to IS NOT NULL")
        .groupBy(F.date_add("eligible_to", 1).alias("date"))
        .agg((-F.count(F.lit(1))).alias("step"))
    )
    marks = dates.select("date", F.lit(0).cast("bigint").alias("step"), F.lit(1).alias("asked"))
    steps = opens.unionByName(closes).select("date", "step", F.lit(0).alias("asked")).unionByName(marks)
    per_day = steps.groupBy("date").agg(F.sum("step").alias("step"), F.max("asked").alias("asked"))
    expected = (
        per_day.withColumn("expected_count", F.sum("step").over(W.orderBy("date")))
        .where("asked = 1")
        .select("date", "expected_count")
    )
    actual = entries.groupBy("date").agg(F.count(F.lit(1)).alias("actual_count"))
    return expected.join(actual, "date", "left").withColumn(
        "actual_count", F.coalesce("actual_count", F.lit(0))
    ).withColumn("missing_count", F.col("expected_count") - F.col("actual_count"))


def missing_funds(eligible: DataFrame, entries: DataFrame) -> DataFrame:
    """Eligible funds without a valid snapshot on the date."""
    return eligible.join(entries.select("date", "etf_code"), ["date", "etf_code"], "left_anti")


def latest_available(missing: DataFrame, entries: DataFrame) -> DataFrame:
    """For each missing (date, fund): last valid and eligible snapshot strictly before it.

    An as-of join as one sort per fund; a group holds at most one row per date.
    """
    before = W.partitionBy("etf_code").orderBy("date").rowsBetween(W.unboundedPreceding, -1)
    seen = entries.select("date", "etf_code", F.col("date").alias("good"))
    asked = missing.select("date", "etf_code", F.lit(None).cast("date").alias("good"))
    return (
        seen.unionByName(asked)
        .withColumn("latest_date", F.max("good").over(before))
        .where("good IS NULL")
        .select("date", "etf_code", "latest_date")
    )


def valid_dates(cover: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Dates on which enough of the expected funds reported."""
    needed = F.ceil(F.col("expected_count") * F.lit(params.coverage_ratio))
    return cover.where((F.col("expected_count") > 0) & (F.col("actual_count") >= needed))


def date_dimension(cover: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Every date with its validity, dense valid index and previous valid date.

    One row per calendar date: the unpartitioned window below never sees facts.
    """
    needed = F.ceil(F.col("expected_count") * F.lit(params.coverage_ratio))
    valid = (F.col("expected_count") > 0) & (F.col("actual_count") >= needed)
    before = W.orderBy("date").rowsBetween(W.unboundedPreceding, -1)
    upto = W.orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    return (
        cover.withColumn("date_valid", valid)
        .withColumn("prev_date", F.max(F.when(F.col("date_valid"), F.col("date"))).over(before))
        .withColumn("vi", F.count_if(F.col("date_valid")).over(upto))
    )


# --- Maintenance ----------------------------------------------------------------------


def universe_upsert(universe: DataFrame, updates: DataFrame, now: Column) -> DataFrame:
    """Merge update rows into the universe.

    ``updates`` has ``code``, ``present`` (names of the fields the caller sent), the field columns
    and ``seq``, the order of the updates (needed where a code comes twice). Codes count in upper case; of several updates of a code,
    each field takes its last sent value. A present NULL overwrites, an absent field is preserved,
    legacy keys are ignored.
    """
    known = [c for c in UPSERT_COLUMNS if c in updates.columns]
    order = F.col("seq") if "seq" in updates.columns else F.lit(0)

    def sent(name: str) -> Column:
        return F.coalesce(F.array_contains("present", name), F.lit(False))

    new = updates.groupBy(F.upper("code").alias("code")).agg(
        F.array_compact(F.array(*[F.when(F.bool_or(sent(c)), c) for c in known])).alias("present"),
        *[F.max_by(F.struct(c), F.when(sent(c), order)).getField(c).alias(f"new_{c}") for c in known],
    )
    is_new = F.col("old_code").isNull()

    def merged(name: str) -> Column:
        if name not in known:
            return F.col(name)
        return F.when(sent(name), F.col(f"new_{name}")).otherwise(F.col(name)).alias(name)

    out = universe.withColumn("old_code", F.col("code")).join(new, "code", "full")
    touched = F.col("present").isNotNull()
    return (
        out.select("code", "old_code", "present", "created_at", "updated_at", *map(merged, UPSERT_COLUMNS))
        .withColumn("name", F.when(is_new, F.coalesce(F.nullif("name", F.lit("")), "code")).otherwise(F.col("name")))
        .withColumn("retired", F.coalesce("retired", F.lit(0)))
        .withColumn("created_at", F.when(is_new, now).otherwise(F.col("created_at")))
        .withColumn("updated_at", F.when(touched, now).otherwise(F.col("updated_at")))
        .select(*universe.columns)
    )


def retire(universe: DataFrame, codes: DataFrame, now: Column) -> DataFrame:
    """Mark the listed codes retired."""
    hit = codes.select(F.upper("code").alias("code"), F.lit(True).alias("hit")).distinct()
    return (
        universe.join(hit, "code", "left")
        .withColumn("retired", F.when(F.col("hit"), F.lit(1)).otherwise(F.col("retired")))
        .withColumn("updated_at", F.when(F.col("hit"), now).otherwise(F.col("updated_at")))
        .select(*universe.columns)
    )


def universe_reconcile(universe: DataFrame, discovered: DataFrame, seen_date: Column, now: Column) -> DataFrame:
    """Universe after discovery, with an ``action`` of inserted, updated or kept.

    Known funds only take market, isin and listing date, and only where discovery has them.
    """
    found = discovered.groupBy(F.upper("code").alias("code")).agg(
        F.max(F.struct("name", "issuer", "market", "isin", "listing_date")).alias("found")
    )
    joined = universe.withColumn("known", F.lit(True)).join(found, "code", "full")
    is_new = F.col("known").isNull()
    seen = F.col("found").isNotNull()

    def refreshed(name: str) -> Column:
        return F.coalesce(F.col(f"found.{name}"), F.col(name)).alias(name)

    return joined.select(
        "code",
        F.when(is_new, F.coalesce(F.nullif(F.col("found.name"), F.lit("")), F.col("code")))
        .otherwise(F.col("name")).alias("name"),
        F.when(is_new, F.col("found.issuer")).otherwise(F.col("issuer")).alias("issuer"),
        refreshed("market"),
        refreshed("isin"),
        refreshed("listing_date"),
        F.coalesce("retired", F.lit(0)).alias("retired"),
        F.when(is_new, seen_date).otherwise(F.col("first_seen_date")).alias("first_seen_date"),
        "official_url",
        "official_method",
        "official_logic",
        F.when(is_new, now).otherwise(F.col("created_at")).alias("created_at"),
        F.when(seen, now).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(is_new, F.lit("inserted")).when(seen, F.lit("updated")).otherwise(F.lit("kept")).alias("action"),
    )


def retirement_candidates(
    universe: DataFrame, discovered: DataFrame, snapshots: DataFrame, seen_date: Column, status: DataFrame
) -> DataFrame:
    """(code, outcome) for known funds that discovery no longer lists.

    ``status`` is the result of ``discovery_status``. While any expected market is incomplete every
    such fund is ``retirement_skipped``. Otherwise a fund is a ``retirement_candidate`` when it was
    listed on the older of the last two holdings dates and has no row of any kind on either.
    """
    absent = universe.where(F.coalesce(F.col("retired"), F.lit(0)) == 0).join(
        discovered.select(F.upper("code").alias("code")).distinct(), "code", "left_anti"
    )
    complete = status.agg(F.coalesce(F.bool_and("completed"), F.lit(False))).scalar()
    recent = (
        snapshots.where(F.col("date") <= seen_date).select("date").distinct().orderBy(F.col("date").desc()).limit(2)
    )
    older = recent.agg(F.when(F.count(F.lit(1)) == 2, F.min("date"))).scalar()
    present = snapshots.join(F.broadcast(recent), "date", "left_semi").select(
        F.col("etf_code").alias("code"), F.lit(True).alias("present")).distinct()
    gone = ~scope_excluded(F.col("official_logic")) & (F.col("listing_date") <= older) & F.col("present").isNull()
    outcome = F.when(~complete, "retirement_skipped").when(gone, "retirement_candidate")
    return absent.join(present, "code", "left").select("code", outcome.alias("outcome")).where("outcome IS NOT NULL")


# --- Discovery ------------------------------------------------------------------------


def _any_word(text: Column, words: Iterable[str]) -> Column:
    return text.rlike("|".join(words))


def offshore(name: Column, isin: Column) -> Column:
    """Trades offshore by its name: an offshore word, unless a domestic word remains."""
    text = F.concat(name, F.lit(" "), F.coalesce(isin, F.lit("")))
    for issuer in DOMESTIC_ISSUERS:
        text = F.replace(text, F.lit(issuer), F.lit(""))
    return ~_any_word(text, DOMESTIC_WORDS) & _any_word(text, OFFSHORE_WORDS)


def discovery_filter(securities: DataFrame) -> DataFrame:
    """Actively managed domestic funds among listed securities."""
    name, code = F.col("name"), F.col("code")
    return securities.where(name.contains(ACTIVE_WORD) & code.endswith("A") & ~offshore(name, F.col("isin")))


def discovery_status(securities: DataFrame, markets: DataFrame) -> DataFrame:
    """Rows and completion of each expected market, with the overall completion on every row."""
    counts = securities.groupBy("market").agg(F.count(F.lit(1)).alias("securities"))
    each = (
        markets.select("market").distinct().join(counts, "market", "left")
        .withColumn("securities", F.coalesce("securities", F.lit(0)))
        .withColumn("completed", F.col("securities") > 0)
    )
    return each.withColumn("discovery_complete", each.agg(F.bool_and("completed")).scalar())
