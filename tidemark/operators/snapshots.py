"""Snapshot validation, ranking and arbitration.

A snapshot is every row sharing one key (date, fund and source for stored tables, a
candidate id for landed ones). It is never built as an object: all rules are conditional
aggregates, so a snapshot of any size is reduced map-side before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.origin import source_family, source_priority
from tidemark.functions.parsing import parse_date
from tidemark.params import DEFAULT, Params

SNAPSHOT = ("date", "etf_code", "source_type")
METRICS = ("row_count", "stock_count", "non_stock_count", "total_weight", "shares_coverage")


def _blank(column: Column) -> Column:
    return column.isNull() | (column == "")


def snapshot_profile(
    rows: DataFrame,
    keys: Sequence[str] = SNAPSHOT,
    params: Params = DEFAULT,
    headers: DataFrame | None = None,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Metrics, validity and reason of each snapshot.

    ``headers`` lists the keys that must appear even with no rows (empty snapshots); ``extra``
    adds aggregates of the same pass.
    """
    weight = F.col("weight_pct").try_cast("double")
    finite = weight.isNotNull() & ~F.isnan(weight) & (F.abs(weight) != float("inf"))
    stock = F.coalesce(F.col("asset_type") == "stock", F.lit(False))
    code = F.coalesce(F.col("stock_code"), F.lit(""))
    # A plain trim decides nearly always; other Unicode white space is looked for only where it does not.
    shown = F.trim(F.coalesce(F.col("stock_name"), F.lit("")))
    named = F.when(shown == "", False).when(F.ascii(F.substring(shown, 1, 1)).between(33, 126), True).otherwise(shown.rlike(r"(?U)\S"))
    four_digits = code.rlike(r"\A[0-9]{4}\z")
    day = F.col("date") if dict(rows.dtypes)["date"] == "date" else parse_date(F.col("date"))
    etf, source = F.col("etf_code"), F.col("source_type")
    measures = {
        "row_count": F.count(F.lit(1)),
        "stock_count": F.count_if(stock),
        "holding_rows": F.count("stock_code"),
        "total_weight": F.round(F.sum(F.when(finite, weight).otherwise(0.0)), 10),
        "stock_with_shares": F.count_if(stock & F.col("shares").isNotNull()),
        "no_weight": F.count_if(F.col("weight_pct").isNull()),
        "bad_weight": F.count_if(F.col("weight_pct").isNotNull() & ~finite),
        "no_date": F.count_if(day.isNull()),
        "no_etf": F.count_if(_blank(etf)),
        "no_source": F.count_if(_blank(source)),
        "bad_stock": F.count_if(stock & ~(F.col("code_number").isNotNull() & named)),
        "seen_codes": F.collect_set("code_number"),
    }
    # A column of the key is the same in every row of a snapshot, so its two ends need no buffers.
    loose = [x for x in (("date", "date", day), ("etf", "etf_code", etf), ("source", "source_type", source)) if x[1] not in keys]
    for name, _, value in loose:
        measures |= {f"first_{name}": F.min(value), f"last_{name}": F.max(value)}
    differ = {name: F.col(f"first_{name}") != F.col(f"last_{name}") for name, *_ in loose}
    extra = extra or {}
    # With a set among the measures Spark sorts the rows of a task by the keys in their order here. Rows of a fund mostly lie
    # together, so with the fund in front they are nearly in order already.
    order = sorted(keys, key=lambda key: key != "etf_code")
    # The code is read before the aggregate, once a row: what feeds a set is not compiled there.
    coded = rows.withColumn("code_number", F.when(stock & four_digits, code.cast("int")))
    out = coded.groupBy(*order).agg(*[m.alias(name) for name, m in {**measures, **extra}.items()])
    if headers is not None:
        out = headers.select(*keys).distinct().join(out, list(keys), "left")
    count = F.coalesce(F.col("row_count"), F.lit(0))
    rules = [
        (count == 0, "empty_rows"),
        (F.col("no_weight") > 0, "missing_weight_pct"),
        (F.col("bad_weight") > 0, "invalid_weight_pct"),
        (F.col("no_date") > 0, "missing_or_unparseable_date"),
        (differ.get("date", F.lit(False)), "inconsistent_dates"),
        ((F.col("no_etf") > 0) | differ.get("etf", F.lit(False)), "inconsistent_etf_codes"),
        ((F.col("no_source") > 0) | differ.get("source", F.lit(False)), "inconsistent_source_types"),
        (F.col("row_count") < params.min_rows, "fewer_than_5_rows"),
        (F.col("stock_count") < params.min_stock_rows, "fewer_than_5_taiwan_stock_rows"),
        (F.col("bad_stock") > 0, "invalid_taiwan_stock_row"),
        # Every code is one of 10,000 here, as others were refused by the rule before: a set of numbers in the same
        # aggregate needs no second shuffle of rows, and half the time of a distinct count or of bitmaps of 4 kB each.
        (F.size("seen_codes") < F.col("stock_count"), "duplicate_stock_codes"),
    ]
    reason = F.when(*[rules[0][0], F.lit(rules[0][1])])
    for failed, name in rules[1:]:
        reason = reason.when(failed, F.lit(name))
    carried = [] if "date" in keys else [
        F.col("first_date").alias("data_date"),
        F.col("first_etf").alias("etf_code"),
        F.col("first_source").alias("source_type"),
    ]
    carried = [c for c, name in zip(carried, ("data_date", "etf_code", "source_type")) if name not in keys]
    return out.withColumn("reason", reason.otherwise(F.lit("ok"))).select(
        *keys,
        *carried,
        (F.col("reason") == "ok").alias("valid"),
        "reason",
        count.alias("row_count"),
        F.coalesce("stock_count", F.lit(0)).alias("stock_count"),
        (count - F.coalesce("stock_count", F.lit(0))).alias("non_stock_count"),
        F.coalesce("holding_rows", F.lit(0)).alias("holding_rows"),
        F.coalesce("total_weight", F.lit(0.0)).alias("total_weight"),
        F.coalesce(F.col("stock_with_shares") / F.nullif("stock_count", F.lit(0)), F.lit(0.0)).alias(
            "shares_coverage"
        ),
        *extra,
    )


def sort_key(prefix: str = "") -> Column:
    """Struct that orders snapshots of one date and fund; the greatest is the best."""
    return F.struct(
        source_priority(F.col(f"{prefix}source_type")).alias("priority"),
        F.col(f"{prefix}stock_count").alias("stock_count"),
        F.col(f"{prefix}shares_coverage").alias("shares_coverage"),
        F.col(f"{prefix}non_stock_count").alias("non_stock_count"),
        F.coalesce(F.col(f"{prefix}source_type"), F.lit("")).alias("source_type"),
    )


def canonical_snapshot(snapshots: DataFrame) -> DataFrame:
    """The best valid snapshot of each date and fund."""
    rest = ("row_count", "holding_rows", "total_weight")
    best = F.max(F.struct(sort_key().alias("key"), *rest)).alias("best")
    return (
        snapshots.where("valid")
        .groupBy("date", "etf_code")
        .agg(best)
        .select(
            "date",
            "etf_code",
            "best.key.source_type",
            "best.key.priority",
            "best.key.stock_count",
            "best.key.shares_coverage",
            "best.key.non_stock_count",
            *[f"best.{c}" for c in rest],
        )
        .withColumn("source_family", source_family(F.col("source_type")))
    )


def by_fund(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows placed by fund, in so many tasks if that is given."""
    return rows.repartition(*([tasks] if tasks else []), "etf_code")


def canonical_holdings(rows: DataFrame, canonical: DataFrame) -> DataFrame:
    """Rows of the canonical source only.

    Rows and entries meet on the whole snapshot key, straight from their exchanges, so adaptive
    execution can split a snapshot that holds a large share of all rows.
    """
    return rows.join(canonical.select(*SNAPSHOT), list(SNAPSHOT), "left_semi")


def ranked_holdings(holdings: DataFrame, entries: DataFrame, tasks: int | None = None) -> DataFrame:
    """Stock-table rows of the canonical source, ranked in their fund by weight then code.

    Rows of other sources leave first, and with them every invalid snapshot, however large. What is ranked is one valid snapshot: stock rows have distinct
    four-digit codes, rows of another asset type are bounded by the table's key only.
    """
    extra = [c for c in ("issuer", "source_family", "ti") if c in entries.columns]
    in_fund = W.partitionBy("date", "etf_code").orderBy(F.col("weight_pct").desc(), "stock_code")
    rows = holdings.select("date", "etf_code", "stock_code", "stock_name", "asset_type", "shares", "weight_pct", "source_type")
    # Both sides are placed by date and fund, which is all of the join's key and all of the ranks' group, so rows move once: a key
    # with the source in it would not be met by this placing. A task hashes its own entries; without the hint Spark goes by the
    # size of their compressed file and sends millions of them through the driver to every executor.
    chosen = _by_snapshot(entries.select("date", "etf_code", F.col("source_type").alias("chosen"), *extra), tasks)
    return (
        _by_snapshot(rows, tasks).join(chosen.hint("shuffle_hash"), ["date", "etf_code"])
        .where(F.col("source_type").between(F.col("chosen"), F.col("chosen")))
        .select(*rows.columns, *extra)
        .withColumn("rank", F.row_number().over(in_fund))
    )


def _by_snapshot(rows: DataFrame, tasks: int | None) -> DataFrame:
    return rows.repartition(*([tasks] if tasks else []), "date", "etf_code")


def canonical_stock_codes(holdings: DataFrame, canonical: DataFrame) -> DataFrame:
    """Set of stock codes per canonical snapshot, whatever their asset type."""
    return (
        canonical_holdings(holdings, canonical)
        .groupBy(*SNAPSHOT)
        .agg(F.array_sort(F.collect_set("stock_code")).alias("stock_codes"))
    )


# --- Arbitration of incoming snapshots ------------------------------------------------


def arbitrate(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Decision for each incoming snapshot profile against the stored canonical one.

    ``incoming`` is a candidate profile (data_date, etf_code, source_type and metrics).
    """
    kept = stored.select(
        F.col("date").alias("data_date"),
        "etf_code",
        F.col("source_type").alias("stored_source_type"),
        *[F.col(c).alias(f"stored_{c}") for c in ("stock_count", "shares_coverage", "non_stock_count")],
    )
    joined = incoming.join(kept, ["data_date", "etf_code"], "left")
    outranked = (
        F.col("stored_source_type").isNotNull()
        & (F.col("stored_source_type") != F.col("source_type"))
        & (sort_key() < sort_key("stored_"))
    )
    return joined.withColumn(
        "decision",
        F.when(~F.col("valid"), F.concat(F.lit("invalid_snapshot:"), F.col("reason")))
        .when(outranked, F.lit("existing_higher_priority_source_preserved"))
        .otherwise(F.lit("replace")),
    ).withColumn("inserted", F.col("decision") == "replace")


def equivalence(incoming: DataFrame, stored: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Incoming against stored: same stock count and less than one point of total weight apart."""
    kept = stored.select(
        F.col("date").alias("data_date"),
        "etf_code",
        F.col("source_type").alias("existing_source_type"),
        F.col("stock_count").alias("existing_stock_count"),
        F.col("total_weight").alias("existing_total_weight"),
    )
    delta = F.round(F.abs(F.col("total_weight") - F.col("existing_total_weight")), 10)
    joined = incoming.join(kept, ["data_date", "etf_code"], "left")
    found = F.col("valid") & F.col("existing_source_type").isNotNull()
    same = (F.col("stock_count") == F.col("existing_stock_count")) & (delta < params.equivalence_delta)
    return joined.select(
        "*",
        found.alias("existing_snapshot_found"),
        F.when(found, delta).alias("weight_delta_pct_points"),
        F.when(found, same).alias("equivalent"),
    )
