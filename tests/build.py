"""Tiny input tables for the cases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark import Params, schemas
from tidemark.plans.history import History
from tidemark.plans.staging import Staging
from tidemark.sources.tables import Tables

SMALL = Params(min_rows=1, min_stock_rows=1)
STAMP = dt.datetime(2026, 6, 30, 12)


def day(text):
    return dt.date.fromisoformat(text)


def holdings(spark, rows):
    """rows: (date, fund, stock, shares, weight[, source])."""
    out = [
        (day(d), f, f"S{s}({s}.TW)", "stock", s, f"S{s}", None if sh is None else float(sh), float(w), "",
         (rest or ["moneydj_primary"])[0], "test", STAMP)
        for d, f, s, sh, w, *rest in rows
    ]
    return spark.createDataFrame(out, schemas.HOLDINGS)


def non_stock(spark, rows=()):
    out = [(day(d), f, name, "cash", float(w), "", source, "test", STAMP) for d, f, name, w, source in rows]
    return spark.createDataFrame(out, schemas.NON_STOCK)


def universe(spark, rows):
    """rows: (code, issuer[, listing_date, retired, logic])."""
    out = []
    for code, issuer, *rest in rows:
        listing, retired, logic = (list(rest) + [None] * 3)[:3]
        listing = "2020-01-01" if listing is None and not rest else listing
        out.append((code, f"Fund {code}", issuer, "TWSE", None, day(listing) if listing else None, retired or 0,
                    day("2020-01-01"), None, None, logic, STAMP, STAMP))
    return spark.createDataFrame(out, schemas.UNIVERSE)


def history(spark, stock_rows, funds, other=(), params=SMALL):
    tables = Tables(holdings(spark, stock_rows), non_stock(spark, other), universe(spark, funds))
    return History(tables, params, Staging(spark), created_at=F.lit(STAMP))


CHANGE_DEFAULTS = dict(
    issuer="", stock_name="N", prev_date=None, prev_weight_pct=1.0, weight_pct=1.0, weight_delta_1d=0.0, prev_shares=100.0,
    shares=100.0, shares_delta_1d=0.0, etf_scale_factor=1.0, active_shares_delta_1d=0.0, active_shares_delta_pct_1d=0.0,
    prev_rank=1, rank=1, is_new_position=0, is_removed_position=0, consecutive_add_days=0, consecutive_reduce_days=0,
    consecutive_active_add_days=0, consecutive_active_reduce_days=0, position_change_type="unchanged", active_direction="none",
    is_active_add=0, is_active_reduce=0, is_passive_weight_change=0, flow_adjusted_direction="none", confidence="high",
)


def change(date, fund, stock, direction=None, **over):
    row = dict(CHANGE_DEFAULTS, date=day(date), etf_code=fund, stock_code=stock)
    if direction:
        sign = 1.0 if direction == "add" else -1.0
        row.update(
            position_change_type=f"confirmed_active_{direction}", active_direction=direction, flow_adjusted_direction=direction,
            active_shares_delta_1d=10.0 * sign, active_shares_delta_pct_1d=10.0 * sign, **{f"is_active_{direction}": 1},
        )
    row.update(over)
    return row


def changes(spark, rows):
    names = schemas.columns(schemas.CHANGES)
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schemas.CHANGES)


def rows_by(df, *keys):
    return {tuple(str(r[k]) for k in keys) if len(keys) > 1 else str(r[keys[0]]): r for r in df.collect()}
