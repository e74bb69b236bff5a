"""Declared table schemas; nothing in the library relies on inference."""

from __future__ import annotations

HOLDINGS = (
    "date DATE, etf_code STRING, asset_name STRING, asset_type STRING, stock_code STRING, "
    "stock_name STRING, shares DOUBLE, weight_pct DOUBLE, source_url STRING, source_type STRING, "
    "extraction_method STRING, scraped_at TIMESTAMP"
)

NON_STOCK = (
    "date DATE, etf_code STRING, asset_name STRING, asset_type STRING, weight_pct DOUBLE, "
    "source_url STRING, source_type STRING, extraction_method STRING, scraped_at TIMESTAMP"
)

UNIVERSE = (
    "code STRING, name STRING, issuer STRING, market STRING, isin STRING, listing_date DATE, "
    "retired INT, first_seen_date DATE, official_url STRING, official_method STRING, "
    "official_logic STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
)

CHANGES = (
    "date DATE, etf_code STRING, issuer STRING, stock_code STRING, stock_name STRING, "
    "prev_date DATE, prev_weight_pct DOUBLE, weight_pct DOUBLE, weight_delta_1d DOUBLE, "
    "prev_shares DOUBLE, shares DOUBLE, shares_delta_1d DOUBLE, etf_scale_factor DOUBLE, "
    "active_shares_delta_1d DOUBLE, active_shares_delta_pct_1d DOUBLE, prev_rank INT, rank INT, "
    "is_new_position INT, is_removed_position INT, consecutive_add_days INT, "
    "consecutive_reduce_days INT, consecutive_active_add_days INT, "
    "consecutive_active_reduce_days INT, position_change_type STRING, active_direction STRING, "
    "is_active_add INT, is_active_reduce INT, is_passive_weight_change INT, "
    "flow_adjusted_direction STRING, confidence STRING"
)

DIAGNOSTICS = (
    "date DATE, prev_date DATE, etf_code STRING, status STRING, reason STRING, "
    "current_source_type STRING, previous_source_type STRING, current_stock_count BIGINT, "
    "previous_stock_count BIGINT, current_total_weight DOUBLE, previous_total_weight DOUBLE, "
    "overlap_ratio DOUBLE, size_ratio DOUBLE, created_at TIMESTAMP"
)

SNAPSHOTS = (
    "date DATE, etf_code STRING, source_type STRING, valid BOOLEAN, reason STRING, row_count BIGINT, "
    "stock_count BIGINT, non_stock_count BIGINT, holding_rows BIGINT, total_weight DOUBLE, shares_coverage DOUBLE"
)

STREAK_STATE = "date DATE, etf_code STRING, stock_code STRING, wa INT, wr INT, sa INT, sr INT"

SIGNAL_FACTS = (
    "date DATE, signal_type STRING, signal_score DOUBLE, stock_code STRING, stock_name STRING, etf_count BIGINT, "
    "issuer_count BIGINT, explanation STRING, confidence STRING, signal_freshness STRING, freshness_reason STRING, "
    "avg_active_pct DOUBLE, only_etf STRING"
)

SIGNAL_EVIDENCE = (
    "signal_date DATE, signal_type STRING, only_etf STRING, date DATE, etf_code STRING, issuer STRING, stock_code STRING, "
    "stock_name STRING, weight_pct DOUBLE, prev_weight_pct DOUBLE, shares_delta_1d DOUBLE, active_shares_delta_1d DOUBLE, "
    "active_shares_delta_pct_1d DOUBLE, position_change_type STRING, active_direction STRING, flow_adjusted_direction STRING, "
    "consecutive_add_days INT, consecutive_reduce_days INT, consecutive_active_add_days INT, "
    "consecutive_active_reduce_days INT"
)

OUTCOMES = (
    "batch STRING, run_date DATE, etf_code STRING, candidate_id STRING, source_type STRING, data_date DATE, outcome STRING, "
    "outcome_reason STRING, decision STRING, inserted BOOLEAN, stock_count BIGINT, non_stock_count BIGINT"
)

HOLIDAYS = "year INT, mmdd STRING, kind STRING"

CANDIDATES = (
    "candidate_id STRING, run_date DATE, date STRING, etf_code STRING, asset_name STRING, "
    "asset_type STRING, stock_code STRING, stock_name STRING, shares DOUBLE, weight_pct STRING, "
    "source_url STRING, source_type STRING, extraction_method STRING"
)

PAYLOADS = (
    "payload_id STRING, etf_code STRING, source_type STRING, format STRING, "
    "expected_fund_no STRING, body STRING"
)


def columns(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]
