"""Expected result of each registered query, as SQL (see ``checks.oracle`` for the steps)."""

from __future__ import annotations

from checks.oracle import final

ANSWERS: dict[str, str] = {}


def answer(name: str, sql: str, doubles: str = "") -> None:
    ANSWERS[name] = final(sql, doubles)


METRIC = "row_count, stock_count, non_stock_count, total_weight, shares_coverage"
CHANGE_KEY = "date, etf_code, stock_code"
ENTITY = "date, window_days::bigint as window_days, entity_level, stock_code, issuer_key"

answer("scan_holdings", "select * from all_rows", "shares weight_pct")
answer("scan_dates", "select distinct date from all_rows")
answer("range_filter", "select distinct date from holdings where date between '1996-01-01' and '1997-12-31'")

answer("snapshot_validity", "select date, etf_code, source_type, (reason = 'ok')::bigint as valid, reason from snap")
answer("snapshot_metrics", f"select date, etf_code, source_type, {METRIC} from snap", "total_weight shares_coverage")
answer("source_priority", "select s.source_type, count(*) as snapshots, max(coalesce(p.priority, 10))::bigint as priority from snap s left join priority p using (source_type) group by 1")
answer("source_family", "select source_type, count(*) as snapshots, case when source_type like '%moneydj%' then 'moneydj' when source_type like '%official%' then 'official' when source_type = '' then 'unknown' else source_type end as family from snap group by 1")
answer("canonical_snapshot", f"select date, etf_code, source_type, priority::bigint as priority, {METRIC} from canon", "total_weight shares_coverage")
answer("canonical_holdings", "select r.date, r.etf_code, r.source_type, asset_name, stock_code, shares, weight_pct from all_rows r join canon c using (date, etf_code, source_type)", "shares weight_pct")
answer("canonical_stock_codes", "select h.date, h.etf_code, h.source_type, string_agg(stock_code, ',' order by stock_code) as stock_codes from holdings h join canon c using (date, etf_code, source_type) group by 1, 2, 3")

answer("scope_excluded", "select code, excluded::bigint as excluded from scope")
answer("active_universe", "select code, name, issuer, market, listing_date from scope where retired = 0 and listing_date <= '1996-06-30' and not excluded")
answer("pending_review", "select code, name, issuer from universe where retired = 0 and listing_date is null")
answer("latest_holdings_date", "select etf_code, latest_date from latest")
answer("eligible_universe", "select date, etf_code from elig")
answer("snapshot_codes", "select date, etf_code from canon")
answer("coverage", "select date, expected_count, actual_count, expected_count - actual_count as missing_count from cov")
answer("latest_available", "select date, etf_code, latest_date from available")
answer("missing_candidates", "select etf_code, latest_date as data_date from available where date = '1997-07-01'")
answer("valid_dates", "select date, expected_count, actual_count from dates where date_valid")
answer("latest_valid_date", "select max(date) as latest_valid_date from dates where date_valid")
answer("prev_valid_date", "select date, date_valid::bigint as date_valid, prev_date from dates")

answer("date_pairs", "select date, prev_date, case when prev_date is null then 'skipped_first' else 'paired' end as status from dates where has_holdings")
answer("pair_ratios", "select date, prev_date, etf_code, overlap_ratio, size_ratio from diag where overlap_ratio is not null", "overlap_ratio size_ratio")
answer("comparable_pair", "select date, prev_date, etf_code from compared")
answer("change_diagnostics", """
select date, prev_date, etf_code, status, reason, current_source_type, previous_source_type, current_stock_count, previous_stock_count,
       current_total_weight, previous_total_weight, overlap_ratio, size_ratio from diag""",
       "current_total_weight previous_total_weight overlap_ratio size_ratio")
answer("ranked_holdings", "select date, etf_code, stock_code, stock_name, shares, weight_pct, source_type, rank from ranked", "shares weight_pct")
answer("scale_factor", "select s.date, s.etf_code, scale as etf_scale_factor from scales s", "etf_scale_factor")
answer("position_diff", f"""
select {CHANGE_KEY}, stock_name, prev_date, prev_weight_pct, weight_pct, weight_delta_1d, prev_shares, shares, shares_delta_1d,
       prev_rank, rank, is_new_position::bigint as is_new_position, is_removed_position::bigint as is_removed_position from chg""",
       "prev_weight_pct weight_pct weight_delta_1d prev_shares shares shares_delta_1d")
answer("flow_adjusted_delta", f"select {CHANGE_KEY}, etf_scale_factor, active_shares_delta_1d, active_shares_delta_pct_1d from flowed",
       "etf_scale_factor active_shares_delta_1d active_shares_delta_pct_1d")
answer("materiality", f"select {CHANGE_KEY}, is_material::bigint as is_material from material")
FLAGS = "is_active_add::bigint as is_active_add, is_active_reduce::bigint as is_active_reduce, is_passive_weight_change::bigint as is_passive_weight_change"
answer("position_class", f"select {CHANGE_KEY}, position_change_type, active_direction, {FLAGS}, active_direction as flow_adjusted_direction, confidence from classed")
answer("change_issuer", "select etf_code, issuer, count(*) as change_rows from chg group by 1, 2")
answer("weight_streak", f"select {CHANGE_KEY}, wa::bigint as consecutive_add_days, wr::bigint as consecutive_reduce_days from streaked")
answer("share_streak", f"select {CHANGE_KEY}, sa::bigint as share_add_days, sr::bigint as share_reduce_days from streaked")
STREAKS = "consecutive_active_add_days::bigint as consecutive_active_add_days, consecutive_active_reduce_days::bigint as consecutive_active_reduce_days"
answer("flow_streak", f"select {CHANGE_KEY}, {STREAKS} from chg")
answer("holding_changes", f"""
select date, etf_code, issuer, stock_code, stock_name, prev_date, prev_weight_pct, weight_pct, weight_delta_1d, prev_shares, shares,
       shares_delta_1d, etf_scale_factor, active_shares_delta_1d, active_shares_delta_pct_1d, prev_rank, rank,
       is_new_position::bigint as is_new_position, is_removed_position::bigint as is_removed_position,
       consecutive_add_days::bigint as consecutive_add_days, consecutive_reduce_days::bigint as consecutive_reduce_days, {STREAKS},
       position_change_type, active_direction, {FLAGS}, flow_adjusted_direction, confidence from chg""",
       "prev_weight_pct weight_pct weight_delta_1d prev_shares shares shares_delta_1d etf_scale_factor active_shares_delta_1d active_shares_delta_pct_1d")
answer("change_run_summary", """
select d.date, d.prev_date, coalesce(list_extract(['週一', '週二', '週三', '週四', '週五', '週六', '週日'], isodow(d.prev_date::date)::int), '未知') as previous_date_weekday,
       (coalesce(c.n, 0) > 0)::bigint as ok, coalesce(c.n, 0) as row_count, coalesce(c.a, 0)::bigint as new_positions,
       coalesce(c.r, 0)::bigint as removed_positions, coalesce(s.n, 0) as skipped_count,
       case when d.prev_date is null then 'no previous holdings date' when c.n > 0 then null
            when s.n > 0 then 'not comparable ETF/date pairs' else 'no holdings rows' end as reason
from dates d
left join (select date, count(*) as n, sum(is_new_position) as a, sum(is_removed_position) as r from chg group by 1) c using (date)
left join (select date, count(*) as n from diag where status = 'skipped' group by 1) s using (date)
where d.has_holdings""")

answer("skipped_funds", "select date, etf_code, reason from diag where status = 'skipped'")

answer("event_add", f"select {CHANGE_KEY} from acts where direction = 'add'")
answer("event_reduce", f"select {CHANGE_KEY} from acts where direction = 'reduce'")
answer("event_streak", f"select {CHANGE_KEY}, add_run::bigint as add_streak_event, reduce_run::bigint as reduce_streak_event from flags")
answer("single_signals", "select date, etf_code, stock_code, signal_type, signal_score::double as signal_score, freshness_reason from single", "signal_score")
answer("event_window", "select t.date as target_date, c.date, c.etf_code, c.stock_code from cdates t join cdates m on m.ci between t.ci - 2 and t.ci join chg c on c.date = m.date")
answer("consensus", "select tdate as date, stock_code, direction, issuer_count, etf_count, avg_active_pct from agree", "avg_active_pct")
answer("representative", "select tdate as date, stock_code, direction, left(rep, 10) as representative_date, substr(rep, 11) as representative_etf, stock_name, confidence from agree")
answer("freshness", """
select s.date, f.stock_code, f.direction, f.signal_freshness, s.freshness_reason from fresh f
join sig s on s.date = f.tdate and s.stock_code = f.stock_code and s.signal_type = 'consensus_' || f.direction || '_3d'""")
answer("signal_rows", "select signal_id, etf_codes, issuers, etf_count, issuer_count, events as evidence_rows, confidence from sig")
answer("manager_signals", "select date, signal_id, signal_type, signal_score, stock_code, stock_name, etf_count, issuer_count, confidence, signal_freshness, freshness_reason from sig", "signal_score")
answer("signal_evidence", """
select w.tdate as signal_date, 'consensus_' || direction || '_3d' as signal_type, w.date, w.etf_code, w.stock_code, w.weight_pct, w.active_shares_delta_pct_1d, w.position_change_type
from windowed w join agree a using (tdate, stock_code, direction)
union all
select date, signal_type, date, etf_code, stock_code, weight_pct, active_shares_delta_pct_1d, position_change_type from single""",
       "weight_pct active_shares_delta_pct_1d")
answer("latest_signal_date", "select max(date) as latest_signal_date from sig")

answer("intent_window", "select tdate as date, window_days::bigint as window_days, date as member_date from iwin")
answer("event_score", f"select c.date, c.etf_code, c.stock_code, s.score from chg c join scored s using (date, etf_code, stock_code)", "score")
answer("comparable_context", "select date, etf_code from ctx")
answer("eligible_days", f"select {ENTITY}, eligible_days from intent where eligible_days > 0")
answer("entity_scores", f"""
select {ENTITY}, cum_active_buy_score, cum_active_sell_score, net_active_score, gross_active_score, net_to_gross,
       buy_etf_count, sell_etf_count, buy_issuer_count, sell_issuer_count from intent""",
       "cum_active_buy_score cum_active_sell_score net_active_score gross_active_score net_to_gross")
answer("buy_sell_days", f"""
select {ENTITY}, buy_days, sell_days, buy_days::double / nullif(eligible_days, 0) as buy_day_pct,
       sell_days::double / nullif(eligible_days, 0) as sell_day_pct from intent""", "buy_day_pct sell_day_pct")
answer("rotation_counts", f"select {ENTITY}, rotation_buy_etf_count, rotation_sell_etf_count from intent")
answer("offset_ratio", f"select {ENTITY}, cross_fund_offset_ratio from intent", "cross_fund_offset_ratio")
answer("intent_class", f"select {ENTITY}, intent_direction, primary_intent_state, tags, confidence from intent")
answer("manager_intent", f"""
select i.date, i.window_days::bigint as window_days, i.entity_level, i.stock_code, i.stock_name,
       case when i.entity_level = 'issuer_stock' then i.issuer_key end as issuer, i.issuer_key, eligible_days, buy_days, sell_days,
       buy_days::double / nullif(eligible_days, 0) as buy_day_pct, sell_days::double / nullif(eligible_days, 0) as sell_day_pct,
       cum_active_buy_score, cum_active_sell_score, net_active_score, gross_active_score, net_to_gross, buy_etf_count, sell_etf_count,
       buy_issuer_count, sell_issuer_count, rotation_buy_etf_count, rotation_sell_etf_count, cross_fund_offset_ratio,
       intent_direction, primary_intent_state, tags, confidence, 'manager_intent_mvp_v1' as metric_version,
       coalesce(e.evidence, '') as evidence
from intent i left join (
  select tdate, window_days, entity_level, stock_code, issuer_key,
         string_agg(date || ':' || etf_code || ':' || score::varchar, '|' order by date, etf_code) as evidence
  from (select *, row_number() over (partition by tdate, window_days, entity_level, stock_code, issuer_key order by date, etf_code) as n from ievents)
  where n <= 20 group by 1, 2, 3, 4, 5) e
on e.tdate = i.date and e.window_days = i.window_days and e.entity_level = i.entity_level and e.stock_code = i.stock_code and e.issuer_key = i.issuer_key""",
       "buy_day_pct sell_day_pct cum_active_buy_score cum_active_sell_score net_active_score gross_active_score net_to_gross cross_fund_offset_ratio")

answer("traction_window", "select e.date as end_date, s.date as start_date from cdates e join cdates s on s.ci = greatest(e.ci - 5, 1)")
answer("net_active_flow", """
select end_date, stock_code, stock_name, active_adds, active_reduces, new_positions, removed_positions, add_issuers, reduce_issuers,
       add_streaks_2plus, reduce_streaks_2plus, total_weight, avg_weight from nflow""", "total_weight avg_weight")
answer("fund_breakdown", """
select t.end_date, c.date, etf_code, u.name, c.issuer, stock_code, position_change_type, active_direction, round(weight_pct, 2) as weight,
       round(active_shares_delta_1d, 0) as shares_delta
from chg c join twin t on t.date = c.date join universe u on u.code = c.etf_code where is_active_add = 1 or is_active_reduce = 1""", "weight shares_delta")
answer("traction_buckets", """
select end_date, stock_code, net, bucket, case when bucket in ('gaining', 'losing')
       then case when abs(net) >= 6 then 'strong' when abs(net) >= 4 then 'medium' else 'early' end end as strength from buckets""")
answer("traction_stats", """
select end_date, count(*) as stocks, count(*) filter (where bucket = 'gaining') as gaining, count(*) filter (where bucket = 'losing') as losing,
       count(*) filter (where bucket = 'split') as split from buckets group by 1""")

answer("summary_stats", """
select r.date, count(distinct r.etf_code) as etf_count, count(distinct stock_code) filter (where asset_type = 'stock') as stock_count,
       count(*) filter (where asset_type <> 'stock') as non_stock_count
from all_rows r join entries n using (date, etf_code, source_type) group by 1""")
answer("change_summary", """
select date, count(*) filter (where is_new_position = 1) as new_count, count(*) filter (where is_removed_position = 1) as removed_count,
       count(*) filter (where is_new_position + is_removed_position = 0 and weight_delta_1d > 0) as increased_count,
       count(*) filter (where is_new_position + is_removed_position = 0 and weight_delta_1d < 0) as decreased_count from chg group by 1""")
answer("skipped_diagnostics", "select date, etf_code, reason, current_source_type, previous_source_type from skips")
answer("data_warnings", "select date, warning, etf_code, expected, actual from warns", "expected actual")
answer("data_quality", """
select date, expected_count, actual_count, actual_count as fresh_count, stale_count, unknown_count, missing_count, skip_count, warning_count,
       case when missing_count + skip_count + warning_count > 0 then 'Degraded' else 'Clean' end as status, (missing_count > 0)::bigint as provisional
from (
  select date, expected_count, actual_count, expected_count - actual_count as missing_count,
         (select count(latest_date) from available a where a.date = c.date) as stale_count,
         (select count(*) from available a where a.date = c.date and latest_date is null) as unknown_count,
         (select count(*) from skips s where s.date = c.date) as skip_count, (select count(*) from warns w where w.date = c.date) as warning_count
  from cov c)""")
answer("top_movers", """
select date, position, stock_code, stock_name, etf_code, weight_pct as curr_weight, prev_weight_pct as prev_weight, weight_delta_1d, shares_delta_1d,
       active_shares_delta_pct_1d, position_change_type, active_direction, confidence from movers""",
       "curr_weight prev_weight weight_delta_1d shares_delta_1d active_shares_delta_pct_1d")
answer("new_positions", "select date, etf_code, stock_code, stock_name, weight_pct, shares, rank from opened", "weight_pct shares")
answer("new_position_groups", """
select date, stock_code, min(stock_name) as stock_name, count(distinct etf_code) as etf_count, max(weight_pct) as max_weight, sum(weight_pct) as total_weight,
       string_agg(etf_code, ',' order by weight_pct desc, etf_code) as etf_codes from opened group by 1, 2""", "max_weight total_weight")
answer("removed_positions", "select date, etf_code, stock_code, stock_name, prev_weight_pct, prev_shares, prev_rank from closed", "prev_weight_pct prev_shares")
answer("removed_position_groups", """
select date, stock_code, min(stock_name) as stock_name, max(prev_weight_pct) as max_prev_weight,
       string_agg(etf_code, ',' order by prev_weight_pct desc, etf_code) as etf_codes from closed group by 1, 2""", "max_prev_weight")
answer("hidden_counts", """
select date, count(*) filter (where is_new_position = 1 and weight_pct < 0.5 and (rank is null or rank > 20)) as hidden_new,
       count(*) filter (where is_removed_position = 1 and prev_weight_pct < 0.5 and (prev_rank is null or prev_rank > 20)) as hidden_removed from chg group by 1""")
answer("consensus_holdings", "select date, stock_code, stock_name, etf_count, avg_weight, max_weight, total_weight, active_etf_count from held_by where etf_count >= 5",
       "avg_weight max_weight total_weight")
answer("stock_weight_change", "select date, prev_date, stock_code, weight_change from drift", "weight_change")
answer("signal_ranking", "select date, signal_type, stock_code, signal_score, signal_freshness, freshness_order::bigint as freshness_order from strong", "signal_score")
answer("signal_summary", """
select date, count(*) filter (where signal_type like 'consensus%' and signal_freshness = 'new') as fresh_consensus,
       count(*) filter (where signal_freshness = 'reversal') as reversals,
       count(*) filter (where signal_type like 'consensus%' and signal_freshness = 'persistent') as persistent_consensus,
       count(*) filter (where signal_freshness in ('stale', 'fading')) as stale_or_fading from strong group by 1""")
answer("signal_sections", """
select date, section::bigint as section, position, signal_type, stock_code, signal_freshness, greatest(n - 8, 0) as remaining from (
  select *, row_number() over (partition by date, section order by freshness_order, abs(signal_score) desc, stock_code, signal_type) as position,
         count(*) over (partition by date, section) as n
  from (select *, case when signal_type like 'consensus%' and signal_freshness = 'new' then 1 when signal_freshness = 'reversal' then 2
                       when signal_type like 'consensus%' and signal_freshness = 'persistent' then 3
                       when signal_type like 'consensus%' and signal_freshness in ('stale', 'fading') then 4
                       when signal_type not like 'consensus%' or signal_freshness = 'current' then 5 end as section from strong)
  where section is not null)
where position <= 8""")
answer("signal_direction", """
select date, signal_type, case when signal_type like '%reduce%' or signal_score < 0 then 'REDUCE'
       when signal_type like '%add%' or signal_type like '%new%' or signal_score > 0 then 'ADD' else 'NEUTRAL' end as direction, count(*) as signals
from sig group by 1, 2, 3""")
answer("signal_avg_active", "select signal_id, avg_active_pct from sig", "avg_active_pct")
answer("intent_ranking", "select date, position, entity_level, stock_code, issuer_key, primary_intent_state, net_active_score, gross_active_score from irank",
       "net_active_score gross_active_score")
answer("intent_sections", """
select date, section::bigint as section, section_position, position, stock_code, issuer_key,
       case primary_intent_state when 'cross_fund_rotation_accumulation' then 'cross-fund rotation accumulation' when 'cross_fund_rotation_distribution' then 'cross-fund rotation distribution'
            when 'cross_fund_rotation' then 'cross-fund rotation / unclear' when 'contested' then 'issuer disagreement / contested'
            when 'high_activity_unclear' then 'high activity unclear' else primary_intent_state end as label,
       case primary_intent_state when 'cross_fund_rotation_accumulation' then 'same-issuer fund-level rotation while net exposure increased'
            when 'cross_fund_rotation_distribution' then 'same-issuer fund-level rotation while net exposure decreased'
            when 'cross_fund_rotation' then 'same-issuer fund-level rotation; net direction unclear' when 'accumulation' then 'broad active accumulation'
            when 'distribution' then 'broad active distribution' when 'contested' then 'different issuers disagreeing'
            when 'high_activity_unclear' then 'high gross activity with low directional clarity' end as interpretation,
       count(*) filter (where section_position > 4) over (partition by date) as remaining
from (
  select *, row_number() over (partition by date, section order by position) as section_position from (
    select *, case when primary_intent_state in ('accumulation', 'cross_fund_rotation_accumulation') then 1
                   when primary_intent_state in ('distribution', 'cross_fund_rotation_distribution') then 2
                   when primary_intent_state = 'cross_fund_rotation' then 3 else 4 end as section from irank))
qualify section_position <= 4""")
answer("observations", """
with busy as (select date, etf_code, count(*) as n, min(position) as p from movers group by 1, 2),
drifted as (select h.date, h.stock_code, h.stock_name, x.weight_change from held_by h join drift x using (date, stock_code) where etf_count >= 15)
select date, observation_type, position, subject, name, value::double as value from (
  select date, 'consensus_gaining' as observation_type, row_number() over (partition by date order by weight_change desc, stock_code) as position,
         stock_code as subject, stock_name as name, weight_change as value from drifted where weight_change > 1
  union all
  select date, 'consensus_losing', row_number() over (partition by date order by weight_change, stock_code), stock_code, stock_name, weight_change from drifted where weight_change < -1
  union all
  select date, 'new_core', row_number() over (partition by date order by stock_code, weight_pct desc, etf_code), stock_code, stock_name, weight_pct from opened where weight_pct >= 2
  union all
  select date, 'removed_core', row_number() over (partition by date order by prev_weight_pct desc, etf_code, stock_code), stock_code, stock_name, prev_weight_pct from closed where prev_weight_pct >= 2
  union all
  select date, 'mover_concentration', row_number() over (partition by date order by n desc, p), etf_code, '', n from busy b
  where (select max(n) from busy c where c.date = b.date) >= 3)
where position <= 3 and date in (select date from dates where prev_date is not null)""", "value")

answer("trading_day", "select s.d::varchar as date, trading::bigint as trading from ship_days s join trading t using (d)")
answer("last_trading_day", """
select s.d::varchar as date, (select max(t.d) from trading t where t.trading and t.d between s.d - 9 and s.d)::varchar as last_trading_day from ship_days s""")
answer("expected_data_date", """
select event_id, local::date::varchar as run_date, (select max(t.d) from run_trading t where t.trading
       and t.d between case when hour(local) < 15 then local::date - 1 else local::date end - 9
                   and case when hour(local) < 15 then local::date - 1 else local::date end)::varchar as expected_data_date
from runs""")
STAMPS = "'2002-01-01 00:00:00'"
answer("universe_upsert", f"""
select code, case when k % 5 = 0 then 'Renamed' else name end as name, case when k % 5 = 0 then 'New issuer' else issuer end as issuer, market, isin, case when k % 5 = 0 then null else listing_date end as listing_date,
       retired::bigint as retired, '1995-01-01' as first_seen_date, {STAMPS} as created_at, case when k % 5 = 0 then '2002-02-02 00:00:00' else {STAMPS} end as updated_at
from universe
union all
select 'X' || s_suppkey, 'X' || s_suppkey, null, null, null, '2001-01-01', 0, null, '2002-02-02 00:00:00', '2002-02-02 00:00:00' from supplier where s_suppkey % 4 = 0""")
answer("retire", f"""
select code, (case when k % 9 = 0 then 1 else retired end)::bigint as retired, case when k % 9 = 0 then '2002-02-02 00:00:00' else {STAMPS} end as updated_at from universe""")
answer("universe_reconcile", f"""
select u.code, u.name, u.issuer, case when f.code is null then u.market else 'TWSE' end as market, coalesce(f.isin, u.isin) as isin,
       coalesce(f.listing_date, u.listing_date) as listing_date, u.retired::bigint as retired, '1995-01-01' as first_seen_date, {STAMPS} as created_at,
       case when f.code is null then {STAMPS} else '2002-02-02 00:00:00' end as updated_at, case when f.code is null then 'kept' else 'updated' end as action
from universe u left join found f on f.code = u.code
union all
select f.code, f.name, null, 'TWSE', f.isin, f.listing_date, 0, '2001-10-01', '2002-02-02 00:00:00', '2002-02-02 00:00:00', 'inserted'
from found f where f.code not in (select code from universe)""")
answer("retirement_candidates", """
with recent as (select distinct date from all_rows where date <= '2001-10-01' order by date desc limit 2)
select code, 'retirement_candidate' as outcome from scope
where code not in (select code from found) and substr(code, 2, 5)::int % 11 <> 0 and not excluded and listing_date <= (select min(date) from recent)
  and code not in (select etf_code from all_rows where date in (select date from recent))""")
answer("retirement_skipped", """
select code, 'retirement_skipped' as outcome from universe
where code not in (select code from found) and substr(code, 2, 5)::int % 11 <> 0""")
answer("discovery_filter", """
select * from listed where contains(name, '主動') and code like '%A' and (
  regexp_matches(replace(name || ' ' || coalesce(isin, ''), '中國信託', ''), '台灣|臺灣|台股|臺股')
  or not regexp_matches(replace(name || ' ' || coalesce(isin, ''), '中國信託', ''), '境外|海外|全球|美國|日本|中國|越南|印度|歐洲|亞洲'))""")
answer("discovery_status", """
with m as (select distinct market from universe union select r_name from region)
select m.market, count(l.code) as securities, (count(l.code) > 0)::bigint as completed,
       (select bool_and(market in (select market from listed)) from m)::bigint as discovery_complete
from m left join listed l using (market) group by 1""")

answer("snapshot_arbitration", "select candidate_id, stored as stored_source_type, decision, (decision = 'replace')::bigint as inserted from judged")
answer("snapshot_equivalence", """
select candidate_id, stored as existing_source_type, existing_found::bigint as existing_snapshot_found, weight_delta as weight_delta_pct_points,
       same::bigint as equivalent from judged""", "weight_delta_pct_points")
answer("dedupe_rows", "select candidate_id, count(*) as row_count from cand group by 1")
answer("split_assets", "select candidate_id, count(*) as rows, case when asset_type = 'stock' then 'stock' else 'non_stock' end as kind from cand group by 1, 3")
answer("min_weight_gate", """
with g as (
  select candidate_id, count(*) as n0, count(stock_code) as s0,
         count(*) filter (where asset_type <> 'stock' or weight_pct >= 1.0) as n1, count(stock_code) filter (where weight_pct >= 1.0) as s1
  from cand group by 1),
v as (select *, case when candidate_id like '%|' then 'inconsistent_source_types' when n0 < 5 then 'fewer_than_5_rows' when s0 < 5 then 'fewer_than_5_taiwan_stock_rows' else 'ok' end as r0,
             case when n1 < 5 then 'fewer_than_5_rows' when s1 < 5 then 'fewer_than_5_taiwan_stock_rows' else 'ok' end as r1 from g)
select candidate_id, (r0 = 'ok' and r1 = 'ok')::bigint as valid, case when r0 <> 'ok' then r0 when r1 <> 'ok' then 'post_filter_invalid_snapshot:' || r1 else 'ok' end as reason,
       n1 as row_count, s1 as stock_count from v""")
answer("weight_warning", "select candidate_id, source_total_weight, weight_warning from warned", "source_total_weight")
answer("row_count_history", """
select date, etf_code, source_type, n as stock_rows,
       avg(n) over (partition by etf_code, source_type order by date rows between 5 preceding and 1 preceding) as mean_rows from stock_counts""", "mean_rows")
answer("row_count_check", """
select candidate_id, mean_rows, case when source_type like 'moneydj%' then mean_rows * 0.6::double end as minimum_expected,
       coalesce(source_type like 'moneydj%' and stock_count < mean_rows * 0.6::double, false)::bigint as low_confidence
from prof join means using (candidate_id, run_date)""", "mean_rows minimum_expected")
answer("candidate_selection", """
select run_date, etf_code, run_date as target_date, choice, candidate_id, chosen_source_type, warning as row_count_warning from outcome""")
answer("scrape_outcome", "select run_date, etf_code, candidate_id, data_date, outcome, outcome_reason from outcome")
answer("stale_decision", """
select o.run_date, o.etf_code, o.candidate_id, o.outcome, same::bigint as equivalent,
       case when o.outcome = 'stale' and coalesce(same, false) then 'skip_rewrite' else decision end as decision
from outcome o join judged j using (run_date, candidate_id) where o.outcome <> 'failed'""")
answer("run_summary", """
select run_date, count(*) as total_etfs, count(*) filter (where outcome <> 'failed' and chosen_source_type like 'moneydj%') as aggregator_success,
       count(*) filter (where outcome <> 'failed' and chosen_source_type not like 'moneydj%') as official_success,
       count(*) filter (where outcome = 'failed') as failed, count(*) filter (where outcome = 'success') as fresh, count(*) filter (where outcome = 'stale') as stale,
       count(*) filter (where outcome = 'failed') as unknown, coalesce(sum(stock_count) filter (where outcome <> 'failed'), 0)::bigint as total_stock_rows,
       coalesce(sum(non_stock_count) filter (where outcome <> 'failed'), 0)::bigint as total_non_stock_rows, count(warning) as row_count_warnings,
       min(data_date) filter (where outcome <> 'failed') as data_date_min, max(data_date) filter (where outcome <> 'failed') as data_date_max,
       (select count(weight_warning) from warned w where w.run_date = o.run_date) as weight_warnings
from outcome o group by 1""")
answer("run_failures", "select run_date, etf_code, outcome, outcome_reason, data_date from outcome where outcome <> 'success'")
answer("preexisting_partition", """
select e.date, e.etf_code, case when c.etf_code is null then 'to_load' else 'preexisting' end as status
from elig e join universe u on u.code = e.etf_code and u.retired = 0 left join canon c on c.date = e.date and c.etf_code = e.etf_code""")
answer("config_text_map", """
select code, (case when k % 25 = 24 then 0 else 2 end)::bigint as entries, case when k % 25 <> 24 then k::varchar end as fund_no,
       case when k % 25 <> 24 then 'zh' end as lang from universe""")
answer("classify_asset", """
select p_partkey, n as asset_name, case when regexp_matches(n, '\\(\\d{4}\\.tw\\)$') then 'stock' when contains(lower(n), 'cash') then 'cash'
         when contains(lower(n), 'futures') or contains(n, '期貨') then 'futures' when contains(lower(n), 'options') or contains(n, '選擇權') then 'options'
         when contains(lower(n), 'bond') or contains(n, '債') then 'bond' else 'unknown' end as asset_type,
       case when p_partkey % 6 = 0 then '1' || lpad((p_partkey % 1000)::varchar, 3, '0') end as stock_code,
       case when p_partkey % 6 = 0 then 'STK' || p_partkey end as stock_name
from (select p_partkey, list_extract(['STK' || p_partkey || '(1' || lpad((p_partkey % 1000)::varchar, 3, '0') || '.tw)', 'Cash USD', '台指 期貨', 'TX Options',
                                      '公司債', p_name], (p_partkey % 6 + 1)::int) as n from part)""")
answer("parse_numbers", """
select p_partkey, case p_partkey % 6 when 0 then floor(p_retailprice) * 1000 when 4 then 0.0 when 5 then floor(p_retailprice) end::double as number,
       case p_partkey % 6 when 0 then floor(p_retailprice) * 1000 when 3 then p_retailprice when 4 then 0.0 when 5 then floor(p_retailprice) end::double as weight,
       case p_partkey % 6 when 0 then floor(p_retailprice) * 1000 when 3 then p_retailprice when 4 then 0.004 when 5 then floor(p_retailprice) end::double as aggregator_weight
from part""", "number weight aggregator_weight")
LANDED = "payload_id, date, etf_code, stock_code, stock_name, shares, weight_pct"
answer("json_payload_rows", f"select {LANDED} from landed where k % 7 in (0, 1, 2) or (k % 7 = 3 and k % 14 <> 10)", "shares weight_pct")
answer("payload_rejects", "select distinct payload_id, etf_code, 'headered_table' as format, 'etf_mismatch' as reject from landed where k % 14 = 10")
answer("fund_options", """
select code as etf_code, case when k % 5 = 4 then k::varchar end as fund_no,
       case k % 5 when 0 then 'api_failed' when 1 then 'fund_option_missing_or_ambiguous' when 2 then 'fund_option_missing_or_ambiguous'
                  when 3 then 'fund_no_missing' end as reject
from universe""")
answer("html_table_rows", f"""
select {LANDED}, asset_name, asset_type from landed where k % 7 in (4, 6)
union all
select distinct payload_id, date, etf_code, null, null, null::double, 5.0::double, 'Cash & equivalents', 'cash' from landed where k % 7 = 6""", "shares weight_pct")
answer("text_block_rows", f"select {LANDED} from landed where k % 7 = 5", "shares weight_pct")
answer("security_master_rows", "select * from listed")
answer("payload_date", "select distinct payload_id, date as data_date from landed where k % 7 in (4, 5, 6)")

answer("snapshot_sink", """
with d as (
  select j.data_date, j.etf_code, o.run_date, o.candidate_id, j.stored,
         case when o.outcome = 'stale' and coalesce(same, false) then 'skip_rewrite' else decision end as decision
  from outcome o join judged j using (run_date, candidate_id) where o.outcome <> 'failed')
select r.date, r.etf_code, r.asset_name, r.stock_code, r.source_type, r.weight_pct
from all_rows r left join d on d.data_date = r.date and d.etf_code = r.etf_code
where d.decision is null or d.decision = 'skip_rewrite' or (d.decision = 'existing_higher_priority_source_preserved' and r.source_type = d.stored)
union all
select c.date, c.etf_code, c.asset_name, c.stock_code, c.source_type, c.weight_pct
from cand c join d using (run_date, candidate_id) where d.decision = 'replace' and (c.asset_type <> 'stock' or c.weight_pct >= 0.01)""", "weight_pct")
answer("derived_sink", f"select {CHANGE_KEY}, position_change_type, weight_delta_1d from chg where date <> '1999-01-01'", "weight_delta_1d")
ANSWERS["report_sink"] = ANSWERS["change_summary"]
answer("backfill", """
select date, count(*) as change_rows, (select count(*) from sig s where s.date = c.date) as signal_rows from chg c
where date between '1996-01-01' and '1997-12-31' group by 1""")
RUN = f"{CHANGE_KEY}, prev_date, position_change_type, consecutive_add_days::bigint as consecutive_add_days, consecutive_active_add_days::bigint as consecutive_active_add_days, weight_delta_1d"
answer("incremental_ingest", f"select {RUN} from chg where substr(etf_code, 2)::bigint % 14 <> 10", "weight_delta_1d")
answer("late_snapshot", f"select {RUN} from chg", "weight_delta_1d")
ANSWERS["late_signals"] = ANSWERS["manager_signals"]
ANSWERS["stateful_streak"] = ANSWERS["flow_streak"]
