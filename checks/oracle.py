"""Independent SQL for the registered queries, for DuckDB on the same parquet tables.

Dates are ISO text throughout. Steps are named CTEs; each query gets only those it needs.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def with_steps(sql: str) -> str:
    """``sql`` preceded by every step it names, directly or through another step."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"[a-z_0-9]+", text)):
            if word in CTES and word not in needed:
                needed.add(word)
                visit(CTES[word])

    visit(sql)
    steps = ",\n".join(f"{n} as materialized (\n{s}\n)" if n != "flow_run" else f"{n} as (\n{s}\n)"
                       for n, s in CTES.items() if n in needed)
    sql = sql.strip()
    if not steps:
        return sql
    own = sql[len("with "):] if sql.startswith("with ") else None
    return f"with recursive {steps},\n{own}" if own else f"with recursive {steps}\n{sql}"


def final(sql: str, doubles: str = "") -> str:
    """Query text with its floating-point columns rounded to six digits."""
    if doubles:
        rounded = ", ".join(f"round({c}, 6) + 0.0 as {c}" for c in doubles.split())
        sql = f"select * replace ({rounded}) from (\n{sql.strip()}\n)"
    return with_steps(sql)


# --- Tables ---------------------------------------------------------------------------

cte("base", """
select cast(cast(date_trunc('quarter', l_shipdate) as date) as varchar) as d, l_suppkey as k,
       l_partkey % 20 as b, l_linenumber as ln, l_quantity as q,
       cast(round(l_extendedprice * 100) as bigint) as c
from lineitem
""")
cte("sourced", """
select d, k, b, q, c,
       case when d = '1997-07-01' and k % 3 = 0 then ''
            when (k + quarter(d::date) + year(d::date)) % 7 = 0 then 'official_fallback'
            else 'moneydj_primary' end as st
from base
union all
select d, k, b, q, c, 'official_static' from base where k % 5 = 0 and ln <= 3
""")
cte("summed", "select d, k, b, st, sum(q) as q, cast(sum(c) as bigint) as c from sourced group by all")
cte("holdings", """
select d as date, 'F' || lpad(cast(k as varchar), 5, '0') as etf_code,
       'STK' || (1000 + b) || '(' || (1000 + b) || '.TW)' as asset_name, 'stock' as asset_type,
       cast(1000 + b as varchar) as stock_code, 'STK' || (1000 + b) as stock_name,
       case when (k + b) % 17 <> 0 then q end as shares,
       cast(95.0 as double) * c / cast(sum(c) over (partition by d, k, st) as bigint) as weight_pct,
       st as source_type
from summed
""")
cte("non_stock", """
select distinct date, etf_code, 'Cash' as asset_name, 'cash' as asset_type,
       cast(5.0 as double) as weight_pct, source_type from holdings
""")
cte("universe", """
select 'F' || lpad(cast(s_suppkey as varchar), 5, '0') as code, s_name as name, n_name as issuer,
       case when s_suppkey % 2 = 0 then 'TWSE' else 'TPEx' end as market,
       case when s_suppkey % 7 <> 0 then 'TW' || s_suppkey end as isin,
       case when s_suppkey % 33 <> 32
            then cast(date '1995-01-01' + cast((s_suppkey % 10) * 91 as integer) as varchar) end as listing_date,
       case when s_suppkey % 20 = 19 then 1 else 0 end as retired,
       case when s_suppkey % 4 = 0 then 'api' else 'static' end as official_method,
       case when s_suppkey % 25 = 24 then 'excluded_from_taiwan_stock_universe'
            else 'fund_no=' || s_suppkey || '; lang = zh' end as official_logic,
       s_suppkey as k
from supplier join nation on s_nationkey = n_nationkey
""")
cte("all_rows", """
select date, etf_code, asset_name, asset_type, stock_code, stock_name, shares, weight_pct, source_type from holdings
union all
select date, etf_code, asset_name, asset_type, null, null, null, weight_pct, source_type from non_stock
""")

# --- Snapshots ------------------------------------------------------------------------

cte("snap", """
select date, etf_code, source_type, count(*) as row_count,
       count(*) filter (where asset_type = 'stock') as stock_count,
       count(*) filter (where asset_type <> 'stock') as non_stock_count,
       round(sum(weight_pct), 10) as total_weight,
       coalesce(count(shares) filter (where asset_type = 'stock') * 1.0
                / nullif(count(*) filter (where asset_type = 'stock'), 0), 0.0)::double as shares_coverage,
       case when source_type = '' then 'inconsistent_source_types'
            when count(*) < 5 then 'fewer_than_5_rows'
            when count(*) filter (where asset_type = 'stock') < 5 then 'fewer_than_5_taiwan_stock_rows'
            when count(*) filter (where asset_type = 'stock'
                 and not (regexp_full_match(coalesce(stock_code, ''), '[0-9]{4}') and coalesce(trim(stock_name), '') <> '')) > 0
                 then 'invalid_taiwan_stock_row'
            when count(distinct stock_code) <> count(stock_code) then 'duplicate_stock_codes'
            else 'ok' end as reason
from all_rows group by 1, 2, 3
""")
cte("priority", """
select * from (values ('moneydj_primary', 40), ('moneydj_browser', 38), ('official_fallback', 35),
                      ('official_browser', 35), ('official_static', 30)) as p(source_type, priority)
""")
cte("canon", """
select * exclude (n) from (
  select s.*, coalesce(p.priority, 10) as priority,
         case when contains(s.source_type, 'moneydj') then 'moneydj'
              when contains(s.source_type, 'official') then 'official' else s.source_type end as family,
         row_number() over (partition by date, etf_code order by coalesce(p.priority, 10) desc, stock_count desc,
                            shares_coverage desc, non_stock_count desc, s.source_type desc) as n
  from snap s left join priority p on p.source_type = s.source_type where reason = 'ok')
where n = 1
""")
cte("latest", "select etf_code, max(date) as latest_date from all_rows group by 1")
cte("scope", """
select *, (contains(coalesce(official_logic, ''), 'excluded_from_taiwan_stock_universe')
           or contains(coalesce(official_logic, ''), 'trades_offshore_instruments=true')) as excluded
from universe
""")
cte("date_list", "select date, bool_or(stock_code is not null) as has_holdings from all_rows group by 1")
cte("elig", """
select d.date, u.code as etf_code, u.issuer
from date_list d join scope u on not u.excluded and u.listing_date <= d.date
left join latest l on l.etf_code = u.code
where u.retired = 0 or d.date <= l.latest_date
""")
cte("entries", """
select c.*, e.issuer, row_number() over (partition by c.etf_code order by c.date) as ti
from canon c join elig e using (date, etf_code)
""")
cte("cov", """
select d.date, d.has_holdings, (select count(*) from elig e where e.date = d.date) as expected_count,
       (select count(*) from entries n where n.date = d.date) as actual_count
from date_list d
""")
cte("dates", """
select *, count(*) filter (where date_valid) over (order by date) as vi,
       max(case when date_valid then date end) over (order by date rows between unbounded preceding and 1 preceding) as prev_date
from (select *, expected_count > 0 and actual_count >= ceil(expected_count * 0.8::double) as date_valid from cov)
""")
cte("missing", "select e.date, e.etf_code from elig e anti join entries n using (date, etf_code)")
cte("available", """
select m.date, m.etf_code,
       (select max(n.date) from entries n where n.etf_code = m.etf_code and n.date < m.date) as latest_date
from missing m
""")
cte("ranked", """
select h.*, n.family, n.ti, n.issuer,
       row_number() over (partition by h.date, h.etf_code order by weight_pct desc, stock_code) as rank
from holdings h join entries n using (date, etf_code, source_type)
""")

# --- Changes --------------------------------------------------------------------------

cte("pairs", "select date, prev_date, date_valid, vi from dates where has_holdings and prev_date is not null")
cte("overlap", """
select p.date, r.etf_code, count(*) as both_n
from pairs p join ranked r on r.date = p.date
join ranked q on q.date = p.prev_date and q.etf_code = r.etf_code and q.stock_code = r.stock_code
group by 1, 2
""")
cte("diag", """
select date, prev_date, etf_code, case when reason = 'comparable_source_pair' then 'included' else 'skipped' end as status, * exclude (date, prev_date, etf_code)
from (
  select *, case when current_source_type is null then 'missing_current_source'
                 when previous_source_type is null then 'missing_previous_source'
                 when overlap_ratio >= 0.9 and size_ratio >= 0.7 then 'comparable_source_pair'
                 when cf = pf and overlap_ratio >= 0.5 and size_ratio >= 0.5 then 'comparable_source_pair'
                 else 'incompatible_source_pair' end as reason
  from (
    select coalesce(c.date, q.date) as date, coalesce(c.prev_date, q.prev_date) as prev_date, coalesce(c.etf_code, q.etf_code) as etf_code,
           c.source_type as current_source_type, q.source_type as previous_source_type,
           c.stock_count as current_stock_count, q.stock_count as previous_stock_count,
           c.total_weight as current_total_weight, q.total_weight as previous_total_weight,
           c.family as cf, q.family as pf,
           case when c.etf_code is not null and q.etf_code is not null
                then coalesce(o.both_n, 0)::double / greatest(c.stock_count, q.stock_count) end as overlap_ratio,
           case when c.etf_code is not null and q.etf_code is not null then c.stock_count::double / q.stock_count end as size_ratio
    from (select p.date, p.prev_date, n.* exclude (date) from pairs p join entries n on n.date = p.date) c
    full join (select p.date, p.prev_date, n.* exclude (date) from pairs p join entries n on n.date = p.prev_date) q
      on c.date = q.date and c.etf_code = q.etf_code
    left join overlap o on o.date = coalesce(c.date, q.date) and o.etf_code = coalesce(c.etf_code, q.etf_code)))
""")
cte("compared", "select date, prev_date, etf_code from diag where status = 'included'")
cte("ratios", """
select c.date, c.etf_code, r.shares / q.shares as ratio
from compared c join ranked r on r.date = c.date and r.etf_code = c.etf_code
join ranked q on q.date = c.prev_date and q.etf_code = c.etf_code and q.stock_code = r.stock_code
where r.shares is not null and q.shares > 1e-9
""")
cte("scales", """
select date, etf_code, avg(ratio) as scale from (
  select *, row_number() over (partition by date, etf_code order by ratio) as i, count(*) over (partition by date, etf_code) as n from ratios)
where n >= 3 and i in ((n + 1) // 2, n // 2 + 1) group by 1, 2
""")
cte("moved", """
select c.date, c.prev_date, c.etf_code, coalesce(r.stock_code, q.stock_code) as stock_code,
       coalesce(nullif(r.stock_name, ''), q.stock_name) as stock_name,
       q.weight_pct as prev_weight_pct, coalesce(r.weight_pct, 0.0) as weight_pct,
       coalesce(r.weight_pct, 0.0) - coalesce(q.weight_pct, 0.0) as weight_delta_1d,
       q.shares as prev_shares, r.shares as shares, r.shares - q.shares as shares_delta_1d,
       s.scale as etf_scale_factor, q.rank as prev_rank, r.rank as rank,
       case when q.stock_code is null then 1 else 0 end as is_new_position,
       case when r.stock_code is null then 1 else 0 end as is_removed_position
from compared c
join (select distinct c.date, c.etf_code, x.stock_code from compared c join ranked x on x.etf_code = c.etf_code and x.date in (c.date, c.prev_date)) u
  on u.date = c.date and u.etf_code = c.etf_code
left join ranked r on r.date = c.date and r.etf_code = c.etf_code and r.stock_code = u.stock_code
left join ranked q on q.date = c.prev_date and q.etf_code = c.etf_code and q.stock_code = u.stock_code
left join scales s on s.date = c.date and s.etf_code = c.etf_code
""")
cte("flowed", """
select *, case when active_shares_delta_1d is null or base is null or abs(base) < 1e-9 then null
               else active_shares_delta_1d / base * 100.0 end as active_shares_delta_pct_1d
from (
  select *, coalesce(prev_shares * etf_scale_factor, prev_shares) as base,
         case when shares is not null and prev_shares is not null and etf_scale_factor is not null
              then case when abs(shares - prev_shares * etf_scale_factor) <= 1e-9 then 0.0 else shares - prev_shares * etf_scale_factor end
              else shares_delta_1d end as active_shares_delta_1d
  from moved)
""")
cte("material", """
select *, coalesce(abs(active_shares_delta_1d) > 1e-9
                   and (active_shares_delta_pct_1d is null or abs(active_shares_delta_pct_1d) >= 1.0), false) as is_material
from flowed
""")
cte("named_class", """
select *, case
  when is_new_position = 1 then 'new_position'
  when is_removed_position = 1 then 'removed_position'
  when active_shares_delta_1d is null then
    case when weight_delta_1d > 1e-9 then 'weight_only_increase' when weight_delta_1d < -1e-9 then 'weight_only_decrease' else 'unchanged' end
  when etf_scale_factor is not null and abs(active_shares_delta_1d) <= 1e-9 and shares_delta_1d > 1e-9 then 'flow_scaled_increase'
  when etf_scale_factor is not null and abs(active_shares_delta_1d) <= 1e-9 and shares_delta_1d < -1e-9 then 'flow_scaled_decrease'
  when not is_material and active_shares_delta_1d > 1e-9 then 'immaterial_active_increase'
  when not is_material and active_shares_delta_1d < -1e-9 then 'immaterial_active_decrease'
  when active_shares_delta_1d > 1e-9 then case when weight_delta_1d >= -1e-9 then 'confirmed_active_add' else 'mixed_add_but_weight_down' end
  when active_shares_delta_1d < -1e-9 then case when weight_delta_1d <= 1e-9 then 'confirmed_active_reduce' else 'mixed_reduce_but_weight_up' end
  when weight_delta_1d > 1e-9 then 'passive_weight_increase'
  when weight_delta_1d < -1e-9 then 'passive_weight_decrease'
  else 'unchanged' end as position_change_type
from material
""")
cte("classed", """
select *,
  case when position_change_type in ('new_position', 'confirmed_active_add', 'mixed_add_but_weight_down') then 'add'
       when position_change_type in ('removed_position', 'confirmed_active_reduce', 'mixed_reduce_but_weight_up') then 'reduce'
       when position_change_type like 'weight_only%' then 'unknown' else 'none' end as active_direction,
  case when position_change_type in ('new_position', 'confirmed_active_add', 'mixed_add_but_weight_down') then 1 else 0 end as is_active_add,
  case when position_change_type in ('removed_position', 'confirmed_active_reduce', 'mixed_reduce_but_weight_up') then 1 else 0 end as is_active_reduce,
  case when position_change_type like 'passive%' then 1 else 0 end as is_passive_weight_change,
  case when position_change_type in ('new_position', 'removed_position', 'confirmed_active_add', 'confirmed_active_reduce') then 'high'
       when position_change_type like 'mixed%' or position_change_type like 'flow%' then 'medium'
       when position_change_type = 'unchanged' and active_shares_delta_1d is not null then 'high' else 'low' end as confidence
from named_class
""")
# Full grid of own dates and stocks: the plain definition of the two own-date streaks.
cte("grid", """
select n.etf_code, n.date, n.ti, s.stock_code, r.weight_pct as w, r.shares as sh
from entries n join (select distinct etf_code, stock_code from ranked) s using (etf_code)
left join ranked r on r.etf_code = n.etf_code and r.date = n.date and r.stock_code = s.stock_code
""")
cte("steps", """
select *, case when ti = 1 then 0 when coalesce(w, 0) > pw + 1e-9 then 1 when coalesce(w, 0) < pw - 1e-9 then -1 else 0 end as wd,
       case when ti = 1 then 0 when sh > psh + 1e-9 then 1 when sh < psh - 1e-9 then -1 else 0 end as sd
from (select *, coalesce(lag(w) over g, 0) as pw, lag(sh) over g as psh from grid window g as (partition by etf_code, stock_code order by ti))
""")
cte("own_streaks", """
select etf_code, stock_code, date,
       ti - max(case when wd <> 1 then ti end) over g as wa, ti - max(case when wd <> -1 then ti end) over g as wr,
       ti - max(case when sd <> 1 then ti end) over g as sa, ti - max(case when sd <> -1 then ti end) over g as sr
from steps window g as (partition by etf_code, stock_code order by ti)
""")
cte("streaked", """
select c.*, d.vi, d.date_valid, coalesce(o.wa, 0) as wa, coalesce(o.wr, 0) as wr, coalesce(o.sa, 0) as sa, coalesce(o.sr, 0) as sr
from classed c join dates d on d.date = c.date
left join own_streaks o on o.etf_code = c.etf_code and o.stock_code = c.stock_code and o.date = c.date
""")
# Day by day over valid dates, as the stored counts are built.
cte("flow_run", """
select 0::bigint as n, '' as etf_code, '' as stock_code, 0 as fa, 0 as fr, 0::bigint as a, 0::bigint as r
union all
select s.n + 1, v.etf_code, v.stock_code, v.is_active_add, v.is_active_reduce,
       case when v.etf_scale_factor is null then v.sa when v.is_active_add = 0 then 0
            when f.fa = 1 then f.a + 1 else 1 end,
       case when v.etf_scale_factor is null then v.sr when v.is_active_reduce = 0 then 0
            when f.fr = 1 then f.r + 1 else 1 end
from (select distinct n from flow_run) s
join (select vi, etf_code, stock_code, is_active_add, is_active_reduce, etf_scale_factor, sa, sr from streaked where date_valid
      union all select vi, '', '', 0, 0, 1.0, 0, 0 from dates where date_valid) v on v.vi = s.n + 1
left join flow_run f on f.etf_code = v.etf_code and f.stock_code = v.stock_code
""")
cte("chg", """
select c.date, c.etf_code, coalesce(u.issuer, '') as issuer, c.stock_code, c.stock_name, c.prev_date, c.prev_weight_pct, c.weight_pct,
       c.weight_delta_1d, c.prev_shares, c.shares, c.shares_delta_1d, c.etf_scale_factor, c.active_shares_delta_1d,
       c.active_shares_delta_pct_1d, c.prev_rank, c.rank, c.is_new_position, c.is_removed_position,
       c.wa as consecutive_add_days, c.wr as consecutive_reduce_days,
       case when c.etf_scale_factor is null then c.sa when c.is_active_add = 0 then 0 when f.fa = 1 then f.a + 1 else 1 end as consecutive_active_add_days,
       case when c.etf_scale_factor is null then c.sr when c.is_active_reduce = 0 then 0 when f.fr = 1 then f.r + 1 else 1 end as consecutive_active_reduce_days,
       c.position_change_type, c.active_direction, c.is_active_add, c.is_active_reduce, c.is_passive_weight_change,
       c.active_direction as flow_adjusted_direction, c.confidence
from streaked c
left join universe u on u.code = c.etf_code
join dates p on p.date = c.prev_date
left join flow_run f on f.n = p.vi and f.etf_code = c.etf_code and f.stock_code = c.stock_code
""")

# --- Signals --------------------------------------------------------------------------

cte("cdates", "select date, row_number() over (order by date) as ci from (select distinct date from chg)")
cte("flags", """
select c.*, d.ci,
  case when consecutive_active_add_days >= 3 then coalesce(coalesce(active_shares_delta_1d, shares_delta_1d) > 0, false)
       else is_passive_weight_change = 0 and consecutive_active_add_days = 0 and consecutive_add_days >= 3
            and active_shares_delta_1d is null and coalesce(shares_delta_1d > 0, false) end as add_run,
  case when consecutive_active_reduce_days >= 3 then coalesce(coalesce(active_shares_delta_1d, shares_delta_1d) < 0, false)
       else is_passive_weight_change = 0 and consecutive_active_reduce_days = 0 and consecutive_reduce_days >= 3
            and active_shares_delta_1d is null and coalesce(shares_delta_1d < 0, false) end as reduce_run
from chg c join cdates d using (date)
""")
cte("acts", """
select 'add' as direction, * from flags
where (is_new_position = 1 and weight_pct >= 2) or is_active_add = 1 or active_direction = 'add' or add_run
union all
select 'reduce', * from flags
where (is_removed_position = 1 and prev_weight_pct >= 2) or is_active_reduce = 1 or active_direction = 'reduce' or reduce_run
""")
cte("windowed", "select d.ci as tci, d.date as tdate, a.* from cdates d join acts a on a.ci between d.ci - 2 and d.ci")
cte("agree", """
select tci, tdate, stock_code, direction, count(distinct nullif(issuer, '')) as issuer_count, count(distinct etf_code) as etf_count,
       arg_max(stock_name, date || etf_code) as stock_name, arg_max(confidence, date || etf_code) as confidence,
       max(date || etf_code) as rep, bool_or(date = tdate) as acted_today, avg(active_shares_delta_pct_1d) as avg_active_pct,
       string_agg(distinct etf_code, '-' order by etf_code) as funds, string_agg(distinct issuer, ',' order by issuer) as issuers,
       count(*) as events
from windowed group by 1, 2, 3, 4 having count(distinct nullif(issuer, '')) >= 2
""")
cte("fresh", """
select a.*, case when not a.acted_today then 'stale' when o.tci is not null then 'reversal' when s.tci is null then 'new'
                 when a.issuer_count < s.issuer_count then 'fading' else 'persistent' end as signal_freshness,
       s.issuer_count as prior_count
from agree a
left join agree s on s.tci = a.tci - 1 and s.stock_code = a.stock_code and s.direction = a.direction
left join agree o on o.tci = a.tci - 1 and o.stock_code = a.stock_code and o.direction <> a.direction
""")
cte("single", """
select date, 'new_core_position' as signal_type, 4.0 as signal_score, 'single ETF new core position' as freshness_reason, * exclude (date) from flags where is_new_position = 1 and weight_pct >= 2
union all
select date, 'removed_core_position', -5.0, 'single ETF removed core position', * exclude (date) from flags where is_removed_position = 1 and prev_weight_pct >= 2
union all
select date, 'consecutive_add_3d', 4.0, 'single ETF consecutive active add', * exclude (date) from flags where add_run
union all
select date, 'consecutive_reduce_3d', -4.0, 'single ETF consecutive active reduce', * exclude (date) from flags where reduce_run
""")
cte("sig", """
select date, date || ':' || signal_type || ':' || stock_code || ':' || etf_code as signal_id, signal_type, signal_score::double as signal_score,
       stock_code, stock_name, etf_code as etf_codes, coalesce(nullif(issuer, ''), '') as issuers, 1::bigint as etf_count,
       (case when issuer <> '' then 1 else 0 end)::bigint as issuer_count, confidence, 'current' as signal_freshness, freshness_reason,
       active_shares_delta_pct_1d as avg_active_pct, 1::bigint as events
from single
union all
select tdate, tdate || ':consensus_' || direction || '_3d:' || stock_code || ':' || funds, 'consensus_' || direction || '_3d',
       (case when issuer_count >= 3 then 6.0 else 4.0 end * case when direction = 'add' then 1 else -1 end)::double,
       stock_code, stock_name, replace(funds, '-', ','), issuers, etf_count, issuer_count, confidence, signal_freshness,
       case signal_freshness when 'stale' then 'consensus remains in the rolling window, but there is no current-day event'
            when 'reversal' then 'current consensus follows an opposite consensus in the previous window'
            when 'new' then 'first reaches consensus in the rolling window'
            when 'fading' then 'issuer count declined from ' || prior_count || ' to ' || issuer_count
            else 'consensus continues with current-day evidence' end,
       avg_active_pct, events
from fresh
""")

# --- Intent ---------------------------------------------------------------------------

cte("qdates", "select date, row_number() over (order by date) as qi from (select distinct date from entries)")
cte("iwin", """
select t.date as tdate, w.window_days, m.date
from qdates t cross join (values (5), (10)) as w(window_days) join qdates m on m.qi between t.qi - w.window_days + 1 and t.qi
""")
cte("ctx", """
select date, etf_code from diag where status = 'included' and (date, etf_code) in (select (date, etf_code) from elig)
union
select date, etf_code from entries where date not in (select date from diag)
""")
cte("scored", """
select *, case when is_new_position = 1 or position_change_type = 'new_position' then 4.0
               when is_removed_position = 1 or position_change_type = 'removed_position' then -4.0
               when is_active_add = 1 or active_direction = 'add' or contains(position_change_type, 'active_add')
                    then case when consecutive_active_add_days >= 3 then 1.5 else 2.0 end
               when is_active_reduce = 1 or active_direction = 'reduce' or contains(position_change_type, 'active_reduce')
                    then case when consecutive_active_reduce_days >= 3 then -1.5 else -2.0 end
               else 0.0 end::double as score
from chg join elig using (date, etf_code) where chg.issuer <> ''
""")
cte("ievents", """
select v.entity_level, w.tdate, w.window_days, s.date, s.stock_code, s.stock_name, s.etf_code, s.issuer, s.score, s.position_change_type, s.active_direction,
       case when v.entity_level = 'stock' then '' else s.issuer end as issuer_key
from iwin w join (select date, stock_code, stock_name, etf_code, chg_issuer as issuer, score, position_change_type, active_direction
                  from (select * exclude (issuer, issuer_1), issuer as chg_issuer from scored) where score <> 0) s on s.date = w.date
cross join (values ('stock'), ('issuer_stock')) as v(entity_level)
""")
cte("iheld", """
select v.entity_level, w.tdate, w.window_days, r.date, r.stock_code, r.stock_name,
       case when v.entity_level = 'stock' then '' else r.issuer end as issuer_key
from iwin w join ranked r on r.date = w.date join ctx c on c.date = r.date and c.etf_code = r.etf_code
cross join (values ('stock'), ('issuer_stock')) as v(entity_level)
where r.asset_type = 'stock' and r.issuer <> ''
""")
cte("idays", """
select entity_level, tdate, window_days, stock_code, issuer_key, count(distinct date) as eligible_days
from iheld group by all
""")
cte("iscore", """
select entity_level, tdate, window_days, stock_code, issuer_key,
       coalesce(sum(score) filter (where score > 0), 0.0) as buy, coalesce(-sum(score) filter (where score < 0), 0.0) as sell,
       count(distinct etf_code) filter (where score > 0) as buy_etf_count, count(distinct etf_code) filter (where score < 0) as sell_etf_count,
       count(distinct issuer) filter (where score > 0) as buy_issuer_count, count(distinct issuer) filter (where score < 0) as sell_issuer_count
from ievents group by all
""")
cte("inet", """
select e.entity_level, e.tdate, e.window_days, e.stock_code, e.issuer_key,
       count(*) filter (where net > 0) as buy_days, count(*) filter (where net < 0) as sell_days
from (select entity_level, tdate, window_days, stock_code, issuer_key, date, sum(score) as net from ievents group by all) e
semi join iheld h on h.entity_level = e.entity_level and h.tdate = e.tdate and h.window_days = e.window_days
  and h.stock_code = e.stock_code and h.issuer_key = e.issuer_key and h.date = e.date
group by all
""")
cte("irot", """
select a.tdate, a.window_days, a.stock_code, a.issuer_key, a.entity_level,
       count(distinct a.etf_code) filter (where a.score > 0) as rotation_buy_etf_count,
       count(distinct a.etf_code) filter (where a.score < 0) as rotation_sell_etf_count
from ievents a
where a.entity_level = 'issuer_stock' and exists (
  select 1 from ievents b where b.entity_level = a.entity_level and b.tdate = a.tdate and b.window_days = a.window_days
    and b.stock_code = a.stock_code and b.issuer_key = a.issuer_key and b.date = a.date and b.etf_code <> a.etf_code
    and sign(b.score) <> sign(a.score))
group by all
""")
cte("inames", """
select tdate, window_days, entity_level, stock_code, issuer_key, arg_min(stock_name, k) as stock_name from (
  select tdate, window_days, entity_level, stock_code, issuer_key, stock_name, '0' || date || stock_name as k from iheld
  union all select tdate, window_days, entity_level, stock_code, issuer_key, stock_name, '1' || date || stock_name from ievents) group by all
""")
cte("ibase", """
select coalesce(d.tdate, s.tdate) as date, coalesce(d.window_days, s.window_days) as window_days,
       coalesce(d.entity_level, s.entity_level) as entity_level, coalesce(d.stock_code, s.stock_code) as stock_code,
       coalesce(d.issuer_key, s.issuer_key) as issuer_key, coalesce(d.eligible_days, 0) as eligible_days,
       coalesce(s.buy, 0.0) as cum_active_buy_score, coalesce(s.sell, 0.0) as cum_active_sell_score,
       coalesce(s.buy_etf_count, 0) as buy_etf_count, coalesce(s.sell_etf_count, 0) as sell_etf_count,
       coalesce(s.buy_issuer_count, 0) as buy_issuer_count, coalesce(s.sell_issuer_count, 0) as sell_issuer_count
from idays d full join iscore s using (entity_level, tdate, window_days, stock_code, issuer_key)
""")
cte("imetric", """
select b.*, n.stock_name, coalesce(t.buy_days, 0) as buy_days, coalesce(t.sell_days, 0) as sell_days,
       coalesce(r.rotation_buy_etf_count, 0) as rotation_buy_etf_count, coalesce(r.rotation_sell_etf_count, 0) as rotation_sell_etf_count,
       cum_active_buy_score - cum_active_sell_score as net_active_score, cum_active_buy_score + cum_active_sell_score as gross_active_score,
       (cum_active_buy_score - cum_active_sell_score) / nullif(cum_active_buy_score + cum_active_sell_score, 0) as net_to_gross,
       case when r.rotation_buy_etf_count > 0 and r.rotation_sell_etf_count > 0
            then least(cum_active_buy_score, cum_active_sell_score) / greatest(cum_active_buy_score, cum_active_sell_score) end as cross_fund_offset_ratio
from ibase b
left join inames n on n.tdate = b.date and n.window_days = b.window_days and n.entity_level = b.entity_level and n.stock_code = b.stock_code and n.issuer_key = b.issuer_key
left join inet t on t.tdate = b.date and t.window_days = b.window_days and t.entity_level = b.entity_level and t.stock_code = b.stock_code and t.issuer_key = b.issuer_key
left join irot r on r.tdate = b.date and r.window_days = b.window_days and r.entity_level = b.entity_level and r.stock_code = b.stock_code and r.issuer_key = b.issuer_key
where exists (select 1 from iwin w join ctx c on c.date = w.date where w.tdate = b.date and w.window_days = b.window_days)
""")
cte("intent", """
select *, case primary_intent_state when 'insufficient_data' then 'neutral' when 'cross_fund_rotation_accumulation' then 'rotation_accumulation'
            when 'cross_fund_rotation_distribution' then 'rotation_distribution' when 'cross_fund_rotation' then 'rotation'
            when 'high_activity_unclear' then 'unclear' else primary_intent_state end as intent_direction,
       case primary_intent_state when 'insufficient_data' then 'insufficient_data' when 'contested' then 'issuer_disagreement,high_gross_low_net'
            when 'cross_fund_rotation_accumulation' then 'cross_fund_rotation,rotation_net_accumulation'
            when 'cross_fund_rotation_distribution' then 'cross_fund_rotation,rotation_net_distribution'
            when 'cross_fund_rotation' then 'cross_fund_rotation' when 'accumulation' then 'broad_manager_accumulation'
            when 'distribution' then 'broad_manager_distribution' when 'high_activity_unclear' then 'high_gross_low_net' else '' end as tags,
       case when primary_intent_state in ('insufficient_data', 'neutral', 'high_activity_unclear') then 'low' else 'medium' end as confidence
from (
  select *, case
    when eligible_days < 3 then 'insufficient_data'
    when gross_active_score = 0 then 'neutral'
    when entity_level = 'stock' and buy_issuer_count >= 2 and sell_issuer_count >= 2
         and gross_active_score >= case window_days when 5 then 8 else 12 end and abs(net_to_gross) <= 0.25 then 'contested'
    when coalesce(cross_fund_offset_ratio >= 0.5, false) then
         case when net_to_gross >= 0.25 then 'cross_fund_rotation_accumulation' when net_to_gross <= -0.25 then 'cross_fund_rotation_distribution' else 'cross_fund_rotation' end
    when net_active_score >= case window_days when 5 then 4 else 6 end and net_to_gross >= 0.25 and (buy_issuer_count >= 2 or buy_etf_count >= 3) then 'accumulation'
    when net_active_score <= case window_days when 5 then -4 else -6 end and net_to_gross <= -0.25 and (sell_issuer_count >= 2 or sell_etf_count >= 3) then 'distribution'
    when gross_active_score >= case window_days when 5 then 8 else 12 end and abs(net_to_gross) <= 0.25 then 'high_activity_unclear'
    else 'neutral' end as primary_intent_state
  from imetric)
""")

# --- Traction -------------------------------------------------------------------------

cte("twin", "select e.date as end_date, m.date from cdates e join cdates m on m.ci between e.ci - 5 and e.ci")
cte("nflow", """
select f.*, coalesce(w.total_weight, 0.0) as total_weight, coalesce(w.avg_weight, 0.0) as avg_weight
from (
  select end_date, stock_code,
         coalesce(arg_max(stock_name, c.date || etf_code) filter (where is_active_add = 1),
                  arg_max(stock_name, c.date || etf_code) filter (where is_active_reduce = 1), '') as stock_name,
         count(*) filter (where is_active_add = 1) as active_adds, count(*) filter (where is_active_reduce = 1) as active_reduces,
         count(*) filter (where is_new_position = 1) as new_positions, count(*) filter (where is_removed_position = 1) as removed_positions,
         count(distinct issuer) filter (where is_active_add = 1) as add_issuers, count(distinct issuer) filter (where is_active_reduce = 1) as reduce_issuers,
         count(*) filter (where is_active_add = 1 and consecutive_active_add_days >= 2) as add_streaks_2plus,
         count(*) filter (where is_active_reduce = 1 and consecutive_active_reduce_days >= 2) as reduce_streaks_2plus
  from twin t join chg c on c.date = t.date group by 1, 2) f
left join (select date, stock_code, round(sum(weight_pct), 2) as total_weight, round(avg(weight_pct), 2) as avg_weight from chg group by 1, 2) w
  on w.date = f.end_date and w.stock_code = f.stock_code
where active_adds >= 2 or active_reduces >= 2
""")
cte("buckets", """
select *, case when net >= 2 and (add_issuers >= 2 or net >= 4) then 'gaining' when net <= -2 and (reduce_issuers >= 2 or net <= -4) then 'losing'
               when net between -1 and 1 and active_adds >= 3 and active_reduces >= 2 then 'split' end as bucket
from (select *, active_adds - active_reduces as net from nflow)
""")

# --- Report ---------------------------------------------------------------------------

cte("skips", """
select date, etf_code, reason, current_source_type, previous_source_type from diag
where status = 'skipped' and (date, etf_code) in (select (date, etf_code) from elig)
""")
cte("warns", """
select date, 'incomplete_coverage' as warning, '' as etf_code, expected_count::double as expected, actual_count::double as actual
from cov where expected_count > 0 and actual_count < expected_count
union all
select date, 'low_stock_weight', etf_code, 80.0, sum(weight_pct) from ranked group by date, etf_code having sum(weight_pct) < 80.0
""")
cte("movers", """
select * from (
  select *, row_number() over (partition by date order by abs(weight_delta_1d) desc, etf_code, stock_code) as position from chg
  where is_new_position = 0 and is_removed_position = 0 and position_change_type not in ('passive_weight_increase', 'passive_weight_decrease')
    and abs(active_shares_delta_pct_1d) >= 10)
where position <= 10
""")
cte("opened", """
select * from (select *, count(distinct etf_code) over (partition by date, stock_code) as funds from chg
               where is_new_position = 1 and (weight_pct >= 0.5 or rank <= 20)) where funds >= 2
""")
cte("closed", "select * from chg where is_removed_position = 1 and (prev_weight_pct >= 0.5 or prev_rank <= 20)")
cte("held_by", """
select r.date, r.stock_code, r.stock_name, count(distinct r.etf_code) as etf_count, avg(weight_pct) as avg_weight, max(weight_pct) as max_weight,
       sum(weight_pct) as total_weight, any_value(c.expected_count) as active_etf_count
from ranked r join cov c using (date) group by 1, 2, 3
""")
cte("drift", """
select d.date, d.prev_date, a.stock_code, a.t - b.t as weight_change from dates d
join (select date, stock_code, sum(weight_pct) as t from ranked group by 1, 2) a on a.date = d.date
join (select date, stock_code, sum(weight_pct) as t from ranked group by 1, 2) b on b.date = d.prev_date and b.stock_code = a.stock_code
""")
cte("strong", """
select *, case signal_freshness when 'new' then 0 when 'reversal' then 1 when 'persistent' then 2 when 'current' then 3 when 'fading' then 4 when 'stale' then 5 else 9 end as freshness_order
from sig where abs(signal_score) >= 6
""")
cte("irank", """
select * from (
  select *, row_number() over (partition by date order by
      case primary_intent_state when 'cross_fund_rotation_accumulation' then 0 when 'cross_fund_rotation_distribution' then 1 when 'cross_fund_rotation' then 2
           when 'accumulation' then 3 when 'distribution' then 4 when 'contested' then 5 when 'high_activity_unclear' then 6 else 99 end,
      abs(net_active_score) desc, gross_active_score desc, stock_code, issuer_key) as position
  from intent where window_days = 5 and primary_intent_state not in ('neutral', 'insufficient_data'))
where position <= 8
""")

# --- Calendar, discovery, landed inputs -----------------------------------------------

cte("ship_days", "select distinct cast(l_shipdate as date) as d from lineitem")
cte("all_days", """
select unnest(generate_series((select min(d) from ship_days) - interval 10 day, (select max(d) from ship_days)::timestamp, interval 1 day))::date as d
""")
cte("trading", """
select d, isodow(d) < 6 and strftime(d, '%m%d') not in ('0101', '0228', '0404', '0501', '1010')
          and not (year(d) % 2 = 0 and strftime(d, '%m%d') = '0702') as trading from all_days
""")
cte("runs", "select event_id, ts + interval 8 hour as local from events")
cte("run_days", """
select unnest(generate_series((select min(ts)::date from events) - interval 10 day, (select max(ts)::date from events) + interval 1 day, interval 1 day))::date as d
""")
cte("run_trading", """
select d, isodow(d) < 6 and strftime(d, '%m%d') not in ('0101', '0228', '0404', '0501', '1010')
          and not (year(d) % 2 = 0 and strftime(d, '%m%d') = '0702') as trading from run_days
""")
cte("found", """
select case when s_suppkey % 7 = 1 then 'Z' || s_suppkey else 'F' || lpad(s_suppkey::varchar, 5, '0') end as code,
       'Found ' || s_suppkey as name, case when s_suppkey % 2 = 0 then 'ISIN' || s_suppkey end as isin,
       case when s_suppkey % 11 = 0 then '1999-09-09' end as listing_date
from supplier where s_suppkey % 3 <> 0 and s_suppkey % 20 <> 19
""")
cte("listed", """
select case when s_suppkey % 2 = 0 then 'TWSE' else 'TPEx' end as market,
       lpad(s_suppkey::varchar, 5, '0') || case when s_suppkey % 5 = 0 then 'B' else 'A' end as code,
       list_extract(['主動台灣優選', '主動全球科技', '主動中國信託台股', '被動高息', '主動中國信託海外', '主動價值'], (s_suppkey % 6 + 1)::int) as name,
       case when s_suppkey % 7 <> 0 then 'TW' || s_suppkey end as isin,
       cast(date '1995-01-01' + (s_suppkey % 500)::int as varchar) as listing_date
from supplier
""")
cte("cand", """
select date || '|' || etf_code || '|' || source_type as candidate_id,
       case when k % 4 = 1 then cast((date::date + interval 3 month)::date as varchar) else date end as run_date, * exclude (k)
from (
  select * replace (case when k % 8 = 3 and source_type = 'moneydj_primary' then 'moneydj_browser' else source_type end as source_type)
  from (select *, substr(etf_code, 2)::bigint as k from all_rows)
  where not (k % 8 = 3 and source_type = 'moneydj_primary' and coalesce(stock_code::int, 1) % 7 = 0))
""")
cte("prof", """
select candidate_id, run_date, any_value(date) as data_date, any_value(etf_code) as etf_code, any_value(source_type) as source_type,
       count(*) as row_count, count(stock_code) as stock_count, count(*) - count(stock_code) as non_stock_count,
       round(sum(weight_pct), 10) as total_weight, coalesce(count(shares)::double / nullif(count(stock_code), 0), 0.0) as shares_coverage,
       case when any_value(source_type) = '' then 'inconsistent_source_types' when count(*) < 5 then 'fewer_than_5_rows'
            when count(stock_code) < 5 then 'fewer_than_5_taiwan_stock_rows' else 'ok' end as reason
from cand where asset_type <> 'stock' or weight_pct >= 0.01 group by 1, 2
""")
cte("against", """
select p.*, c.source_type as stored, c.stock_count as c_count, c.total_weight as c_weight,
       row(coalesce(a.priority, 10), p.stock_count, p.shares_coverage, p.non_stock_count, p.source_type) as mine,
       row(c.priority, c.stock_count, c.shares_coverage, c.non_stock_count, c.source_type) as theirs
from prof p left join priority a on a.source_type = p.source_type
left join canon c on c.date = p.data_date and c.etf_code = p.etf_code
""")
cte("judged", """
select *, case when reason <> 'ok' then 'invalid_snapshot:' || reason
               when stored is not null and stored <> source_type and mine < theirs then 'existing_higher_priority_source_preserved'
               else 'replace' end as decision,
       reason = 'ok' and stored is not null as existing_found,
       case when reason = 'ok' and stored is not null then round(abs(total_weight - c_weight), 10) end as weight_delta,
       case when reason = 'ok' and stored is not null then stock_count = c_count and round(abs(total_weight - c_weight), 10) < 1.0 end as same
from against
""")
cte("stock_counts", "select date, etf_code, source_type, count(*) as n from holdings group by 1, 2, 3")
cte("means", """
select p.candidate_id, p.run_date,
       (select avg(n) from (select n from stock_counts s where s.etf_code = p.etf_code and s.source_type = p.source_type and s.date < p.data_date
                            order by date desc limit 5)) as mean_rows
from prof p
""")
cte("offer", """
select p.*, m.mean_rows, case when p.source_type like 'moneydj%' then m.mean_rows end as minimum,
       case p.source_type when 'moneydj_primary' then 1 when 'moneydj_browser' then 2 when 'official_fallback' then 3
            when 'official_browser' then 3 else 4 end as ch
from prof p join means m using (candidate_id, run_date) where p.reason = 'ok'
""")
cte("asked", "select distinct run_date, etf_code from prof")
cte("best_agg", """
select * from (select *, row_number() over (partition by run_date, etf_code order by ch, data_date desc) as n from offer where ch <= 2) where n = 1
""")
cte("best_off", """
select * from (select *, row_number() over (partition by run_date, etf_code order by ch, data_date desc) as n from offer where ch >= 3) where n = 1
""")
cte("picked", """
select *, case when rule in ('agg', 'failed', 'stale', 'equal', 'lower') then 'aggregator' when rule = 'none' then 'none' else 'official' end as choice,
       case rule when 'none' then 'all sources failed' when 'failed' then 'low_row_count_official_fallback_failed'
            when 'stale' then 'low_row_count_official_fallback_stale' when 'equal' then 'low_row_count_confirmed_by_fallback'
            when 'lower' then 'low_row_count_official_fallback_lower_row_count' when 'still_low' then 'low_row_count_official_fallback_still_low' end as warning
from (
  select q.run_date, q.etf_code, a.candidate_id as aid, a.source_type as asrc, o.candidate_id as oid, o.source_type as osrc,
         case when a.candidate_id is null and o.candidate_id is not null then 'off' when a.candidate_id is null then 'none'
              when a.data_date < q.run_date and o.data_date = q.run_date then 'renewed'
              when not coalesce(a.stock_count < a.minimum, false) then 'agg'
              when o.candidate_id is null then 'failed'
              when o.data_date < a.data_date then 'stale'
              when o.stock_count = a.stock_count then 'equal'
              when o.stock_count > a.stock_count then case when o.stock_count >= a.minimum then 'more' else 'still_low' end
              else 'lower' end as rule
  from asked q left join best_agg a using (run_date, etf_code) left join best_off o using (run_date, etf_code))
""")
cte("outcome", """
select k.run_date, k.etf_code, k.choice, k.warning, case k.choice when 'aggregator' then aid when 'official' then oid end as candidate_id,
       case k.choice when 'aggregator' then asrc when 'official' then osrc end as chosen_source_type,
       p.data_date, p.stock_count, p.non_stock_count, p.total_weight,
       case when k.choice = 'none' or p.data_date > k.run_date then 'failed' when p.data_date < k.run_date then 'stale' else 'success' end as outcome,
       case when k.choice = 'none' then 'all sources failed' when p.data_date > k.run_date then 'source_date_after_expected_data_date'
            when p.data_date < k.run_date then 'source_date_before_expected_data_date' end as outcome_reason
from picked k left join prof p on p.run_date = k.run_date and p.candidate_id = case k.choice when 'aggregator' then aid when 'official' then oid end
""")
cte("warned", """
select candidate_id, run_date, round(total_weight, 2) as source_total_weight,
       case when source_type like 'moneydj%' and round(total_weight, 2) < 70 then 'total_weight_below_expected_range'
            when source_type like 'moneydj%' and round(total_weight, 2) > 140 then 'total_weight_above_expected_range'
            when source_type like 'official%' and round(total_weight, 2) < 20 then 'total_weight_below_expected_range'
            when source_type like 'official%' and round(total_weight, 2) > 110 then 'total_weight_above_expected_range' end as weight_warning
from prof where reason = 'ok'
""")
cte("landed", """
select date || '|' || etf_code || '|' || source_type as payload_id, *, substr(etf_code, 2)::bigint as k from holdings
""")
