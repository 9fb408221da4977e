"""The same queries in SQL for DuckDB, over the test tables."""

from __future__ import annotations

_VAR = "case event_type when 'click' then 'temp' when 'purchase' then 'soil_temp' when 'signup' then 'rh' when 'view' then 'ppfd' when 'error' then 'solar' end"
_ZONE = "(user_id % 4)::varchar"
RAW = f"""raw as (select {_ZONE} as zone, 'S' || (user_id % 3)::varchar as serial, (user_id % 3 + 1)::int as rep, date_trunc('hour', ts)::timestamp as ts, {_VAR} as base_var, floor(value + 0.5)::double as v, event_id from events)"""
R = f"{RAW}, r as (select zone, ts, base_var as channel, arg_max(v, event_id) as value from raw group by all)"
REP = f"{RAW}, rp as (select zone, ts, base_var || '__rep' || rep as channel, base_var, rep, arg_max(v, event_id) as value from raw group by all)"
G = f"""{R}, spine as (select zone, channel, unnest(generate_series(min(ts), max(ts), interval 1 hour)) as ts from r group by zone, channel),
    g as (select s.zone, s.channel, s.ts, r.value, case when r.ts is null then 'missing_timestamp_inserted' else 'original' end as qc_status from spine s left join r using (zone, channel, ts))"""
SPECS = "specs as (select * from (values ('temp', -40.0, 80.0, 5.0), ('rh', 0.0, 100.0, 30.0), ('soil_temp', -40.0, 60.0, 4.0), ('ppfd', 0.0, 2500.0, null), ('solar', 0.0, 1400.0, null)) t(channel, lo, hi, spike))"
_AS_DAY = "date::timestamp as start, date::timestamp as \"end\""


def _alert(rule, variable, start, end, value, detail, level, source):
    """An alert's columns of ``source``; start and end are expressions of timestamps."""
    key = f"zone || '|{rule}|' || {variable} || '|' || coalesce(strftime({start}, '%Y-%m-%d %H:%M'), '-')"
    return f"select zone, '{rule}' as rule, {level} as level, {variable} as variable, {start} as start, {end} as \"end\", ({value})::double as value, {detail} as detail, {key} as key from {source} where ({level}) is not null"


_TRIES = ", ".join(f"try_strptime(x, '{f}')" for f in ("%Y-%m-%d", "%Y/%m/%d %H:%M", "%m/%d/%Y", "%m/%d/%Y %H:%M", "%d/%m/%Y", "%d.%m.%Y", "%d.%m.%Y %H:%M:%S"))
_NONE = "cast(null as varchar)"
_DATE = "date::timestamp"
_DAY = ", date_trunc('day', ts)::date as date"
_R03 = f"b as (select zone, channel, ts::date as date, count(*) as n from g join specs using (channel) where value < lo or value > hi group by all)"
_R06 = "d as (select zone, channel, ts::date as date, max(value) as hi from g where value is not null and channel in ('ppfd', 'solar') and hour(ts) >= 10 and hour(ts) < 15 group by all)"
_R13 = "h as (select zone, channel, ts::date as date, count(*) filter (value > case when channel = 'temp' then 45 else 40 end) as n, max(value) as hi from g where channel in ('temp', 'soil_temp') group by all having n > 0)"
_A03 = _alert("R03_out_of_range", "channel", _DATE, _DATE, "n", _NONE, "case when n >= 12 then 'CRITICAL' else 'WARN' end", "b")
_A06 = _alert("R06_daytime_dark", "channel", _DATE, _DATE, "hi", _NONE, "case when hi < case when channel = 'solar' then 10.0 else 20.0 end then 'CRITICAL' end", "d")
_A13 = _alert("R13_heat_event", "channel", _DATE, _DATE, "hi", _NONE, "case when n >= 1 then 'CRITICAL' else 'WARN' end", "h")
_OFF = _alert("R09_logger_offline", "'logger'", "last", "now", "round_even(delay, 1)", _NONE, "case when delay >= 720 then 'CRITICAL' when delay >= 120 then 'WARN' end", "o")
_TRANS = _alert("R11_transmittance_drop", "'ppfd'", "s::timestamp", "e::timestamp", "round_even(now / was, 3)", _NONE, "case when was > 0 and now / was < {drop} then 'WARN' end", "tt")
_OFFLINE = "o as (select zone, max(ts) as last, timestamp '2024-01-31 06:00:00' as now, date_diff('microsecond', max(ts), timestamp '2024-01-31 06:00:00') / 60000000.0 as delay from r group by zone)"


def _through(recent, base):
    """Each zone's light inside against outside by days: ``tr`` days, ``tt`` the last days against those before."""
    return f"""tr as (select zone, ts::date as date, median(p / (s * 2.057)) as ratio from (select zone, ts, max(value) filter (channel = 'ppfd') as p, max(value) filter (channel = 'solar') as s from r where hour(ts) >= 10 and hour(ts) < 15 group by all) where p is not null and s > 50 group by all),
        tn as (select *, row_number() over (partition by zone order by date desc) as n from tr), tt as (select zone, median(ratio) filter (n <= {recent}) as now, median(ratio) filter (n > {recent} and n <= {recent + base}) as was, min(date) filter (n <= {recent}) as s, max(date) as e from tn group by zone having count(*) >= 5)"""


DAILY = """env as (select l_shipdate::date as date, sum(l_quantity) as dli, floor(avg(l_quantity) * 1000 + 0.5) as temp_mean, max(l_quantity) as temp_max, min(l_quantity) as temp_min, least(count(*) / 2.0, 1.0) as completeness, count(*) >= 2 as is_complete from lineitem group by 1)"""
DAILY_T = """env as (select l_returnflag as trt, l_shipdate::date as date, sum(l_quantity) as dli, floor(avg(l_quantity) * 1000 + 0.5) as temp_mean from lineitem group by 1, 2)"""
SEASONS = "se as (select c_nationkey as site, min(o_orderdate::date) as first, max(o_orderdate::date) as last, any_value(c_nationkey % 5 * 7) as step from orders join customer on o_custkey = c_custkey group by c_nationkey)"
SURVEYS = "sv as (select distinct o_orderdate::date as d from orders)"
FIXED = f"{SURVEYS}, iv as (select row_number() over (order by d) as interval_id, d as growth_date, d - 13 as a, d as b, 14::bigint as days_expected from sv)"
AGG = f"""{DAILY}, {FIXED}, ag as (select interval_id, growth_date, days_expected, count(date) as days_used, round_even(count(date) / days_expected, 3) as day_coverage, round_even(avg(completeness), 3) as record_completeness,
    sum(case when not is_complete then 1 else 0 end) filter (date is not null) as n_incomplete_days, case when count(date) > 0 then coalesce(sum(dli), 0.0) end as dli_sum, avg(dli) as dli_mean, avg(temp_mean) as temp_mean, max(temp_max) as temp_max, min(temp_min) as temp_min, avg(temp_max) as temp_max_mean
    from iv left join env on date between a and b group by interval_id, growth_date, days_expected)"""
AGG_T = f"""{DAILY_T}, {FIXED}, ag as (select k.trt, iv.interval_id, iv.growth_date, count(date) as days_used, case when count(date) > 0 then coalesce(sum(dli), 0.0) end as dli_sum, avg(temp_mean) as temp_mean
    from iv cross join (select distinct trt from env) k left join env on env.trt = k.trt and date between a and b group by all)"""
DEFS = "select interval_id, growth_date, (a - {lag})::date as start_date, (b - {lag})::date as end_date, ((b - a) + 1)::bigint as days_expected, {lag}::bigint as lag_days from iv"
GAPS = "gp as (select g as gap, count(*) as n from (select d - lag(d) over (order by d) as g from sv) where g is not null group by 1), cd as (select coalesce((select gap from gp order by n desc, gap limit 1), 0) as days)"
VARIABLE = f"{SURVEYS}, {GAPS}, iv as (select row_number() over (order by d) as interval_id, d as growth_date, coalesce(lag(d) over (order by d) + 1, {{first}}) as a, d as b from sv, cd)"
ISLAND = "select *, sum(case when ok and not coalesce(was, false) then 1 else 0 end) over (partition by zone, channel order by ts) as isl from (select *, lag(ok) over (partition by zone, channel order by ts) as was from m)"
CELLS = f"""c as (select event_id, {_ZONE} as zone, event_type as source, {_VAR} as base_var, case event_id % 8 when 0 then 'ERROR' when 1 then '' when 2 then '#VALUE!' when 3 then ' 12.5 ' when 4 then '-' when 5 then 'inf' when 6 then '1.5d' else user_id::varchar end as raw from events),
    cc as (select *, case when regexp_matches(trim(raw), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') then trim(raw)::double end as value, event_id % 8 in (0, 2, 5, 6) as is_error from c),
    mr as (select zone, source, base_var, count(*) as rows, count(value) as valid, count(*) - count(value) as missing, count(*) filter (is_error) as errors, coalesce(min(value) < max(value), false) as alive from cc group by all)"""
PAIRS = "p as (select zone, ts, max(value) filter (channel = 'ppfd') as ref, max(value) filter (channel = 'temp') as test from r where channel in ('ppfd', 'temp') {hours} group by all having ref is not null and test is not null)"
LOG = """lg as (select (date '2025-01-01' + (c_custkey % 400)::int)::date as date, c_nationkey::varchar as logger_id, 's' || (c_custkey % 2)::varchar as sensor_id, case c_custkey % 3 when 0 then 'temp' when 1 then 'ppfd' else 'other' end as variable,
    case when c_custkey % 2 = 0 then 'cross_check' else 'calibration' end as check_type, floor(c_acctbal + 0.5) - 5000.0 as deviation, c_custkey from customer)"""
LOADS = f"""{RAW}, ld as (select zone, ts, base_var as channel, serial, case when event_id % 2 = 1 then 0 else 1 end as load_ord, arg_max(v, event_id) as x from raw group by all), l as (select * exclude (x), case when x % 5 <> 0 then x end as value from ld)"""
WIDE = f"{R}, w as (select zone, ts, max(value) filter (channel = 'temp') as temp, max(value) filter (channel = 'rh') as rh, max(value) filter (channel = 'soil_temp') as soil_temp, max(value) filter (channel = 'ppfd') as ppfd, max(value) filter (channel = 'solar') as solar from r group by all)"
_MAP = "m(zone, trt, base_var, channel) as (values ('0', 'control', 'temp', 'temp'), ('0', 'control', 'rh', 'rh'), ('0', 'lit', 'temp', 'soil_temp'), ('0', 'lit', 'ppfd', 'ppfd'), ('0', 'lit', 'rh', 'rh'), ('1', 'control', 'ppfd', 'ppfd'), ('1', 'control', 'co2', 'co2'))"
_ALIVE = "st as (select zone, base_var, channel, rep, coalesce(min(value) < max(value), false) as alive from rp group by all having count(value) > 0)"


def _corr(a, b):
    return f"select '{a}' as a, '{b}' as b, count(*) as n, round(corr({a}, {b}), 8) as r from w where {a} is not null and {b} is not null"


SQL: dict[str, str] = {
    "readings_hourly": f"with {R} select zone, ts, channel, value from r",
    "readings_keep_first": f"with {RAW} select zone, ts, base_var, min(event_id) as event_id, arg_min(v, event_id) as v from raw group by zone, ts, base_var",
    "interval_mode": f"""with t as (select distinct {_ZONE} as zone, date_trunc('minute', ts)::timestamp as ts from events), d as (select zone, epoch_us(ts) - lag(epoch_us(ts)) over (partition by zone order by ts) as us from t),
        c as (select zone, us, count(*) as n from d where us > 0 group by all), k as (select *, row_number() over (partition by zone order by n desc, us) as rn from c) select zone, us / 60000000.0 as interval_minutes from k where rn = 1""",
    "snap_half_even": """with s as (select event_id, epoch_us(ts) as us, epoch_us(ts) // 600000000 as slot from events)
        select event_id, make_timestamp((slot + case when 2 * (us - slot * 600000000) > 600000000 or (2 * (us - slot * 600000000) = 600000000 and slot % 2 <> 0) then 1 else 0 end) * 600000000) as slot from s""",
    "grid_spine": f"with {G} select zone, channel, ts, value, qc_status from g",
    "gap_runs": f"with {G}, m as (select *, qc_status <> 'original' as ok from g), i as ({ISLAND}) select zone, channel, min(ts) as start, max(ts) as \"end\", count(*) as missing, count(*) * 60.0::double as minutes from i where ok group by zone, channel, isl",
    "gaps_between": f"""with {R}, d as (select zone, channel, lag(ts) over (partition by zone, channel order by ts) as start, ts as "end" from r)
        select zone, channel, start, "end", date_diff('hour', start, "end") - 1 as missing, ((date_diff('hour', start, "end") - 1) * 60.0)::double as minutes from d where start is not null and date_diff('hour', start, "end") > 1""",
    "lookback_window": f"with {R}, e as (select zone, max(ts) - interval 7 day as edge from r group by zone) select zone, count(*) filter (ts >= edge) as closed, count(*) filter (ts > edge) as half_open from r join e using (zone) group by zone",
    "pivot_wide": f"with {WIDE} select zone, ts, temp, rh, soil_temp, ppfd, solar from w",
    "unpivot_wide": "select l_orderkey, l_linenumber, channel, value from (select l_orderkey, l_linenumber, l_quantity, l_discount, l_tax from lineitem) unpivot include nulls (value for channel in (l_quantity, l_discount, l_tax))",
    "numeric_coercion": f"with {CELLS} select event_id, value, is_error from cc",
    "mapping_report": f"with {CELLS} select zone, source, base_var as channel, rows, valid, missing, errors, case when valid = 0 then 'empty port' when not alive then 'dead port' else 'in use' end as adopted from mr",
    "normalize_key": "select p_partkey, regexp_replace(lower(p_name || ' / ' || '배지 온도' || ' / ' || p_brand), '[^0-9a-z가-힣]+', '', 'g') as key from part",
    "serial_extract": """with t as (select c_custkey, case c_custkey % 4 when 0 then 'Plot Title : A-' || c_custkey when 1 then 'x LGR S/N: ' || c_custkey when 2 then 'Serial Number: ' || c_custkey else c_name end as t from customer)
        select c_custkey, case c_custkey % 4 when 0 then 'A-' || c_custkey when 1 then c_custkey::varchar when 2 then c_custkey::varchar end as serial from t""",
    "representative_channel": f"with {REP}, {_ALIVE}, ch as (select *, row_number() over (partition by zone, base_var order by case when alive then 0 else 1 end, rep) as rn from st) select rp.zone, ts, rp.base_var, rp.channel, value from rp join ch on rp.zone = ch.zone and rp.channel = ch.channel and rn = 1",
    "replicate_mean": f"with {REP}, {_ALIVE}, k as (select *, max(alive::int) over (partition by zone, base_var) as any_alive, row_number() over (partition by zone, base_var order by rep) as rn from st) select rp.zone, ts, rp.base_var, avg(value) as value, count(value) as sensors from rp join k on rp.zone = k.zone and rp.channel = k.channel and (alive or (any_alive = 0 and rn = 1)) group by all",
    "range_mask": f"with {R}, {SPECS} select zone, ts, channel, case when value < lo or value > hi then null else value end as value from r left join specs using (channel)",
    "range_report": f"with {R}, {SPECS}, c as (select zone, channel, count(*) filter (value < lo or value > hi) as masked, count(*) as n from r left join specs using (channel) group by all) select zone, channel, masked, round_even(masked / n, 5) as ratio from c where masked > 0",
    "vpd_daily": f"with {WIDE} select zone, ts::date as date, round(avg(0.6108 * exp(17.27 * temp / (temp + 237.3)) * (1.0 - rh / 100.0)), 6) as vpd_mean from w where temp is not null and rh is not null group by all",
    "daily_summary": f"with {R} select zone, channel, ts::date as date, count(value) as n, avg(value) as mean, min(value) as min, max(value) as max, round_even(1 - count(value) / 24, 4) as missing_ratio from r group by zone, channel, date",
    "daily_vpd": f"with {WIDE}, v as (select zone, ts, 0.6108 * exp(17.27 * temp / (temp + 237.3)) * (1.0 - rh / 100.0) as v from w) select zone, ts::date as date, round(avg(v), 6) as vpd_mean, round(avg(v) filter (hour(ts) >= 9 and hour(ts) < 15), 6) as vpd_day from v group by zone, date",
    "growth_xlsx": "select o_orderdate::date as date, substr(o_orderstatus, 1, 1) as trt, o_orderkey as plant, floor(o_totalprice + 0.5) as fresh_wt, case when o_orderkey % 3 <> 0 then 'dry' end as note from orders",
    "daily_wide": f"""with {WIDE}, d as (select zone, ts::date as date, count(*) as n, avg(temp) as tm, min(temp) as tn, max(temp) as tx, avg(rh) as rh_mean, max(soil_temp) as sx, sum(ppfd) as ps, count(*) filter (ppfd > 10) as lit, avg(ppfd) filter (ppfd > 10) as pm, max(ppfd) as px, sum(solar) as ss, max(solar) as sox, count(temp) as nt from w group by all)
        select zone, date, n as n_records, round_even(n / 24, 4) as completeness, round_even(n / 24, 4) >= 0.9 as is_complete, tm as temp_mean, tn as temp_min, tx as temp_max, tx - tn as temp_amp, case when tm is null then 0.0 else greatest(tm - 10.0, 0.0) end as gdd, rh_mean, sx as soil_temp_max,
        coalesce(ps * 3600 / 1000000.0::double, 0.0) as dli, round_even(case when px is null then null else lit end * 60.0::double / 60, 2) as photoperiod_h, coalesce(pm, 0.0) as ppfd_day_mean, px as ppfd_max, coalesce(ss * 3600 / 1000000.0::double, 0.0) as solar_mj, sox as solar_max, round_even(1 - nt / 24, 4) as temp_missing_ratio from d""",
    "daily_light": f"with {R} select zone, ts::date as date, coalesce(sum(value), 0.0) * 3600.0::double / 1000000.0::double as dli, round_even(count(*) filter (value > 10) * 60.0::double / 60, 2) as photoperiod_h, coalesce(avg(value) filter (value > 10), 0.0) as light_day_mean, max(value) as light_max from r where channel = 'ppfd' group by zone, date",
    "daily_gdd": f"with {R} select zone, ts::date as date, avg(value) as mean, max(value) - min(value) as amp, greatest(avg(value) - 10.0, 0.0) as gdd from r where channel = 'temp' group by zone, date",
    "daily_missing_ratio": f"with {R} select zone, ts::date as date, channel, round_even(1 - count(value) / 24, 4) as missing_ratio from r group by zone, date, channel",
    "daily_completeness": f"with {R}, t as (select distinct zone, ts from r where value is not null) select zone, ts::date as date, count(*) as n_records, round_even(count(*) / 24, 4) as completeness, round_even(count(*) / 24, 4) >= 0.9 as is_complete from t group by zone, date",
    "daily_by_treatment": f"with {R} select case when zone::int % 2 = 0 then 'even' else 'odd' end as trt, channel, ts::date as date, count(value) as n, avg(value) as mean, min(value) as min, max(value) as max from r group by trt, channel, date",
    "survey_dates_count": f"with {SEASONS} select site, (first + (i * step)::int)::date as survey from se, range(100) t(i) where step > 0 and i <= site",
    "survey_dates_end": f"with {SEASONS} select site, (first + (i * step)::int)::date as survey from se, range(10000) t(i) where step > 0 and first + (i * step)::int <= last",
    "survey_dates_list": "select distinct o_orderpriority as site, o_orderdate::date as survey from orders",
    "cadence": f"with {SURVEYS}, {GAPS} select days::bigint as days from cd",
    "interval_defs_variable": f"with {VARIABLE.format(first="date '1995-03-01'")} {DEFS.format(lag=0)}",
    "interval_defs_lag": f"with {VARIABLE.format(first='d - (case when days > 0 then days else 7 end)::int + 1')} {DEFS.format(lag=3)}",
    "interval_defs_fixed": f"with {FIXED} {DEFS.format(lag=0)}",
    "interval_agg": f"with {AGG} select interval_id, growth_date, days_used, day_coverage, record_completeness, n_incomplete_days::bigint as n_incomplete_days, dli_sum, dli_mean, temp_mean, temp_max, temp_min, temp_max_mean from ag",
    "interval_agg_treatment": f"with {AGG_T} select trt, interval_id, days_used, dli_sum, temp_mean from ag",
    "interval_running_totals": f"with {AGG_T} select trt, interval_id, dli_sum, sum(coalesce(dli_sum, 0.0)) over (partition by trt order by interval_id) as cum_dli from ag",
    "interval_quality_flag": f"""with {AGG} select interval_id, days_used, case when days_used = 0 then 'no data' else coalesce(nullif(concat_ws('; ', case when day_coverage < 0.9 then 'day shortage(' || days_used || '/' || days_expected || ')' end, case when record_completeness < 0.9 then 'record shortage' end), ''), 'normal') end as quality from ag""",
    "growth_join": f"with {AGG} select o_orderkey, o_orderdate::date as date, floor(o_totalprice + 0.5) as weight, interval_id, dli_sum, temp_mean from orders left join ag on o_orderdate::date = growth_date",
    "growth_join_treatment": f"with {AGG_T} select o_orderkey, o_orderdate::date as date, o_orderstatus[1:1] as trt, interval_id, dli_sum from orders left join ag on o_orderdate::date = growth_date and o_orderstatus[1:1] = translate(ag.trt, 'ARN', 'FOP')",
    "growth_rate": """with g as (select o_orderstatus[1:1] as trt, o_orderdate::date as date, max(floor(o_totalprice + 0.5)) as w from orders group by all), d as (select trt, date, w - lag(w) over (partition by trt order by date) as x from g) select trt, date, x as weight_delta, x / 7 as weight_rate from d""",
    "r01_gaps": f"with {G}, t as (select zone, 'x' as channel, ts, bool_and(qc_status <> 'original') as ok from g group by all), m as (select * from t), i as ({ISLAND}), s as (select zone, min(ts) as a, max(ts) as b, count(*) as n from i where ok group by zone, isl) " + _alert("R01_timestamp_gap", "'timestamp'", "a", "b", "n", _NONE, "case when n * 60 >= 360 then 'CRITICAL' when n * 60 >= 60 then 'WARN' else 'INFO' end", "s"),
    "r01_gaps_no_grid": f"with {R}, s as (select zone, lag(ts) over (partition by zone order by ts) as a, ts as b from r where channel = 'temp'), s2 as (select *, date_diff('hour', a, b) - 1 as n from s where a is not null and date_diff('hour', a, b) > 1) " + _alert("R01_timestamp_gap", "'timestamp'", "a", "b", "n", _NONE, "case when n * 60 >= 360 then 'CRITICAL' when n * 60 >= 60 then 'WARN' else 'INFO' end", "s2"),
    "r02_missing": f"""with {G}, sl as (select zone, ts::date as date, count(distinct ts) as slots from g group by all), ed as (select zone, min(date) as a, max(date) as b from sl group by zone), dy as (select zone, date from sl join ed using (zone) where slots >= 24 * 0.99 or (date > a and date < b)),
        sn as (select zone, channel, ts::date as date, count(value) as n from g group by all), lf as (select zone, channel, min(date) as f, max(date) as l from sn where n > 0 group by all),
        ev as (select lf.zone, lf.channel, dy.date, coalesce(sn.n, 0) as n, 1 - coalesce(sn.n, 0) / 24 as ratio from lf join dy on lf.zone = dy.zone and dy.date between f and l left join sn on sn.zone = lf.zone and sn.channel = lf.channel and sn.date = dy.date) """
    + _alert("R02_missing_ratio", "channel", _DATE, _DATE, "round_even(ratio, 4)", _NONE, "case when ratio >= 0.5 then 'CRITICAL' when ratio >= 0.1 then 'WARN' end", "ev"),
    "r03_out_of_range": f"with {G}, {SPECS}, {_R03} {_A03}",
    "r04_flatline": f"""with {G}, p as (select *, lag(value) over (partition by zone, channel order by ts) as bv, lag(ts) over (partition by zone, channel order by ts) as bt from g),
        m as (select *, coalesce(value = bv and (channel not in ('ppfd', 'solar') or value > 10), false) as ok from p), i as ({ISLAND}), s as (select zone, channel, min(bt) as a, max(ts) as b, count(*) + 1 as n, min(value) as v from i where ok group by zone, channel, isl having count(*) + 1 >= 2) """
    + _alert("R04_flatline", "channel", "a", "b", "v", "channel", "case when n >= 12 then 'CRITICAL' else 'WARN' end", "s"),
    "r05_spike": f"with {G}, {SPECS}, d as (select zone, channel, ts::date as date, abs(value - lag(value) over (partition by zone, channel order by ts)) as x, spike from g join specs using (channel) where spike is not null), s as (select zone, channel, date, count(*) as n from d where x > spike * 6 group by all) " + _alert("R05_spike", "channel", _DATE, _DATE, "n", _NONE, "case when n >= 2 then 'WARN' end", "s"),
    "r06_daytime_dark": f"with {G}, {_R06} {_A06}",
    "r07_night_light": f"with {G}, d as (select zone, channel, ts::date as date, max(value) as hi from g where value is not null and channel = 'ppfd' and (hour(ts) >= 23 or hour(ts) < 3) group by all) " + _alert("R07_night_light", "channel", _DATE, _DATE, "hi", _NONE, "case when hi > 5 then 'WARN' end", "d"),
    "r08_rh_saturated": f"with {G}, m as (select *, coalesce(value >= 30, false) as ok from g where channel = 'rh'), i as ({ISLAND}), s as (select zone, channel, min(ts) as a, max(ts) as b, count(*) as n from i where ok group by zone, channel, isl) " + _alert("R08_rh_saturated", "channel", "a", "b", "n", _NONE, "case when n >= 2 then 'WARN' end", "s"),
    "r09_offline": f"with {R}, {_OFFLINE} {_OFF}",
    "r10_pair_divergence": f"""with {REP}, lim(base_var, most) as (values ('temp', 1.0), ('soil_temp', 1.0), ('rh', 5.0), ('ppfd', 0.15)), b as (select o.zone, o.base_var, f.channel as first, o.channel as channel, most, o.ts, f.value as x, o.value as y from rp o join rp f on o.zone = f.zone and o.base_var = f.base_var and o.ts = f.ts and f.rep = 1 join lim on lim.base_var = o.base_var where o.rep > 1),
        s as (select zone, base_var, first, channel, most, count(*) as n, median(case when base_var = 'ppfd' then case when x > 50 then abs(y - x) / x end else abs(y - x) end) as metric, min(ts) as a, max(ts) as b from b group by all) """
    + _alert("R10_pair_divergence", "base_var", "a", "b", "round_even(metric, 4)", "first || ' vs ' || channel", "case when n >= 6 and metric > most then 'WARN' end", "s"),
    "r11_transmittance": f"with {R}, {_through(3, 7)} {_TRANS.format(drop=1.5)}",
    "r12_errors": f"with {CELLS} " + _alert("R12_error_value", "base_var", "null::timestamp", "null::timestamp", "errors", "source", "case when errors = 0 then null when errors / rows > 0.3 then 'CRITICAL' when errors / rows > 0.001 then 'WARN' else 'INFO' end", "mr"),
    "r13_heat": f"with {G}, {_R13} {_A13}",
    "transmittance_ratio": f"with {R} select zone, ts::date as date, median(p / (s * 2.057)) as ratio from (select zone, ts, max(value) filter (channel = 'ppfd') as p, max(value) filter (channel = 'solar') as s from r where hour(ts) >= 10 and hour(ts) < 15 group by all) where p is not null and s > 50 group by all",
    "health_table": f"""with {R}, {SPECS}, e as (select zone, max(ts) - interval 7 day as edge from r group by zone), s as (select zone, channel, count(value) as valid, count(*) filter (value < lo or value > hi) as oor, arg_max(value, ts) as lv, max(ts) as ls, avg(value) as m, min(value) as mn, max(value) as mx from r join e using (zone) left join specs using (channel) where ts > edge group by all),
        k as (select distinct zone, channel from r where value is not null), j as (select zone, channel, coalesce(valid, 0) as valid, coalesce(oor, 0) as oor, lv, ls, m, mn, mx from k left join s using (zone, channel))
        select zone, channel, round_even(valid / 168, 3) as received, round_even(1 - valid / 168, 3) as missing, oor as out_of_range, lv as last_value, m as mean, mn as min, mx as max, ls as last_seen, case when valid / 168 >= 0.9 and oor = 0 then 'normal' when valid / 168 >= 0.5 then 'caution' else 'danger' end as status from j""",
    "pair_compare": f"with {R}, {PAIRS.format(hours='')} select zone, count(*) as n, avg(ref) as ref_mean, avg(test) as test_mean, avg(test - ref) as bias, avg(abs(test - ref)) as mae, round(sqrt(avg((test - ref) * (test - ref))), 8) as rmse, round(corr(test, ref), 8) as r, round(regr_slope(test, ref), 8) as slope, round(regr_intercept(test, ref), 8) as intercept, min(ts) as start, max(ts) as \"end\" from p group by zone having count(*) >= 6",
    "daily_pair": f"with {R}, {PAIRS.format(hours='and hour(ts) >= 9 and hour(ts) < 16')} select zone, ts::date as date, count(*) as n, avg(ref) as ref_mean, avg(test) as test_mean, avg(test - ref) as bias, avg(abs(test - ref)) as mae, max(abs(test - ref)) as max_abs_diff from p group by zone, date",
    "judge_tolerance": f"with {LOG}, t(variable, tol) as (values ('temp', 2500.0::double), ('ppfd', 0.5::double)), j as (select c_custkey, deviation, deviation / 5000.0 as rel_deviation, tol, case when lg.variable = 'ppfd' then abs(deviation / 5000.0) else abs(deviation) end as size from lg left join t using (variable)) select c_custkey, deviation, rel_deviation, case when size <= tol then 'pass' when size > tol then 'fail' end as result from j",
    "due_status": f"""with {LOG}, sc(check_type, period) as (values ('cross_check', 30), ('calibration', 365)), la as (select logger_id, sensor_id, variable, check_type, max(date) as last_date from lg group by all),
        j as (select s.*, sc.check_type, sc.period, la.last_date, (la.last_date + sc.period)::date as next_date, (date '2026-01-15' - (la.last_date + sc.period)::date)::int as overdue_days from (select distinct logger_id, sensor_id, variable from lg) s cross join sc left join la on la.logger_id = s.logger_id and la.sensor_id = s.sensor_id and la.variable = s.variable and la.check_type = sc.check_type)
        select *, case when last_date is null then 'never' when overdue_days > 0 then 'late' when overdue_days > -3 then 'imminent' else 'ok' end as status from j""",
    "drift_trend": f"""with {LOG}, x as (select *, (date - min(date) over (partition by logger_id, sensor_id, variable))::double as x from lg), s as (select logger_id, sensor_id, variable, count(*) as n, count(*) * sum(x * deviation) - sum(x) * sum(deviation) as xy, count(*) * sum(x * x) - sum(x) * sum(x) as xx, arg_max(deviation, struct_pack(d := date, e := deviation)) as last_deviation, min(date) as first_date, max(date) as last_date from x group by all having count(*) >= 3)
        select logger_id, sensor_id, variable, n, round_even(case when xx > 0 then xy / xx end, 6) as slope_per_day, round_even(case when xx > 0 then xy / xx end * 365, 4) as slope_per_year, last_deviation, first_date, last_date from s""",
    "drift_history": f"""with {LOG}, t(variable, tol) as (values ('temp', 2500.0::double), ('ppfd', 0.5::double)), x as (select lg.*, case when (case when lg.variable = 'ppfd' then abs(deviation / 5000.0) else abs(deviation) end) <= tol then 'pass' when tol is not null then 'fail' end as result from lg left join t using (variable)),
        h as (select logger_id, sensor_id, variable, date, check_type, deviation, result, count(*) over k as n, row_number() over o as number, deviation - lag(deviation) over o as change from x window k as (partition by logger_id, sensor_id, variable), o as (partition by logger_id, sensor_id, variable order by date, check_type, deviation, result nulls first))
        select * exclude (n) from h where n >= 3""",
    "cross_check": f"""with {R}, v(variable, test, tol) as (values ('temp', 'temp', 8.0::double), ('solar', 'solar', 0.5::double), ('rh', 'rh', null)),
        p as (select a.zone, a.ts::date as day, v.variable, v.tol, a.value as ref, b.value as test from r a join r b on a.zone = b.zone and a.ts = b.ts and a.channel = 'ppfd' join v on b.channel = v.test),
        g as (select zone, day, variable, any_value(tol) as tol, count(*) as n, avg(ref) as ref_mean, avg(test) as test_mean, avg(test - ref) as bias, avg(abs(test - ref)) as mae, sqrt(avg((test - ref) * (test - ref))) as rmse, corr(test, ref) as r, regr_slope(test, ref) as slope, regr_intercept(test, ref) as intercept,
          case when variable = 'solar' then avg(test - ref) / nullif(avg(abs(ref)), 0) end as rel_bias from p group by zone, day, variable)
        select zone, day, variable, n, {", ".join(f"case when n >= 6 and not isnan({c}) then round({c}, 8) end as {c}" for c in ("ref_mean", "test_mean", "bias", "mae", "rmse", "r", "slope", "intercept", "rel_bias"))}, tol as tolerance,
          case when n < 6 then 'too_few' when coalesce(rel_bias, bias) is null or tol is null then 'unknown' when abs(coalesce(rel_bias, bias)) <= tol then 'pass' else 'fail' end as result from g""",
    "zone_upsert": f"""with {LOADS}, k as (select *, row_number() over (partition by zone, ts, channel order by case when value is null then 1 else 0 end, load_ord, serial) as rn, min(serial) over (partition by zone, ts, channel) as any_serial from l) select zone, ts, channel, case when value is null then any_serial else serial end as serial, value from k where rn = 1""",
    "archive_increment": f"""with {LOADS}, k as (select zone, channel, serial, max(load_ord) as o from l group by all), n as (select *, row_number() over (partition by zone, channel order by o desc, serial) as rn from k)
        select l.zone, l.ts, case when rn = 1 then l.channel else l.channel || '__rep' || rn end as channel, case when rn = 1 then 0 else rn end::int as rep, l.serial, coalesce(max(value) filter (load_ord = 0), max(value) filter (load_ord = 1)) as value from l join n using (zone, channel, serial) group by all""",
    "serial_concat": f"with {LOADS} select zone, ts, string_agg(distinct serial, '+' order by serial) as serial from l group by zone, ts",
    "collision_rename": f"""with {LOADS}, k as (select zone, channel, serial, min(load_ord) as o from l group by all), n as (select *, row_number() over (partition by zone, channel order by o, serial) as rn from k), m as (select *, 1 + row_number() over (partition by zone, channel order by o, serial) as k2 from n where rn > 1)
        select l.zone, l.serial, coalesce(m.channel || '__rep' || k2, l.channel) as channel, coalesce(k2, 0)::int as rep, count(*) as n from l left join m on l.zone = m.zone and l.serial = m.serial and l.channel = m.channel group by all""",
    "zone_lookup": f"with {LOADS} select serial, case when serial = 'S0' then 'North' else serial end as zone, count(*) as n from l group by all",
    "archive_summary": f"""with {R}, t as (select distinct zone, ts from r), e as (select zone, min(ts) as start, max(ts) as "end", count(*) as rows from t group by zone), v as (select zone, string_agg(distinct channel, ',' order by channel) as variables from r where value is not null group by zone)
        select zone, start, "end", date_diff('microsecond', start, "end") // 86400000000 + 1 as span_days, rows, 60.0::double as interval_minutes, date_diff('hour', start, "end") + 1 as grid_rows, date_diff('hour', start, "end") + 1 - rows as missing, round_even((date_diff('hour', start, "end") + 1 - rows) / (date_diff('hour', start, "end") + 1), 4) as missing_ratio, variables from e left join v using (zone)""",
    "daily_record_count": f"with {R} select zone, ts::date as date, count(*) as records from r group by zone, date",
    "treatment_split": f"with {R}, {_MAP} select zone, trt, base_var, channel, ts, value from r join m using (zone, channel)",
    "treatment_coverage": f"with {R}, {_MAP}, s as (select distinct zone, channel from r where zone in (select zone from m)), n as (select distinct zone, channel from m) select zone as logger, channel, 'mapped, not found' as state from n anti join s using (zone, channel) union all select zone as logger, channel, 'found, not mapped' as state from s anti join n using (zone, channel)",
    "logger_lookup": """with k as (select distinct (c_custkey * 7 + 100)::varchar as key from customer), m as (select (p_partkey * 13)::varchar as logger, p_partkey as place from part where p_size > 5)
        select key, arg_min(logger, case when key = logger then -1 else place end) filter (contains(key, logger) or contains(logger, key)) as logger from k left join m on contains(key, logger) or contains(logger, key) group by key""",
    "upload_dedup": "select sha256(text)[1:16] as fingerprint, min(doc_id) as doc_id, count(*) as copies from documents group by 1",
    "corr_matrix": f"with {WIDE} " + " union all ".join(_corr(a, b) for a, b in (("temp", "rh"), ("temp", "ppfd"), ("temp", "solar"), ("rh", "ppfd"), ("rh", "solar"), ("ppfd", "solar"))),
    "ols": f"""with {WIDE}, d as (select * from w where temp is not null and ppfd is not null and solar is not null), s as (select count(*) as n, avg(temp) as my, avg(ppfd) as ma, avg(solar) as mb, covar_pop(ppfd, ppfd) as aa, covar_pop(solar, solar) as bb, covar_pop(ppfd, solar) as ab, covar_pop(ppfd, temp) as ay, covar_pop(solar, temp) as by_ from d)
        select n, round(my - (ay * bb - by_ * ab) / (aa * bb - ab * ab) * ma - (by_ * aa - ay * ab) / (aa * bb - ab * ab) * mb, 6) as intercept, round((ay * bb - by_ * ab) / (aa * bb - ab * ab), 6) as b1, round((by_ * aa - ay * ab) / (aa * bb - ab * ab), 6) as b2 from s""",
}

#: The rules that the union runs; transmittance with the drop and days that are the defaults.
_RULES = ["r01_gaps", "r02_missing", "r03_out_of_range", "r04_flatline", "r05_spike", "r06_daytime_dark", "r07_night_light", "r08_rh_saturated", "r09_offline", "r10_pair_divergence", "r12_errors", "r13_heat"]
_ALL = " union all ".join(f"select * from ({q})" for q in [*(SQL[n] for n in _RULES), f"with {R}, {_through(3, 30)} {_TRANS.format(drop=0.7)}"])
SQL |= {
    "rule_union_sorted": f"with a as ({_ALL}) select zone, rule, level, variable, start, value, key from a",
    "alert_summary": f"with a as ({_ALL}) select level, rule, count(*) as alerts, count(distinct variable) as variables, coalesce(string_agg(distinct variable, ', ' order by variable), '') as variable_names from a group by level, rule",
    "alerts_by_zone": f"with a as ({_ALL}) select zone, count(*) as alerts, max(case level when 'CRITICAL' then 3 when 'WARN' then 2 else 1 end)::int as worst from a group by zone",
    "alerts_cooldown": f"with a as ({_ALL}) select key, level from a where level = 'CRITICAL' and zone <> '0'",
    "stream_cooldown": f"""with recursive a as (select {_ZONE} as zone, 'S' || (user_id % 3)::varchar as serial, {_VAR} as channel, ts::timestamp as t from events where floor(value + 0.5) > 100),
        s as (select zone, serial, channel, min(t) as t from a group by all union all select * from (select s.zone, s.serial, s.channel, min(a.t) as t from s join a on a.zone = s.zone and a.serial = s.serial and a.channel = s.channel and a.t >= s.t + interval 12 hour group by all))
        select zone, serial, channel, t as detected_at from s""",
    "stream_offline": f"""with e as (select {_ZONE} as zone, 'S' || (user_id % 3)::varchar as serial, ts::timestamp as t from events), p as (select *, lag(t) over w as was, lead(t) over w as following from e window w as (partition by zone, serial order by t)),
        r as (select *, count(*) filter (was is null or t - was >= interval 120 minute) over (partition by zone, serial order by t) as run from p),
        x as (select zone, serial, min(t) as first_seen, max(t) as last_seen, count(*) as records, arg_max(following, t) as following from r group by zone, serial, run)
        select zone, serial, first_seen, last_seen, records, last_seen + interval 120 minute as lost_at from x where last_seen + interval 120 minute <= (select max(t) from e)""",
    "stream_daily": f"with {RAW} select zone, base_var as channel, ts::date as date, count(v) as n, avg(v) as mean, min(v) as min, max(v) as max from raw group by all",
    "ingest_xlsx": f"with {R} select 'z6-0000' || zone as serial, case when channel in ('temp', 'rh') then '' else 'METER ZL6' end as model, ts, channel, value from r",
    "time_format_vote": f"""with d as (select o_orderkey, 'f' || (o_custkey % 7) as file, o_custkey % 7 as k, o_orderdate::timestamp as d from orders),
        t as (select o_orderkey, file, case when o_orderkey % 50 = 7 then 'broken' when k = 0 then strftime(d, '%d/%m/%Y') when k = 1 then strftime(d, '%m/%d/%Y %H:%M') when k = 2 then strftime(d, '%Y-%m-%d') when k = 3 then strftime(d, '%d.%m.%Y %H:%M:%S')
                     when k = 4 then strftime(d, '%Y/%m/%d %H:%M') when k = 5 then case when day(d) <= 12 then strftime(d, '%d/%m/%Y') end else strftime(d, '%d.%m.%Y') end as x from d),
        p as (select o_orderkey, file, unnest([{_TRIES}]) as ts, unnest(range(7)) as place from t),
        v as (select file, place, count(ts) as n from p group by all), b as (select file, arg_max(place, n * 100 - place) as place from v group by file having max(n) > 0)
        select p.o_orderkey, p.file, p.ts from p join b using (file, place)""",
    "store_rebuild": f"with {R} select case when zone = '3' then 'L-1003' else 'house ' || zone end as zone, 'L-100' || zone as serial, ts, channel, value from r",
    "alert_state": f"with a as ({SQL['r03_out_of_range']}) select key, case when start < timestamp '2024-01-16' then timestamp '2024-02-01 00:00:00' else timestamp '2024-02-01 06:00:00' end as last_sent, level, rule from a where level in ('WARN', 'CRITICAL')",
    "ingest_csv": f"with {R} select 'L-100' || zone as serial, ts, channel, value from r",
    "ingest_source": f"with {R} select 'L-100' || zone as serial, ts, channel, value from r",
}
