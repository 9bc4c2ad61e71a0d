"""DuckDB SQL with the result of each registered query."""

from __future__ import annotations

from catalog import fixtures as X

ORACLES: dict[str, str] = {}


def _with(**parts: str) -> str:
    return "with " + ",\n".join(f"{n} as ({sql})" for n, sql in parts.items()) + "\n"


FX, FX_DENSE, RAW, RANGES = (X.for_duckdb(s) for s in (X.FX, X.FX_DENSE, X.RAW, X.IP_RANGES))

# ------------------------------------------------------------- new visitors

# type, first and last millisecond bound, year, season, month, week, day, calendar
PERIODS = {
    X.RUN_DATE: """
      ('day', 1704844800000, 1704931200000, 2024, 1, 1, 2, 10, date '2024-01-10'),
      ('week', 1704585600000, 1705190400000, 2024, 1, 1, 2, 0, date '2024-01-07'),
      ('month', 1704067200000, 1706745600000, 2024, 1, 1, 0, 0, date '2024-01-01')""",
    X.LATER_RUN_DATE: """
      ('day', 1705708800000, 1705795200000, 2024, 1, 1, 3, 20, date '2024-01-20'),
      ('week', 1705190400000, 1705795200000, 2024, 1, 1, 3, 0, date '2024-01-14'),
      ('month', 1704067200000, 1706745600000, 2024, 1, 1, 0, 0, date '2024-01-01')""",
}


def _install_parts(run_date) -> dict[str, str]:
    return {
        "fx": FX,
        "periods": f"""select * from (values {PERIODS[run_date]})
          t(type, lo, hi, year, season, month, week, day, calendar)""",
        "launches": """select u_ud, s_time, pl, coalesce(ver, 'unknown') as ver, coalesce(browser, 'unknown') as b,
          case when browser is null then 'unknown' else coalesce(browser_v, 'unknown') end as bv
          from fx where en = 'e_l'""",
        "by_platform": """select u_ud, s_time, b, bv, pl as platform_name, ver as platform_version from launches
          union all select u_ud, s_time, b, bv, pl, 'all' from launches
          union all select u_ud, s_time, b, bv, 'all', 'all' from launches""",
        "by_browser": """select u_ud, s_time, platform_name, platform_version, b as browser_name, bv as browser_version
          from by_platform union all select u_ud, s_time, platform_name, platform_version, b, 'all' from by_platform""",
        "stats": """select year, season, month, week, day, type, calendar, platform_name, platform_version,
          'new_install_user' as kpi_name, '' as browser_name, '' as browser_version,
          count(distinct u_ud) as new_install_users
          from by_platform join periods on s_time >= lo and s_time < hi group by all""",
        "browser_stats": """select year, season, month, week, day, type, calendar, platform_name, platform_version,
          'browser_new_install_user' as kpi_name, browser_name, browser_version,
          count(distinct u_ud) as new_install_users
          from by_browser join periods on s_time >= lo and s_time < hi group by all""",
    }


def _install(run_date, select: str, **more: str) -> str:
    return _with(**_install_parts(run_date), **more) + select


BOTH_KPIS = "select * from stats union all select * from browser_stats"
ORACLES["new_install_users"] = _install(X.RUN_DATE, "select * exclude (browser_name, browser_version) from stats")
ORACLES["browser_new_install_users"] = _install(X.RUN_DATE, "select * from browser_stats")
ORACLES["install_kpis"] = _install(X.RUN_DATE, BOTH_KPIS)
ORACLES["sort_stats"] = _install(X.LATER_RUN_DATE, BOTH_KPIS)
ORACLES["rollup_platform"] = _with(fx=FX, n="select pl, coalesce(ver, 'unknown') as ver from fx") + """
  select platform_name, platform_version, count(*) as events from (
    select pl as platform_name, ver as platform_version from n union all select pl, 'all' from n
    union all select 'all', 'all' from n) group by all"""
ORACLES["rollup_browser"] = _with(fx=FX, n="""select coalesce(browser, 'unknown') as b,
  case when browser is null then 'unknown' else coalesce(browser_v, 'unknown') end as bv from fx""") + """
  select browser_name, browser_version, count(*) as events from (
    select b as browser_name, bv as browser_version from n union all select b, 'all' from n) group by all"""
ORACLES["date_buckets"] = _with(fx=FX) + """
  select buckets, count(*) as launches from (
    select (case when s_time >= 1704844800000 and s_time < 1704931200000 then 1 else 0 end)
      + (case when s_time >= 1704585600000 and s_time < 1705190400000 then 2 else 0 end)
      + (case when s_time >= 1704067200000 and s_time < 1706745600000 then 4 else 0 end) as buckets
    from fx where en = 'e_l') where buckets > 0 group by buckets"""

# ------------------------------------------------------------------- hourly

STAGED = """select pl, ver, en, s_time, u_ud, u_sd, cast(hour(make_timestamp(s_time * 1000)) as int) as hour,
  cast(make_timestamp(s_time * 1000) as date) as date from {source} where en in ('e_pv', 'e_l')"""
LEVELS = """select 0 as level, * from staged union all select 1, * replace ('all' as ver) from staged
  union all select 2, * replace ('all' as pl, 'all' as ver) from staged"""
HOURLY_PARTS = {"fx": FX_DENSE, "staged": STAGED.format(source="fx"), "levels": LEVELS}


def _distinct(kpi: str, event: str, col: str) -> str:
    return f"""select pl, ver, date, hour, '{kpi}' as kpi, count(distinct {col}) as value from levels
      where en = '{event}' group by level, pl, ver, date, hour"""


HOURLY = {
    "new_users": _distinct("new_users", "e_l", "u_ud"),
    "active_users": _distinct("active_users", "e_pv", "u_ud"),
    "sessions": _distinct("sessions", "e_pv", "u_sd"),
    "sessions_lengths": """select pl, ver, date, hour, 'sessions_lengths' as kpi,
      cast(floor(sum(span) / 1000) as bigint) as value from (
        select level, pl, ver, date, hour, u_sd, max(s_time) - min(s_time) as span from levels where en = 'e_pv'
        group by level, pl, ver, date, hour, u_sd) group by level, pl, ver, date, hour""",
}
HOURLY_PARTS["hourly"] = " union all ".join(f"select * from ({q})" for q in HOURLY.values())
ORACLES["stage_hourly"] = _with(fx=FX) + STAGED.format(source="fx")
ORACLES["hourly_active_users"] = _with(**HOURLY_PARTS) + HOURLY["active_users"]
ORACLES["hourly_new_users"] = _with(**HOURLY_PARTS) + HOURLY["new_users"]
ORACLES["hourly_session_count"] = _with(**HOURLY_PARTS) + HOURLY["sessions"]
ORACLES["hourly_session_length"] = _with(**HOURLY_PARTS) + HOURLY["sessions_lengths"]
ORACLES["hourly_kpis"] = _with(**HOURLY_PARTS) + "select * from hourly"
CELLS = ", ".join(f"cast(max(case when hour = {h} then value else 0 end) as bigint) as hour_{h:02d}" for h in range(24))
WIDE = f"select pl, ver, date, kpi, {CELLS} from hourly group by pl, ver, date, kpi"
ORACLES["hourly_kpis_pivot"] = _with(**HOURLY_PARTS) + WIDE
ORACLES["export_hourly_tsv"] = ORACLES["hourly_kpis_pivot"]

# --------------------------------------------------------------- dimensions

DAYS = "select distinct cast(o_orderdate as date) as d from orders"


def _week_number(d: str) -> str:
    return f"cast(least(53, (dayofyear({d}) - 1 + dayofweek(date_trunc('year', {d}))) // 7 + 1) as int)"


def _date_row(grain: str, d: str) -> str:
    """Date dimension columns of date expression `d`."""
    start = {
        "year": f"cast(date_trunc('year', {d}) as date)", "season": f"cast(date_trunc('quarter', {d}) as date)",
        "month": f"cast(date_trunc('month', {d}) as date)", "week": f"({d} - cast(dayofweek({d}) as int))", "day": d,
    }[grain]
    parts = {
        "year": f"cast(year({start}) as int)",
        "season": f"cast(quarter({start}) as int)" if grain != "year" else "0",
        "month": f"cast(month({start}) as int)" if grain in ("month", "week", "day") else "0",
        "week": _week_number(start) if grain in ("week", "day") else "0",
        "day": f"cast(day({start}) as int)" if grain == "day" else "0",
        "type": f"'{grain}'", "calendar": start,
    }
    return ", ".join(f"{v} as {k}" for k, v in parts.items())


for _grain in ("year", "season", "month", "week", "day"):
    ORACLES[f"date_dimension_{_grain}"] = _with(days=DAYS) + f"select distinct {_date_row(_grain, 'd')} from days"
ORACLES["date_parts"] = _with(days=DAYS) + f"""select d, cast(year(d) as int) as year, cast(quarter(d) as int) as season,
  cast(month(d) as int) as month, {_week_number('d')} as week, cast(day(d) as int) as day from days"""
ORACLES["period_bounds"] = _with(days=DAYS, w="select d, d - cast(dayofweek(d) as int) as s, date_trunc('month', d) as m from days") + """
  select d, s as week_start, s + 7 as next_week_start, s - 7 as prev_week_start, cast(m as date) as month_start,
    cast(m + interval 1 month as date) as next_month_start, cast(m - interval 1 month as date) as prev_month_start,
    d + 2 as in_two_days, d - 1 as day_before from w"""
ORACLES["time_text"] = _with(fx=FX, t="select event_id, s_time, make_timestamp(s_time * 1000) as ts from fx") + """
  select event_id, strftime(ts, '%Y-%m-%d') as day_text, strftime(ts, '%Y%m%d') as day_suffix, true as valid,
    s_time - s_time % 86400000 as midnight, cast(ts as date) as date, cast(hour(ts) as int) as hour,
    s_time - s_time % 1000 as second, s_time - s_time % 60000 - 28800000 as shanghai_minute from t"""
ORACLES["event_types"] = _with(fx=FX) + """select id, name, alias, count(en) as events from (values
    (1, 'launch event', 'e_l'), (2, 'page view event', 'e_pv'), (3, 'charge request event', 'e_crt'),
    (4, 'charge success event', 'e_cs'), (5, 'charge refund event', 'e_cr'), (6, 'event duration event', 'e_e'))
    t(id, name, alias) left join fx on alias = en group by id, name, alias"""

PLATFORMS = """select distinct platform_name, platform_version from (
  select pl as platform_name, coalesce(ver, 'unknown') as platform_version from fx
  union all select pl, 'all' from fx union all select 'all', 'all' from fx)"""


def _browsers(source: str) -> str:
    return f"""select distinct browser_name, browser_version from (
      select coalesce(browser, 'unknown') as browser_name,
        case when browser is null then 'unknown' else coalesce(browser_v, 'unknown') end as browser_version from {source}
      union all select coalesce(browser, 'unknown'), 'all' from {source})"""


def _numbered(source: str, keys: list[str], after: str = "0") -> str:
    text = "concat_ws(chr(1), " + ", ".join(f"coalesce(cast({k} as varchar), '')" for k in keys) + ")"
    order = f"substr(md5({text}), 1, 3), " + ", ".join(keys)
    return f"select cast({after} + row_number() over (order by {order}) as int) as id, {', '.join(keys)} from ({source})"


PLATFORM_KEYS, BROWSER_KEYS = ["platform_name", "platform_version"], ["browser_name", "browser_version"]
DATE_KEYS = ["year", "season", "month", "week", "day", "type", "calendar"]
ORACLES["platform_dimension"] = _with(fx=FX) + PLATFORMS
ORACLES["browser_dimension"] = _with(fx=FX) + _browsers("fx")
ORACLES["kpi_dimension"] = _with(**HOURLY_PARTS, **{k: v for k, v in _install_parts(X.RUN_DATE).items() if k != "fx"}).replace(
    "launches as (", f"sparse as ({FX}), launches as (").replace("from fx where en = 'e_l'", "from sparse where en = 'e_l'") + _numbered(
    "select distinct kpi as kpi_name from hourly union select kpi_name from stats union select kpi_name from browser_stats",
    ["kpi_name"])
ORACLES["assign_dim_ids"] = _with(
    fx=FX, launches="select * from fx where en = 'e_l'",
    known=_numbered(f"select * from ({_browsers('launches')}) where browser_version <> 'all'", BROWSER_KEYS),
    fresh=f"select * from ({_browsers('fx')}) anti join known using (browser_name, browser_version)",
) + "select * from known union all " + _numbered(
    "select * from fresh", BROWSER_KEYS, "coalesce((select max(id) from known), 0)"
)

DIM_PARTS = {
    "kpis": BOTH_KPIS,
    "platforms": _numbered("select distinct platform_name, platform_version from kpis", PLATFORM_KEYS),
    "dates": _numbered(f"select distinct {', '.join(DATE_KEYS)} from kpis", DATE_KEYS),
    "browsers": _numbered("select distinct browser_name, browser_version from browser_stats", BROWSER_KEYS),
}
ORACLES["stats_user"] = _install(X.RUN_DATE, """
  select p.id as platform_dimension_id, d.id as date_dimension_id, new_install_users, date '2024-01-10' as created
  from stats join platforms p using (platform_name, platform_version) join dates d using (type, calendar)""", **DIM_PARTS)
ORACLES["stats_device_browser"] = _install(X.RUN_DATE, """
  select p.id as platform_dimension_id, d.id as date_dimension_id, b.id as browser_dimension_id, new_install_users,
    date '2024-01-10' as created
  from browser_stats join platforms p using (platform_name, platform_version) join dates d using (type, calendar)
  join browsers b using (browser_name, browser_version)""", **DIM_PARTS)
HOURLY_IDS = {
    "wide": WIDE + "",
    "named": """select case when pl is null or ver is null then 'unknown' else pl end as platform_name,
      case when pl is null or ver is null then 'unknown' else ver end as platform_version, * from wide""",
    "platforms": _numbered("select distinct platform_name, platform_version from named", PLATFORM_KEYS),
    "dates": _numbered(f"select {_date_row('day', 'd')} from (select distinct date as d from wide)", DATE_KEYS),
    "kpi_ids": _numbered("select distinct kpi as kpi_name from wide", ["kpi_name"]),
}
HOURS = ", ".join(f"hour_{h:02d}" for h in range(24))
ORACLES["stats_hourly"] = _with(**HOURLY_PARTS, **HOURLY_IDS) + f"""
  select p.id as platform_dimension_id, d.id as date_dimension_id, k.id as kpi_dimension_id, {HOURS}
  from named join platforms p using (platform_name, platform_version) join dates d on d.calendar = named.date
  join kpi_ids k on k.kpi_name = named.kpi"""

_old, _new = _install_parts(X.RUN_DATE), _install_parts(X.LATER_RUN_DATE)
BY_NAME = "select platform_name, platform_version, type, calendar, new_install_users from stats"
_UPSERTED = """
  select coalesce(o.platform_name, n.platform_name) as platform_name,
    coalesce(o.platform_version, n.platform_version) as platform_version, coalesce(o.type, n.type) as type,
    coalesce(o.calendar, n.calendar) as calendar, coalesce(n.new_install_users, o.new_install_users) as new_install_users,
    case when o.type is null then date '2024-01-20' else date '2024-01-10' end as created
  from ({old}) o full join ({new}) n
  on o.platform_name = n.platform_name and o.platform_version is not distinct from n.platform_version and o.type = n.type
    and o.calendar = n.calendar"""
ORACLES["upsert_facts"] = _UPSERTED.format(old=_with(**_old) + BY_NAME, new=_with(**_new) + BY_NAME)
_WITH_NULLS = BY_NAME + """ union all select platform_name, null, type, calendar, new_install_users from stats
  where platform_version = 'all'"""
ORACLES["upsert_stream_facts"] = _UPSERTED.format(old=_with(**_old) + _WITH_NULLS, new=_with(**_new) + _WITH_NULLS)

# ---------------------------------------------------------------- raw lines

PAIRS = """list_filter(list_transform(string_split({query}, '&'), lambda x: {{
    'k': url_decode(replace(trim(split_part(rtrim(x, '='), '=', 1)), '+', ' ')),
    'v': url_decode(replace(trim(split_part(rtrim(x, '='), '=', 2)), '+', ' ')),
    'ok': contains(rtrim(x, '='), '=')}}), lambda e: e.ok)"""


def _query(text: str) -> str:
    return f"case when strpos({text}, '?') between 1 and length({text}) - 1 then substr({text}, strpos({text}, '?') + 1) end"


def _last(name: str) -> str:
    return f"list_filter(params, lambda e: e.k = '{name}')[-1].v"


FIELDS = ["en", "pl", "ver", "u_ud", "u_mid", "u_sd", "c_time", "p_url", "tt", "oid", "cua", "cut", "pt", "ca", "ac", "b_iev"]
RAW_PARTS = {
    "raw": RAW,
    "cut_up": "select event_id, value, string_split(trim(value), '^A') as p from raw",
    "queried": f"""select event_id, value, len(p) = 3 and p[3] <> '' as three, trim(p[1]) as line_ip,
      cast(trunc(try_cast(trim(p[2]) as double) * 1000) as bigint) as line_time,
      {_query("trim(p[3])")} as query from cut_up""",
    "parsed": f"""select event_id, value, case when not three then 'bad_line' when query is null then 'no_parameters' end
      as parse_error, line_ip, line_time, case when three then {PAIRS.format(query='query')} end as params from queried""",
    "fields": "select event_id, value, parse_error, params, "
      "case when parse_error is null then line_ip end as ip, case when parse_error is null then line_time end as s_time, "
      + ", ".join(f"{_last(n)} as {n}" for n in FIELDS) + " from parsed",
}


def _blank(*names: str) -> str:
    return "(" + " or ".join(f"trim(coalesce({n}, '')) = ''" for n in names) + ")"


def _classified(strict: bool = False) -> str:
    who = ["u_ud", "u_sd"] if strict else []
    return f"""select *, case when parse_error is not null then parse_error
      when en is null or en not in ('e_l', 'e_pv', 'e_crt', 'e_cs', 'e_cr', 'e_e') then 'unknown_event'
      when s_time is null then 'bad_server_time'
      when {_blank('pl')} then 'missing_platform'
      when pl = 'java_server' then case
        when en = 'e_cr' then case when {_blank('u_mid')} then 'missing_field' end
        when en = 'e_cs' then case when {_blank('u_mid', 'oid')} then 'missing_field' end
        else 'event_not_allowed' end
      when pl = 'website' then case
        when en = 'e_crt' then case when {_blank('oid', 'cut', 'pt', 'cua', *who)} then 'missing_field' end
        when en = 'e_e' then case when {_blank('ca', 'ac', *who)} then 'missing_field' end
        when en = 'e_pv' then case when {_blank('p_url', *who)} then 'missing_field' end
        when en = 'e_l' then {f"case when {_blank(*who)} then 'missing_field' end" if strict else 'null'}
        else 'event_not_allowed' end
      else 'unknown_platform' end as reject_reason from fields"""


AGENTS = """case when trim(coalesce(b_iev, '')) <> '' then
    case when contains(b_iev, 'Chrome/') then 'Chrome' when contains(b_iev, 'Firefox/') then 'Firefox'
      when contains(b_iev, 'Safari/') then 'Safari' else 'unknown' end end as browser,
  nullif(case when contains(b_iev, 'Chrome/') then regexp_extract(b_iev, 'Chrome/([0-9.]+)', 1)
    when contains(b_iev, 'Firefox/') then regexp_extract(b_iev, 'Firefox/([0-9.]+)', 1)
    when contains(b_iev, 'Safari/') then regexp_extract(b_iev, 'Version/([0-9.]+)', 1) end, '') as browser_v,
  case when trim(coalesce(b_iev, '')) <> '' then
    case when contains(b_iev, 'Windows') then 'Windows' when contains(b_iev, 'Mac OS X') then 'OS X'
      when contains(b_iev, 'Linux') then 'Linux' else 'unknown' end end as os,
  case when trim(coalesce(b_iev, '')) <> '' then
    case when contains(b_iev, 'Windows NT 6.1') then 'Windows 7'
      when contains(b_iev, 'Mac OS X') then 'OS X ' || replace(regexp_extract(b_iev, 'Mac OS X ([0-9_.]+)', 1), '_', '.')
      when contains(b_iev, 'Linux') then 'Linux' else 'unknown' end end as os_v"""

CLASSIFIED = {**RAW_PARTS, "classified": _classified()}
VALID = {**CLASSIFIED, "valid": "select * from classified where reject_reason is null"}
ORACLES["parse_log_lines"] = _with(**RAW_PARTS) + """
  select event_id, parse_error, case when parse_error is null then cast(1 + (case when s_time is null then 0 else 1 end)
    + len(list_distinct(list_transform(params, lambda e: e.k))) as int) end as n_fields,
    ip, cast(s_time as varchar) as s_time, en, pl, ver, u_ud, u_mid, u_sd, c_time, p_url, tt, ca, ac, oid, cua, b_iev
  from fields"""
ORACLES["valid_events"] = _with(**VALID) + "select event_id, s_time, en, pl, ver, u_ud, p_url, oid from valid"
ORACLES["rejected_lines"] = _with(**CLASSIFIED) + "select value, reject_reason from classified where reject_reason is not null"
ORACLES["reject_counts"] = _with(**CLASSIFIED) + """
  select reject_reason, count(*) as lines from classified where reject_reason is not null group by reject_reason"""
ORACLES["reject_counts_strict"] = _with(**RAW_PARTS, classified=_classified(strict=True)) + """
  select reject_reason, count(*) as lines from classified where reject_reason is not null group by reject_reason"""
ORACLES["activity_active_users"] = _with(**VALID) + """
  select ca, ac, cast(make_timestamp(s_time * 1000) as date) as date, count(distinct u_ud) as active_users
  from valid where en = 'e_e' group by all"""
ORACLES["dedupe_events"] = _with(**VALID) + """
  select s_time % 86400000 as time_in_day, s_time, u_ud, en, count(distinct value) as copies from valid group by all"""
ORACLES["event_log_view"] = _with(**VALID) + """
  select pl, nullif(trim(ver), '') as ver, en, u_ud, u_sd, s_time from valid"""
ORACLES["event_table_scan"] = _with(**VALID) + """
  select dt, en, pl, count(*) as events, cast(sum(s_time) as bigint) as time_sum from (
    select date '2024-01-10' as dt, * from valid union all select date '2024-01-11', * from valid where en = 'e_l')
  group by dt, en, pl"""
ORACLES["raw_log_scan"] = _with(raw=RAW) + "select value from raw"
ORACLES["ingest_stream_lines"] = ORACLES["raw_log_scan"]
ORACLES["landing_rolled_by_size"] = f"""
SELECT CAST(count(*) AS BIGINT) AS lines, CAST(sum(strlen(value) + 1) AS BIGINT) AS bytes, CAST(0 AS BIGINT) AS oversized
FROM ({ORACLES["raw_log_scan"]}) t
"""
ORACLES["user_agents"] = _with(**RAW_PARTS) + f"select event_id, {AGENTS} from fields where b_iev is not null"
ORACLES["url_params"] = _with(
    queried=f"select page_id, {_query('url')} as query from pages",
    parsed=f"select page_id, {PAIRS.format(query='query')} as params from queried where trim(query) <> ''",
    named="select page_id, params, unnest(list_distinct(list_transform(params, lambda e: e.k))) as name from parsed",
) + "select page_id, name, list_filter(params, lambda e: e.k = name)[-1].v as value from named"

# ---------------------------------------------------------------- addresses

NUMBER = """cast(split_part(ip, '.', 1) as bigint) * 16777216 + cast(split_part(ip, '.', 2) as bigint) * 65536
  + cast(split_part(ip, '.', 3) as bigint) * 256 + cast(split_part(ip, '.', 4) as bigint)"""


def _region(c: str) -> str:
    rest = f"substr({c}, 4)"

    def through(text: str, mark: str) -> str:
        return f"case when strpos({text}, '{mark}') > 1 then substr({text}, 1, strpos({text}, '{mark}')) end"

    district = f"""case when strpos({rest}, '区') > 1 and substr({rest}, strpos({rest}, '区') - 1, 1) not in ('小', '校')
      then substr({rest}, 1, strpos({rest}, '区')) end"""
    after = f"substr({c}, strpos({c}, '省') + 1)"
    local = f"({c} = '局域网' or trim({c}) like '%CZ88')"
    home = f"""{local} or strpos({c}, '省') > 1 or substr({c}, 1, 2) in
      ('内蒙', '广西', '宁夏', '西藏', '新疆', '上海', '北京', '重庆', '天津', '香港', '澳门')"""
    return f"""case when {c} = '' then 'unknown' when {home} then '中国' else {c} end as country,
      case when {c} = '' then 'unknown' when {local} then '局域网'
        when strpos({c}, '省') > 1 then substr({c}, 1, strpos({c}, '省'))
        when substr({c}, 1, 2) = '内蒙' then '内蒙古自治区'
        when substr({c}, 1, 2) in ('广西', '宁夏', '西藏', '新疆') then substr({c}, 1, 2)
        when substr({c}, 1, 2) in ('上海', '北京', '重庆', '天津') then substr({c}, 1, 2) || '市'
        when substr({c}, 1, 2) in ('香港', '澳门') then substr({c}, 1, 2) || '特别行政区' else 'unknown' end as province,
      coalesce(case when {c} = '' or {local} then null
        when strpos({c}, '省') > 1 then case when strpos({after}, '市') > 0 then substr({after}, 1, strpos({after}, '市')) end
        when substr({c}, 1, 2) = '内蒙' then {through(rest, '市')}
        when substr({c}, 1, 2) in ('广西', '宁夏', '西藏', '新疆') then {through(f'substr({c}, 3)', '市')}
        when substr({c}, 1, 2) in ('上海', '北京', '重庆', '天津')
          then coalesce({district}, {through(rest, '县')}) end, 'unknown') as city"""


LOCATED = {
    "ranges": RANGES,
    "numbered": f"select *, {NUMBER} as number from {{source}} where ip is not null",
    "located": """select numbered.*, coalesce(r.country, '未知国家') as ip_country, coalesce(r.area, '未知地区') as ip_area
      from numbered left join ranges r on number between begin_ip and end_ip""",
}


def _located(source: str) -> dict[str, str]:
    return {k: v.replace("{source}", source) for k, v in LOCATED.items()}


ORACLES["ip_convert"] = _with(**RAW_PARTS) + f"select event_id, ip, {NUMBER} as number, ip as text from fields where ip is not null"
ORACLES["ip_region"] = _with(**RAW_PARTS, **_located("fields")) + f"""
  select event_id, ip, ip_country, ip_area, trim(case when ip_country = ' CZ88.NET' then '' else ip_country end || ' '
    || case when ip_area = ' CZ88.NET' then '' else ip_area end) as ip_address, {_region('ip_country')} from located"""
ORACLES["ip_region_shuffled"] = ORACLES["ip_region"]
DOTTED = "concat_ws('.', {n} // 16777216, {n} // 65536 % 256, {n} // 256 % 256, {n} % 256)"
ORACLES["find_ip_ranges"] = _with(ranges=RANGES) + f"""
  select {DOTTED.format(n='begin_ip')} as begin_ip, {DOTTED.format(n='end_ip')} as end_ip, country, area from ranges
  where country like '%市%' or area like '%市%'"""
ORACLES["list_range_ends"] = _with(ranges=RANGES) + f"select {DOTTED.format(n='end_ip')} as end_ip from ranges"
ORACLES["ip_range_table"] = RANGES

ORACLES["etl_events"] = _with(
    **VALID, **_located("valid"),
    agents=f"select * exclude (b_iev), {AGENTS} from located",
) + f"""select s_time % 86400000 as time_in_day, ip, s_time, en, pl, nullif(trim(ver), '') as ver, u_ud, u_mid, u_sd,
  c_time, p_url, tt, oid, cua, cut, pt, ca, ac, browser, browser_v, os, os_v, {_region('ip_country')},
  cast(0 as int) as n_extra from agents"""
ORACLES["etl_stream_events"] = ORACLES["etl_events"]
ORACLES["stream_then_batch_scan"] = _with(**VALID) + """
  select streamed, en, pl, count(*) as events, cast(sum(s_time) as bigint) as time_sum
  from valid, (values (true), (false)) t(streamed) group by all"""

ORACLES["shared_day_scan"] = _with(**VALID) + """
  select en, pl, count(*) as events, cast(sum(s_time) as bigint) as time_sum from valid group by all"""
ORACLES["stream_distinct_events"] = ORACLES["etl_events"]

# --------------------------------------------------------------------- jobs

ORACLES["etl_job_counts"] = _with(**CLASSIFIED) + """
  select 'lines' as reason, count(*) as lines, cast(0 as bigint) as kept from classified
  union all select reason, count(reject_reason), count(reject_reason) from (values ('bad_line'), ('no_parameters'),
    ('unknown_event'), ('bad_server_time'), ('missing_platform'), ('unknown_platform'), ('event_not_allowed'),
    ('missing_field')) t(reason) left join classified on reason = reject_reason group by reason"""
ORACLES["kpi_job"] = _install(X.RUN_DATE, f"""
  select kpi_name, platform_name, platform_version, type, calendar, browser_name, browser_version, new_install_users,
    date '2024-01-10' as created from ({BOTH_KPIS})""")
ORACLES["kpi_job_by_days"] = ORACLES["kpi_job"]
ORACLES["hourly_increments"] = ORACLES["hourly_kpis"]
ORACLES["hourly_two_days"] = _with(**HOURLY_PARTS, **HOURLY_IDS) + f"""
  select source, platform_name, platform_version, date as calendar, kpi as kpi_name, {HOURS}
  from named, (values ('table'), ('tsv')) t(source) where date in (date '2024-01-01', date '2024-01-02')"""

# ---------------------------------------------------------- other raw lines


def _raw_parts(raw: str) -> dict[str, str]:
    return {**RAW_PARTS, "raw": raw}


_SET = f"""select event_id, case when event_id % 2 = 0 then value || '&ip=8.8.4.4&s_time=1704070000123' else value end as value
  from ({RAW}) r"""
ORACLES["client_set_fields"] = _with(**_raw_parts(_SET)) + f"""
  select event_id, protected, parse_error,
    case when parse_error is null then case when protected then line_ip else coalesce({_last('ip')}, line_ip) end end as ip,
    case when parse_error is null then case when protected then cast(line_time as varchar)
      else coalesce({_last('s_time')}, cast(line_time as varchar)) end end as s_time
  from parsed, (values (false), (true)) t(protected)"""
_REFUNDS = f"""select event_id, case when event_id % 5 = 0 then replace(replace(value, 'en=e_cs', 'en=e_cr'), '&u_mid=', '&x_mid=')
  else replace(value, 'en=e_cs', 'en=e_cr') end as value from ({RAW}) r"""
ORACLES["refund_lines"] = _with(**_raw_parts(_REFUNDS), classified=_classified()) + "select event_id, en, reject_reason from classified"
ORACLES["row_hashes"] = _with(**VALID) + """
  select en, 2 * count(*) as n_rows, cast(1 as bigint) as keys_per_event, count(distinct value) as n_hashes from valid group by en"""
