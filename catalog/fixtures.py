"""Inputs derived from the given tables, as SQL text that Spark and DuckDB both run.

`{events}`, `{customer}`, `{nation}`, `{orders}`, `{pages}` stand for the tables and `{ms}` for the epoch milliseconds of `ts`.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from visitlake.sources.files import spread

RUN_DATE = date(2024, 1, 10)
LATER_RUN_DATE = date(2024, 1, 20)

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

FX = """
select event_id, {ms} as s_time,
  case event_type when 'signup' then 'e_l' when 'view' then 'e_pv' when 'click' then 'e_e'
    when 'purchase' then case when user_id % 3 = 1 then 'e_cs' else 'e_crt' end else 'error' end as en,
  case user_id % 3 when 0 then 'website' when 1 then 'java_server' else 'mobile' end as pl,
  case when event_id % 10 = 0 then null else cast(1 + user_id % 4 as string) end as ver,
  concat('u', cast(user_id as string)) as u_ud,
  concat(cast(user_id as string), '-', cast(event_id % 7 as string)) as u_sd,
  case user_id % 4 when 0 then 'Chrome' when 1 then 'Firefox' when 2 then 'Safari' else null end as browser,
  case when event_id % 5 = 0 then null else cast(40 + event_id % 3 as string) end as browser_v
from {events}
"""

# The same events within 36 hours and six sessions, so that sessions have a length.
FX_DENSE = f"""
select event_id, cast(1704067200000 + floor((s_time - 1704067200000) / 20) as bigint) as s_time, en, pl, ver, u_ud,
  concat('s', cast(cast(substr(u_ud, 2) as bigint) % 6 as string)) as u_sd, browser, browser_v
from ({FX}) fx
"""

# Raw lines, some malformed: two fields, bad time, no query, unknown event, no platform, no page url.
RAW = f"""
select event_id, concat(
  case when event_id % 17 = 0 then '11.' when event_id % 19 = 0 then '13.' else '10.' end,
  case when event_id % 4 = 3 then '1.2' else concat(cast(user_id % 16 as string), '.', cast(event_id % 256 as string)) end, '.7', '^A',
  case when event_id % 103 = 0 then 'bad-time'
       else concat(cast(cast((ms - ms % 1000) / 1000 as bigint) as string), '.', lpad(cast(ms % 1000 as string), 3, '0')) end,
  case when event_id % 101 = 0 then '' when event_id % 107 = 0 then '^A/log.gif'
  else concat('^A/log.gif?en=', en,
    case when event_id % 109 = 0 then '' else concat('&pl=', pl) end,
    '&ver=', coalesce(ver, '%20'), '&u_ud=', u_ud, '&u_sd=', u_sd, '&c_time=', cast(ms as string),
    case when en = 'e_pv' and event_id % 11 <> 0 then '&p_url=http%3A%2F%2Fex.com%2Fa%3Fb%3D1&tt=a+b%20c' else '' end,
    case when en = 'e_e' then concat('&ca=cat', cast(event_id % 3 as string), '&ac=act') else '' end,
    case when en in ('e_crt', 'e_cs') then concat('&oid=o', cast(event_id as string), '&cut=CNY&pt=card&cua=', cast(event_id % 500 as string)) else '' end,
    case when pl = 'java_server' then concat('&u_mid=m', cast(user_id as string)) else '' end,
    '&ver=', coalesce(ver, '9'),
    case user_id % 4 when 0 then '&b_iev=Mozilla%2F5.0%20(Windows%20NT%206.1)%20AppleWebKit%2F537.36%20Chrome%2F45.0.2454.101%20Safari%2F537.36'
      when 1 then '&b_iev=Mozilla%2F5.0%20(X11%3B%20Linux%20x86_64%3B%20rv%3A40.0)%20Gecko%2F20100101%20Firefox%2F40.0'
      when 2 then '&b_iev=Mozilla%2F5.0%20(Macintosh%3B%20Intel%20Mac%20OS%20X%2010_10)%20Version%2F8.0%20Safari%2F600.1' else '' end) end) as value
from (select f.*, s_time as ms, cast(substr(u_ud, 2) as bigint) as user_id from ({FX}) f) t
"""

PLACES = [
    "广东省深圳市", "北京市海淀区", "内蒙古呼和浩特市", "广西南宁市", "香港", "美国", "局域网", "上海市浦东新区",
    "重庆市云阳县", "北京市清华大学小区", "河北省", " CZ88.NET", "",
]

# One range per customer, 201 to 500 addresses long, with gaps; a part of them crosses a /24 border. Two more share only the
# first byte, or none, between their ends.
IP_RANGES = """
select cast(167772160 + c_custkey * 512 as bigint) as begin_ip,
  cast(167772160 + c_custkey * 512 + 200 + c_custkey % 300 as bigint) as end_ip,
  case c_custkey % 14 {cases} else n_name end as country,
  case when c_custkey % 5 = 0 then ' CZ88.NET' else lower(c_mktsegment) end as area
from {customer} join {nation} on c_nationkey = n_nationkey
union all select cast(184549376 as bigint), cast(185204735 as bigint), n_name, 'wide' from {nation} where n_nationkey = 0
union all select cast(201326592 as bigint), cast(268435455 as bigint), n_name, 'wider' from {nation} where n_nationkey = 1
""".replace("{cases}", " ".join(f"when {i} then '{p}'" for i, p in enumerate(PLACES)))

SPARK_MS = "timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"
DUCKDB_MS = "(epoch_us(ts) // 1000)"


def _fill(sql: str, tables: dict[str, str], ms: str) -> str:
    for name, relation in tables.items():
        sql = sql.replace("{" + name + "}", relation)
    return sql.replace("{ms}", ms)


def for_duckdb(sql: str) -> str:
    return _fill(sql, {t: t for t in TABLES}, DUCKDB_MS).strip()


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(_fill(sql, {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}, SPARK_MS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, FX)


def fx_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, FX_DENSE)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(run(spark, sf_dir, RAW))


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, IP_RANGES)
