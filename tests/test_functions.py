"""Column helpers against hand-derived values and plain Python."""

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from conftest import column
from pyspark.sql import functions as F

from visitlake.functions import timeparts as TP
from visitlake.functions.agents import BROWSER_RULES, OS_RULES, with_user_agent
from visitlake.functions.ip import address_text, ip_to_long, long_to_ip, parse_region
from visitlake.functions.params import parse_server_time
from visitlake.functions.text import is_blank, trim_controls, whole_number


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_blank_and_trim(spark):
    texts = [None, "", " \t", "　", " ", "a", " a ", "\x01", "é", " ", "\x1f \n"]
    df = column(spark, texts).coalesce(1)
    assert values(df, is_blank(F.col("c"))) == [
        True, True, True, True, False, False, False, False, False, False, True,
    ]
    assert values(df, trim_controls(F.col("c"))) == [
        None, "", "", "　", " ", "a", "a", "", "é", " ", "",
    ]


def test_whole_number(spark):
    df = column(spark, ["12", "-3", "+4", " 5", "1.5", "x", "", None, "99999999999999999999"]).coalesce(1)
    assert values(df, whole_number(F.col("c"))) == [12, -3, 4, None, None, None, None, None, None]


def test_server_time(spark):
    df = column(spark, ["1449410796.976", " 1.5 ", "x", "", None, "-0.001", "1e3", "NaN"]).coalesce(1)
    assert values(df, parse_server_time(F.col("c"))) == [
        int(float("1449410796.976") * 1000), 1500, None, None, None, None, 1000000, None,
    ]


GOLDEN_DATES = [
    ("2015-12-20", "day", (2015, 4, 12, 52, 20, "day", "2015-12-20")),
    ("2015-12-20", "week", (2015, 4, 12, 52, 0, "week", "2015-12-20")),
    ("2015-12-20", "month", (2015, 4, 12, 0, 0, "month", "2015-12-01")),
    ("2015-12-20", "season", (2015, 4, 0, 0, 0, "season", "2015-10-01")),
    ("2015-12-20", "year", (2015, 0, 0, 0, 0, "year", "2015-01-01")),
    ("2016-01-01", "week", (2015, 4, 12, 53, 0, "week", "2015-12-27")),
    ("2016-01-01", "day", (2016, 1, 1, 1, 1, "day", "2016-01-01")),
    ("2000-12-24", "week", (2000, 4, 12, 53, 0, "week", "2000-12-24")),
    ("2000-12-31", "week", (2000, 4, 12, 53, 0, "week", "2000-12-31")),
]


@pytest.mark.parametrize("day,grain,row", GOLDEN_DATES)
def test_date_dimension(spark, day, grain, row):
    got = spark.range(1).select(TP.date_dimension(F.lit(date.fromisoformat(day)), grain).alias("d")).first()["d"]
    assert tuple(got) == (*row[:-1], date.fromisoformat(row[-1]))


def test_hour_has_no_dimension():
    for grain in ("hour", "minute"):
        with pytest.raises(ValueError):
            TP.date_dimension(F.lit(date(2020, 1, 1)), grain)


def test_week_rule_on_every_day(spark):
    days = spark.sql("select explode(sequence(date'1900-01-01', date'2100-12-31')) as d")
    rows = days.select("d", TP.week_of_year(F.col("d")).alias("w"), TP.week_start(F.col("d")).alias("s")).collect()
    for r in rows:
        first = date(r.d.year, 1, 1)
        week = (r.d.timetuple().tm_yday - 1 + first.isoweekday() % 7) // 7 + 1
        sunday = r.d - timedelta(days=r.d.isoweekday() % 7)
        in_next_year = (sunday + timedelta(days=6)).year > r.d.year
        assert r.w == (53 if in_next_year else week), r
        assert r.s == sunday


@pytest.mark.parametrize("tz", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_local_calendar(spark, tz):
    stamps = [0, 1583020800999, 1704067199999, 1704067200000, 1710054000000 - 1, 1710054000000, 1730613600000, -1]
    ms = F.col("c")
    rows = column(spark, stamps, "bigint").select(
        "c", TP.event_date(ms, tz).alias("d"), TP.event_hour(ms, tz).alias("h"),
        TP.midnight_millis(TP.event_date(ms, tz), tz).alias("m"),
        TP.format_millis(ms, "yyyyMMdd", tz).alias("t"),
    ).collect()
    for r in rows:
        local = datetime.fromtimestamp(r.c / 1000, timezone.utc).astimezone(ZoneInfo(tz))
        assert (r.d, r.h, r.t) == (local.date(), local.hour, local.strftime("%Y%m%d"))
        assert r.m == TP.day_start_millis(local.date(), tz)


def test_results_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        row = spark.range(1).select(
            TP.event_date(F.lit(1704067200000)).alias("d"), TP.event_hour(F.lit(1704067200000), "Asia/Shanghai").alias("h"),
            TP.date_to_millis(F.lit("2024-01-01")).alias("m"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (date(2024, 1, 1), 8, 1704067200000)


def test_date_text(spark):
    df = column(spark, ["2024-01-10", "2015-02-30", "2015-13-01", "20240110", "x", "", None]).coalesce(1)
    day = lambda d: TP.day_start_millis(d)
    assert values(df, TP.date_to_millis(F.col("c"))) == [
        day(date(2024, 1, 10)), day(date(2015, 3, 2)), day(date(2016, 1, 1)), None, None, None, None,
    ]
    assert values(df, TP.date_to_millis(F.col("c"), "yyyyMMdd"))[3] == day(date(2024, 1, 10))
    assert values(df, TP.is_valid_run_date(F.col("c"))) == [True, False, False, False, False, False, False]


@pytest.mark.parametrize("run,today,start,end", [
    ("2024-01-10", "2024-01-11", "2024-01-01", "2024-01-11"),
    ("2024-01-10", "2024-01-14", "2024-01-01", "2024-02-01"),
    ("2024-01-31", "2024-02-01", "2024-01-01", "2024-02-04"),
    ("2024-03-01", "2024-03-02", "2024-02-25", "2024-03-02"),
])
def test_scan_window(run, today, start, end):
    d = date.fromisoformat
    assert TP.scan_window(d(run), d(today)) == TP.Period(d(start), d(end))


def test_run_date():
    today = date(2024, 3, 1)
    assert TP.resolve_run_date(None, today) == date(2024, 2, 29)
    assert TP.resolve_run_date("20240101", today) == date(2024, 2, 29)
    assert TP.resolve_run_date("2024-01-01", today) == date(2024, 1, 1)
    with pytest.raises(ValueError):
        TP.resolve_run_date("2015-99-99", today)


def test_yesterday(spark):
    row = spark.range(1).select(TP.yesterday().alias("y"), TP.arrival_date().alias("t")).first()
    assert row.t - row.y == timedelta(days=1)


def test_ip_numbers(spark):
    texts = ["127.0.0.1", "255.255.255.255", "1.2.3", "1..2.3.4.5", "a.1.2.3", "1.x.2.3", "300.-1.0.1", "", None, "1. 2.3.4"]
    df = column(spark, texts).coalesce(1)
    assert values(df, ip_to_long(F.col("c"))) == [
        0x7F000001, 0xFFFFFFFF, 0x01020300, 0x01020304, 0, 0x01000000, 0x2CFF0001, 0, None, 0x01000000,
    ]
    back = column(spark, [0x7F000001, 0xFFFFFFFF, 0], "bigint").coalesce(1)
    assert values(back, long_to_ip(F.col("c"))) == ["127.0.0.1", "255.255.255.255", "0.0.0.0"]


REGIONS = {
    "广东省深圳市": ("中国", "广东省", "深圳市"), "北京市海淀区": ("中国", "北京市", "海淀区"),
    "内蒙古呼和浩特市": ("中国", "内蒙古自治区", "呼和浩特市"), "广西南宁市": ("中国", "广西", "南宁市"),
    "香港": ("中国", "香港特别行政区", "unknown"), "美国": ("美国", "unknown", "unknown"),
    "局域网": ("中国", "局域网", "unknown"), "上海市浦东新区": ("中国", "上海市", "浦东新区"),
    "重庆市云阳县": ("中国", "重庆市", "云阳县"), "北京市清华大学小区": ("中国", "北京市", "unknown"),
    "河北省": ("中国", "河北省", "unknown"), " CZ88.NET": (" CZ88.NET", "unknown", "unknown"),
    "": ("unknown", "unknown", "unknown"), "未知国家": ("未知国家", "unknown", "unknown"), "x CZ88": ("中国", "局域网", "unknown"),
    "日": ("日", "unknown", "unknown"), "上海": ("中国", "上海市", "unknown"), "内蒙": ("中国", "内蒙古自治区", "unknown"),
    "天津市校区和平县": ("中国", "天津市", "校区和平县"), "省x": ("省x", "unknown", "unknown"),
}


def test_regions(spark):
    df = column(spark, list(REGIONS)).select("c", parse_region(F.col("c")).alias("r"))
    assert {r.c: tuple(r.r) for r in df.collect()} == REGIONS


def test_address_text(spark):
    df = spark.createDataFrame([("美国", "加州"), (" CZ88.NET", "x"), ("y", " CZ88.NET")], "c string, a string").coalesce(1)
    assert values(df, address_text(F.col("c"), F.col("a"))) == ["美国 加州", "x", "y"]


AGENTS = {
    "Mozilla/5.0 (Windows NT 5.1) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/45.0.2454.101 Safari/537.36":
        ("Chrome", "45.0.2454.101", "Windows", "Windows XP"),
    "Mozilla/5.0 (X11; Linux x86_64; rv:40.0) Gecko/20100101 Firefox/40.0": ("Firefox", "40.0", "Linux", "Linux"),
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_10_5) AppleWebKit/600.8 (KHTML, like Gecko) Version/8.0.8 Safari/600.8":
        ("Safari", "8.0.8", "OS X", "OS X 10.10.5"),
    "Mozilla/5.0 (Windows NT 6.1; Trident/7.0; rv:11.0) like Gecko": ("IE", "11.0", "Windows", "Windows 7"),
    "Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 6.0)": ("IE", "8.0", "Windows", "Windows Vista"),
    "Opera/9.80 (Windows NT 6.1) Presto/2.12 Version/12.16": ("Opera", "12.16", "Windows", "Windows 7"),
    "Mozilla/5.0 (iPhone; CPU iPhone OS 9_1 like Mac OS X) AppleWebKit/601.1 Version/9.0 Mobile/13B143 Safari/601.1":
        ("Mobile Safari", "9.0", "iOS", "iOS 9.1"),
    "Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 Chrome/42.0 Safari/537.36 Edge/12.246":
        ("Edge", "12.246", "Windows", "Windows 10"),
    "something else": ("unknown", None, "unknown", "unknown"),
}


def test_user_agents(spark):
    df = with_user_agent(column(spark, list(AGENTS)), "c", "a")
    assert {r.c: tuple(r.a) for r in df.collect()} == AGENTS
    assert with_user_agent(column(spark, [" ", None]), "c", "a").filter("a is not null").count() == 0


def test_every_agent_rule_is_met_once(spark):
    """A text of just one marker and its version meets that rule, as no earlier marker is part of a later one."""
    shapes = {"rv:": "rv:7.5", "Version/": "Version/7.5", "OS ": "OS 7_5 like Mac"}
    for part, rules in (("browser", BROWSER_RULES), ("os", OS_RULES)):
        texts = {}
        for rule in rules:
            head = rule.pattern.split("(")[0].split("[")[0]
            text = f"{rule.marker} {shapes.get(head, rule.marker.rstrip('/') + ('/7.5' if '/' in rule.pattern else ' 7.5'))}"
            first = next(r for r in rules if r.marker in text)
            texts[text] = first.name
        got = with_user_agent(column(spark, list(texts)), "c", "a").select("c", f"a.{part}").collect()
        assert {r.c: r[part] for r in got} == texts
        assert {r.name for r in rules} == set(texts.values())


def test_text_with_a_time(spark):
    df = spark.createDataFrame([("2024-01-10 13:14:15",), ("2024-03-10 02:30:00",), ("x",), (None,)], "c string").coalesce(1)
    pattern = "yyyy-MM-dd HH:mm:ss"
    assert values(df, TP.date_to_millis(F.col("c"), pattern))[:1] == [1704892455000]
    assert values(df, TP.date_to_millis(F.col("c"), pattern, "Asia/Shanghai")) == [1704892455000 - 8 * 3600000, 1710037800000 - 8 * 3600000, None, None]
