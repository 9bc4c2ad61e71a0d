"""Line parsing, validation, enrichment and duplicates."""

import random
import zlib
from urllib.parse import unquote_to_bytes

import pytest
from conftest import column, plan
from pyspark.sql import functions as F

from visitlake import schema as S
from visitlake.functions.params import add_params
from visitlake.operators import lines as L
from visitlake.plans.jobs import etl

LAUNCH_LINE = (
    "198.51.100.7^A1683356889.25^A/hit?u_ud=reader-7f&pl=website&en=e_l&l=pt-BR&shop=south&b_rst=2560*1080&ver=4.2"
    "&b_iev=Mozilla%2F5.0%20(X11%3B%20Ubuntu%3B%20Linux%20x86_64%3B%20rv%3A112.0)%20Gecko%2F20100101%20Firefox%2F112.0"
    "&c_time=1683356880001&u_sd=visit-3"
)
PAID_LINE = "203.0.113.90^A1669852798.5^A/hit?oid=basket%2F12&pl=java_server&till=3&en=e_cs&u_mid=m-00451&c_time=1669852797990&ver=2"
LINE_CASES = {
    LAUNCH_LINE: None, PAID_LINE: None,
    "1.2.3.4^A1.5^A/x?en=e_l&pl=website^A": None,
    "1.2.3.4^A1.5": S.BAD_LINE, "": S.BAD_LINE, "a^Ab^A/x?en=e_l^Ad": S.BAD_LINE, "a^A^A": S.BAD_LINE,
    "1.2.3.4^A1.5^A/x": S.NO_PARAMETERS, "1.2.3.4^A1.5^A/x?": S.NO_PARAMETERS, "1.2.3.4^A1.5^A/x? ^A": S.NO_PARAMETERS,
    "1.2.3.4^Ax^A/x?en=e_l&pl=website": S.BAD_SERVER_TIME,
    "1.2.3.4^A1.5^A/x?en=e_l&pl=website&s_time=abc": S.BAD_SERVER_TIME,
    "1.2.3.4^Ax^A/x?en=e_l&pl=website&s_time=7": None,
    "1.2.3.4^A1.5^A/x?en=zz&pl=website": S.UNKNOWN_EVENT, "1.2.3.4^A1.5^A/x?pl=website": S.UNKNOWN_EVENT,
    "1.2.3.4^A1.5^A/x?en=e_l": S.MISSING_PLATFORM, "1.2.3.4^A1.5^A/x?en=e_l&pl=%20": S.MISSING_PLATFORM,
    "1.2.3.4^A1.5^A/x?en=e_l&pl=phone": S.UNKNOWN_PLATFORM,
    "1.2.3.4^A1.5^A/x?en=e_pv&pl=website": S.MISSING_FIELD, "1.2.3.4^A1.5^A/x?en=e_pv&pl=website&p_url=u": None,
    "1.2.3.4^A1.5^A/x?en=e_cs&pl=website": S.EVENT_NOT_ALLOWED,
    "1.2.3.4^A1.5^A/x?en=e_l&pl=java_server&u_mid=7": S.EVENT_NOT_ALLOWED,
    "1.2.3.4^A1.5^A/x?en=e_cr&pl=java_server&u_mid=7": None, "1.2.3.4^A1.5^A/x?en=e_cr&pl=java_server": S.MISSING_FIELD,
    "1.2.3.4^A1.5^A/x?en=e_cs&pl=java_server&u_mid=7": S.MISSING_FIELD,
    "1.2.3.4^A1.5^A/x?en=e_e&pl=website&ca=a": S.MISSING_FIELD, "1.2.3.4^A1.5^A/x?en=e_e&pl=website&ca=a&ac=b": None,
    "1.2.3.4^A1.5^A/x?en=e_crt&pl=website&oid=1&cut=2&pt=3": S.MISSING_FIELD,
    "1.2.3.4^A1.5^A/x?en=e_crt&pl=website&oid=1&cut=2&pt=3&cua=4": None,
}


def classified(spark, lines, **options):
    return L.classify_events(L.parse_log_lines(column(spark, lines, name="value")), **options)


def test_reject_reasons(spark):
    got = {r.value: r.reject_reason for r in classified(spark, list(LINE_CASES)).collect()}
    assert got == LINE_CASES


def test_strict_rules(spark):
    lines = ["1.1.1.1^A1^A/x?en=e_l&pl=website", "1.1.1.1^A1^A/x?en=e_l&pl=website&u_ud=a&u_sd=b"]
    got = {r.value: r.reject_reason for r in classified(spark, lines, strict=True).collect()}
    assert got == {lines[0]: S.MISSING_FIELD, lines[1]: None}


def test_golden_lines(spark):
    rows = {r.en: r for r in L.to_event_rows(L.valid_events(classified(spark, [LAUNCH_LINE, PAID_LINE]))).collect()}
    launch, paid = rows["e_l"], rows["e_cs"]
    assert (launch.ip, launch.s_time, launch.pl, launch.ver) == ("198.51.100.7", 1683356889250, "website", "4.2")
    assert (launch.u_ud, launch.u_sd, launch.b_rst, launch.l) == ("reader-7f", "visit-3", "2560*1080", "pt-BR")
    assert (launch.browser, launch.browser_v, launch.os, launch.os_v) == ("Firefox", "112.0", "Linux", "Linux (Ubuntu)")
    # 07:08:09.25 in UTC
    assert launch.time_in_day == ((7 * 60 + 8) * 60 + 9) * 1000 + 250 and launch.extra == {"shop": "south"}
    assert (paid.s_time, paid.oid, paid.u_mid, paid.browser) == (1669852798500, "basket/12", "m-00451", None)
    assert paid.extra == {"till": "3"}


def test_row_hash_is_the_crc_of_visitor_and_content(spark):
    row = L.with_row_key(L.to_event_columns(L.valid_events(classified(spark, [PAID_LINE])))).first()
    named = sorted(f"{c}={row[c]}" for c in S.TEXT_COLUMNS if row[c] is not None)
    text = "\x01".join(["", str(row.s_time), *named, "till=3"])
    assert row.row_hash == zlib.crc32(text.encode())


def test_client_values_win_unless_protected(spark):
    lines = column(spark, ["1.2.3.4^A1.5^A/x?en=e_l&pl=website&ip=9.9.9.9&s_time=7&country=X&k=v"], name="value")
    f = L.parse_log_lines(lines).first().fields
    assert (f["ip"], f["s_time"], f["country"]) == ("9.9.9.9", "7", "X")
    f = L.parse_log_lines(lines, protect_reserved=True).first().fields
    assert f == {"ip": "1.2.3.4", "s_time": "1500", "en": "e_l", "pl": "website", "k": "v"}


def expected_params(query):
    """The parameter rules, written out one pair at a time."""
    out = {}
    for pair in query.split("&"):
        parts = pair.split("=")
        while parts and parts[-1] == "":
            parts.pop()
        if len(parts) < 2:
            continue
        decoded = []
        for p in parts[:2]:
            p = p.strip("".join(map(chr, range(0x21)))).replace("+", " ")
            raw = p.encode()
            i = 0
            while i < len(raw):
                if raw[i : i + 1] == b"%":
                    if len(raw) < i + 3 or any(chr(c) not in "0123456789abcdefABCDEF" for c in raw[i + 1 : i + 3]):
                        break
                    i += 3
                else:
                    i += 1
            else:
                decoded.append(unquote_to_bytes(raw).decode("utf-8", "replace"))
        if len(decoded) == 2:
            out[decoded[0]] = decoded[1]
    return out


def test_params_against_brute_force(spark):
    rng = random.Random(7)
    tokens = ["a", "b", "k", "=", "=", "&", "&", "%26", "%3D", "%3d", "%41", "%zz", "%", "+", " ", "\x01", "%02", "%01",
              "%20", "é", "%C3%A9", "%e4%bd%a0", "1"]
    queries = ["".join(rng.choices(tokens, k=rng.randint(1, 14))) for _ in range(4000)]
    queries += ["a=1&b=2&a=3&c=x=y&d&e=&=v&f=q+r%20s&g=%ZZ&c2==z", "%26", "a=%26&b=%3D=1"]
    rows = add_params(column(spark, queries, name="q").repartition(8), "q", "p").collect()
    assert len(rows) == len(queries)
    for r in rows:
        assert r.p == expected_params(r.q), r.q


def test_golden_params(spark):
    q = "a=1&b=2&a=3&c=x=y&d&e=&=v&f=q+r%20s&g=%ZZ&c2==z"
    row = add_params(column(spark, [q, None], name="q"), "q", "p", {"ip": F.lit("x"), "s_time": F.lit(None)}).collect()
    assert row[0].p == {"ip": "x", "a": "3", "b": "2", "c": "x", "": "v", "f": "q r s", "c2": ""}
    assert row[1].p is None


def test_blank_values_are_dropped_but_tell_events_apart(spark):
    base = "1.2.3.4^A1.5^A/x?en=e_l&pl=website"
    agent = "&b_iev=Mozilla%2F5.0%20(Windows%20NT%205.1)%20Chrome%2F45.0"
    lines = column(spark, [base, base, base + "&tt=%20", base + "&=v", base + agent, base + agent + "%20x"], name="value")
    rows = etl(lines)[0].collect()
    # the blank title and the nameless value make events of their own; the raw user agent does not
    assert len(rows) == 4 and all(r.tt is None and not r.extra for r in rows)
    assert len({r.row_hash for r in rows}) == 4


def test_many_copies_become_one_row(spark):
    lines = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit(LAUNCH_LINE)).otherwise(
        F.concat(F.lit(PAID_LINE), F.lit("&n="), (F.col("id") % 100).cast("string"))).alias("value"))
    assert etl(lines)[0].count() == 101


def test_lines_are_parsed_once(spark):
    valid = L.valid_events(classified(spark, [LAUNCH_LINE]))
    assert plan(L.to_event_rows(valid)).count("regexp_extract_all") == 6  # whole: 2, piecewise: 2 x 2


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_regions_of_events(spark, max_rows):
    ranges = spark.createDataFrame(
        [(0x01020300, 0x010203FF, "广东省深圳市", "x"), (0x05000000, 0x05FFFFFF, None, None)], S.IP_RANGE_SCHEMA
    )
    ips = {"1.2.3.4": ("中国", "广东省", "深圳市"), "5.1.1.1": ("unknown",) * 3, "6.1.1.1": ("未知国家", "unknown", "unknown"),
           "%20": ("unknown",) * 3}
    lines = [f"{ip}^A1.5^A/x?en=e_l&pl=website&ip={ip}&country=X" for ip in ips]
    valid = L.valid_events(classified(spark, lines))
    rows = L.to_event_rows(valid, ranges, max_rows=max_rows).collect()
    assert {r.ip or "%20": (r.country, r.province, r.city) for r in rows} == ips
    assert L.to_event_rows(valid).filter("country = 'X'").count() == 4


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_events_in_overlapping_ranges(spark, max_rows):
    """Copies of a line are one event; it has a row for every range that holds its address, or one row."""
    ranges = spark.createDataFrame(
        [(0x01020300, 0x010203FF, "美国", "x"), (0x01000000, 0x01FFFFFF, "美国", "y"), (0x01020000, 0x0102FFFF, "北京市海淀区", "z")],
        S.IP_RANGE_SCHEMA,
    )
    lines = [f"{ip}^A1.5^A/x?en=e_l&pl=website&country={c}" for ip in ("1.2.3.4", "1.2.9.9", "7.1.1.1") for c in "XY"]
    valid = L.valid_events(classified(spark, lines))
    rows = lambda how: sorted((r.ip, r.country) for r in L.to_event_rows(valid, ranges, max_rows=max_rows, overlaps=how).collect())
    assert rows("every") == [("1.2.3.4", "中国"), ("1.2.3.4", "美国"), ("1.2.3.4", "美国"), ("1.2.9.9", "中国"), ("1.2.9.9", "美国"),
                             ("7.1.1.1", "未知国家")]
    assert rows("last") == [("1.2.3.4", "美国"), ("1.2.9.9", "中国"), ("7.1.1.1", "未知国家")]
