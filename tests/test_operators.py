"""Range lookup, roll-ups, KPIs, hourly report and dimensions against brute force."""

import os
import random
import subprocess
import sys
from collections import defaultdict
from datetime import date, datetime, timedelta, timezone

import pytest
from conftest import column, plan
from pyspark.sql import functions as F

from visitlake import schema as S
from visitlake.functions.timeparts import day_period, month_period, week_period
from visitlake.operators import dimensions as D
from visitlake.operators import hourly as H
from visitlake.operators import visitors as V
from visitlake.operators.ip_ranges import _best_first, find_ip_ranges, find_overlaps, fits_broadcast, join_ip_range, list_range_ends

RUN = date(2024, 1, 10)
EVENT_FIELDS = "en string, pl string, ver string, browser string, browser_v string, u_ud string, u_sd string, s_time bigint"


def some_ranges(rng):
    """Non-overlapping ranges of very different widths, some adjacent, some single addresses."""
    out, at = [], 0
    while at < 1 << 32:
        at += rng.choice([0, 0, 1, 300, 70_000, 20_000_000, 400_000_000])
        width = rng.choice([1, 2, 200, 256, 1000, 65_536, 200_000, 16_777_216, 90_000_000, 500_000_000])
        if at + width > 1 << 32:
            break
        out.append((at, at + width - 1, f"c{len(out)}", "a"))
        at += width
        if len(out) > 400:
            break
    return out


@pytest.mark.parametrize("max_rows", [10_000, 0])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_range_lookup(spark, seed, max_rows):
    rng = random.Random(seed)
    ranges = some_ranges(rng)
    ips = [e for r in ranges for e in (r[0], r[1], r[1] + 1, r[0] - 1)] + [rng.randrange(1 << 32) for _ in range(300)]
    ips = [i for i in ips if 0 <= i < 1 << 32] + [ranges[0][0]] * 900 + [None] * 500 + [0, (1 << 32) - 1]
    df = spark.createDataFrame(list(enumerate(ips)), "n int, ip bigint").repartition(8)
    table = spark.createDataFrame(ranges, S.IP_RANGE_SCHEMA)
    joined = join_ip_range(df, table.select("begin_ip", "end_ip", "country"), "ip", max_rows=max_rows)
    got = {r.n: r.country for r in joined.collect()}
    want = {
        n: next((c for b, e, c, _ in ranges if ip is not None and b <= ip <= e), None) for n, ip in enumerate(ips)
    }
    assert joined.count() == len(ips) and got == want
    assert "NestedLoop" not in plan(joined) and "Cartesian" not in plan(joined)


def test_lookup_reads_its_rows_once(spark):
    table = spark.createDataFrame([(5, 9, "x", "y")], S.IP_RANGE_SCHEMA)
    for max_rows in (10, 0):
        rows = spark.range(10).select(F.col("id").alias("ip")).filter("rand(1) < 2")
        text = join_ip_range(rows, table, "ip", max_rows=max_rows)._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("Range (0, 10") == 1


def test_overlapping_ranges_are_refused(spark):
    table = spark.createDataFrame([(1, 5, "x", "y"), (5, 9, "x", "y")], S.IP_RANGE_SCHEMA)
    with pytest.raises(ValueError, match="overlapping"):
        join_ip_range(spark.range(3).withColumnRenamed("id", "ip"), table, "ip")


def test_broadcast_check_sees_maps(spark):
    row = {"country": "c" * 300, "province": "p" * 300}
    df = spark.createDataFrame([(i, i, row) for i in range(50)], "begin_ip bigint, end_ip bigint, place map<string,string>")
    assert fits_broadcast(df, 50, 2 * 50 * 650) and not fits_broadcast(df, 50, 50 * 650 // 2) and not fits_broadcast(df, 49)


def test_hours_hold_large_sums(spark):
    hourly = spark.createDataFrame([("p", "v", None, 3, "k", 3_000_000_000)], "pl string, ver string, date date, hour int, kpi string, value bigint")
    assert H.pivot_hours(hourly).first().hour_03 == 3_000_000_000


def test_upsert_matches_null_keys(spark):
    facts = spark.createDataFrame([(None, 5, None), (1, 6, None)], "k int, n bigint, created date")
    assert sorted(tuple(r)[:2] for r in D.upsert_facts(facts, facts, ["k"], "n").collect() if r.k is None) == [(None, 5)]


def test_overlaps_are_found(spark):
    octet = 1 << 24
    good = [(0, 5), (6, 6), (7, 3 * octet), (3 * octet + 1, 3 * octet + 9)]
    make = lambda pairs: spark.createDataFrame([(b, e, "", "") for b, e in pairs], S.IP_RANGE_SCHEMA)
    assert find_overlaps(make(good)).isEmpty()
    for extra in ((6, 6), (2 * octet, 2 * octet), (3 * octet, 3 * octet), (3 * octet + 9, 3 * octet + 20)):
        assert not find_overlaps(make([*good, extra])).isEmpty()


def test_range_listing(spark):
    table = spark.createDataFrame([(1 << 24, (1 << 24) + 5, "广东", "电信"), (2 << 24, 3 << 24, "x", "广东y"), (9, 9, "z", "")],
                                  S.IP_RANGE_SCHEMA)
    assert {tuple(r) for r in find_ip_ranges(table, "广东").collect()} == {
        ("1.0.0.0", "1.0.0.5", "广东", "电信"), ("2.0.0.0", "3.0.0.0", "x", "广东y")}
    assert sorted(r[0] for r in list_range_ends(table).collect()) == ["0.0.0.9", "1.0.0.5", "3.0.0.0"]


def some_events(rng, n):
    pick = rng.choice
    day = datetime(2023, 12, 30, tzinfo=timezone.utc)
    return [
        (pick(["e_l", "e_l", "e_pv", "e_pv", "e_e"]), pick(["website", "java_server", "all", "", None, "website"]),
         pick(["1", "2", "all", " ", None]), pick(["Chrome", "Safari", "", None]), pick(["40", "all", None, ""]),
         pick([f"u{rng.randrange(8)}", None, "  "]), pick([f"s{rng.randrange(4)}", None]),
         int((day + timedelta(minutes=rng.randrange(60 * 24 * 36))).timestamp() * 1000) + rng.randrange(1000))
        for _ in range(n)
    ]


def blank(x):
    return x is None or not x.strip()


def expected_installs(events):
    groups = defaultdict(set)
    periods = {"day": day_period(RUN), "week": week_period(RUN), "month": month_period(RUN)}
    for en, pl, ver, b, bv, u, _, ms in events:
        if en != "e_l" or blank(pl) or blank(u):
            continue
        ver = "unknown" if blank(ver) else ver
        b, bv = ("unknown", "unknown") if blank(b) else (b, "unknown" if blank(bv) else bv)
        for grain, p in periods.items():
            lo, hi = p.millis()
            if lo <= ms < hi:
                for plat in {(pl, ver), (pl, "all"), ("all", "all")}:
                    groups[("new_install_user", grain, *plat, "", "")].add(u)
                    for brow in {(b, "all"), (b, bv)}:
                        groups[("browser_new_install_user", grain, *plat, *brow)].add(u)
    return {k: len(v) for k, v in groups.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_installs_against_brute_force(spark, seed):
    events = some_events(random.Random(seed), 1500)
    df = spark.createDataFrame(events, EVENT_FIELDS)
    keys = ["kpi_name", "type", *S.PLATFORM_KEYS, *S.BROWSER_KEYS]
    want = expected_installs(events)
    rows = V.install_kpis(df, RUN).collect()
    assert len(rows) == len({tuple(r[k] for k in keys) for r in rows})
    assert {tuple(r[k] for k in keys): r.new_install_users for r in rows} == want
    for kpi, one in ((S.KPI_NEW_USERS, V.new_install_users), (S.KPI_BROWSER_NEW_USERS, V.browser_new_install_users)):
        n = sum(k[0] == kpi for k in want)
        assert one(df, RUN).count() == n and one(df, RUN).columns[-1] == "new_install_users"


def test_sorted_stats(spark):
    df = spark.createDataFrame(some_events(random.Random(3), 800), EVENT_FIELDS)
    rows = [tuple(r) for r in V.sort_stats(V.install_kpis(df, RUN)).drop("calendar").collect()]
    order = [r[:6] + r[6:8] + (r[8],) + r[9:11] for r in rows]
    assert order == sorted(order)


def test_roll_up_reads_little(spark, tmp_path):
    df = spark.createDataFrame(some_events(random.Random(4), 300), EVENT_FIELDS).withColumn("extra", F.lit("x"))
    df.write.parquet(str(tmp_path / "e"))
    text = plan(V.install_kpis(spark.read.parquet(str(tmp_path / "e")), RUN))
    assert "EqualTo(en,e_l)" in text and "GreaterThanOrEqual(s_time" in text and "extra" not in text


def expected_hourly(events):
    out = defaultdict(set)
    spans = defaultdict(list)
    for en, pl, ver, _, _, u, sd, ms in events:
        if en not in ("e_l", "e_pv"):
            continue
        t = datetime.fromtimestamp(ms / 1000, timezone.utc)
        for level, (p, v) in enumerate(((pl, ver), (pl, "all"), ("all", "all"))):
            k = (level, p, v, t.date(), t.hour)
            ids = out[("new_users" if en == "e_l" else "active_users", k)]
            ids |= {u} - {None}
            if en == "e_pv":
                out[("sessions", k)] |= {sd} - {None}
                spans[(k, sd)].append(ms)
    rows = [(k[1:], kpi, len(v)) for (kpi, k), v in out.items()]
    total = defaultdict(int)
    for (k, _), ms in spans.items():
        total[k] += max(ms) - min(ms)
    rows += [(k[1:], "sessions_lengths", v // 1000) for k, v in total.items()]
    return sorted(rows, key=repr)


def test_hourly_against_brute_force(spark):
    events = [(*e[:7], 1704067200000 + e[7] % 100_000_000) for e in some_events(random.Random(5), 1200)]
    rows = H.hourly_kpis(spark.createDataFrame(events, EVENT_FIELDS)).collect()
    got = sorted((((r.pl, r.ver, r.date, r.hour), r.kpi, r.value) for r in rows), key=repr)
    assert got == expected_hourly(events)
    one = H.hourly_session_length(spark.createDataFrame(events, EVENT_FIELDS))
    assert one.count() == sum(k == "sessions_lengths" for _, k, _ in got)
    # rows that read `all` by themselves give way to the roll-up, which is never smaller
    wide = H.pivot_hours(spark.createDataFrame(rows)).collect()
    best = defaultdict(int)
    for (pl, ver, d, h), kpi, v in got:
        best[(pl, ver, d, kpi, h)] = max(v, best[(pl, ver, d, kpi, h)])
    assert len(wide) == len({k[:4] for k in best})
    for r in wide:
        for h in range(24):
            assert r[f"hour_{h:02d}"] == best.get((r.pl, r.ver, r.date, r.kpi, h), 0)


def test_unknown_kpi_is_an_error(spark):
    df = spark.createDataFrame([], EVENT_FIELDS)
    for call in (lambda: V.install_kpis(df, RUN, ("x",)), lambda: H.hourly_kpis(df, ("x",)), lambda: H.hourly_kpis(df, ())):
        with pytest.raises(ValueError):
            call()


def test_hot_visitor_and_hot_group(spark):
    """A third of all launches by one visitor and all on one platform."""
    df = spark.range(60000).select(
        F.lit("e_l").alias("en"), F.lit("website").alias("pl"), F.lit("1").alias("ver"), F.lit(None).cast("string").alias("browser"),
        F.lit(None).cast("string").alias("browser_v"), F.lit(1704844800000).alias("s_time"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("u_ud"),
    )
    rows = V.new_install_users(df, RUN).collect()
    assert {r.new_install_users for r in rows} == {40001} and len(rows) == 9


def test_ids_grow_and_stay(spark):
    keys = S.BROWSER_KEYS
    empty = spark.createDataFrame([], "id int, browser_name string, browser_version string")
    make = lambda rng: spark.createDataFrame([(f"b{i % 50}", f"v{i}") for i in rng], "browser_name string, browser_version string")
    first = D.assign_dim_ids(empty, make(range(300)), keys)
    one = {tuple(r[k] for k in keys): r.id for r in first.collect()}
    assert sorted(one.values()) == list(range(1, 301))
    second = D.assign_dim_ids(first, make(range(200, 500)).unionAll(make(range(450, 500))), keys)
    two = {tuple(r[k] for k in keys): r.id for r in second.collect()}
    assert sorted(two.values()) == list(range(1, 501)) and all(two[k] == i for k, i in one.items())
    assert D.assign_dim_ids(second, make(range(500)), keys).count() == 500


def test_ids_of_udf_style_calls(spark):
    platforms = spark.createDataFrame([(1, "website", "1"), (2, "unknown", "unknown")], "id int, platform_name string, platform_version string")
    df = spark.createDataFrame([("website", "1"), ("website", " "), (None, "1"), ("x", "y")], "pl string, ver string")
    got = {(r.pl, r.ver): r.platform_dimension_id for r in D.with_platform_id(df, platforms, "pl", "ver").collect()}
    assert got == {("website", "1"): 1, ("website", " "): 2, (None, "1"): 2, ("x", "y"): None}
    days = D.date_dimension_rows(column(spark, ["2015-12-20"]), "c", ("day", "week", "month", "season", "year"))
    dates = D.assign_dim_ids(spark.createDataFrame([], "id int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in days.schema)), days, S.DATE_KEYS)
    ids = {g: D.with_date_id(column(spark, ["2015-12-20"]), dates, "c", g).first().date_dimension_id for g in ("day", "week", "year")}
    assert len(set(ids.values())) == 3 and None not in ids.values()
    for bad in ("20151220", "2015-99-99", "", None):
        with pytest.raises(Exception, match="not a date"):
            D.with_date_id(column(spark, [bad]), dates, "c", "day").collect()
    with pytest.raises(ValueError):
        D.with_date_id(column(spark, ["2015-12-20"]), dates, "c", "hour")
    kpis = spark.createDataFrame([(1, "a")], "id int, kpi_name string")
    assert D.with_kpi_id(column(spark, ["a"]), kpis, "c").first().kpi_dimension_id == 1
    with pytest.raises(Exception, match="blank KPI"):
        D.with_kpi_id(column(spark, [" "]), kpis, "c").collect()


def test_smallest_id_counts(spark):
    dim = spark.createDataFrame([(2, "a"), (1, "a"), (3, "b")], "id int, kpi_name string")
    assert {tuple(r) for r in D.first_ids(dim, ["kpi_name"]).collect()} == {("a", 1), ("b", 3)}


def test_upsert(spark):
    schema = "k int, n bigint, created date"
    old = spark.createDataFrame([(1, 10, date(2024, 1, 1)), (2, 20, date(2024, 1, 1))], schema)
    new = spark.createDataFrame([(2, 5, date(2024, 1, 2)), (3, 7, date(2024, 1, 2))], schema)
    want = {(1, 10, date(2024, 1, 1)), (2, 5, date(2024, 1, 1)), (3, 7, date(2024, 1, 2))}
    once = D.upsert_facts(old, new, ["k"], "n")
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in D.upsert_facts(once, new, ["k"], "n").collect()} == want


def test_reference_tables(spark):
    assert D.event_types(spark).count() == 6
    assert [r[0] for r in D.kpi_dimension(spark).collect()] == [*S.STATS_KPIS, *S.HOURLY_KPIS]


@pytest.mark.parametrize("max_rows", [1_000_000, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_overlapping_ranges_are_looked_up(spark, seed, max_rows):
    """Nested, crossing, equal and repeated ranges, also across borders of prefixes: every one of an address, or the last."""
    rng, top = random.Random(seed), 10 << 24
    ranges = []
    for n in range(120):
        begin, width = top + rng.randrange(3000), rng.choice([1, 2, 200, 256, 700, 2000])
        ranges.append((begin, begin + width - 1, f"c{n % 50}", "a"))
    ranges += [(top - 70_000, top + 140_000, "wide", "a"), ranges[0], (ranges[1][0], ranges[1][1], "other", "a")]
    ips = [ip for r in ranges for ip in (r[0] - 1, r[0], r[1], r[1] + 1)] + [None] * 50 + [0, top - 70_001]
    df = spark.createDataFrame(list(enumerate(ips)), "n int, ip bigint").repartition(4)
    table = spark.createDataFrame(ranges, S.IP_RANGE_SCHEMA).select("begin_ip", "end_ip", "country")
    holding = {n: [r for r in ranges if ip is not None and r[0] <= ip <= r[1]] for n, ip in enumerate(ips)}
    every = join_ip_range(df, table, "ip", max_rows=max_rows, overlaps="every")
    assert sorted((r.n, r.country or "") for r in every.collect()) == sorted(
        (n, c) for n, held in holding.items() for c in [r[2] for r in held] or [""])
    last = join_ip_range(df, table, "ip", max_rows=max_rows, overlaps="last")
    assert sorted((r.n, r.country or "") for r in last.collect()) == [
        (n, max(held, key=lambda r: (r[0], -r[1], r[2]))[2] if held else "") for n, held in holding.items()]
    for joined in (every, last):
        assert "NestedLoop" not in plan(joined) and "Cartesian" not in plan(joined)
    with pytest.raises(ValueError, match="overlaps is one of"):
        join_ip_range(df, table, "ip", overlaps="some")


SMALL_DRIVER = """
import sys
from pyspark.sql import SparkSession
from visitlake.operators.ip_ranges import join_ip_range

spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
begin = 167772160
# three wide ranges over each other, filed under 750,000 prefixes, with texts of 100 letters
ranges = spark.range(3).selectExpr(f"{begin} + id * 256 as begin_ip", f"{begin} + id * 256 + 64000000 - 1 as end_ip", "repeat(cast(id as string), 100) as country")
rows = spark.range(1000).selectExpr("id", f"{begin} + id * 64064 as ip")
found = join_ip_range(rows, ranges, "ip", overlaps=sys.argv[1]).selectExpr("count(*) as n", "sum(cast(substr(country, 1, 1) as int)) as places")
print("plan", "BroadcastExchange" in found._jdf.queryExecution().executedPlan().toString())
print("found", *found.first())
"""


@pytest.mark.parametrize("how, want", [("last", "found 1000 1998"), ("every", "found 2998 2997")])
def test_overlapping_ranges_in_a_small_driver(tmp_path, how, want):
    """Ranges below the bounds for a broadcast, but for a driver that cannot hold them, are dealt out."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYTHONPATH": repo, "PYSPARK_SUBMIT_ARGS": "--driver-memory 512m pyspark-shell"}
    run = subprocess.run([sys.executable, "-c", SMALL_DRIVER, how], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "plan False" in run.stdout and want in run.stdout, run.stdout + run.stderr[-2000:]


@pytest.mark.parametrize("how", ["last", "every"])
def test_a_hot_prefix_is_split(spark, how):
    """Most addresses lie below one prefix of a table that is dealt out; lists of ranges carry nothing but what is looked up."""
    ranges = spark.createDataFrame([(n * 100, n * 100 + 149, f"c{n}") for n in range(100)], "begin_ip bigint, end_ip bigint, country string")
    ip = F.when(F.col("id") % 20 > 0, 130).otherwise(F.col("id") % 10_000)
    rows = spark.range(0, 200_000, 1, 8).select("id", ip.alias("ip"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.shuffle.partitions": "40"}
    former = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = join_ip_range(rows, ranges, "ip", max_rows=0, overlaps=how)
        assert len(joined.collect()) >= 200_000
        text = plan(joined)
        assert "SortMergeJoin(skew=true)" in text and "BroadcastHashJoin" not in text
    finally:
        for k, v in former.items():
            spark.conf.set(k, v)


def test_lists_of_ranges_hold_what_is_looked_up(spark):
    filed = spark.createDataFrame([(1, 256, 300, "a"), (1, 256, 511, "b")], "_prefix long, begin_ip long, end_ip long, v string")
    listed = _best_first(filed.select("_prefix", "begin_ip", "end_ip", F.struct("v").alias("_value")))
    assert [[tuple(r) for r in x._held] for x in listed.collect()] == [[(256, 300, ("a",)), (256, 511, ("b",))]]
