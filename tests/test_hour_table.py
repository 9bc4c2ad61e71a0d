"""Hourly values by increments: late files, replaced files, runs that are repeated."""

import random
from datetime import date

from pyspark.sql import functions as F

from visitlake import schema as S
from visitlake.operators.hourly import hourly_kpis
from visitlake.plans.jobs import run_hourly, run_hourly_increment
from visitlake.sources.event_table import put_events
from visitlake.sources.hour_table import merge_hours, read_hours
from visitlake.sources.readers import read_event_logs

DAY, NEXT = date(2024, 1, 10), date(2024, 1, 11)
MIDNIGHT = 1_704_844_800_000


def events(spark, seed, hours, n=400):
    rnd = random.Random(seed)
    rows = [(
        MIDNIGHT + rnd.choice(hours) * 3_600_000 + rnd.randint(0, 3_599_999), rnd.choice(["e_l", "e_pv", "e_pv", "e_e"]),
        rnd.choice(["website", "java_server", None]), rnd.choice(["1", "2", None]), rnd.choice([*(f"u{i}" for i in range(20)), None]),
        rnd.choice([*(f"s{i}" for i in range(9)), None]),
    ) for _ in range(n)]
    short = spark.createDataFrame(rows, "s_time bigint, en string, pl string, ver string, u_ud string, u_sd string")
    others = [F.lit(None).cast(S.EVENT_SCHEMA[c].dataType).alias(c) for c in S.EVENT_COLUMNS if c not in short.columns]
    return short.select("*", *others, F.lit(DAY).alias("dt"))


def text(df):
    return sorted(map(repr, df.collect()))


def test_increments_equal_a_full_run(spark, tmp_path):
    root, facts, state = (str(tmp_path / n) for n in ("events", "facts", "state"))
    run = lambda: run_hourly_increment(spark, root, facts, state, DAY)
    full = lambda: hourly_kpis(read_event_logs(spark, root, DAY, NEXT))
    files = lambda: {str(p) for p in (tmp_path / "state").rglob("part-*.parquet")}
    hour = lambda h: MIDNIGHT // 3_600_000 + h

    put_events(events(spark, 1, range(24)), root, "first")
    report, changed = run()
    assert changed == [hour(h) for h in range(24)] and text(read_hours(spark, state, DAY)) == text(full())
    before = files()
    put_events(events(spark, 2, [3, 4], 90), root, "late")
    report, changed = run()
    assert changed == [hour(3), hour(4)] and text(read_hours(spark, state, DAY)) == text(full())
    assert {f.split("period=")[1].split("/")[0] for f in files() - before} == {f"{DAY}_{hour(3)}", f"{DAY}_{hour(4)}"}
    assert text(report) == text(run_hourly(spark, root, facts, DAY))
    assert run()[1] == [] and text(read_hours(spark, state, DAY)) == text(full())
    # a replaced file may take subjects away, hours among them
    put_events(events(spark, 3, range(12), 200), root, "first")
    assert run()[1] == [hour(h) for h in range(12)] and text(read_hours(spark, state, DAY)) == text(full())


def test_merging_twice_changes_nothing(spark, tmp_path):
    from visitlake.operators.hourly import hourly_subjects

    subjects = hourly_subjects(events(spark, 7, range(6)))
    merge_hours(subjects, str(tmp_path), DAY)
    once = text(read_hours(spark, str(tmp_path), DAY))
    merge_hours(subjects.filter("slot % 2 = 0"), str(tmp_path), DAY)
    assert text(read_hours(spark, str(tmp_path), DAY)) == once == text(hourly_kpis(events(spark, 7, range(6))))


def test_a_day_without_events(spark, tmp_path):
    root, facts, state = (str(tmp_path / n) for n in ("events", "facts", "state"))
    put_events(events(spark, 1, [5]).limit(0), root, "batch", always=DAY)
    report, changed = run_hourly_increment(spark, root, facts, state, DAY)
    assert changed == [] and report.count() == 0 and read_hours(spark, state, DAY).count() == 0
