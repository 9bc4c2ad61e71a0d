"""New visitors per day, week and month of a run date over platform and browser roll-ups."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake import schema as S
from visitlake.functions.text import is_blank
from visitlake.functions.timeparts import (
    date_dimension, day_period, event_date, month_period, week_period,
)
from visitlake.operators.rollups import BROWSER_LEVELS, PLATFORM_LEVELS, level_label, normalise_name_version

GRAINS = {"day": day_period, "week": week_period, "month": month_period}


def with_date_buckets(events: DataFrame, run_date: date, tz: str = "UTC") -> DataFrame:
    """Adds `buckets`, one bit per grain (day 1, week 2, month 4) whose period of the run date holds the event."""
    s_time = F.col("s_time")
    bits = F.lit(0)
    for i, period in enumerate(GRAINS.values()):
        start, end = period(run_date).millis(tz)
        bits = bits + F.when((s_time >= start) & (s_time < end), 1 << i).otherwise(0)
    return events.withColumn("buckets", bits)


def launches(events: DataFrame, run_date: date, tz: str = "UTC") -> DataFrame:
    """Launch events with a platform and a visitor that fall into a period of the run date.

    Event kind and time range stay plain comparisons so that they reach the scan.
    """
    periods = [period(run_date).millis(tz) for period in GRAINS.values()]
    first, last = min(p[0] for p in periods), max(p[1] for p in periods)
    usable = usable_launches(events).filter((F.col("s_time") >= first) & (F.col("s_time") < last))
    return with_date_buckets(usable, run_date, tz).filter(F.col("buckets") > 0)


def usable_launches(events: DataFrame) -> DataFrame:
    """Launch events with a time, a platform and a visitor."""
    numbered = events.withColumn("s_time", F.col("s_time").try_cast("bigint"))
    return numbered.filter(
        (F.col("en") == S.LAUNCH) & F.col("s_time").isNotNull() & ~is_blank(F.col("pl")) & ~is_blank(F.col("u_ud"))
    )


def _same_label_twice(by_browser: bool) -> Column:
    """True on a level whose own value reads `all`, where a coarser level with the same labels covers its rows."""

    def own_all(name: str) -> Column:
        return (F.grouping(name) == 0) & (F.col(name) == S.ALL)

    whole_platform = (F.grouping("ver") == 1) & own_all("pl")
    twice = own_all("ver") | whole_platform
    return twice | own_all("browser_v") if by_browser else twice


def install_kpis(
    events: DataFrame, run_date: date, kpis: tuple[str, ...] = S.STATS_KPIS, tz: str = "UTC"
) -> DataFrame:
    """Distinct launch visitors per period, platform level and, for the browser KPI, browser level.

    One row per visitor and finest group is built first, with the periods as bits, so that the roll-up
    multiplies distinct visitors and not events. Every grouping carries the visitor until the last step,
    which spreads even the (all, all) level over tasks.
    """
    unknown = set(kpis) - set(S.STATS_KPIS)
    if unknown or not kpis:
        raise ValueError(f"no such KPI: {sorted(unknown)}")
    by_browser = S.KPI_BROWSER_NEW_USERS in kpis
    names = ["pl", "ver", *(["browser", "browser_v"] if by_browser else [])]
    labels = normalise_name_version("pl", "ver")
    if by_browser:
        labels |= normalise_name_version("browser", "browser_v")
    visitors = (
        launches(events, run_date, tz).withColumns(labels)
        .groupBy(*names, "u_ud").agg(F.bit_or("buckets").alias("buckets"))
    )

    rolled = count_levels(visitors, "u_ud", kpis, [F.bit_or("buckets").alias("buckets")])
    counted = rolled.groupBy("kpi_name", *S.PLATFORM_KEYS, *S.BROWSER_KEYS).agg(
        *[F.count_if(F.col("buckets").bitwiseAND(1 << i) != 0).alias(g) for i, g in enumerate(GRAINS)]
    )
    return period_rows(counted, run_date)


def count_levels(finest: DataFrame, subject: str, kpis: tuple[str, ...], merged: list[Column]) -> DataFrame:
    """Rows of every platform level and, for the browser KPI, browser level: `merged` of each subject, under its labels.

    `finest` has platform and, where needed, browser as normalised, and the subject, which every grouping carries.
    """
    by_browser = S.KPI_BROWSER_NEW_USERS in kpis
    names = ["pl", "ver", *(["browser", "browser_v"] if by_browser else [])]
    levels = []
    if S.KPI_NEW_USERS in kpis:
        levels += [(*p, subject) for p in PLATFORM_LEVELS]
    if by_browser:
        levels += [(*p, *b, subject) for p in PLATFORM_LEVELS for b in BROWSER_LEVELS]
    no_browser = F.grouping("browser") == 1 if by_browser else F.lit(True)
    empty = F.lit("")
    return (
        finest.groupingSets(levels, *names, subject)
        .agg(
            *merged,
            _same_label_twice(by_browser).alias("_twice"),
            F.when(no_browser, F.lit(S.KPI_NEW_USERS)).otherwise(F.lit(S.KPI_BROWSER_NEW_USERS)).alias("kpi_name"),
            level_label("pl").alias("platform_name"),
            level_label("ver").alias("platform_version"),
            (F.when(no_browser, empty).otherwise(F.col("browser")) if by_browser else empty).alias("browser_name"),
            (F.when(no_browser, empty).otherwise(level_label("browser_v")) if by_browser else empty)
            .alias("browser_version"),
        )
        .filter(~F.col("_twice"))
    )


def period_rows(counted: DataFrame, run_date: date) -> DataFrame:
    """One row per group and grain whose count is above zero, with the period's date columns."""
    day = F.lit(run_date)
    periods = F.array(*[
        F.struct(date_dimension(day, g).alias("period"), F.col(g).alias("new_install_users")) for g in GRAINS
    ])
    return (
        counted.select("kpi_name", *S.PLATFORM_KEYS, *S.BROWSER_KEYS, F.inline(periods))
        .filter(F.col("new_install_users") > 0)
        .select(
            *[F.col("period")[k].alias(k) for k in S.DATE_KEYS],
            *S.PLATFORM_KEYS, "kpi_name", *S.BROWSER_KEYS, "new_install_users",
        )
    )


def new_install_users(events: DataFrame, run_date: date, tz: str = "UTC") -> DataFrame:
    return install_kpis(events, run_date, (S.KPI_NEW_USERS,), tz).drop(*S.BROWSER_KEYS)


def browser_new_install_users(events: DataFrame, run_date: date, tz: str = "UTC") -> DataFrame:
    return install_kpis(events, run_date, (S.KPI_BROWSER_NEW_USERS,), tz)


def activity_active_users(events: DataFrame, tz: str = "UTC") -> DataFrame:
    """Distinct visitors per activity (category, action) and date."""
    active = events.filter(F.col("en") == S.ACTIVITY).withColumn("date", event_date(F.col("s_time"), tz))
    return active.groupBy("ca", "ac", "date").agg(F.countDistinct("u_ud").alias("active_users"))


def sort_stats(stats: DataFrame) -> DataFrame:
    """Rows in the order of their composite key: date, platform, KPI, browser."""
    keys = [*S.DATE_KEYS[:5], "type", *S.PLATFORM_KEYS, *S.KPI_KEYS, *S.BROWSER_KEYS]
    return stats.orderBy(*[k for k in keys if k in stats.columns])
