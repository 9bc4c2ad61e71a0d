"""Hourly KPIs over platform roll-ups, and their pivot to one column per hour."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake import schema as S
from visitlake.functions.timeparts import event_date, event_hour
from visitlake.operators.rollups import PLATFORM_LEVELS, level_label

_EPOCH = date(1970, 1, 1)

# What is counted per hour: event kind, identifying column and the KPIs read off it.
_SUBJECTS = (
    (S.LAUNCH, "u_ud", (S.KPI_HOURLY_NEW_USERS,)),
    (S.PAGE_VIEW, "u_ud", (S.KPI_ACTIVE_USERS,)),
    (S.PAGE_VIEW, "u_sd", (S.KPI_SESSIONS, S.KPI_SESSION_LENGTH)),
)


# What tells subjects of an hour apart; `slot` is the hour's number.
SUBJECT_KEYS = ["subject", "pl", "ver", "slot", "id"]


def stage_hourly(events: DataFrame, tz: str = "UTC") -> DataFrame:
    """Page views and launches with their date and hour."""
    s_time = F.col("s_time").cast("bigint")
    return events.filter(F.col("en").isin(S.PAGE_VIEW, S.LAUNCH)).select(
        "pl", "ver", "en", s_time.alias("s_time"), "u_ud", "u_sd",
        event_hour(s_time, tz).alias("hour"), event_date(s_time, tz).alias("date"),
    )


def hourly_kpis(events: DataFrame, kpis: tuple[str, ...] = S.HOURLY_KPIS, tz: str = "UTC") -> DataFrame:
    """Long table (pl, ver, date, hour, kpi, value) of the asked KPIs, from one pass over the events.

    Each event stands for the subjects it tells about. Subjects shrink to one row per finest group with
    their first and last time, then roll up to the three platform levels. A level recomputes the span of
    each of its sessions, so levels do not add up. Null platforms and versions form groups of their own.
    """
    return kpis_of_subjects(hourly_subjects(events, kpis, tz), kpis)


def _wanted(kpis: tuple[str, ...]) -> dict[int, tuple]:
    unknown = set(kpis) - set(S.HOURLY_KPIS)
    if unknown or not kpis:
        raise ValueError(f"no such KPI: {sorted(unknown)}")
    return {code: v for code, v in enumerate(_SUBJECTS) if set(v[2]) & set(kpis)}


def hourly_subjects(events: DataFrame, kpis: tuple[str, ...] = S.HOURLY_KPIS, tz: str = "UTC") -> DataFrame:
    """SUBJECT_KEYS of what the KPIs count, with first and last time: one row per subject, platform, version and hour.

    Rows of several sets of events merge by `merge_subjects` to the rows of all of them.
    """
    wanted = _wanted(kpis)
    staged = stage_hourly(events, tz).filter(F.col("en").isin(sorted({v[0] for v in wanted.values()})))
    subjects = None
    for en in sorted({v[0] for v in wanted.values()}):
        told = F.array(*[
            F.struct(F.lit(code).cast("tinyint").alias("subject"), F.col(c).alias("id"))
            for code, (e, c, _) in wanted.items() if e == en
        ])
        subjects = (F.when if subjects is None else subjects.when)(F.col("en") == en, told)
    # short keys: a code for the subject and one number for date and hour
    slot = F.datediff("date", F.lit(_EPOCH)) * 24 + F.col("hour")
    return (
        staged.select("pl", "ver", slot.alias("slot"), "s_time", F.inline(subjects))
        .groupBy(*SUBJECT_KEYS).agg(F.min("s_time").alias("first"), F.max("s_time").alias("last"))
    )


def merge_subjects(subjects: DataFrame) -> DataFrame:
    """One row per subject of rows that several sets of events gave."""
    return subjects.groupBy(*SUBJECT_KEYS).agg(F.min("first").alias("first"), F.max("last").alias("last"))


def kpis_of_subjects(finest: DataFrame, kpis: tuple[str, ...] = S.HOURLY_KPIS) -> DataFrame:
    """The KPIs of `hourly_subjects`, hour by hour; an hour's values follow from its subjects alone."""
    wanted = _wanted(kpis)
    levels = [("subject", *p, "slot", "id") for p in PLATFORM_LEVELS]
    rolled = finest.groupingSets(levels, *SUBJECT_KEYS).agg(
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.grouping_id().alias("level"), level_label("pl").alias("_pl"), level_label("ver").alias("_ver"),
    )
    counted = rolled.groupBy("subject", "level", "_pl", "_ver", "slot").agg(
        F.count("id").alias("ids"),
        F.expr("sum(last - first) div 1000").alias("seconds"),
    )
    values = None
    for code, (_, _, names) in wanted.items():
        rows = F.array(*[
            F.struct(
                F.lit(k).alias("kpi"),
                (F.col("seconds") if k == S.KPI_SESSION_LENGTH else F.col("ids")).cast("bigint").alias("value"),
            )
            for k in names if k in kpis
        ])
        values = (F.when if values is None else values.when)(F.col("subject") == code, rows)
    return counted.select(
        F.col("_pl").alias("pl"), F.col("_ver").alias("ver"),
        F.date_add(F.lit(_EPOCH), F.floor(F.col("slot") / 24).cast("int")).alias("date"),
        F.pmod("slot", F.lit(24)).alias("hour"), F.inline(values),
    )


def hourly_active_users(events: DataFrame, tz: str = "UTC") -> DataFrame:
    return hourly_kpis(events, (S.KPI_ACTIVE_USERS,), tz)


def hourly_new_users(events: DataFrame, tz: str = "UTC") -> DataFrame:
    return hourly_kpis(events, (S.KPI_HOURLY_NEW_USERS,), tz)


def hourly_session_count(events: DataFrame, tz: str = "UTC") -> DataFrame:
    return hourly_kpis(events, (S.KPI_SESSIONS,), tz)


def hourly_session_length(events: DataFrame, tz: str = "UTC") -> DataFrame:
    return hourly_kpis(events, (S.KPI_SESSION_LENGTH,), tz)


def pivot_hours(hourly: DataFrame) -> DataFrame:
    """One row per (pl, ver, date, kpi) with the value of each hour, 0 where there is none."""
    cells = [
        F.max(F.when(F.col("hour") == h, F.col("value")).otherwise(0)).cast("bigint").alias(name)
        for h, name in enumerate(S.HOUR_COLUMNS)
    ]
    return hourly.groupBy("pl", "ver", "date", "kpi").agg(*cells)
