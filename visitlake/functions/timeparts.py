"""Calendar arithmetic on epoch milliseconds and dates.

Weeks start on Sunday and the week holding 1 January is week 1; December days of that week are
labelled 53. Every function takes its time zone as an argument, so results never depend on the session.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlake.schema import DATE_GRAINS

DAY_MS = 86_400_000
HOUR_MS = 3_600_000
RUN_DATE_PATTERN = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"


# ------------------------------------------------------------------ columns


def _epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def _is_utc(tz: str) -> bool:
    return tz.upper() in ("UTC", "Z", "ETC/UTC")


def local_time(ms: Column, tz: str = "UTC") -> Column:
    """Wall-clock time (timestamp without zone) of epoch milliseconds in `tz`."""
    zero = F.lit(0)
    utc = _epoch() + F.make_dt_interval(zero, zero, zero, (ms / F.lit(1000).cast("decimal(10,0)")).cast("decimal(18,6)"))
    return utc if _is_utc(tz) else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def event_date(ms: Column, tz: str = "UTC") -> Column:
    if _is_utc(tz):
        days = (ms - F.pmod(ms, F.lit(DAY_MS))) / DAY_MS
        return F.date_add(F.lit(date(1970, 1, 1)), days.cast("int"))
    return local_time(ms, tz).cast("date")


def event_hour(ms: Column, tz: str = "UTC") -> Column:
    if _is_utc(tz):
        return F.floor(F.pmod(ms, F.lit(DAY_MS)) / HOUR_MS).cast("int")
    return F.hour(local_time(ms, tz))


def midnight_millis(d: Column, tz: str = "UTC") -> Column:
    """Epoch milliseconds of the start of day `d` in `tz`."""
    if _is_utc(tz):
        return F.datediff(d, F.lit(date(1970, 1, 1))).cast("bigint") * DAY_MS
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), d.cast("timestamp_ntz"))
    return F.timestamp_diff("MILLISECOND", _epoch(), utc)


def is_valid_run_date(c: Column) -> Column:
    """True for text shaped yyyy-MM-dd that names an existing day."""
    return F.coalesce(c.rlike(f"^{RUN_DATE_PATTERN}$") & c.try_cast("date").isNotNull(), F.lit(False))


def date_to_millis(c: Column, pattern: str = "yyyy-MM-dd", tz: str = "UTC") -> Column:
    """Text of a date or a date and time in `tz` -> epoch milliseconds; unreadable text gives null.

    For the two day patterns the month and day may run over (2015-02-30 is 2 March); a pattern without a time
    means midnight.
    """
    if pattern in ("yyyy-MM-dd", "yyyyMMdd"):
        sep = "-" if pattern == "yyyy-MM-dd" else ""
        shape = f"^([0-9]{{4}}){sep}([0-9]{{2}}){sep}([0-9]{{2}})$"
        year, month, day = (F.regexp_extract(c, shape, g).try_cast("int") for g in (1, 2, 3))
        d = F.date_add(F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1), day - 1)
        return midnight_millis(F.when(c.rlike(shape), d), tz)
    # read as if in UTC, whatever the session's zone, then as wall-clock time of `tz`
    utc = F.unix_millis(F.try_to_timestamp(F.concat(c, F.lit(" +00:00")), F.lit(f"{pattern} XXX")))
    return utc if _is_utc(tz) else F.timestamp_diff("MILLISECOND", _epoch(), F.convert_timezone(F.lit(tz), F.lit("UTC"), local_time(utc)))


def format_millis(ms: Column, pattern: str = "yyyy-MM-dd", tz: str = "UTC") -> Column:
    return F.date_format(local_time(ms, tz), pattern)


def week_of_year(d: Column) -> Column:
    """Sunday-based week number, 1 to 53 (December days of week 1 of the next year are in 53)."""
    first_weekday = F.dayofweek(F.trunc(d, "year"))
    return F.least(F.lit(53), (F.floor((F.dayofyear(d) + first_weekday - 2) / 7) + 1).cast("int"))


def season(d: Column) -> Column:
    return F.quarter(d)


def date_part(d: Column, grain: str) -> Column:
    """One calendar part of a date; the hour needs milliseconds, see `event_hour`."""
    parts = {
        "year": F.year, "season": season, "month": F.month, "week": week_of_year, "day": F.dayofmonth,
    }
    if grain not in parts:
        raise ValueError(f"no such date part: {grain}")
    return parts[grain](d)


def shift_days(d: Column, n: int) -> Column:
    return F.date_add(d, n)


def week_start(d: Column) -> Column:
    return F.date_sub(d, F.dayofweek(d) - 1)


def next_week_start(d: Column) -> Column:
    return F.date_add(week_start(d), 7)


def prev_week_start(d: Column) -> Column:
    return F.date_sub(week_start(d), 7)


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def next_month_start(d: Column) -> Column:
    return F.add_months(month_start(d), 1)


def prev_month_start(d: Column) -> Column:
    return F.add_months(month_start(d), -1)


def yesterday(tz: str = "UTC") -> Column:
    """Yesterday by the cluster's clock, read in `tz`."""
    return F.date_sub(event_date(F.unix_millis(F.current_timestamp()), tz), 1)


def arrival_date(tz: str = "UTC") -> Column:
    """Today by the cluster's clock, read in `tz`; one value per batch of a stream."""
    return event_date(F.unix_millis(F.current_timestamp()), tz)


def date_dimension(d: Column, grain: str) -> Column:
    """Struct (year, season, month, week, day, type, calendar) of the period of `grain` holding `d`.

    Parts finer than the grain are 0 and `calendar` is the first day of the period. A week takes all
    its parts from its Sunday, so a week that crosses the new year belongs to the old one.
    """
    if not DATE_GRAINS.get(grain, False):
        raise ValueError(f"no date dimension for grain: {grain}")
    start = {
        "year": F.trunc(d, "year"), "season": F.trunc(d, "quarter"), "month": month_start(d),
        "week": week_start(d), "day": d,
    }[grain]
    zero = F.lit(0)
    has_season, has_month = grain != "year", grain in ("month", "week", "day")
    return F.struct(
        F.year(start).alias("year"),
        (season(start) if has_season else zero).alias("season"),
        (F.month(start) if has_month else zero).alias("month"),
        (week_of_year(start) if grain in ("week", "day") else zero).alias("week"),
        (F.dayofmonth(start) if grain == "day" else zero).alias("day"),
        F.lit(grain).alias("type"),
        start.alias("calendar"),
    )


# ------------------------------------------------------- driver-side dates


@dataclass(frozen=True)
class Period:
    """Half-open range of days [start, end)."""

    start: date
    end: date

    def millis(self, tz: str = "UTC") -> tuple[int, int]:
        return day_start_millis(self.start, tz), day_start_millis(self.end, tz)


def day_start_millis(d: date, tz: str = "UTC") -> int:
    zone = timezone.utc if _is_utc(tz) else ZoneInfo(tz)
    return int(datetime.combine(d, time(), zone).timestamp() * 1000)


def day_period(d: date) -> Period:
    return Period(d, d + timedelta(days=1))


def week_period(d: date) -> Period:
    sunday = d - timedelta(days=d.isoweekday() % 7)
    return Period(sunday, sunday + timedelta(days=7))


def month_period(d: date) -> Period:
    first = d.replace(day=1)
    return Period(first, (first + timedelta(days=32)).replace(day=1))


def scan_window(run_date: date, today: date) -> Period:
    """Days of events a KPI run reads.

    Starts at the earlier of week and month start. Once the week or the month of the run date is over
    the window reaches the later of both ends; until then it stops after the run date.
    """
    week, month = week_period(run_date), month_period(run_date)
    tomorrow = today + timedelta(days=1)
    closed = tomorrow > week.end or tomorrow > month.end
    return Period(min(week.start, month.start), max(week.end, month.end) if closed else day_period(run_date).end)


def resolve_run_date(arg: str | None, today: date) -> date:
    """Run date of a job: the argument, or yesterday when it is missing or not shaped yyyy-MM-dd.

    A well-shaped date that does not exist is an error.
    """
    if arg is None or not re.fullmatch(RUN_DATE_PATTERN, arg):
        return today - timedelta(days=1)
    return date.fromisoformat(arg)
