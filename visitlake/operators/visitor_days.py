"""Visitors of single days as exact bitmaps, which merge to the visitors of weeks and months.

Every visitor has a number. A day's launches become one bitmap per event date, platform, browser and page of 32,768
visitor numbers. Bitmaps of several days are merged bit by bit, so a visitor of many days counts once, and roll-ups merge
them further; no day is read from its events again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake import schema as S
from visitlake.functions.timeparts import event_date
from visitlake.operators.rollups import normalise_name_version
from visitlake.operators.visitors import GRAINS, count_levels, period_rows, usable_launches

FINEST = ["pl", "ver", "browser", "browser_v"]
DAY_COLUMNS = ["event_date", *FINEST, "page", "bits"]


def launch_visitors(events: DataFrame, tz: str = "UTC") -> DataFrame:
    """Distinct (dt, event_date, platform, browser, u_ud) of the event table's launches; names as `install_kpis` has them."""
    labels = normalise_name_version("pl", "ver") | normalise_name_version("browser", "browser_v")
    dated = usable_launches(events).withColumn("event_date", event_date(F.col("s_time"), tz))
    return dated.withColumns(labels).select("dt", "event_date", *FINEST, "u_ud").distinct()


def visitor_bitmaps(visitors: DataFrame, numbers: DataFrame) -> DataFrame:
    """dt and DAY_COLUMNS of `launch_visitors`, all of whose numbers are in `numbers` (id, u_ud)."""
    id_ = F.col("id").cast("bigint")
    numbered = visitors.join(numbers, "u_ud").select(
        "dt", "event_date", *FINEST, F.bitmap_bucket_number(id_).alias("page"), F.bitmap_bit_position(id_).alias("bit")
    )
    return numbered.groupBy("dt", "event_date", *FINEST, "page").agg(F.bitmap_construct_agg("bit").alias("bits"))


def install_kpis_of_days(days: DataFrame, run_date: date, kpis: tuple[str, ...] = S.STATS_KPIS) -> DataFrame:
    """What `install_kpis` gives for the events that the days' bitmaps stand for."""
    day = F.col("event_date")
    merged = []
    for grain, period in GRAINS.items():
        p = period(run_date)
        inside = f"event_date >= date'{p.start.isoformat()}' and event_date < date'{p.end.isoformat()}'"
        merged.append(F.expr(f"bitmap_or_agg(bits) filter (where {inside})").alias(grain))
    starts, ends = zip(*((period(run_date).start, period(run_date).end) for period in GRAINS.values()))
    near = days.filter((day >= F.lit(min(starts))) & (day < F.lit(max(ends))))
    # the days first, so that roll-ups multiply merged pages and not days
    finest = near.groupBy(*FINEST, "page").agg(*merged)
    rolled = count_levels(finest, "page", kpis, [F.expr(f"bitmap_or_agg({g}) filter (where {g} is not null)").alias(g) for g in GRAINS])
    counted = rolled.groupBy("kpi_name", *S.PLATFORM_KEYS, *S.BROWSER_KEYS).agg(
        *[F.coalesce(F.sum(F.bitmap_count(g)), F.lit(0)).cast("bigint").alias(g) for g in GRAINS]
    )
    return period_rows(counted, run_date)
