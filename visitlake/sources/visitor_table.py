"""Stored visitor bitmaps by day of the event table, and the numbers that visitors have in them.

`<root>/visitors` holds the numbers, each given once and kept; `<root>/days` holds a part per day, with the number of the
day's manifest that it was made from.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.operators.dimensions import assign_dim_ids
from visitlake.operators.visitor_days import DAY_COLUMNS, launch_visitors, visitor_bitmaps
from visitlake.sources.files import delete, exists, read_text, staged, write_text
from visitlake.sources.readers import current_version, read_periods
from visitlake.sources.writers import next_version, try_version, write_periods

_DAY_SCHEMA = "event_date date, pl string, ver string, browser string, browser_v string, page bigint, bits binary"


def _table(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _version_file(root: str, day: date) -> str:
    return f"{_table(root, 'days')}/period={day.isoformat()}/_made_from"


def day_version(spark: SparkSession, root: str, day: date) -> int | None:
    """Number of the manifest that a day's bitmaps were made from; None where there are none."""
    path = _version_file(root, day)
    return int(read_text(spark, path)) if exists(spark, path) else None


def number_visitors(spark: SparkSession, root: str, visitors: DataFrame) -> DataFrame:
    """(id, u_ud) of all visitors ever seen, after numbering the new ones; safe beside other writers."""
    table = _table(root, "visitors")
    while True:
        number = next_version(spark, table)
        path = current_version(spark, table)
        known = spark.read.parquet(path) if path else spark.createDataFrame([], "id int, u_ud string")
        if path and visitors.join(known, "u_ud", "left_anti").isEmpty():
            return known
        path = try_version(assign_dim_ids(known, visitors, ["u_ud"]), table, number)
        if path:
            return spark.read.parquet(path)


def write_visitor_days(events: DataFrame, root: str, days: dict[date, int], tz: str = "UTC") -> None:
    """Replaces the bitmaps of some days (`dt`) by those of their events; `days` names each day's manifest number."""
    spark = events.sparkSession
    chosen = events.filter(F.col("dt").isin([F.lit(d) for d in days]))
    visitors, path = staged(launch_visitors(chosen, tz), "day-visitors")
    try:
        numbers = number_visitors(spark, root, visitors.select("u_ud").distinct())
        write_periods(visitor_bitmaps(visitors, numbers), _table(root, "days"), "dt", tuple(d.isoformat() for d in days))
        for d, number in days.items():
            write_text(spark, _version_file(root, d), str(number))
    finally:
        delete(spark, path)


def read_visitor_days(spark: SparkSession, root: str, days: list[date]) -> DataFrame:
    """DAY_COLUMNS of some days."""
    stored = read_periods(spark, _table(root, "days"), [d.isoformat() for d in days])
    return spark.createDataFrame([], _DAY_SCHEMA) if stored is None else stored.select(*DAY_COLUMNS)
