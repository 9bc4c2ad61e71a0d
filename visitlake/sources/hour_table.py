"""Stored subjects of each hour of a day's events, and the hourly values that follow from them.

`<root>/subjects` and `<root>/values` have a part per day of the event table and hour. `<root>/merged` names, per day, the
slots and labels of the event table that went into it. Merging is by distinct rows, so a part that is merged twice, as after a
failure between the writes, changes nothing.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.operators.hourly import kpis_of_subjects, merge_subjects
from visitlake.sources.files import claim, delete, exists, matching, read_text, staged, write_text
from visitlake.sources.readers import read_periods
from visitlake.sources.writers import write_periods

_VALUE_SCHEMA = "pl string, ver string, date date, hour int, kpi string, value bigint"


def _table(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _periods(spark: SparkSession, root: str, day: date) -> set[str]:
    """Parts of a day that are there."""
    return {p.rsplit("=", 1)[1] for p in matching(spark, f"{_table(root, 'subjects')}/period={day.isoformat()}_*")}


def merged_slots(spark: SparkSession, root: str, day: date) -> dict[str, str]:
    path = f"{_table(root, 'merged')}/{day.isoformat()}"
    return json.loads(read_text(spark, path)) if exists(spark, path) else {}


def set_merged_slots(spark: SparkSession, root: str, day: date, slots: dict[str, str]) -> None:
    path = f"{_table(root, 'merged')}/{day.isoformat()}"
    write_text(spark, f"{path}.new", json.dumps(slots, sort_keys=True))
    delete(spark, path)
    if not claim(spark, f"{path}.new", path):
        raise OSError(f"two runs write {path}")


def merge_hours(subjects: DataFrame, root: str, day: date, anew: bool = False) -> list[int]:
    """Merges a day's new subjects into those stored and counts their hours again; returns those hours' numbers.

    `anew` forgets what is stored of the day first. Hours without new subjects are neither read nor written otherwise.
    """
    spark, text = subjects.sparkSession, day.isoformat()
    part = f"concat('{text}_', slot)"
    fresh, path = staged(subjects, "hour-subjects")
    try:
        changed = sorted(r[0] for r in fresh.select("slot").distinct().collect())
        names = [f"{text}_{slot}" for slot in changed]
        cleared = tuple(sorted(_periods(spark, root, day))) if anew else ()
        stored = None if anew else read_periods(spark, _table(root, "subjects"), names)
        merged = merge_subjects(fresh if stored is None else fresh.unionByName(stored.select(*fresh.columns)))
        write_periods(merged, _table(root, "subjects"), part, cleared)
        again = read_periods(spark, _table(root, "subjects"), names)
        hour = F.datediff("date", F.lit(date(1970, 1, 1))) * 24 + F.col("hour")
        if again is None:
            values = spark.createDataFrame([], _VALUE_SCHEMA)
        else:
            values = kpis_of_subjects(again.select(*fresh.columns))
        write_periods(values.withColumn("slot", hour), _table(root, "values"), part, cleared)
        return changed
    finally:
        delete(spark, path)


def read_hours(spark: SparkSession, root: str, day: date) -> DataFrame:
    """Long hourly table (pl, ver, date, hour, kpi, value) of a day's events."""
    stored = read_periods(spark, _table(root, "values"), sorted(_periods(spark, root, day)))
    empty = spark.createDataFrame([], _VALUE_SCHEMA)
    return empty if stored is None else stored.select(*empty.columns)
