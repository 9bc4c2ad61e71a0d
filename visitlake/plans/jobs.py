"""End-to-end jobs over stored tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake import schema as S
from visitlake.functions.timeparts import scan_window
from visitlake.operators.dimensions import hourly_dimension_rows, to_stats_hourly
from visitlake.operators.hourly import hourly_kpis, hourly_subjects
from visitlake.operators.lines import (
    classify_events, parse_log_lines, rejected_lines, to_event_rows, valid_events,
)
from visitlake.operators.visitor_days import install_kpis_of_days
from visitlake.operators.visitors import install_kpis
from visitlake.sources.event_table import day_dir, has_day, live_paths, manifest_number, read_manifest, read_paths
from visitlake.sources.files import delete, staged
from visitlake.sources.hour_table import merge_hours, merged_slots, read_hours, set_merged_slots
from visitlake.sources.visitor_table import day_version, read_visitor_days, write_visitor_days
from visitlake.sources.readers import read_event_logs, read_hourly, read_raw_logs
from visitlake.sources.writers import (
    export_tsv, update_dimension, write_event_logs, write_facts, write_periods, write_rejected_lines,
)


def etl(
    lines: DataFrame,
    ip_ranges: DataFrame | None = None,
    tz: str = "UTC",
    strict: bool = False,
    protect_reserved: bool = False,
    **join_options,
) -> tuple[DataFrame, DataFrame]:
    """Raw lines -> (event rows, classified lines). `join_options` go to the range lookup."""
    classified = classify_events(parse_log_lines(lines, protect_reserved=protect_reserved), strict)
    return to_event_rows(valid_events(classified), ip_ranges, tz, **join_options), classified


def run_etl(
    spark: SparkSession,
    raw_root: str,
    event_root: str,
    run_date: date,
    ip_ranges: DataFrame | None = None,
    rejected_root: str | None = None,
    tz: str = "UTC",
    strict: bool = False,
    protect_reserved: bool = False,
    **join_options,
) -> dict[str, int]:
    """Replaces the event table of `run_date` and returns line counts: all, and per reject reason.

    Lines are parsed and judged once; the outcome is stored in the shared scratch folder while the job runs, and counts,
    events and (where `rejected_root` is given) rejected lines all come from there. `join_options` go to the range lookup.
    """
    lines = read_raw_logs(spark, raw_root, run_date)
    classified = classify_events(parse_log_lines(lines, protect_reserved=protect_reserved), strict)
    rejected = F.col("reject_reason").isNotNull()
    judged, path = staged(classified.select(
        F.when(rejected, F.col("value")).alias("value"), F.when(~rejected, F.col("fields")).alias("fields"), "reject_reason"
    ), "classified-lines")
    try:
        counts = judged.agg(
            F.count(F.lit(1)).alias("lines"), *[F.count_if(F.col("reject_reason") == r).alias(r) for r in S.REJECT_REASONS]
        ).first().asDict()
        write_event_logs(to_event_rows(valid_events(judged), ip_ranges, tz, **join_options), event_root, run_date)
        if rejected_root:
            write_rejected_lines(rejected_lines(judged), rejected_root, run_date)
    finally:
        delete(spark, path)
    return {k: int(v) for k, v in counts.items()}


def run_kpis(
    spark: SparkSession, event_root: str, fact_root: str, run_date: date, today: date, tz: str = "UTC"
) -> dict[str, DataFrame]:
    """Counts new visitors of the run date's day, week and month and upserts both fact tables."""
    window = scan_window(run_date, today)
    events = read_event_logs(spark, event_root, window.start, window.end)
    # stored once, since ids and both fact tables read it again
    kpis, path = staged(install_kpis(events, run_date, tz=tz), "install-kpis")
    try:
        return write_facts(spark, fact_root, kpis, run_date)
    finally:
        delete(spark, path)


def run_kpis_by_days(
    spark: SparkSession, event_root: str, fact_root: str, day_root: str, run_date: date, today: date, tz: str = "UTC"
) -> tuple[dict[str, DataFrame], list[date]]:
    """As `run_kpis`, from stored visitor bitmaps of single days; also returns the days whose events were read.

    Read are only days whose bitmaps are missing or older than the day's manifest: in a daily run the newest day, and a
    past one only if late events came. Weeks and months are merged from bitmaps.
    """
    window = scan_window(run_date, today)
    days = [window.start + timedelta(days=n) for n in range((window.end - window.start).days)]
    there = {d: manifest_number(spark, event_root, d) for d in days if has_day(spark, event_root, d)}
    if not there:
        raise FileNotFoundError(f"no events from {window.start} to {window.end} under {event_root}")
    stale = [d for d, number in there.items() if day_version(spark, day_root, d) != number]
    for first, last in _runs(stale):
        events = read_event_logs(spark, event_root, first, last + timedelta(days=1))
        write_visitor_days(events, day_root, {d: there[d] for d in stale if first <= d <= last}, tz)
    stored = read_visitor_days(spark, day_root, sorted(there))
    kpis, path = staged(install_kpis_of_days(stored, run_date), "install-kpis")
    try:
        return write_facts(spark, fact_root, kpis, run_date), stale
    finally:
        delete(spark, path)


def _runs(days: list[date]) -> list[tuple[date, date]]:
    """First and last day of each run of consecutive days."""
    runs: list[tuple[date, date]] = []
    for day in sorted(days):
        if runs and day - runs[-1][1] == timedelta(days=1):
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((day, day))
    return runs


def run_hourly(
    spark: SparkSession, event_root: str, fact_root: str, run_date: date, tsv_path: str | None = None, tz: str = "UTC"
) -> DataFrame:
    """Writes the hourly report of one day's events and returns it; reports and TSV files of other days stay."""
    events = read_event_logs(spark, event_root, run_date, run_date + timedelta(days=1))
    hourly, path = staged(hourly_kpis(events, tz=tz), "hourly-kpis")
    try:
        return _write_report(spark, hourly, fact_root, run_date, tsv_path)
    finally:
        delete(spark, path)


def run_hourly_increment(
    spark: SparkSession, event_root: str, fact_root: str, state_root: str, run_date: date, tsv_path: str | None = None, tz: str = "UTC"
) -> tuple[DataFrame, list[int]]:
    """As `run_hourly`, from the subjects of each hour that earlier runs stored; also returns the hours that changed.

    Read are only events that were committed to the day since. They are merged into the subjects of their hours, and only
    those hours are counted again. Where events that were merged no longer count, since a writer replaced or packed
    them, the day is made anew.
    """
    if not has_day(spark, event_root, run_date):
        raise FileNotFoundError(f"no events of {run_date} under {event_root}")
    place = day_dir(event_root, run_date)
    slots = read_manifest(spark, place)[1]["slots"]
    merged = merged_slots(spark, state_root, run_date)
    grown = all(slots.get(slot) == label for slot, label in merged.items())
    fresh = {slot for slot, label in slots.items() if not grown or merged.get(slot) != label}
    events = read_paths(spark, event_root, live_paths(spark, place, fresh))
    changed = merge_hours(hourly_subjects(events, tz=tz), state_root, run_date, anew=not grown)
    set_merged_slots(spark, state_root, run_date, slots)
    return _write_report(spark, read_hours(spark, state_root, run_date), fact_root, run_date, tsv_path), changed


def _write_report(spark: SparkSession, hourly: DataFrame, fact_root: str, run_date: date, tsv_path: str | None) -> DataFrame:
    """Gives the day's long hourly table ids and columns, stores it, exports it and returns it as stored."""
    day = run_date.isoformat()
    platforms, dates, kpis = hourly_dimension_rows(hourly)
    report = to_stats_hourly(
        hourly,
        update_dimension(spark, fact_root, "dimension_platform", platforms),
        update_dimension(spark, fact_root, "dimension_date", dates),
        update_dimension(spark, fact_root, "dimension_kpi", kpis),
    )
    write_periods(report, f"{fact_root.rstrip('/')}/stats_hourly", f"'{day}'", (day,))
    stored = read_hourly(spark, fact_root, run_date)
    if tsv_path:
        export_tsv(stored, f"{tsv_path.rstrip('/')}/dt={day}")
    return stored
