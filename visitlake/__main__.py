"""Command line: `python -m visitlake etl|kpi|hourly|compact --date yyyy-MM-dd ...`."""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import SparkSession

from visitlake.functions.timeparts import resolve_run_date
from visitlake.plans.jobs import run_etl, run_hourly, run_hourly_increment, run_kpis, run_kpis_by_days
from visitlake.sources.event_table import compact_day
from visitlake.sources.readers import load_ip_ranges

log = logging.getLogger("visitlake")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="visitlake")
    p.add_argument("job", choices=["etl", "kpi", "hourly", "compact"])
    p.add_argument("--date", "-date", help="run date yyyy-MM-dd; yesterday when missing or malformed")
    p.add_argument("--events", required=True, help="root of the event table")
    p.add_argument("--raw", help="root of the raw logs (etl)")
    p.add_argument("--rejected", help="where to keep rejected lines (etl)")
    p.add_argument("--ip-ranges", help="Parquet table of IP ranges (etl)")
    p.add_argument("--facts", help="root of dimension and fact tables (kpi, hourly)")
    p.add_argument("--days", help="root of stored visitor bitmaps; only new days' events are read (kpi)")
    p.add_argument("--state", help="root of stored hours; only new events are read (hourly)")
    p.add_argument("--tsv", help="also export the hourly report there (hourly)")
    p.add_argument("--tz", default="UTC")
    p.add_argument("--strict", action="store_true", help="website events need visitor and session ids (etl)")
    p.add_argument("--protect-reserved", action="store_true", help="ignore client values of derived columns (etl)")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    needed = {"etl": "raw", "kpi": "facts", "hourly": "facts", "compact": "events"}[args.job]
    if not getattr(args, needed):
        parser().error(f"{args.job} needs --{needed}")
    today = datetime.now(ZoneInfo(args.tz)).date()
    run_date = resolve_run_date(args.date, today)
    if args.date and args.date != run_date.isoformat():
        log.warning("date %r is not shaped yyyy-MM-dd, running for %s", args.date, run_date)
    spark = spark or SparkSession.builder.appName(f"visitlake {args.job} {run_date}").getOrCreate()
    try:
        if args.job == "etl":
            ranges = load_ip_ranges(spark, args.ip_ranges) if args.ip_ranges else None
            counts = run_etl(
                spark, args.raw, args.events, run_date, ranges, args.rejected, args.tz, args.strict, args.protect_reserved
            )
            log.info("lines %s", counts)
        elif args.job == "compact":
            log.info("packed %d batches", compact_day(spark, args.events, run_date))
        elif args.job == "kpi" and args.days:
            _, read = run_kpis_by_days(spark, args.events, args.facts, args.days, run_date, today, args.tz)
            log.info("read events of %s", read)
        elif args.job == "kpi":
            run_kpis(spark, args.events, args.facts, run_date, today, args.tz)
        elif args.state:
            _, hours = run_hourly_increment(spark, args.events, args.facts, args.state, run_date, args.tsv, args.tz)
            log.info("%d hours changed", len(hours))
        else:
            run_hourly(spark, args.events, args.facts, run_date, args.tsv, args.tz)
    except Exception:
        log.exception("job %s for %s failed", args.job, run_date)
        return 1
    return 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main())
