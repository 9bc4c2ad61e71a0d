"""Scans: raw log directories, the event table, IP ranges, dimension and fact tables."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake import schema as S
from visitlake.operators.dimensions import first_ids
from visitlake.operators.ip_ranges import REFUSE, find_overlaps
from visitlake.sources.event_table import day_dir, has_day, live_paths, read_paths
from visitlake.sources.files import children, exists, matching, spread


def read_raw_logs(spark: SparkSession, root: str, run_date: date) -> DataFrame:
    """Lines collected on `run_date`; an error when nothing was collected that day.

    Reads what lies in `<root>/yyyy/MM/dd` and what `ingest_stream` landed on that day, and lists nothing else.
    """
    base = root.rstrip("/")
    day_dir, landed = f"{base}/{run_date:%Y/%m/%d}", f"{base}/arrival_date={run_date.isoformat()}"
    found = []
    if exists(spark, day_dir):
        found.append(spark.read.text(day_dir))
    if exists(spark, landed):
        found.append(spark.read.option("basePath", base).text(landed).select("value"))
    if not found:
        raise FileNotFoundError(f"no raw logs for {run_date} under {root}")
    return spread(reduce(DataFrame.unionByName, found))


def read_event_logs(spark: SparkSession, root: str, start: date, end: date) -> DataFrame:
    """Events of the days in [start, end), stored by batch jobs, streams or both; only those days are listed.

    What counts is what a day's manifest names. Days without a table are skipped; none at all is an error.
    """
    days = [start + timedelta(days=n) for n in range((end - start).days)]
    there = [d for d in days if has_day(spark, root, d)]
    if not there:
        raise FileNotFoundError(f"no events from {start} to {end} under {root}")
    paths = [path for d in there for path in live_paths(spark, day_dir(root, d))]
    return read_paths(spark, root, paths).filter((F.col("dt") >= F.lit(start)) & (F.col("dt") < F.lit(end)))


def load_ip_ranges(spark: SparkSession, path: str, fmt: str = "parquet", overlaps: str = REFUSE, **options) -> DataFrame:
    """IP ranges (begin_ip, end_ip, country, area); unusable ranges are an error.

    So are overlapping ones, unless `overlaps` says that the lookup will know what they mean (`join_ip_range`).
    """
    ranges = spark.read.format(fmt).options(**options).schema(S.IP_RANGE_SCHEMA).load(path)
    usable = F.coalesce(
        (F.col("begin_ip") >= 0) & (F.col("begin_ip") <= F.col("end_ip")) & (F.col("end_ip") < 1 << 32), F.lit(False)
    )
    begin = F.when(usable, F.col("begin_ip")).otherwise(F.raise_error(F.lit("unusable IP range")).cast("bigint"))
    text = {c: F.coalesce(c, F.lit("")) for c in ("country", "area")}
    checked = ranges.withColumns({"begin_ip": begin, **text})
    found = find_overlaps(checked).take(3) if overlaps == REFUSE else []
    if found:
        raise ValueError(f"overlapping IP ranges, such as {found}")
    return checked


def read_jdbc_table(spark: SparkSession, url: str, table: str, **properties: str) -> DataFrame:
    """A dimension or fact table kept in a relational database."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **properties).load()


def read_dimension(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Current rows (id and natural key) of a dimension table; empty before its first write."""
    path = current_version(spark, f"{root.rstrip('/')}/{name}")
    keys = S.DIM_KEYS[name]
    if path is None:
        types = {"calendar": "date", "type": "string", **{k: "int" for k in S.DATE_KEYS[:5]}}
        columns = ", ".join(f"{k} {types.get(k, 'string')}" for k in keys)
        return spark.createDataFrame([], f"id int, {columns}")
    return first_ids(spark.read.parquet(path), keys).select("id", *keys)


def read_facts(spark: SparkSession, root: str, fact: S.FactTable, periods: list[str] | None = None) -> DataFrame | None:
    """Current rows of a fact table, or of some of its periods; None where there is none."""
    return read_periods(spark, f"{root.rstrip('/')}/{fact.table}", periods)


def read_hourly(spark: SparkSession, root: str, run_date: date | None = None) -> DataFrame | None:
    """The hourly report of all days, or of one; None where there is none."""
    return read_periods(spark, f"{root.rstrip('/')}/stats_hourly", [run_date.isoformat()] if run_date else None)


def read_periods(spark: SparkSession, table: str, periods: list[str] | None = None) -> DataFrame | None:
    """Newest version of each period of a table written by `write_periods`, listed by one call."""
    newest = {}
    for path in matching(spark, f"{table}/period=*/v=*"):
        newest[path.rsplit("/", 2)[1].removeprefix("period=")] = path
    paths = [path for period, path in newest.items() if periods is None or period in periods]
    return spark.read.parquet(*paths) if paths else None


def current_version(spark: SparkSession, table: str) -> str | None:
    """Newest completely written version of a table written by `write_version`; looks from the newest down."""
    versions = (v for v in reversed(children(spark, table)) if v.startswith("v="))
    return next((f"{table}/{v}" for v in versions if exists(spark, f"{table}/{v}/_SUCCESS")), None)
