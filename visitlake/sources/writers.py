"""Sinks: the event table, dimension and fact tables, delimited files, relational tables."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from visitlake import schema as S
from visitlake.operators.dimensions import (
    assign_dim_ids, to_stats_device_browser, to_stats_user, upsert_facts,
)
from visitlake.sources.event_table import BATCH_SLOT, put_events
from visitlake.sources.files import children, claim, delete, matching, move, staged
from visitlake.sources.readers import read_dimension, read_facts

# Versions of a table, or of one of its periods, that stay after a write.
KEEP_VERSIONS = 5


def write_event_logs(events: DataFrame, root: str, run_date: date, writer: str = BATCH_SLOT) -> None:
    """Replaces what this writer stored for a day, also when the new rows are none; other writers' events stay.

    The day is the one the lines were collected on. Inside a day events lie apart by kind, so that reports on
    one kind read nothing else.
    """
    put_events(events.withColumn("dt", F.lit(run_date)), root, writer, always=run_date)


def write_rejected_lines(rejected: DataFrame, root: str, run_date: date) -> None:
    rejected.write.mode("overwrite").parquet(f"{root.rstrip('/')}/dt={run_date.isoformat()}")


def write_version(df: DataFrame, table: str) -> str:
    """Writes the next version of a small table beside the current one, which stays readable meanwhile.

    A version is written aside and counts once it is in its place. The last KEEP_VERSIONS are kept. Another
    writer's version that came first is written over by none: this one takes the number after it.
    """
    spark = df.sparkSession
    while True:
        path = try_version(df, table, next_version(spark, table))
        if path:
            return path


def try_version(df: DataFrame, table: str, number: int) -> str | None:
    """Writes a version of a table; None if another writer has taken its number meanwhile."""
    spark = df.sparkSession
    path, incoming = f"{table}/v={number:08d}", f"{table}/_incoming/{uuid.uuid4().hex}"
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(incoming)
    if not claim(spark, incoming, path):
        delete(spark, incoming)
        return None
    _drop_old_versions(spark, table)
    return path


def next_version(spark: SparkSession, table: str) -> int:
    return max((int(v[2:]) for v in children(spark, table) if v.startswith("v=")), default=0) + 1


def _drop_old_versions(spark: SparkSession, table: str) -> None:
    for v in [v for v in children(spark, table) if v.startswith("v=")][:-KEEP_VERSIONS]:
        delete(spark, f"{table}/{v}")


def write_periods(df: DataFrame, table: str, period: str, always: tuple[str, ...] = ()) -> list[str]:
    """Replaces the periods of a table that occur in `df`, and those of `always` even by nothing; returns them.

    `period` is SQL text over the columns; its values become directory names. A period's next version is written aside
    and then put in place at once, so readers see whole versions, and files of other periods are not touched.
    """
    spark = df.sparkSession
    incoming = f"{table}/_incoming/{uuid.uuid4().hex}"
    df.withColumn("period", F.expr(period).cast("string")).write.partitionBy("period").parquet(incoming)
    parts = {path.rsplit("=", 1)[1]: path for path in matching(spark, f"{incoming}/period=*")}
    for name in always:
        if name not in parts:
            parts[name] = f"{incoming}/empty={name}"
            df.limit(0).write.parquet(parts[name])
    for name, path in parts.items():
        place = f"{table}/period={name}"
        move(spark, path, f"{place}/v={next_version(spark, place):08d}")
        _drop_old_versions(spark, place)
    delete(spark, incoming)
    return sorted(parts)


def append_batch(writer: DataFrameWriter, spark: SparkSession, root: str, levels: int, label: str, inner: str | None = None) -> None:
    """Adds the files of a stream's batch below `levels` partition directories of `root`, in a directory `label` of their own.

    They are written aside and then put in place; a batch that is repeated replaces what it wrote before. Directories of a
    last partition column `inner` become plain ones, so that it is no column of the table.
    """
    base = root.rstrip("/")
    incoming = f"{base}/_incoming/{label}"
    writer.mode("overwrite").save(incoming)
    for path in matching(spark, incoming + "/*=*" * levels + f"/{inner}=*") if inner else []:
        above, _, name = path.rpartition(f"/{inner}=")
        move(spark, path, f"{above}/{name}")
    for path in matching(spark, incoming + "/*=*" * levels):
        move(spark, path, f"{base}/{'/'.join(path.rsplit('/', levels)[1:])}/{label}")
    delete(spark, incoming)


def update_dimension(spark: SparkSession, root: str, name: str, candidates: DataFrame) -> DataFrame:
    """Adds missing natural keys to a dimension table and returns the table as written.

    Any number of writers may do so at once: ids are given on top of the version that was read, and if another writer has
    added the next one meanwhile, that is read and the keys still missing are numbered anew. So a key that has an id in a
    written table keeps it, and no id is given twice.
    """
    keys, table = S.DIM_KEYS[name], f"{root.rstrip('/')}/{name}"
    while True:
        number = next_version(spark, table)
        grown = assign_dim_ids(read_dimension(spark, root, name), candidates, keys)
        path = try_version(grown, table, number)
        if path:
            return spark.read.parquet(path)


def upsert_table(spark: SparkSession, root: str, fact: S.FactTable, new: DataFrame) -> DataFrame:
    """Upserts rows into a fact table and returns the table as written; only periods of `new` are rewritten."""
    rows, path = staged(new.select(*fact.keys, fact.measure, "created"), "fact-rows")
    touched = [r[0] for r in rows.select(F.expr(fact.period).cast("string")).distinct().collect()]
    old = read_facts(spark, root, fact, touched)
    merged = rows if old is None else upsert_facts(old, rows, fact.keys, fact.measure)
    write_periods(merged, f"{root.rstrip('/')}/{fact.table}", fact.period)
    delete(spark, path)
    table = read_facts(spark, root, fact)
    return new.select(*fact.keys, fact.measure, "created").limit(0) if table is None else table


def write_facts(spark: SparkSession, root: str, kpis: DataFrame, run_date: date) -> dict[str, DataFrame]:
    """Routes KPI rows to their fact tables, giving ids to new dimension rows on the way.

    `kpis` should be a stored table: it is read once per dimension and once per fact table.
    """
    platforms = update_dimension(spark, root, "dimension_platform", kpis.select(*S.PLATFORM_KEYS))
    dates = update_dimension(spark, root, "dimension_date", kpis.select(*S.DATE_KEYS))
    with_browser = kpis.filter(F.col("kpi_name") == S.KPI_BROWSER_NEW_USERS)
    browsers = update_dimension(spark, root, "dimension_browser", with_browser.select(*S.BROWSER_KEYS))
    rows = {
        S.KPI_NEW_USERS: lambda: to_stats_user(kpis, platforms, dates, run_date),
        S.KPI_BROWSER_NEW_USERS: lambda: to_stats_device_browser(kpis, platforms, dates, browsers, run_date),
    }
    return {kpi: upsert_table(spark, root, S.FACT_TABLES[kpi], make()) for kpi, make in rows.items()}


def export_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated files; null as \\N."""
    df.write.mode("overwrite").option("sep", "\t").option("nullValue", "\\N").csv(path)


def jdbc_options(url: str, table: str, batch_size: int = 500, **properties: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), **properties}


def export_jdbc(
    df: DataFrame, url: str, table: str, batch_size: int = 500, writers: int | None = None, mode: str = "append", **properties: str
) -> None:
    """Appends a table to a relational table, over one connection per partition or, if given, `writers` connections."""
    options = jdbc_options(url, table, batch_size, **properties)
    dealt = df.repartition(writers) if writers else df
    dealt.write.format("jdbc").options(**options).mode(mode).save()
