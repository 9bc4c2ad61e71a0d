"""Dimension tables, surrogate ids and the fact rows that refer to them."""

from __future__ import annotations

import operator
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlake import schema as S
from visitlake.functions.text import is_blank
from visitlake.functions.timeparts import date_dimension, is_valid_run_date
from visitlake.operators.hourly import pivot_hours
from visitlake.operators.rollups import rollup_browser, rollup_platform

_BUCKET_DIGITS = 3  # hexadecimal, so 4096 buckets


def date_dimension_rows(dates: DataFrame, col: str, grains: tuple[str, ...] = ("day",)) -> DataFrame:
    """Distinct date dimension rows, of each grain, of the dates in `col`."""
    days = dates.select(F.col(col).cast("date").alias("d")).filter(F.col("d").isNotNull()).distinct()
    rows = days.select(F.inline(F.array(*[date_dimension(F.col("d"), g) for g in grains])))
    return rows.distinct()


def platform_dimension(events: DataFrame) -> DataFrame:
    pairs = events.select("pl", "ver").distinct()
    return rollup_platform(pairs).select(*S.PLATFORM_KEYS).distinct()


def browser_dimension(events: DataFrame) -> DataFrame:
    pairs = events.select("browser", "browser_v").distinct()
    return rollup_browser(pairs).select(*S.BROWSER_KEYS).distinct()


def kpi_dimension(spark: SparkSession, kpis: tuple[str, ...] = (*S.STATS_KPIS, *S.HOURLY_KPIS)) -> DataFrame:
    return spark.createDataFrame([(k,) for k in kpis], "kpi_name string")


def event_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(S.EVENTS, "id int, name string, alias string")


def _key_text(keys: list[str]):
    return F.concat_ws("\x01", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def assign_dim_ids(existing: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """`existing` (id and `keys`) plus rows for the candidates it lacks, numbered on from its largest id.

    Ids already given never change. New keys are ordered by (first digits of the MD5 of the key, key): each
    digit bucket is numbered in parallel and starts after the rows of the buckets before it, so no task
    sees more than one bucket of keys or the list of bucket sizes.
    """
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    fresh = candidates.select(*keys).distinct().alias("c").join(existing.alias("e"), condition, "left_anti")
    placed = fresh.select(
        F.substring(F.md5(F.encode(_key_text(keys), "UTF-8")), 1, _BUCKET_DIGITS).alias("_bucket"), *keys
    )
    # the largest existing id counts as the rows of a bucket before all others
    given = existing.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("n")).select(
        F.lit("").alias("_bucket"), "n"
    )
    sizes = placed.groupBy("_bucket").agg(F.count("*").alias("n")).unionByName(given)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_bucket").orderBy(*keys)
    numbered = placed.withColumn("_n", F.row_number().over(inside)).join(F.broadcast(starts), "_bucket")
    new_rows = numbered.select((F.col("_start") + F.col("_n")).cast("int").alias("id"), *keys)
    return existing.select(F.col("id").cast("int").alias("id"), *keys).unionByName(new_rows)


def first_ids(dim: DataFrame, keys: list[str]) -> DataFrame:
    """One row per natural key, the smallest id counting."""
    return dim.groupBy(*keys).agg(F.min("id").alias("id"))


def attach_dim_id(facts: DataFrame, dim: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Replaces the natural key columns of `facts` by `id_col`, null where `dim` lacks the key.

    Left to the optimizer's size estimates: small dimensions are broadcast, large ones shuffled.
    """
    condition = None
    for k in keys:
        same = F.col(f"f.{k}").eqNullSafe(F.col(f"d.{k}"))
        condition = same if condition is None else condition & same
    kept = [F.col(f"f.{c}") for c in facts.columns if c not in keys]
    return facts.alias("f").join(dim.select("id", *keys).alias("d"), condition, "left").select(
        F.col("d.id").alias(id_col), *kept
    )


def with_date_id(df: DataFrame, dim: DataFrame, date_col: str, grain: str, id_col: str = "date_dimension_id") -> DataFrame:
    """Date id of `date_col` at `grain`; text that is no date, blank or null fails the query."""
    if not S.DATE_GRAINS.get(grain, False):
        raise ValueError(f"no date dimension for grain: {grain}")
    text = F.col(date_col).cast("string")
    error = F.raise_error(F.concat(F.lit("not a date: "), F.coalesce(text, F.lit("null")))).cast("date")
    period = date_dimension(F.when(is_valid_run_date(text), text.try_cast("date")).otherwise(error), grain)
    keyed = df.withColumn("_period", period).select(
        *df.columns, *[F.col("_period")[k].alias(f"_{k}") for k in S.DATE_KEYS]
    )
    renamed = dim.select("id", *[F.col(k).alias(f"_{k}") for k in S.DATE_KEYS])
    return attach_dim_id(keyed, renamed, [f"_{k}" for k in S.DATE_KEYS], id_col)


def with_kpi_id(df: DataFrame, dim: DataFrame, kpi_col: str, id_col: str = "kpi_dimension_id") -> DataFrame:
    """KPI id of `kpi_col`; a blank name fails the query."""
    name = F.when(is_blank(F.col(kpi_col)), F.raise_error(F.lit("blank KPI name")).cast("string"))
    keyed = df.withColumn("_kpi", name.otherwise(F.col(kpi_col)))
    return attach_dim_id(keyed, dim.select("id", F.col("kpi_name").alias("_kpi")), ["_kpi"], id_col)


def with_platform_id(
    df: DataFrame, dim: DataFrame, name_col: str, version_col: str, id_col: str = "platform_dimension_id"
) -> DataFrame:
    """Platform id; here a blank name or version makes both `unknown`."""
    blank = is_blank(F.col(name_col)) | is_blank(F.col(version_col))
    keyed = df.withColumns({
        "_name": F.when(blank, F.lit(S.UNKNOWN)).otherwise(F.col(name_col)),
        "_version": F.when(blank, F.lit(S.UNKNOWN)).otherwise(F.col(version_col)),
    })
    renamed = dim.select("id", F.col("platform_name").alias("_name"), F.col("platform_version").alias("_version"))
    return attach_dim_id(keyed, renamed, ["_name", "_version"], id_col)


def to_stats_user(kpis: DataFrame, platforms: DataFrame, dates: DataFrame, run_date: date) -> DataFrame:
    """Rows of `stats_user` from the new visitor KPI."""
    rows = kpis.filter(F.col("kpi_name") == S.KPI_NEW_USERS).select(
        *S.DATE_KEYS, *S.PLATFORM_KEYS, "new_install_users"
    )
    rows = attach_dim_id(rows, dates, S.DATE_KEYS, "date_dimension_id")
    rows = attach_dim_id(rows, platforms, S.PLATFORM_KEYS, "platform_dimension_id")
    return rows.select(
        "platform_dimension_id", "date_dimension_id", "new_install_users", F.lit(run_date).alias("created")
    )


def to_stats_device_browser(
    kpis: DataFrame, platforms: DataFrame, dates: DataFrame, browsers: DataFrame, run_date: date
) -> DataFrame:
    """Rows of `stats_device_browser` from the browser KPI."""
    rows = kpis.filter(F.col("kpi_name") == S.KPI_BROWSER_NEW_USERS).select(
        *S.DATE_KEYS, *S.PLATFORM_KEYS, *S.BROWSER_KEYS, "new_install_users"
    )
    rows = attach_dim_id(rows, dates, S.DATE_KEYS, "date_dimension_id")
    rows = attach_dim_id(rows, platforms, S.PLATFORM_KEYS, "platform_dimension_id")
    rows = attach_dim_id(rows, browsers, S.BROWSER_KEYS, "browser_dimension_id")
    return rows.select(
        "platform_dimension_id", "date_dimension_id", "browser_dimension_id", "new_install_users",
        F.lit(run_date).alias("created"),
    )


def to_stats_hourly(hourly: DataFrame, platforms: DataFrame, dates: DataFrame, kpis: DataFrame) -> DataFrame:
    """Rows of `stats_hourly` from the long hourly table.

    Hours are pivoted per platform and version as recorded; ids come after, so groups that share an id
    through blank values stay separate rows (their distinct counts cannot be added).
    """
    wide = pivot_hours(hourly)
    rows = with_platform_id(wide, platforms, "pl", "ver")
    rows = with_date_id(rows, dates, "date", "day")
    rows = with_kpi_id(rows, kpis, "kpi")
    return rows.select("platform_dimension_id", "date_dimension_id", "kpi_dimension_id", *S.HOUR_COLUMNS)


def hourly_dimension_rows(hourly: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Platform, date and KPI rows that the ids of `to_stats_hourly` need."""
    blank = is_blank(F.col("pl")) | is_blank(F.col("ver"))
    platforms = hourly.select(
        F.when(blank, F.lit(S.UNKNOWN)).otherwise(F.col("pl")).alias("platform_name"),
        F.when(blank, F.lit(S.UNKNOWN)).otherwise(F.col("ver")).alias("platform_version"),
    ).distinct()
    return platforms, date_dimension_rows(hourly, "date"), hourly.select(F.col("kpi").alias("kpi_name")).distinct()


def upsert_facts(existing: DataFrame, new: DataFrame, keys: list[str] | tuple[str, ...], measure: str) -> DataFrame:
    """`existing` with the measure of `new` where the keys match, and the rows of `new` it lacks.

    Null keys match each other. A row keeps the `created` date of its first insert.
    """
    same = reduce(operator.and_, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    joined = existing.alias("o").join(new.alias("n"), same, "full")
    return joined.select(
        *[F.coalesce(f"n.{k}", f"o.{k}").alias(k) for k in keys],
        F.coalesce(f"n.{measure}", f"o.{measure}").alias(measure),
        F.coalesce("o.created", "n.created").alias("created"),
    )
