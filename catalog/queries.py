"""One callable per registered query: (spark, directory of the given tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as X
from visitlake import schema as S
from visitlake.functions import timeparts as TP
from visitlake.functions.agents import with_user_agent
from visitlake.functions.ip import ip_to_long, long_to_ip, parse_region
from visitlake.functions.params import add_params, extract_query
from visitlake.operators import dimensions as D
from visitlake.operators import hourly as H
from visitlake.operators import ip_ranges as I
from visitlake.operators import lines as L
from visitlake.operators import rollups as R
from visitlake.operators import visitors as V
from visitlake.plans.jobs import etl, run_etl, run_hourly, run_hourly_increment, run_kpis, run_kpis_by_days
from visitlake.sources.event_table import compact_day, put_events
from visitlake.sources.files import children, delete, scratch_dir, staged
from visitlake.sources.hour_table import read_hours
from visitlake.sources.readers import (
    current_version, load_ip_ranges, read_event_logs, read_facts, read_hourly, read_raw_logs,
)
from visitlake.sources.writers import export_tsv, write_event_logs
from visitlake.streaming.streams import etl_stream, ingest_stream, upsert_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ------------------------------------------------------------- new visitors


@query
def new_install_users(spark, sf):
    return V.new_install_users(X.fx(spark, sf), X.RUN_DATE)


@query
def browser_new_install_users(spark, sf):
    return V.browser_new_install_users(X.fx(spark, sf), X.RUN_DATE)


@query
def install_kpis(spark, sf):
    return V.install_kpis(X.fx(spark, sf), X.RUN_DATE)


@query
def sort_stats(spark, sf):
    return V.sort_stats(V.install_kpis(X.fx(spark, sf), X.LATER_RUN_DATE))


@query
def rollup_platform(spark, sf):
    return R.rollup_platform(X.fx(spark, sf)).groupBy(*S.PLATFORM_KEYS).agg(F.count("*").alias("events"))


@query
def rollup_browser(spark, sf):
    return R.rollup_browser(X.fx(spark, sf)).groupBy(*S.BROWSER_KEYS).agg(F.count("*").alias("events"))


@query
def date_buckets(spark, sf):
    launches = V.launches(X.fx(spark, sf), X.RUN_DATE)
    return launches.groupBy("buckets").agg(F.count("*").alias("launches"))


@query
def activity_active_users(spark, sf):
    rows, _ = etl(X.raw(spark, sf).select("value"))
    return V.activity_active_users(rows)


# ------------------------------------------------------------------- hourly


@query
def stage_hourly(spark, sf):
    return H.stage_hourly(X.fx(spark, sf))


@query
def hourly_active_users(spark, sf):
    return H.hourly_active_users(X.fx_dense(spark, sf))


@query
def hourly_new_users(spark, sf):
    return H.hourly_new_users(X.fx_dense(spark, sf))


@query
def hourly_session_count(spark, sf):
    return H.hourly_session_count(X.fx_dense(spark, sf))


@query
def hourly_session_length(spark, sf):
    return H.hourly_session_length(X.fx_dense(spark, sf))


@query
def hourly_kpis(spark, sf):
    return H.hourly_kpis(X.fx_dense(spark, sf))


@query
def hourly_kpis_pivot(spark, sf):
    return H.pivot_hours(H.hourly_kpis(X.fx_dense(spark, sf)))


# --------------------------------------------------------------- dimensions


def _date_dimension(grain: str) -> Query:
    def run(spark, sf):
        return D.date_dimension_rows(X.table(spark, sf, "orders"), "o_orderdate", (grain,))

    return run


for _grain in ("year", "season", "month", "week", "day"):
    QUERIES[f"date_dimension_{_grain}"] = _date_dimension(_grain)


@query
def date_parts(spark, sf):
    d = F.col("d")
    days = X.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return days.select("d", *[TP.date_part(d, g).alias(g) for g in ("year", "season", "month", "week", "day")])


@query
def period_bounds(spark, sf):
    d = F.col("d")
    days = X.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return days.select(
        "d", TP.week_start(d).alias("week_start"), TP.next_week_start(d).alias("next_week_start"),
        TP.prev_week_start(d).alias("prev_week_start"), TP.month_start(d).alias("month_start"),
        TP.next_month_start(d).alias("next_month_start"), TP.prev_month_start(d).alias("prev_month_start"),
        TP.shift_days(d, 2).alias("in_two_days"), TP.shift_days(d, -1).alias("day_before"),
    )


@query
def time_text(spark, sf):
    """Dates to text and back, and the parts of an event's time."""
    ms = F.col("s_time")
    text = TP.format_millis(ms)
    return X.fx(spark, sf).select(
        "event_id", text.alias("day_text"), TP.format_millis(ms, "yyyyMMdd").alias("day_suffix"),
        TP.is_valid_run_date(text).alias("valid"), TP.date_to_millis(text).alias("midnight"),
        TP.event_date(ms).alias("date"), TP.event_hour(ms).alias("hour"),
        TP.date_to_millis(TP.format_millis(ms, "yyyy-MM-dd HH:mm:ss"), "yyyy-MM-dd HH:mm:ss").alias("second"),
        TP.date_to_millis(TP.format_millis(ms, "yyyyMMdd HHmm"), "yyyyMMdd HHmm", "Asia/Shanghai").alias("shanghai_minute"),
    )


@query
def platform_dimension(spark, sf):
    return D.platform_dimension(X.fx(spark, sf))


@query
def browser_dimension(spark, sf):
    return D.browser_dimension(X.fx(spark, sf))


@query
def kpi_dimension(spark, sf):
    """Ids of the KPIs that events give rise to."""
    _, _, kpis = D.hourly_dimension_rows(H.hourly_kpis(X.fx_dense(spark, sf)))
    stats = V.install_kpis(X.fx(spark, sf), X.RUN_DATE).select("kpi_name").distinct()
    known = D.kpi_dimension(spark).join(kpis.unionByName(stats), "kpi_name", "left_semi")
    return _fresh_ids(spark, known, S.KPI_KEYS)


@query
def event_types(spark, sf):
    """Events per known kind."""
    counts = X.fx(spark, sf).groupBy("en").agg(F.count("*").alias("events"))
    return D.event_types(spark).join(counts, F.col("alias") == F.col("en"), "left").select(
        "id", "name", "alias", F.coalesce("events", F.lit(0)).alias("events")
    )


def _fresh_ids(spark, candidates: DataFrame, keys: list[str]) -> DataFrame:
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in candidates.select(*keys).schema)
    return D.assign_dim_ids(spark.createDataFrame([], f"id int, {fields}"), candidates, keys)


@query
def assign_dim_ids(spark, sf):
    """Ids of the browser versions of launches, then of the browsers of all events on top of them."""
    events = X.fx(spark, sf)
    first = D.browser_dimension(events.filter(F.col("en") == S.LAUNCH))
    known = _fresh_ids(spark, first.filter(F.col("browser_version") != S.ALL), S.BROWSER_KEYS)
    return D.assign_dim_ids(known, D.browser_dimension(events), S.BROWSER_KEYS)


def _stats(spark, sf, run_date):
    kpis, _ = staged(V.install_kpis(X.fx(spark, sf), run_date), "install-kpis")
    dims = {k: _fresh_ids(spark, kpis, S.DIM_KEYS[k]) for k in ("dimension_platform", "dimension_date")}
    with_browser = kpis.filter(F.col("kpi_name") == S.KPI_BROWSER_NEW_USERS)
    return kpis, dims["dimension_platform"], dims["dimension_date"], _fresh_ids(spark, with_browser, S.BROWSER_KEYS)


@query
def stats_user(spark, sf):
    kpis, platforms, dates, _ = _stats(spark, sf, X.RUN_DATE)
    return D.to_stats_user(kpis, platforms, dates, X.RUN_DATE)


@query
def stats_device_browser(spark, sf):
    return D.to_stats_device_browser(*_stats(spark, sf, X.RUN_DATE), X.RUN_DATE)


@query
def stats_hourly(spark, sf):
    hourly, _ = staged(H.hourly_kpis(X.fx_dense(spark, sf)), "hourly-kpis")
    platforms, dates, kpis = D.hourly_dimension_rows(hourly)
    return D.to_stats_hourly(
        hourly, _fresh_ids(spark, platforms, S.PLATFORM_KEYS), _fresh_ids(spark, dates, S.DATE_KEYS),
        _fresh_ids(spark, kpis, S.KPI_KEYS),
    )


def _facts_by_name(spark, sf, run_date):
    """New visitors of the month of `run_date` up to each run, keyed by names instead of ids."""
    kpis = V.new_install_users(X.fx(spark, sf), run_date)
    return kpis.select(*S.PLATFORM_KEYS, "type", "calendar", "new_install_users", F.lit(run_date).alias("created"))


@query
def upsert_facts(spark, sf):
    keys = [*S.PLATFORM_KEYS, "type", "calendar"]
    old, new = _facts_by_name(spark, sf, X.RUN_DATE), _facts_by_name(spark, sf, X.LATER_RUN_DATE)
    return D.upsert_facts(old, new, keys, "new_install_users")


# ---------------------------------------------------------------- raw lines


def _parsed(spark, sf):
    return L.parse_log_lines(X.raw(spark, sf))


@query
def parse_log_lines(spark, sf):
    f = F.col("fields")
    names = ["ip", "s_time", "en", "pl", "ver", "u_ud", "u_mid", "u_sd", "c_time", "p_url", "tt", "ca", "ac", "oid",
             "cua", "b_iev"]
    return _parsed(spark, sf).select(
        "event_id", "parse_error", F.size(f).alias("n_fields"), *[f[n].alias(n) for n in names]
    ).withColumn("n_fields", F.when(F.col("parse_error").isNull(), F.col("n_fields")))


@query
def valid_events(spark, sf):
    rows = L.valid_events(L.classify_events(_parsed(spark, sf)))
    return L.to_event_columns(rows, ["event_id"]).select("event_id", "s_time", "en", "pl", "ver", "u_ud", "p_url", "oid")


@query
def rejected_lines(spark, sf):
    return L.rejected_lines(L.classify_events(_parsed(spark, sf)))


@query
def reject_counts(spark, sf):
    return L.reject_counts(L.classify_events(_parsed(spark, sf)))


@query
def reject_counts_strict(spark, sf):
    return L.reject_counts(L.classify_events(_parsed(spark, sf), strict=True))


_ROW = ["ip", "s_time", "en", "pl", "ver", "u_ud", "u_mid", "u_sd", "c_time", "p_url", "tt", "oid", "cua", "cut", "pt",
        "ca", "ac", "browser", "browser_v", "os", "os_v", "country", "province", "city"]


@query
def dedupe_events(spark, sf):
    """Every line comes twice, and all time-in-day keys stay the same."""
    lines = X.raw(spark, sf).select("value")
    rows, _ = etl(lines.unionAll(lines))
    return rows.groupBy("time_in_day", "s_time", "u_ud", "en").agg(F.count("*").alias("copies"))


@query
def etl_events(spark, sf):
    rows, _ = etl(X.raw(spark, sf).select("value"), X.ip_ranges(spark, sf), overlaps=I.EVERY)
    return rows.select("time_in_day", *_ROW, F.size("extra").alias("n_extra"))


@query
def url_params(spark, sf):
    pages = X.table(spark, sf, "pages").select("page_id", extract_query(F.col("url")).alias("query"))
    return add_params(pages, "query", "params").select("page_id", F.explode("params").alias("name", "value"))


@query
def user_agents(spark, sf):
    agent = F.col("fields")[S.USER_AGENT]
    parsed = _parsed(spark, sf).filter(agent.isNotNull())
    named = parsed.select("event_id", agent.alias("user_agent"))
    return with_user_agent(named, "user_agent", "a").select("event_id", "a.*")


# ---------------------------------------------------------------- addresses


@query
def ip_convert(spark, sf):
    ip = F.col("fields")["ip"]
    numbers = _parsed(spark, sf).filter(ip.isNotNull()).select("event_id", ip.alias("ip"), ip_to_long(ip).alias("number"))
    return numbers.withColumn("text", long_to_ip(F.col("number")))


def _addresses(spark, sf):
    return _parsed(spark, sf).select("event_id", F.col("fields")["ip"].alias("ip")).filter(F.col("ip").isNotNull())


def _with_region(df: DataFrame) -> DataFrame:
    return df.withColumn("r", parse_region(F.col("ip_country"))).select(*df.columns, "r.*")


@query
def ip_region(spark, sf):
    return _with_region(I.with_ip_address(_addresses(spark, sf), X.ip_ranges(spark, sf), overlaps=I.EVERY))


@query
def ip_region_shuffled(spark, sf):
    """The same lookup by the way taken for range tables too large to broadcast."""
    return _with_region(I.with_ip_address(_addresses(spark, sf), X.ip_ranges(spark, sf), max_rows=0, overlaps=I.EVERY))


@query
def find_ip_ranges(spark, sf):
    return I.find_ip_ranges(X.ip_ranges(spark, sf), "市")


@query
def list_range_ends(spark, sf):
    return I.list_range_ends(X.ip_ranges(spark, sf))


# --------------------------------------------------------- sources and sinks


@query
def event_log_view(spark, sf):
    rows, _ = etl(X.raw(spark, sf).select("value"))
    return L.event_log_view(rows).drop("key")


@query
def event_table_scan(spark, sf):
    """The event table written for two days, one of them twice, and read back over a window."""
    root = scratch_dir(spark, "events")
    # stored once, since three writes read it
    rows, path = staged(etl(X.raw(spark, sf).select("value"))[0], "event-rows")
    later = X.RUN_DATE + timedelta(days=1)
    write_event_logs(rows.filter(F.col("en") == S.ACTIVITY), root, X.RUN_DATE)
    write_event_logs(rows, root, X.RUN_DATE)
    write_event_logs(rows.filter(F.col("en") == S.LAUNCH), root, later)
    delete(spark, path)
    events = read_event_logs(spark, root, X.RUN_DATE, X.RUN_DATE + timedelta(days=7))
    return events.groupBy("dt", "en", "pl").agg(F.count("*").alias("events"), F.sum("s_time").alias("time_sum"))


@query
def raw_log_scan(spark, sf):
    root = scratch_dir(spark, "raw")
    X.raw(spark, sf).select("value").write.text(f"{root}/{X.RUN_DATE:%Y/%m/%d}")
    return read_raw_logs(spark, root, X.RUN_DATE)


@query
def ip_range_table(spark, sf):
    path = scratch_dir(spark, "ip-ranges")
    X.ip_ranges(spark, sf).write.parquet(path)
    return load_ip_ranges(spark, path, overlaps=I.EVERY)


@query
def export_hourly_tsv(spark, sf):
    path = scratch_dir(spark, "hourly-tsv")
    export_tsv(H.pivot_hours(H.hourly_kpis(X.fx_dense(spark, sf))), path)
    schema = "pl string, ver string, date date, kpi string, " + ", ".join(f"{h} bigint" for h in S.HOUR_COLUMNS)
    return spark.read.option("sep", "\t").option("nullValue", "\\N").schema(schema).csv(path)


# ---------------------------------------------------------------- streaming


def _line_files(spark, sf) -> str:
    src = scratch_dir(spark, "lines")
    X.raw(spark, sf).select("value").write.text(src)
    return src


@query
def ingest_stream_lines(spark, sf):
    dst = scratch_dir(spark, "landed")
    ingest_stream(spark, _line_files(spark, sf), dst, scratch_dir(spark, "ckpt")).awaitTermination()
    return spark.read.text(dst).select("value")


@query
def landing_rolled_by_size(spark, sf):
    """Lines and bytes landed in files of at most 64 KB, and how many files of several lines are larger (none)."""
    dst, limit = scratch_dir(spark, "landed"), 64 << 10
    ckpt = scratch_dir(spark, "ckpt")
    ingest_stream(spark, _line_files(spark, sf), dst, ckpt, max_bytes_per_file=limit).awaitTermination()
    size = (F.octet_length("value") + 1).cast("bigint")
    files = spark.read.text(dst).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
    return files.agg(
        F.sum("n").alias("lines"), F.sum("bytes").alias("bytes"),
        F.count_if((F.col("bytes") > limit) & (F.col("n") > 1)).alias("oversized"),
    )


@query
def etl_stream_events(spark, sf):
    dst = scratch_dir(spark, "stream-events")
    etl_stream(
        spark, _line_files(spark, sf), dst, scratch_dir(spark, "ckpt"), X.ip_ranges(spark, sf), overlaps=I.EVERY
    ).awaitTermination()
    events = spark.read.schema(S.EVENT_SCHEMA).parquet(dst)
    return events.select("time_in_day", *_ROW, F.size("extra").alias("n_extra"))


@query
def upsert_stream_facts(spark, sf):
    """Fact rows of two run dates, upserted as two micro-batches.

    A batch holds two rows of each key, the later one smaller, and keys of which a part is null.
    """
    fact = S.FactTable("by_name", (*S.PLATFORM_KEYS, "type", "calendar"), "new_install_users", "date_format(calendar, 'yyyy-MM')")
    src, root = scratch_dir(spark, "fact-rows"), scratch_dir(spark, "facts")
    checkpoint = scratch_dir(spark, "ckpt")
    for run_date in (X.RUN_DATE, X.LATER_RUN_DATE):
        named = _facts_by_name(spark, sf, run_date)
        last = named.unionByName(named.filter(F.col("platform_version") == S.ALL).withColumn(
            "platform_version", F.lit(None).cast("string")))
        first = last.withColumn("new_install_users", F.col("new_install_users") + 100)
        rows = first.withColumn("seq", F.lit(1)).unionByName(last.withColumn("seq", F.lit(2)))
        rows.write.mode("append").parquet(src)
        stream = spark.readStream.schema(rows.schema).parquet(src)
        upsert_stream(stream, root, fact, checkpoint, "seq").awaitTermination()
    return read_facts(spark, root, fact).select(*fact.keys, fact.measure, "created")


@query
def stream_then_batch_scan(spark, sf):
    """One event table filled by a stream, by the stream again with another range lookup, and by the batch job."""
    src, root, raw, checkpoint = (scratch_dir(spark, n) for n in ("lines", "events", "raw", "ckpt"))
    lines, ranges = X.raw(spark, sf).select("value"), X.ip_ranges(spark, sf)
    first = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    for part, options in ((first, {}), (~first, {"max_rows": 0})):
        lines.filter(part).write.mode("append").text(src)
        etl_stream(spark, src, root, checkpoint, ranges, overlaps=I.LAST, **options).awaitTermination()
    lines.write.text(f"{raw}/{X.RUN_DATE:%Y/%m/%d}")
    run_etl(spark, raw, root, X.RUN_DATE, ranges, overlaps=I.LAST)
    now = datetime.now(timezone.utc).date()
    windows = ((False, X.RUN_DATE, X.RUN_DATE + timedelta(days=1)), (True, now - timedelta(days=1), now + timedelta(days=2)))
    parts = [read_event_logs(spark, root, a, b).withColumn("streamed", F.lit(streamed)) for streamed, a, b in windows]
    both = parts[0].unionByName(parts[1])
    return both.groupBy("streamed", "en", "pl").agg(F.count("*").alias("events"), F.sum("s_time").alias("time_sum"))


@query
def shared_day_scan(spark, sf):
    """One day's events from a stream and from a batch job that runs twice, each with lines of its own; then compacted."""
    src, root, raw, checkpoint = (scratch_dir(spark, n) for n in ("lines", "events", "raw", "ckpt"))
    lines, ranges = X.raw(spark, sf).select("value"), X.ip_ranges(spark, sf)
    part = F.pmod(F.xxhash64("value"), F.lit(4))
    for n in range(3):
        # one file, made by all cores
        lines.filter(part == n).repartition(1).write.mode("append").text(src)
        etl_stream(spark, src, root, checkpoint, ranges, overlaps=I.LAST).awaitTermination()
    # the stream decides which day it is
    today = max(date.fromisoformat(name.removeprefix("dt=")) for name in children(spark, root) if name.startswith("dt="))
    lines.filter(part == 3).write.text(f"{raw}/{today:%Y/%m/%d}")
    for _ in range(2):
        run_etl(spark, raw, root, today, ranges, overlaps=I.LAST)
    compact_day(spark, root, today)
    events = read_event_logs(spark, root, today - timedelta(days=1), today + timedelta(days=1))
    return events.groupBy("en", "pl").agg(F.count("*").alias("events"), F.sum("s_time").alias("time_sum"))


@query
def stream_distinct_events(spark, sf):
    """Lines that come twice in a batch, again in the next one, and again after a restart: one event each."""
    src, root, checkpoint = (scratch_dir(spark, n) for n in ("lines", "events", "ckpt"))
    lines, ranges = X.raw(spark, sf).select("value"), X.ip_ranges(spark, sf)
    some = F.pmod(F.xxhash64("value"), F.lit(3))
    for part in (lines.filter(some < 2).unionByName(lines.filter(some == 0)), lines.filter(some > 0), lines):
        # two files, made by all cores: a batch each
        part.repartition(2).write.mode("append").text(src)
        etl_stream(spark, src, root, checkpoint, ranges, max_files_per_trigger=1, overlaps=I.EVERY).awaitTermination()
    now = datetime.now(timezone.utc).date()
    events = read_event_logs(spark, root, now - timedelta(days=1), now + timedelta(days=2))
    return events.select("time_in_day", *_ROW, F.size("extra").alias("n_extra"))


# --------------------------------------------------------------------- jobs


def _as_event_rows(events: DataFrame) -> DataFrame:
    missing = [c for c in S.EVENT_COLUMNS if c not in events.columns]
    return events.select("*", *[F.lit(None).cast(S.EVENT_SCHEMA[c].dataType).alias(c) for c in missing])


@query
def etl_job_counts(spark, sf):
    """Line counts of the ETL job, with the rejected lines it kept."""
    raw, root, kept = (scratch_dir(spark, n) for n in ("raw", "events", "rejected"))
    X.raw(spark, sf).select("value").write.text(f"{raw}/{X.RUN_DATE:%Y/%m/%d}")
    counts = run_etl(spark, raw, root, X.RUN_DATE, None, kept)
    stored = spark.read.parquet(kept).groupBy("reject_reason").agg(F.count("*").alias("kept"))
    counted = spark.createDataFrame(list(counts.items()), "reason string, lines bigint")
    return counted.join(stored, F.col("reason") == F.col("reject_reason"), "left").select(
        "reason", "lines", F.coalesce("kept", F.lit(0)).alias("kept"))


@query
def kpi_job(spark, sf):
    """Both fact tables as the KPI job leaves them, joined back to the names of their dimensions."""
    events, facts = scratch_dir(spark, "events"), scratch_dir(spark, "facts")
    write_event_logs(_as_event_rows(X.fx(spark, sf)), events, X.RUN_DATE)
    for _ in range(2):
        stats = run_kpis(spark, events, facts, X.RUN_DATE, date(2024, 2, 5))
    return _named_stats(spark, facts, stats)


def _named_stats(spark, facts: str, stats: dict[str, DataFrame]) -> DataFrame:
    """Both fact tables with the names that their ids stand for."""
    dim = {n: spark.read.parquet(current_version(spark, f"{facts}/{n}")) for n in ("dimension_platform", "dimension_date", "dimension_browser")}
    parts = []
    for kpi, table in stats.items():
        named = table
        for name in S.FACT_TABLES[kpi].keys:
            ids = dim["dimension_" + name.split("_")[0]]
            named = named.join(ids.withColumnRenamed("id", name), name)
        for c in S.BROWSER_KEYS:
            named = named if c in named.columns else named.withColumn(c, F.lit(""))
        parts.append(named.select(F.lit(kpi).alias("kpi_name"), *S.PLATFORM_KEYS, "type", "calendar", *S.BROWSER_KEYS, "new_install_users", "created"))
    return parts[0].unionByName(parts[1])


@query
def kpi_job_by_days(spark, sf):
    """As `kpi_job`, from events stored by day and visitor bitmaps made by an earlier run, for all days but late ones."""
    events, days, first, second = (scratch_dir(spark, n) for n in ("events", "days", "facts", "facts"))
    rows = _as_event_rows(X.fx(spark, sf)).withColumn("dt", TP.event_date(F.col("s_time")))
    late = F.pmod(F.xxhash64("u_ud"), F.lit(5)) == 0
    put_events(rows.filter(~late | (F.col("dt") != F.lit(X.RUN_DATE))), events, "early")
    run_kpis_by_days(spark, events, first, days, X.RUN_DATE - timedelta(days=1), date(2024, 2, 5))
    put_events(rows.filter(late & (F.col("dt") == F.lit(X.RUN_DATE))), events, "late")
    stats, read = run_kpis_by_days(spark, events, second, days, X.RUN_DATE, date(2024, 2, 5))
    if read != [X.RUN_DATE]:
        raise AssertionError(f"read {read}")
    return _named_stats(spark, second, stats)


@query
def hourly_two_days(spark, sf):
    """The hourly report after runs for two days and one of them again: the stored table and its TSV, with names."""
    events, facts, tsv = (scratch_dir(spark, n) for n in ("events", "facts", "tsv"))
    rows, days = _as_event_rows(X.fx_dense(spark, sf)), (date(2024, 1, 1), date(2024, 1, 2))
    for day in days:
        write_event_logs(rows.filter(TP.event_date(F.col("s_time")) == F.lit(day)), events, day)
    for day in (*days, days[0]):
        run_hourly(spark, events, facts, day, tsv)
    stored = read_hourly(spark, facts)
    parts = [spark.read.option("sep", "\t").option("nullValue", "\\N").schema(stored.schema).csv(f"{tsv}/dt={day}") for day in days]
    both = stored.withColumn("source", F.lit("table")).unionByName(parts[0].unionByName(parts[1]).withColumn("source", F.lit("tsv")))
    for name, keys in (("platform", S.PLATFORM_KEYS), ("date", ["calendar"]), ("kpi", S.KPI_KEYS)):
        ids = spark.read.parquet(current_version(spark, f"{facts}/dimension_{name}")).select(F.col("id").alias(f"{name}_dimension_id"), *keys)
        both = both.join(ids, f"{name}_dimension_id")
    return both.select("source", *S.PLATFORM_KEYS, "calendar", "kpi_name", *S.HOUR_COLUMNS)


@query
def hourly_increments(spark, sf):
    """Hourly values of a day whose events come in three parts, the last of them anew, each merged as it comes."""
    events, facts, state = (scratch_dir(spark, n) for n in ("events", "facts", "state"))
    rows = _as_event_rows(X.fx_dense(spark, sf)).withColumn("dt", F.lit(X.RUN_DATE))
    part = F.pmod(F.xxhash64("s_time", "u_ud"), F.lit(3))
    for puts in ({"first": part == 0, "second": part > 0}, {"second": part == 1}, {"late": part == 2}):
        for slot, chosen in puts.items():
            put_events(rows.filter(chosen), events, slot)
        run_hourly_increment(spark, events, facts, state, X.RUN_DATE)
    return read_hours(spark, state, X.RUN_DATE)


# ---------------------------------------------------------- other raw lines


@query
def client_set_fields(spark, sf):
    """Address and time that clients put into the query string, taken and refused."""
    lines = X.raw(spark, sf).withColumn("value", F.when(
        F.col("event_id") % 2 == 0, F.concat("value", F.lit("&ip=8.8.4.4&s_time=1704070000123"))).otherwise(F.col("value")))
    f = F.col("fields")
    parts = [
        L.parse_log_lines(lines, protect_reserved=p).select(
            "event_id", F.lit(p).alias("protected"), "parse_error", f["ip"].alias("ip"), f["s_time"].alias("s_time"))
        for p in (False, True)
    ]
    return parts[0].unionByName(parts[1])


@query
def refund_lines(spark, sf):
    """Charges as refunds, some without a member id."""
    value = F.replace("value", F.lit("en=e_cs"), F.lit("en=e_cr"))
    value = F.when(F.col("event_id") % 5 == 0, F.replace(value, F.lit("&u_mid="), F.lit("&x_mid="))).otherwise(value)
    judged = L.classify_events(L.parse_log_lines(X.raw(spark, sf).withColumn("value", value)))
    return judged.select("event_id", F.col("fields")["en"].alias("en"), "reject_reason")


@query
def row_hashes(spark, sf):
    """Events stored twice: copies share their key, and different events of a visitor and time have different ones."""
    valid = L.valid_events(L.classify_events(_parsed(spark, sf)))
    keyed = L.with_row_key(L.to_event_columns(valid.unionByName(valid), ["event_id"]))
    per_event = keyed.groupBy("event_id", "en").agg(
        F.count("*").alias("n"), F.countDistinct("time_in_day", "row_hash").alias("keys"), F.min("row_hash").alias("h"))
    return per_event.groupBy("en").agg(
        F.sum("n").alias("n_rows"), F.max("keys").alias("keys_per_event"), F.countDistinct("h").alias("n_hashes"))
