"""Stored tables, jobs, command line and streams."""

import os
from datetime import date, timedelta
from pathlib import Path

import pytest
from conftest import plan
from pyspark.sql import functions as F

from catalog import fixtures as X
from visitlake import schema as S
from visitlake.__main__ import main
from visitlake.operators import hourly as H
from visitlake.operators import visitors as V
from visitlake.operators.lines import packed_by_size, rolled_by_size
from visitlake.plans.jobs import etl, run_etl, run_hourly, run_kpis
from visitlake.sources import writers as W
from visitlake.sources.readers import current_version, load_ip_ranges, read_event_logs, read_facts, read_raw_logs
from visitlake.streaming import streams as ST

DAY = timedelta(days=1)


def rows(df):
    return sorted((tuple(sorted(v.items()) if isinstance(v, dict) else v for v in r) for r in df.collect()), key=repr)


def store_raw(spark, sf_dir, root, run_date=X.RUN_DATE):
    X.raw(spark, sf_dir).select("value").write.mode("overwrite").text(f"{root}/{run_date:%Y/%m/%d}")


def test_etl_twice_is_the_same(spark, sf_dir, tmp_path):
    raw, events, rejected = (str(tmp_path / n) for n in ("raw", "events", "rejected"))
    store_raw(spark, sf_dir, raw)
    ranges = X.ip_ranges(spark, sf_dir)
    counts = run_etl(spark, raw, events, X.RUN_DATE, ranges, rejected)
    first = rows(read_event_logs(spark, events, X.RUN_DATE, X.RUN_DATE + DAY))
    assert run_etl(spark, raw, events, X.RUN_DATE, ranges, rejected) == counts
    assert rows(read_event_logs(spark, events, X.RUN_DATE, X.RUN_DATE + DAY)) == first
    lost = spark.read.parquet(rejected)
    assert counts["lines"] == X.raw(spark, sf_dir).count() == len(first) + lost.count()
    by_reason = {r.reject_reason: r["count"] for r in lost.groupBy("reject_reason").count().collect()}
    assert {k: v for k, v in counts.items() if k != "lines" and v} == by_reason


def test_empty_rerun_clears_the_day(spark, sf_dir, tmp_path):
    raw, events = str(tmp_path / "raw"), str(tmp_path / "events")
    store_raw(spark, sf_dir, raw)
    run_etl(spark, raw, events, X.RUN_DATE)
    store_raw(spark, sf_dir, raw, X.RUN_DATE + DAY)
    run_etl(spark, raw, events, X.RUN_DATE + DAY)
    spark.createDataFrame([("junk",)], "value string").write.mode("overwrite").text(f"{raw}/{X.RUN_DATE:%Y/%m/%d}")
    run_etl(spark, raw, events, X.RUN_DATE)
    both = read_event_logs(spark, events, X.RUN_DATE, X.RUN_DATE + 2 * DAY)
    assert {r.dt for r in both.select("dt").distinct().collect()} == {X.RUN_DATE + DAY}


def test_missing_data_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_raw_logs(spark, str(tmp_path), X.RUN_DATE)
    with pytest.raises(FileNotFoundError):
        read_event_logs(spark, str(tmp_path / "none"), X.RUN_DATE, X.RUN_DATE + DAY)
    bad = str(tmp_path / "ranges")
    spark.createDataFrame([(5, 1, "x", "y")], S.IP_RANGE_SCHEMA).write.parquet(bad)
    with pytest.raises(Exception, match="unusable IP range"):
        load_ip_ranges(spark, bad).collect()
    twice = str(tmp_path / "twice")
    spark.createDataFrame([(1, 5, "x", "y"), (5, 9, "x", "y")], S.IP_RANGE_SCHEMA).write.parquet(twice)
    with pytest.raises(ValueError, match="overlapping"):
        load_ip_ranges(spark, twice)


def test_scans_are_pruned(spark, sf_dir, tmp_path):
    raw, events = str(tmp_path / "raw"), str(tmp_path / "events")
    store_raw(spark, sf_dir, raw)
    run_etl(spark, raw, events, X.RUN_DATE)
    text = plan(V.new_install_users(read_event_logs(spark, events, X.RUN_DATE, X.RUN_DATE + DAY), X.RUN_DATE))
    filters = text[text.index("PartitionFilters"):text.index("PushedFilters")]
    assert "dt#" in filters and "en#" in filters
    schema = text[text.index("ReadSchema"):].split("\n")[0]
    assert "p_url" not in schema and "extra" not in schema


def test_kpi_and_hourly_jobs(spark, sf_dir, tmp_path):
    events, facts, tsv = (str(tmp_path / n) for n in ("events", "facts", "tsv"))
    fx = X.fx_dense(spark, sf_dir).withColumn("s_time", F.col("s_time") + 9 * 86_400_000)
    missing = [c for c in S.EVENT_COLUMNS if c not in fx.columns]
    fx = fx.select("*", *[F.lit(None).cast(S.EVENT_SCHEMA[c].dataType).alias(c) for c in missing])
    W.write_event_logs(fx, events, X.RUN_DATE)
    run_kpis(spark, events, facts, X.RUN_DATE, date(2024, 2, 5))
    stats = read_facts(spark, facts, S.FACT_TABLES[S.KPI_NEW_USERS])
    want = V.new_install_users(fx, X.RUN_DATE)
    assert sorted(r[0] for r in stats.select("new_install_users").collect()) == sorted(
        r[0] for r in want.select("new_install_users").collect())
    assert stats.filter("platform_dimension_id is null or date_dimension_id is null").count() == 0
    before = rows(stats)
    again = run_kpis(spark, events, facts, X.RUN_DATE, date(2024, 2, 5))
    assert rows(again[S.KPI_NEW_USERS]) == before
    assert again[S.KPI_BROWSER_NEW_USERS].count() == V.browser_new_install_users(fx, X.RUN_DATE).count()
    report = run_hourly(spark, events, facts, X.RUN_DATE, tsv)
    assert report.count() == H.pivot_hours(H.hourly_kpis(fx)).count()
    assert report.filter("platform_dimension_id is null or date_dimension_id is null or kpi_dimension_id is null").count() == 0
    assert spark.read.option("sep", "\t").csv(f"{tsv}/dt={X.RUN_DATE}").count() == report.count()
    dims = spark.read.parquet(current_version(spark, f"{facts}/dimension_platform"))
    assert dims.count() == dims.select("id").distinct().count() == dims.select(*S.PLATFORM_KEYS).distinct().count()


def test_unfinished_version_is_ignored(spark, tmp_path):
    table = str(tmp_path / "t")
    W.write_version(spark.range(3), table)
    path = W.write_version(spark.range(5), table)
    os.remove(f"{path}/_SUCCESS")
    assert spark.read.parquet(current_version(spark, table)).count() == 3
    assert W.write_version(spark.range(7), table).endswith("00000003")


def test_command_line(spark, sf_dir, tmp_path):
    raw, events, facts = (str(tmp_path / n) for n in ("raw", "events", "facts"))
    store_raw(spark, sf_dir, raw)
    day = X.RUN_DATE.isoformat()
    assert main(["etl", "--date", day, "--raw", raw, "--events", events], spark) == 0
    assert main(["hourly", "-date", day, "--events", events, "--facts", facts], spark) == 0
    assert main(["kpi", "--date", day, "--events", events, "--facts", facts], spark) == 0
    assert main(["kpi", "--date", day, "--events", events, "--facts", facts, "--days", str(tmp_path / "days")], spark) == 0
    assert main(["hourly", "--date", day, "--events", events, "--facts", facts, "--state", str(tmp_path / "state")], spark) == 0
    assert main(["compact", "--date", day, "--events", events], spark) == 0
    assert main(["etl", "--date", "2001-01-01", "--raw", raw, "--events", events], spark) == 1


def test_jdbc_options():
    got = W.jdbc_options("jdbc:x", "stats_hourly", 10, user="u")
    assert got == {"url": "jdbc:x", "dbtable": "stats_hourly", "batchsize": "10", "user": "u"}


@pytest.mark.parametrize("options", [{}, {"max_rows": 0}])
def test_stream_equals_batch(spark, sf_dir, tmp_path, options):
    src, dst, ckpt = (str(tmp_path / n) for n in ("src", "dst", "ckpt"))
    lines = X.raw(spark, sf_dir).select("value")
    ranges = X.ip_ranges(spark, sf_dir)
    lines.repartition(4).write.text(src)
    for _ in range(2):  # the second run finds nothing new
        ST.etl_stream(spark, src, dst, ckpt, ranges, max_files_per_trigger=2, **options).awaitTermination()
    got = spark.read.schema(S.EVENT_SCHEMA).parquet(dst).select(*S.EVENT_COLUMNS)
    assert rows(got) == rows(etl(lines, ranges)[0].select(*S.EVENT_COLUMNS))


def test_repeated_stream_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    batch = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "b", "y")], "n int, dt string, en string")
    for _ in range(2):
        W.append_batch(batch.write.format("parquet").partitionBy("dt", "en"), spark, root, 2, "s-0")
    W.append_batch(batch.filter("n = 1").write.format("parquet").partitionBy("dt", "en"), spark, root, 2, "s-1")
    assert sorted(r.n for r in spark.read.parquet(root).collect()) == [1, 1, 2, 3]


def test_upsert_leaves_other_periods_alone(spark, tmp_path):
    fact = S.FactTable("t", ("k", "m"), "n", "m")
    make = lambda values: spark.createDataFrame([(*v, date(2024, 1, 1)) for v in values], "k int, m string, n bigint, created date")
    files = lambda: {str(p) for p in tmp_path.rglob("part-*.parquet")}
    W.upsert_table(spark, str(tmp_path), fact, make([(1, "2024-01", 5), (1, "2024-02", 6), (None, "2024-02", 7)]))
    before = files()
    table = W.upsert_table(spark, str(tmp_path), fact, make([(1, "2024-02", 9)]))
    assert sorted((r.m, r.k or 0, r.n) for r in table.collect()) == [("2024-01", 1, 5), ("2024-02", 0, 7), ("2024-02", 1, 9)]
    assert before <= files() and all("period=2024-02" in f for f in files() - before)
    for n in range(8):
        W.upsert_table(spark, str(tmp_path), fact, make([(1, "2024-02", n)]))
    assert len({p.parent for p in tmp_path.rglob("part-*.parquet") if "period=2024-02" in str(p)}) == W.KEEP_VERSIONS


@pytest.mark.parametrize("cuts", [[5], [1, 4], [2, 2, 1], [1, 1, 1, 1, 1]])
def test_last_row_of_a_key_counts(spark, tmp_path, cuts):
    fact = S.FactTable("t", ("k",), "n")
    data = [(1, 9, 1), (None, 4, 2), (1, 5, 3), (None, 8, 4), (2, 3, 5)]
    upsert = ST.upsert_batch(str(tmp_path), fact, "seq")
    for batch_id, n in enumerate(cuts):
        part, data = data[:n], data[n:]
        upsert(spark.createDataFrame([(*r, date(2024, 1, 1)) for r in part], "k int, n bigint, seq int, created date"), batch_id)
    assert {r.k: r.n for r in read_facts(spark, str(tmp_path), fact).collect()} == {1: 5, None: 8, 2: 3}


def test_rows_that_disagree_need_a_sequence(spark, tmp_path):
    batch = spark.createDataFrame([(1, 9, date(2024, 1, 1)), (1, 5, date(2024, 1, 1))], "k int, n bigint, created date")
    with pytest.raises(Exception, match="disagree"):
        ST.upsert_batch(str(tmp_path), S.FactTable("t", ("k",), "n"))(batch, 0)


def test_one_day_is_listed(spark, tmp_path):
    for day in (1, 2):
        for root in (f"{tmp_path}/2024/01/0{day}", f"{tmp_path}/arrival_date=2024-01-0{day}/s-0"):
            spark.createDataFrame([(f"{root[-14:]}",)], "value string").write.text(root)
    lines = read_raw_logs(spark, str(tmp_path), date(2024, 1, 2))
    assert lines.count() == 2 and all("0" + "2" in f for f in lines.inputFiles())


def test_collected_lines_are_read_back(spark, sf_dir, tmp_path):
    src, dst, ckpt = (str(tmp_path / n) for n in ("src", "dst", "ckpt"))
    lines = X.raw(spark, sf_dir).select("value")
    lines.write.text(src)
    ST.ingest_stream(spark, src, dst, ckpt, max_records_per_file=300).awaitTermination()
    lines.limit(5).write.mode("append").text(src)
    ST.ingest_stream(spark, src, dst, ckpt).awaitTermination()
    landed = spark.read.text(dst)
    assert landed.count() == lines.count() + 5
    arrived = landed.select("arrival_date").distinct().collect()
    assert sum(read_raw_logs(spark, dst, r.arrival_date).count() for r in arrived) == landed.count()


def test_landed_files_roll_by_size(spark, tmp_path):
    """No file above the limit but a longer line alone; every line is kept, files fill up, and a batch adds no column."""
    src, dst, ckpt = (str(tmp_path / n) for n in ("src", "dst", "ckpt"))
    long = ["x" * 500, "é" * 3000, "y" * 9000]
    values = [f"line {i} " + "ü" * (i % 90) for i in range(2000)] + long + ["", "last"]
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(2).write.text(src)
    ST.ingest_stream(spark, src, dst, ckpt, max_bytes_per_file=4000).awaitTermination()
    landed = spark.read.text(dst)
    assert landed.columns == ["value", "arrival_date"]
    assert sorted(r.value for r in landed.collect()) == sorted(values)
    files = [p for p in Path(dst).rglob("*.txt") if "_incoming" not in p.parts]
    sizes = {p: p.stat().st_size for p in files}
    assert all(n <= 4000 or len(p.read_text().splitlines()) == 1 for p, n in sizes.items())
    assert sorted(n for n in sizes.values() if n > 4000) == [6001, 9001]
    total = sum(len(v.encode()) + 1 for v in values)
    assert sum(sizes.values()) == total and len(files) <= total / 3000 + 5


@pytest.mark.parametrize("packed", [True, False])
def test_small_landed_files_are_not_moved(spark, tmp_path, monkeypatch, packed):
    """Files that may be a row are written in place, so moves do not grow with them; others come by directories."""
    moves, move = [], W.move
    monkeypatch.setattr(W, "move", lambda spark, *paths: (moves.append(paths), move(spark, *paths)))
    if not packed:
        monkeypatch.setattr(ST, "PACKED_BYTES", 0)
    src, dst, ckpt = (str(tmp_path / n) for n in ("src", "dst", "ckpt"))
    values = [f"{i:05d}" + "é" * (i % 50) for i in range(3000)] + ["", "z" * 700]
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.text(src)
    ST.ingest_stream(spark, src, dst, ckpt, max_bytes_per_file=1000).awaitTermination()
    landed = spark.read.text(dst)
    assert landed.columns == ["value", "arrival_date"] and sorted(r.value for r in landed.collect()) == sorted(values)
    files = [p for p in Path(dst).rglob("*.txt") if "_incoming" not in p.parts]
    assert all(p.stat().st_size <= 1000 for p in files) and len(files) > 150
    for text in (p.read_text() for p in files):  # lines of a file stay in order
        told = [line for line in text.splitlines() if line]
        assert told == sorted(told)
    assert (len(moves) <= 2) == packed


def test_packed_lines_of_awkward_texts(spark):
    df = spark.createDataFrame([(None, 1), ("", 1), ("a" * 8, 2), ("b", 2)], "value string, day int").coalesce(1)
    assert sorted((r.value, r.day) for r in packed_by_size(df, 16, ["day"]).collect()) == [("\n", 1), ("a" * 8, 2), ("b", 2)]
    assert packed_by_size(df.limit(0), 16, ["day"]).count() == 0


def test_range_table_with_overlaps(spark, tmp_path):
    path, ranges = str(tmp_path / "ranges"), [(1, 9, "x", "y"), (1, 9, "x", "y"), (3, 4, "z", "")]
    spark.createDataFrame(ranges, S.IP_RANGE_SCHEMA).write.parquet(path)
    assert sorted(tuple(r) for r in load_ip_ranges(spark, path, overlaps="every").collect()) == ranges
    with pytest.raises(ValueError, match="overlapping"):
        load_ip_ranges(spark, path)


def test_roll_by_size_of_awkward_lines(spark):
    df = spark.createDataFrame([(None,), ("",), ("a" * 8,)], "value string")
    assert rolled_by_size(df.coalesce(1), 16).select("roll").distinct().count() == 2
    assert rolled_by_size(df.limit(0), 16).count() == 0
    with pytest.raises(ValueError):
        rolled_by_size(df, 7)


def test_repeated_batch_changes_nothing(spark, tmp_path):
    fact = S.FactTable("t", ("k",), "n")
    batch = spark.createDataFrame([(1, 5, date(2024, 1, 1)), (2, 6, date(2024, 1, 1))], "k int, n bigint, created date")
    upsert = ST.upsert_batch(str(tmp_path), fact)
    upsert(batch, 0)
    first = rows(read_facts(spark, str(tmp_path), fact))
    upsert(batch, 0)
    assert rows(read_facts(spark, str(tmp_path), fact)) == first
