"""Every registered query against its SQL counterpart."""

import os
from datetime import datetime, timedelta

import __spark_entry__ as E
import catalog.queries as Q
import duckdb
import pytest
from catalog.fixtures import TABLES
from catalog.oracle import ORACLES
from catalog.queries import QUERIES
from compare import compare, oracle
from conftest import plan


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    ok, note = compare(spark, con, sf_dir, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert E.entry(spark).count() > 0


@pytest.fixture(scope="module")
def overlapping(spark, sf_dir, tmp_path_factory):
    """Tables with customers whose ranges reach into both wide ones, as they do from key 32768 and 65536 on."""
    root = tmp_path_factory.mktemp("overlapping")
    for name in os.listdir(sf_dir):
        if name not in ("customer.parquet", "events.parquet"):
            os.symlink(f"{sf_dir}/{name}", root / name)
    keys = [*range(1, 30), *range(32768, 32768 + 1290, 3), *range(65536, 65536 + 60)]
    customers = [(k, k % 25, "BUILDING") for k in keys]
    kinds = ["signup", "view", "click", "purchase"]
    events = [(n, datetime(2024, 1, 3) + timedelta(seconds=n), n % 60, kinds[n // 60 % 4], 1.0) for n in range(1200)]
    spark.createDataFrame(customers, "c_custkey bigint, c_nationkey int, c_mktsegment string").write.parquet(str(root / "customer.parquet"))
    spark.createDataFrame(events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double").coalesce(1).write.parquet(
        str(root / "events.parquet"))
    return root


@pytest.mark.parametrize("name", [
    "ip_range_table", "ip_region", "ip_region_shuffled", "etl_events", "etl_stream_events", "shared_day_scan", "stream_distinct_events",
    "stream_then_batch_scan",
])
def test_overlapping_ranges(spark, overlapping, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{overlapping}/{t}.parquet{'/*.parquet' if (overlapping / f'{t}.parquet').is_dir() else ''}'")
    if name == "ip_region":
        assert con.execute(f"select count(*) > count(distinct event_id) from ({ORACLES[name]})").fetchone()[0]
    ok, note = compare(spark, con, str(overlapping), name)
    assert ok, note


def test_event_table_is_written_from_stored_rows(spark, sf_dir, monkeypatch):
    """The lines are parsed once, not once a write."""
    written, write = [], Q.write_event_logs
    monkeypatch.setattr(Q, "write_event_logs", lambda rows, *args: (written.append(plan(rows)), write(rows, *args)))
    Q.event_table_scan(spark, sf_dir)
    assert len(written) == 3 and not any("regexp_extract_all" in text for text in written)
