"""Days that several writers share: manifests, clashes, compaction; stream duplicates; visitors of days; shared dimensions."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from catalog import fixtures as X
from visitlake import schema as S
from visitlake.operators import visitor_days as VD
from visitlake.operators import visitors as V
from visitlake.plans import jobs as J
from visitlake.sources import event_table as E
from visitlake.sources import files
from visitlake.sources import writers as W
from visitlake.sources.readers import read_dimension, read_event_logs
from visitlake.streaming.streams import etl_stream

DAY, NEXT = date(2024, 1, 10), date(2024, 1, 11)


def events(spark, texts, day=DAY, kind="e_pv"):
    rows = spark.createDataFrame([(t,) for t in texts], "tt string").coalesce(1)
    others = [F.lit(None).cast(S.EVENT_SCHEMA[c].dataType).alias(c) for c in S.EVENT_COLUMNS if c not in ("tt", "en")]
    return rows.select("tt", F.lit(kind).alias("en"), *others, F.lit(day).alias("dt"))


def stored(spark, root, day=DAY):
    return sorted(r.tt for r in read_event_logs(spark, root, day, day + timedelta(days=1)).collect())


def test_writers_of_a_day_keep_each_others_events(spark, tmp_path):
    root = str(tmp_path)
    E.put_events(events(spark, ["s1"]), root, "0000aaaa-000000000")
    W.write_event_logs(events(spark, ["b1", "b2"]).drop("dt"), root, DAY)
    E.put_events(events(spark, ["s2"], kind="e_l"), root, "0000aaaa-000000001")
    W.write_event_logs(events(spark, ["b3"]).drop("dt"), root, DAY)
    E.put_events(events(spark, ["s2 again"], kind="e_l"), root, "0000aaaa-000000001")
    assert stored(spark, root) == ["b3", "s1", "s2 again"]
    W.write_event_logs(events(spark, []).drop("dt"), root, DAY)
    assert stored(spark, root) == ["s1", "s2 again"]
    W.write_event_logs(events(spark, ["other lines"]).drop("dt"), root, DAY, writer="second-job")
    assert stored(spark, root) == ["other lines", "s1", "s2 again"]


def test_a_writer_that_comes_second_loses_nothing(spark, tmp_path, monkeypatch):
    """Another writer commits between this one's reading and its commit, three times over."""
    root, n = str(tmp_path), 0
    real = E.claim

    def interrupted(spark_, source, target):
        nonlocal n
        if n < 3:
            n += 1
            monkeypatch.setattr(E, "claim", real)
            E.put_events(events(spark, [f"other {n}"]), root, f"other-{n}")
            monkeypatch.setattr(E, "claim", interrupted)
        return real(spark_, source, target)

    monkeypatch.setattr(E, "claim", interrupted)
    E.put_events(events(spark, ["mine"]), root, "mine")
    assert stored(spark, root) == ["mine", "other 1", "other 2", "other 3"]


def test_claim_overwrites_nothing(spark, tmp_path):
    for name in "ab":
        files.write_text(spark, str(tmp_path / name), name)
    assert files.claim(spark, str(tmp_path / "a"), str(tmp_path / "x" / "y"))
    assert not files.claim(spark, str(tmp_path / "b"), str(tmp_path / "x" / "y"))
    assert files.read_text(spark, str(tmp_path / "x" / "y")) == "a"


def test_days_without_a_manifest_are_read_and_adopted(spark, tmp_path):
    """What older versions left: files of the batch job in `en=` itself, directories of stream batches beside them."""
    root = str(tmp_path)
    old = events(spark, ["old batch"])
    old.drop("dt", "en").write.parquet(f"{root}/dt={DAY}/en=e_pv")
    events(spark, ["old stream"]).drop("dt", "en").write.parquet(f"{root}/dt={DAY}/en=e_l/0000aaaa-000000000")
    assert stored(spark, root) == ["old batch", "old stream"]
    E.put_events(events(spark, ["new stream"]), root, "0000aaaa-000000001")
    assert stored(spark, root) == ["new stream", "old batch", "old stream"]
    W.write_event_logs(events(spark, ["new batch"]).drop("dt"), root, DAY)
    assert stored(spark, root) == ["new batch", "new stream", "old stream"]


def test_compaction(spark, tmp_path):
    """Many small batches become few files; a reader's state from before stays whole; the batch job's files stay."""
    root = str(tmp_path)
    W.write_event_logs(events(spark, ["batch"]).drop("dt"), root, DAY)
    for n in range(30):
        E.put_events(events(spark, [f"{n:02d} {i}" for i in range(3)], kind="e_pv" if n % 3 else "e_l"), root, f"0000aaaa-{n:09d}")
    before = read_event_logs(spark, root, DAY, NEXT)
    want = sorted(["batch", *(f"{n:02d} {i}" for n in range(30) for i in range(3))])
    assert E.compact_day(spark, root, DAY) == 29
    assert stored(spark, root) == want == sorted(r.tt for r in before.collect())
    paths = E.live_paths(spark, E.day_dir(root, DAY))
    assert len(paths) == 4 and sum(len(list((tmp_path / p.split(str(tmp_path))[1].strip("/")).glob("part-*"))) for p in paths) == 4
    assert E.compact_day(spark, root, DAY) == 0
    E.put_events(events(spark, ["late repeat"]), root, "0000aaaa-000000003")  # is in the packed files already
    E.put_events(events(spark, ["29 again"], kind="e_pv"), root, "0000aaaa-000000029")
    assert stored(spark, root) == sorted([t for t in want if not t.startswith("29")] + ["29 again"])
    for n in range(30, 33):
        E.put_events(events(spark, [f"{n}"]), root, f"0000aaaa-{n:09d}")
    assert E.compact_day(spark, root, DAY) >= 3 and len(stored(spark, root)) == 88 + 1 + 3 + 0


def test_compaction_gives_way_to_a_writer(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for n in range(4):
        E.put_events(events(spark, [f"{n}"]), root, f"0000aaaa-{n:09d}")
    real = E.commit

    def later(spark_, day, change):
        monkeypatch.setattr(E, "commit", real)
        E.put_events(events(spark, ["1 anew"]), root, "0000aaaa-000000001")
        return real(spark_, day, change)

    monkeypatch.setattr(E, "commit", later)
    assert E.compact_day(spark, root, DAY) == 0
    assert stored(spark, root) == ["0", "1 anew", "2", "3"]


def test_bins_hold_no_more_than_the_target():
    rnd = random.Random(5)
    sizes = {f"p{n}": rnd.randint(1, 60) for n in range(200)}
    bins = E._bins(sizes, 100)
    full = [sum(s for p, s in sizes.items() if bins[p] == b) for b in set(bins.values())]
    assert max(full) <= 100 and len(full) <= sum(sizes.values()) / 100 * 1.3
    assert E._bins({"big": 500, "small": 1}, 100) == {"big": 0, "small": 1}


def test_old_labels_are_deleted_some_commits_later(spark, tmp_path):
    root = str(tmp_path)
    for n in range(E.KEEP_VERSIONS + 4):
        W.write_event_logs(events(spark, [f"run {n}"]).drop("dt"), root, DAY)
    assert stored(spark, root) == [f"run {E.KEEP_VERSIONS + 3}"]
    assert len(files.matching(spark, f"{root}/dt={DAY}/en=*/*")) == E.KEEP_VERSIONS


@pytest.mark.parametrize("within", ["1 day", None])
def test_stream_duplicates(spark, sf_dir, tmp_path, within):
    src, root, ckpt = (str(tmp_path / n) for n in ("src", "events", "ckpt"))
    lines = X.raw(spark, sf_dir).select("value").limit(300).coalesce(1)
    lines.write.text(src)
    lines.limit(50).write.mode("append").text(src)
    etl_stream(spark, src, root, ckpt, max_files_per_trigger=1, distinct_within=within).awaitTermination()
    lines.limit(20).write.mode("append").text(src)
    etl_stream(spark, src, root, ckpt, max_files_per_trigger=1, distinct_within=within).awaitTermination()
    got = spark.read.schema(S.EVENT_SCHEMA).parquet(root).select(*S.EVENT_COLUMNS)
    want = J.etl(lines)[0].select(*S.EVENT_COLUMNS)
    text = lambda df: sorted(repr(tuple(sorted(v.items()) if isinstance(v, dict) else v for v in r)) for r in df.collect())
    if within:
        assert text(got) == text(want)
    else:
        assert set(text(got)) == set(text(want)) and got.count() > want.count()


def test_digest_tells_what_dedupe_tells(spark):
    """Same events from different texts share their digest; any difference in content, also a blank, does not."""
    from visitlake.operators import lines as L

    base = {"s_time": "1704067200000", "en": "e_l", "pl": "website", "u_ud": "u", "ip": "1.2.3.4"}
    rows = [base, dict(reversed(base.items())), {**base, "s_time": "01704067200000"}, {**base, "x": "1"}, {**base, "ver": " "},
            {**base, "u_ud": "u2"}, {**base, "x": None}, {**base, "country": "c"}]
    valid = spark.createDataFrame([(n, r) for n, r in enumerate(rows)], "n int, fields map<string,string>")
    named = L.with_agent_fields(valid)
    digests = [r[0] for r in named.withColumn("d", L.event_digest(named, located=False)).orderBy("n").select("d").collect()]
    assert len(set(digests)) == 5 and digests[0] == digests[1] == digests[2] == digests[6]
    located = [r[0] for r in named.withColumn("d", L.event_digest(named, located=True)).orderBy("n").select("d").collect()]
    assert located[7] == located[0]


def test_visitors_of_days_merge_to_weeks_and_months(spark, tmp_path):
    """Random launches over two months, some stored on later days, counted from bitmaps and from events."""
    rnd, root, days = random.Random(3), str(tmp_path / "events"), str(tmp_path / "days")
    rows = []
    for n in range(1500):
        at = date(2024, 1, 1) + timedelta(days=rnd.randint(0, 45))
        stored_on = at + timedelta(days=rnd.choice([0, 0, 0, 1]))
        ms = (at - date(1970, 1, 1)).days * 86_400_000 + rnd.randint(0, 86_399_999)
        rows.append((stored_on, ms, rnd.choice(["e_l", "e_l", "e_pv"]), rnd.choice(["website", "all", None, " "]), rnd.choice(["1", "all", None]),
                     rnd.choice([*(f"u{rnd.randint(0, 60)}" for _ in range(8)), None, " "]), rnd.choice(["Chrome", None, "all"]), rnd.choice(["4", "all", None])))
    short = spark.createDataFrame(rows, "dt date, s_time bigint, en string, pl string, ver string, u_ud string, browser string, browser_v string")
    whole = short.select("*", *[F.lit(None).cast(S.EVENT_SCHEMA[c].dataType).alias(c) for c in S.EVENT_COLUMNS if c not in short.columns])
    E.put_events(whole, root, "lines")
    today = date(2024, 2, 28)
    for run_date in (date(2024, 1, 10), date(2024, 1, 31)):
        _, read = J.run_kpis_by_days(spark, root, str(tmp_path / "facts"), days, run_date, today)
        window = J.scan_window(run_date, today)
        inside = read_event_logs(spark, root, window.start, window.end)
        from visitlake.sources.visitor_table import read_visitor_days
        got = VD.install_kpis_of_days(read_visitor_days(spark, days, [window.start + timedelta(days=n) for n in range((window.end - window.start).days)]), run_date)
        want = V.install_kpis(inside, run_date)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.select(*got.columns).collect()), key=repr)
    assert read == [d for d in read if d >= date(2024, 2, 1)]  # January's days were made before
    E.put_events(whole.filter("u_ud = 'u1'").withColumn("dt", F.lit(date(2024, 1, 7))).withColumn("u_ud", F.lit("late")), root, "late")
    _, read = J.run_kpis_by_days(spark, root, str(tmp_path / "facts"), days, date(2024, 1, 10), today)
    assert read == [date(2024, 1, 7)]


def test_two_writers_of_a_dimension(spark, tmp_path, monkeypatch):
    """Another writer adds keys between reading and committing: ids that were given stay, none is given twice."""
    root, real = str(tmp_path), W.try_version
    key = lambda *names: spark.createDataFrame([(n, "1") for n in names], "platform_name string, platform_version string")
    W.update_dimension(spark, root, "dimension_platform", key("a"))

    def interrupted(df, table, number):
        monkeypatch.setattr(W, "try_version", real)
        W.update_dimension(spark, root, "dimension_platform", key("b", "c"))
        return real(df, table, number)

    monkeypatch.setattr(W, "try_version", interrupted)
    W.update_dimension(spark, root, "dimension_platform", key("b", "d"))
    ids = {r.platform_name: r.id for r in read_dimension(spark, root, "dimension_platform").collect()}
    assert ids["a"] == 1 and {ids["b"], ids["c"]} == {2, 3} and ids["d"] == 4
