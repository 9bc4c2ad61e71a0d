"""Language identification, quality ranking and language-model scores."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from helpers import awkward, empty, table
from pyspark.sql import functions as F

from visitlake.llm import language, ppm, quality
from visitlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def remainder(doc_id, folds):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def test_languages_of_held_out_texts(spark):
    docs = table(spark, SF, "documents")
    got = {r.doc_id: r for r in QUERIES["op7_language_id"](spark, SF).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert all(r.held_out == (remainder(d, 4) == 2) and 0 <= r.score <= 1 for d, r in got.items()) and got.keys() == truth.keys()
    held = [d for d, r in got.items() if r.held_out]
    assert sum(got[d].lang_pred == truth[d] for d in held) >= 0.98 * len(held)
    # a held-out label that changes changes nothing
    spoiled = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang")))
    again = {r.doc_id: (r.lang_pred, r.score) for r in language.identify_languages(spoiled).collect()}
    assert again == {d: (r.lang_pred, r.score) for d, r in got.items()}


def test_language_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = language.identify_languages(docs).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        silent = r.doc_id in (2, 3, 4, 6)
        assert (r.lang_pred == "und") == silent if r.doc_id is not None else True
        assert r.lang_pred in ("und", "en", "fr") and (r.score == 0) == (r.lang_pred == "und"), texts
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and not {2, 3, 4, 6} & {r.doc_id for r in kept.collect()}
    assert language.identify_languages(empty(spark)).count() == 0
    unlabelled = language.identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_elastic_net_leaves_few_weights():
    rng = np.random.default_rng(0)
    rows = []
    for k in range(400):
        c = k % 2
        rows.append((np.array([c, 2 + rng.integers(500)]), np.array([0.9, 0.4]), c))
    weights = language.train_ftrl(rows, 600, 2, language.FtrlOptions(l1=0.5))
    assert weights[0, 0] > 0 > weights[0, 1] and weights[1, 1] > 0 and (weights[2:] == 0).mean() > 0.9


def test_temperature_softens_overconfidence():
    rng = np.random.default_rng(1)
    truth = rng.integers(3, size=600)
    logits = rng.normal(size=(600, 3))
    logits[np.arange(600), truth] += 1
    assert 5 < language.fit_temperature(8 * logits, truth) < 12


def test_quality_of_held_out_texts(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = {r.doc_id: r for r in QUERIES["op6_quality_scores"](spark, SF).collect()}
    assert all(r.held_out == (remainder(d, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in got.items())
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [d for d in truth if d in got and got[d].held_out]
    good = [got[d].score for d in held if truth[d] == 1]
    bad = [got[d].score for d in held if truth[d] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert sum(got[d].predicted == truth[d] for d in held) >= 0.9 * len(held)
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.score_quality(docs, flipped).collect()}
    assert again == {d: r.score for d, r in got.items()}


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark, [(100 + i, "fine text with several words. " * (i + 1), "en", "a") for i in range(20)])
    labels = spark.createDataFrame([(100 + i, i % 2, 0) for i in range(20)] + [(None, 1, 0), (1, None, 0), (5, 7, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert quality.score_quality(empty(spark), labels).count() == 0
    blank = quality.score_quality(docs, labels.limit(0)).collect()
    assert len(blank) == docs.count() and {round(r.score, 9) for r in blank} == {0.3}


def slow_ppm(training, text):
    contexts = [defaultdict(Counter) for _ in range(3)]
    for t in training:
        marked = b"\xff\xff" + t + b"\xff"
        for i in range(2, len(marked)):
            for order in range(3):
                contexts[order][marked[i - order : i]][marked[i]] += 1

    def log_chance(history, symbol):
        excluded, total = set(), 0.0
        for order in (2, 1, 0):
            counted = contexts[order].get(history[len(history) - order :], Counter())
            fresh = {s: n for s, n in counted.items() if s not in excluded}
            if fresh:
                whole = sum(fresh.values()) + len(fresh)
                if symbol in fresh:
                    return total + math.log10(fresh[symbol] / whole)
                total += math.log10(len(fresh) / whole)
            excluded |= set(counted)
        return total - math.log10(256 - len(excluded))

    marked = b"\xff\xff" + text + b"\xff"
    return sum(log_chance(marked[i - 2 : i], marked[i]) for i in range(2, len(marked)))


def check_scores(rows, docs):
    texts = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    training = [t for d, t in texts if remainder(d, 5) != 1]
    counts = Counter(w for t in training for w in (*t.lower().split(), None))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    cache = {}
    for d, t in texts:
        words = [*t.lower().split(), None]
        if t not in cache:
            cache[t] = slow_ppm(training, t) if len(t) < 20_000 else None
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        score = None if cache[t] is None else round(cache[t], 2)
        want[d, remainder(d, 5) == 1, len(words), sum(counts[w] > 0 for w in words), n, round(base, 3), score] += 1
    long = {d for d, t in texts if len(t) >= 20_000}
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3), None if r.doc_id in long else round(r.score, 2)) for r in rows)
    assert got == want


def test_scores_of_awkward_rows(spark):
    docs = awkward(spark, [(20, "Zebra zebra ñu", "en", "a"), (21, "zebra", "en", "a"), (22, "\x00\x01 odd", "en", "a")])
    check_scores(ppm.score_texts(docs).collect(), docs)
    assert ppm.score_texts(empty(spark)).count() == 0


def test_cold_and_hot_tokens_agree(spark, monkeypatch):
    docs = awkward(spark).filter("doc_id is null or doc_id <> 5")
    for share in (1.0, 1e-9):
        monkeypatch.setattr(ppm, "HOT_SHARE", share)
        check_scores(ppm.score_texts(docs).collect(), docs)


@pytest.mark.parametrize("seed", [0, 1])
def test_codes_of_a_context_are_a_distribution(seed):
    rng = np.random.default_rng(seed)
    leaves = np.unique(rng.integers(0, 1 << 24, 3000).astype(np.int32))
    codes = ppm.code_table(leaves, rng.integers(1, 50, len(leaves)))
    sums = (10.0 ** codes[rng.integers(256, size=200), rng.integers(256, size=200)]).sum(axis=1)
    assert np.all(sums <= 1 + 1e-4) and np.all(sums > 0.5)


def slow_deep_ppm(training, text, order):
    contexts = [defaultdict(Counter) for _ in range(order + 1)]
    mark = b"\xff" * order
    for t in training:
        marked = mark + t + b"\xff"
        for i in range(order, len(marked)):
            for k in range(order + 1):
                contexts[k][marked[i - k : i]][marked[i]] += 1
    marked, score = mark + text + b"\xff", 0.0
    for i in range(order, len(marked)):
        excluded = set()
        for k in range(order, -1, -1):
            counted = contexts[k].get(marked[i - k : i], Counter())
            fresh = {s: n for s, n in counted.items() if s not in excluded}
            if marked[i] in fresh:
                score += math.log10(fresh[marked[i]] / (sum(fresh.values()) + len(fresh)))
                break
            if fresh:
                score += math.log10(len(fresh) / (sum(fresh.values()) + len(fresh)))
            excluded |= set(counted)
        else:
            score -= math.log10(256 - len(excluded))
    return score


@pytest.mark.parametrize("hot, order", [(1 << 21, 5), (0, 5), (200, 4)])
def test_contexts_of_higher_orders(spark, monkeypatch, hot, order):
    monkeypatch.setattr(ppm, "HOT_GRAMS", hot)
    more = [(100 + i, f"passage {i % 7} that comes again, with number {i} and \x00 odd ñ bytes", "en", "a") for i in range(40)]
    docs = awkward(spark, more)
    texts = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    training = [t for d, t in texts if remainder(d, 5) != 1]
    want = Counter((d, float(f"{slow_deep_ppm(training, t, order):.5g}")) for d, t in texts)
    assert Counter((r.doc_id, float(f"{r.score:.5g}")) for r in ppm.score_texts(docs, order=order).collect()) == want
    assert ppm.score_texts(empty(spark), order=order).count() == 0


def test_the_query_uses_contexts_of_more_than_two_bytes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    deep = {r.doc_id: r for r in QUERIES["op4_lm_scores"](spark, sf_dir).collect()}
    flat = {r.doc_id: r for r in ppm.score_texts(docs).collect()}
    assert deep.keys() == flat.keys() and all(deep[d].base_score == pytest.approx(flat[d].base_score) for d in flat)
    held = [d for d in flat if flat[d].held_out]
    assert sum(deep[d].score for d in held) > sum(flat[d].score for d in held)


@pytest.mark.parametrize("window", [1, 50, 1 << 18])
def test_windows_of_contexts_change_no_code(monkeypatch, window):
    """The coder, run here on rows in its order, whose windows split contexts of three bytes."""
    monkeypatch.setattr(ppm, "_WINDOW", window)
    rnd, order = random.Random(12), 5
    texts = ["".join(rnd.choice("abc ") for _ in range(600)).encode(), b"x" * 300, b"", "ñandú, ".encode() * 9]
    found = [g for grams, _ in ppm._windows(texts, order) for g in grams.tolist()]
    counts = Counter(found)
    nodes = Counter()
    for gram, n in counts.items():
        nodes[gram & 0xFFFFFFFF] += n
    rows = [(0, g, n) for g, n in nodes.items()] + [(1, g, n) for g, n in counts.items()]
    rows.sort(key=lambda r: (r[1] >> 16 & 0xFF, r[1] >> 8 & 0xFFFFFF, r[0], r[1] >> 8 & 0xFFFFFFFF))
    trie = Counter()
    for gram, n in counts.items():
        trie[gram & 0xFFFFFF] += n
    leaves = np.array(sorted(trie), dtype=np.int32)
    leaf_counts = np.array([trie[x] for x in leaves.tolist()], dtype=np.int64)
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[at : at + 40])], names=["kind", "gram", "n"]) for at in range(0, len(rows), 40)]
    codes = {}
    for batch in ppm._coder(leaves.tobytes(), leaf_counts.tobytes(), order)(iter(batches)):
        codes.update(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
    assert codes.keys() == counts.keys()
    for text in texts:
        grams = [g for found, _ in ppm._windows([text], order) for g in found.tolist()]
        assert sum(codes[g] for g in grams) == pytest.approx(slow_deep_ppm(texts, text, order), rel=1e-6)


def test_slices_go_by_bytes():
    texts = pa.array([*[b"a" * 900] * 600, b"b" * 2_000_000, None, *[b"c" * 700_000] * 3], pa.binary())
    assert list(ppm._byte_slices(texts)) == [(0, 512), (512, 89), (601, 3), (604, 1)]


def test_parts_of_a_text_are_bounded():
    rnd = random.Random(2)
    text = bytes(rnd.randrange(97, 123) for _ in range(3_000_000))
    none = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.float32)
    parts = [grams for _, grams in ppm._deep_scores([text], none, 5)]
    assert len(parts) > 3 and max(len(p.values) for p in parts) <= ppm._PART + ppm._WINDOW
    assert sum(pa.compute.sum(p.values.field("n")).as_py() for p in parts) == len(text) + 1
