"""What keeps the operators bounded: spans of very long texts, hashed shapes, samples, survivors of bounds, short items."""

import random
import time

import numpy as np
import pytest
from helpers import DOCS, awkward, empty
from pyspark.sql import functions as F

from visitlake.llm import decontaminate, language, mixing, pii, quality, secret_scan, spans, topk

SPAN = "array<struct<kind:string,start:int,end:int>>"


def some_spans(rng, kinds, n):
    """Spans in order that do not overlap within a kind."""
    out = []
    for kind in kinds:
        cuts = sorted(rng.sample(range(60), 2 * rng.randrange(n)))
        out += [(kind, a, b) for a, b in zip(cuts[::2], cuts[1::2])]
    return out


def test_spans_against_all_others(spark):
    rng = random.Random(2)
    rows = [(some_spans(rng, "abc", 7), some_spans(rng, "xy", 5)) for _ in range(300)] + [([], []), ([("a", 1, 2)], [])]
    df = spark.createDataFrame(rows, f"s {SPAN}, k {SPAN}")
    apart = spans.apart_from(F.col("s"), F.col("k"), ("x", "y"))
    longest = spans.longest(F.col("s"), "kind", ("a", "b", "c"))
    for r in df.select("s", "k", apart.alias("apart"), longest.alias("longest")).collect():
        assert r.apart == [s for s in r.s if not any(s.start < k.end and k.start < s.end for k in r.k)]
        assert r.longest == [
            s for s in r.s if not any(o.start <= s.start and s.end <= o.end and o.end - o.start > s.end - s.start for o in r.s)]


def test_span_tests_grow_with_the_spans(spark):
    """Ten times the spans in one row, at most about ten times the time."""

    def seconds(n):
        rows = [([("a", 3 * i, 3 * i + 2) for i in range(n)], [("x", 6 * i + 1, 6 * i + 3) for i in range(n // 2)])]
        df = spark.createDataFrame(rows, f"s {SPAN}, k {SPAN}")
        sizes = df.select(F.size(spans.apart_from(F.col("s"), F.col("k"), ("x", "y"))), F.size(spans.longest(F.col("s"), "kind", ("a", "b"))))
        sizes.collect()
        start = time.perf_counter()
        assert tuple(sizes.collect()[0]) == (n // 2, n)
        return time.perf_counter() - start

    small, large = seconds(2000), seconds(20_000)
    assert large < 15 * small + 5, (small, large)


def test_features_are_bounded_whatever_the_texts_hold(spark):
    rng = random.Random(1)
    odd = ["+1" + "".join(rng.choice("0123456789().- ") for _ in range(14)) + "7" for _ in range(3000)]
    scanned = pii._scanned(awkward(spark, [(10 + i, f"call {o} now", "en", "a") for i, o in enumerate(odd)]), "text")
    model = pii.fit(scanned)
    names = {"email": 0, "ip": 0, "card": 0, "phone": 0}
    for feature in model.features:
        names[feature.split("|")[0]] += 1
    assert names["phone"] > 50 and all(n <= pii.SHAPES + 45 for n in names.values())


def test_language_sample_is_exact_and_loses_no_language(spark, monkeypatch):
    seen = []
    train = language.train_ftrl
    monkeypatch.setattr(language, "train_ftrl", lambda rows, *a: (seen.append([r[2] for r in rows]), train(rows, *a))[1])
    letters = {"en": "the quick brown fox jumps over lazy dogs", "fr": "été français où garçon élève château", "rare": "жизнь мир слово"}
    rng = random.Random(4)
    some = lambda lang: " ".join(rng.choice(letters[lang].split()) for _ in range(12))
    rows = [(i, "the one text that everybody copied", "en", "a") for i in range(6000)] + [(7000 + i, some("en"), "en", "a") for i in range(500)]
    rows += [(8000 + i, some("fr"), "fr", "a") for i in range(500)] + [(9000 + i, "жизнь мир слово", "rare", "a") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    model = language.train_language_model(docs, sample_rows=300)
    assert max(seen[0].count(k) for k in range(3)) <= 100 and len(seen[0]) <= 300
    assert set(seen[0]) == {0, 1, 2}  # the one text of `rare` teaches, held back or not
    asked = spark.createDataFrame([("мир слово жизнь",), ("garçon élève",)], "t string")
    assert [r.p.lang_pred for r in asked.coalesce(1).select(language.predict_language(F.col("t"), model).alias("p")).collect()] == ["rare", "fr"]


def test_a_label_teaches_one_row_of_its_id(spark, monkeypatch):
    seen = []
    train = quality.train_ranking
    monkeypatch.setattr(quality, "train_ranking", lambda good, bad: (seen.append((len(good), len(bad))), train(good, bad))[1])
    rows = [(1, f"a good and long text of number {i}", "en", "a") for i in range(3000)] + [(2 + i, "bad !!! $$$", "en", "a") for i in range(40)]
    docs = spark.createDataFrame([(*r, 5, 0.5, "r", 1, "s", 2) for r in rows], DOCS)
    labels = spark.createDataFrame([(1, 1), (1, 1), *((2 + i, 0) for i in range(40))], "doc_id bigint, quality int")
    assert quality.score_quality(docs, labels, folds=1, held_out=1).count() == len(rows)
    assert seen == [(1, 40)]


def test_rows_without_id_spread_over_the_order(spark):
    docs = spark.createDataFrame([(None, f"text number {i}", "a") for i in range(2000)], "doc_id bigint, text string, source string")
    places = docs.select(mixing._place("mix", "source", "doc_id", "text").alias("p"))
    assert places.distinct().count() == 2000
    quarters = places.groupBy(F.floor(F.col("p") / F.lit(float(1 << 58)))).count().collect()
    assert len(quarters) == 4 and all(400 < r["count"] < 600 for r in quarters)


def test_few_pairs_of_clustered_vectors_are_computed(monkeypatch):
    """Of vectors in 40 clusters under a tenth of the pairs is computed; results are those of all products."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 64)) * 3
    vectors = np.floor((centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 64)) * 0.3) * 64).astype(np.int64)
    ids, asked, computed = np.arange(4000), slice(0, 200), []
    masked = topk._masked_products
    monkeypatch.setattr(topk, "_masked_products", lambda q, c, mask: (computed.append(int(mask.sum())), masked(q, c, mask))[1])
    floors = np.full(200, -np.inf)
    found = [topk.block_top_k(ids[asked], vectors[asked], ids[a : a + 1000], vectors[a : a + 1000], 20, floors) for a in range(0, 4000, 1000)]
    assert sum(computed) < 0.1 * 200 * 4000
    got = {}
    for query, vec, score in {t for part in found for t in zip(*(x.tolist() for x in part))}:
        got.setdefault(query, []).append((-score, vec))
    scores = vectors[asked] @ vectors.T
    for q in range(200):
        want = sorted((-int(s), int(i)) for i, s in enumerate(scores[q]) if i != q)[:20]
        assert sorted(got[q])[:20] == want


def test_products_too_large_for_a_float_are_exact():
    q, v = np.array([[2**40 + 1, 3]]), np.array([[2**20 + 1, -7], [5, 2**33 + 1]])
    want = [[(2**40 + 1) * (2**20 + 1) - 21, 5 * (2**40 + 1) + 3 * (2**33 + 1)]]
    assert topk.exact_products(q, v).tolist() == want
    assert topk._masked_products(q, v, np.array([[False, True]])).tolist() == [[topk._LOWEST, want[0][1]]]
    with pytest.raises(OverflowError):
        topk.exact_products(np.array([[2**40]]), np.array([[2**40]]))


def test_items_of_one_and_two_words_are_found_verbatim(spark):
    items = spark.createDataFrame([(1, "Zyzzyva"), (2, "purple walrus"), (3, "..."), (4, None), (5, "one two three four five six")], "item_id bigint, text string")
    rows = [(20, "here a zyzzyva, there none", "en", "a"), (21, "the Purple, walrus sings", "en", "a"), (22, "purple and walrus apart", "en", "a"),
            (23, "walrus purple", "en", "a"), (24, "so one two three four five six", "en", "a"), (24, "so one two three four five six", "en", "a")]
    docs = awkward(spark, rows)
    got = {(r.doc_id, r.item_id, r.score, r.first_word, r.last_word) for r in decontaminate.find_contamination(docs, items).collect()}
    assert got == {(20, 1, 1.0, 2, 3), (21, 2, 1.0, 1, 3), (24, 5, 1.0, 1, 7)}
    assert decontaminate.drop_contaminated(docs, items).count() == docs.count() - 4
    assert decontaminate.find_contamination(empty(spark), items).count() == 0


def test_a_text_of_one_word_meets_an_item_of_that_word_in_bounded_rows(spark):
    items = spark.createDataFrame([(1, "again " * 50)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "again " * 80_000), (2, "again and " * 100)], "doc_id bigint, text string")
    start = time.perf_counter()
    got = decontaminate.find_contamination(docs, items).collect()
    assert [(r.doc_id, r.score, r.last_word - r.first_word) for r in got] == [(1, 1.0, 50)]
    assert time.perf_counter() - start < 30
    words, item = decontaminate.word_hashes("again " * 80_000), decontaminate.word_hashes("again " * 50)
    places, *_ = decontaminate._seed_places(item, words, decontaminate.gram_hashes(item))
    assert len(places) == 80_000 - 2  # one row a place, not one for each pair of places


def test_replaced_spans_against_plain_python(spark):
    """Overlapping, touching and repeated spans, texts of several blocks and code points outside the first plane."""
    rng = random.Random(4)
    rows = []
    for n in range(200):
        text = "".join(rng.choice("ab 😀é\n") for _ in range(rng.choice([60, 61, 2100])))
        found = sorted((a, "xyz".index(kind), kind, b) for kind, a, b in some_spans(rng, "xyz", 6))
        shift = rng.choice([0, len(text) - 60])
        rows.append((text, [(a + shift, r, k, b + shift) for a, r, k, b in found for _ in range(1 + (n % 7 == 0))]))
    df = spark.createDataFrame([*rows, ("", []), ("x", [])], "t string, s array<struct<start:int,rank:int,kind:string,end:int>>")
    for r in df.select("t", "s", spans.replaced(F.col("t"), F.col("s"), ("x", "y", "z"), "[M]").alias("out")).collect():
        at, expected = 0, ""
        for s in r.s:
            expected += r.t[at:s.start] + "[M]" if s.start >= at else ""
            at = max(at, s.end)
        assert r.out == expected + r.t[at:]


@pytest.mark.parametrize("n", [20_000])
def test_texts_of_many_findings(spark, n):
    """One text of 20,000 secrets, another of 20,000 personal data, all found and replaced."""
    rng = random.Random(3)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(32))
    secrets = " ".join(key() for _ in range(n))
    docs = spark.createDataFrame([(1, secrets, len(secrets))], "doc_id bigint, text string, n_chars bigint")
    assert secret_scan.redact_secrets(docs).first().text == " ".join(["[SECRET]"] * n)
    people = spark.createDataFrame([(1, " ".join(f"m{i}@ex{i}.com 10.0.{i % 256}.{i % 250}" for i in range(n // 2)))], "doc_id bigint, text string")
    row = pii.personal_data_digest(pii.find_personal_data(people)).first()
    assert (row.n_email, row.n_ip) == (n // 2, n // 2)
