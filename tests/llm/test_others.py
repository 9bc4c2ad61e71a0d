"""Chat formatting, benchmark leaks, mixing, top-k search and the pipeline."""

import random

import numpy as np
import pytest
from helpers import agrees_with_sql, awkward, empty, table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitlake.llm import chat, decontaminate, mixing, topk

TURNS = "conv_id bigint, turn bigint, role string, text string, formatted string"


@pytest.mark.parametrize("name", ["op2_chat_format", "op8_source_mix", "op9_exact_top_k"])
def test_registered_query(spark, sf_dir, name):
    agrees_with_sql(spark, sf_dir, name)


MARKUP = st.lists(st.sampled_from([*chat.CONTROLS, "<", "[", "\\", "s>", "/s>", "INST]", "é", "😀", "a b", "\n", "|text|>"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.just("assistant"), MARKUP), MARKUP), max_size=4))
def test_template_round_trip(turns):
    text, spans = chat.render([r for r, _ in turns], [t for _, t in turns])
    assert chat.parse(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    for _, t in turns:
        assert not any(c in chat.escape(t) for c in chat.CONTROLS)


def test_masks_cover_the_assistant_exactly(spark):
    rows = [
        (1, 0, "user", "Hi <s>"), (1, 1, "assistant", "  leading spaces, ünï 😀 </s> [INST] \\ <\\s>"), (1, 2, "assistant", ")("), (1, 3, "user", None),
        (2, None, None, None), (2, 0, "assistant", ""), (None, 5, "assistant", "no id"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"),
        (3, 1, "assistant", "a"), (4, 0, "sys\ntem|x", "x" * 50_000), (4, 1, "assistant", "<|endoftext|> word " * 3000),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], TURNS)
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert got.keys() == {1, 2, 3, 4, None}
    for conv, r in got.items():
        turns = sorted(((t is not None, t or 0), ro or "", tx or "") for c, t, ro, tx in rows if c == conv)
        assert chat.parse(r.formatted) == [(ro, tx) for _, ro, tx in turns]
        regions = chat.masked_regions(np.array(r.token_starts), np.array(r.token_ends), np.array(r.loss_mask, dtype=bool))
        assert "".join(chat.unescape(r.formatted[a:b]) for a, b in regions) == "".join(tx for _, ro, tx in turns if ro == "assistant")
        assert len(r.token_ids) == len(r.loss_mask)
    assert chat.format_conversations(df.limit(0)).count() == 0


def planted(spark, sf_dir, share, n=40):
    rng = random.Random(3)
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").orderBy("item_id").collect()]
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").orderBy("doc_id").limit(60).collect()]
    out = []
    for k, (item, text) in enumerate(items[:n]):
        words = [("changed" if rng.random() < share else w) for w in text.split()]
        base = docs[k % len(docs)][1].split()
        at = rng.randrange(len(base))
        out.append((1000 + k, " ".join(base[:at] + words + base[at:]), "en", "a"))
    return items, docs, out


def test_leaks_against_full_alignment(spark, sf_dir):
    items, plain, copies = planted(spark, sf_dir, 0.1)
    benchmark = table(spark, sf_dir, "benchmark")
    docs = awkward(spark, [*[(d + 2000, t, "en", "a") for d, t in plain], *copies])
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.find_contamination(docs, benchmark).collect()}
    hashes = {i: decontaminate.word_hashes(t) for i, t in items}
    want = {}
    for doc_id, text in [(d + 2000, t) for d, t in plain] + [(c[0], c[1]) for c in copies]:
        words = decontaminate.word_hashes(text)
        for item, h in hashes.items():
            score = decontaminate.align(h, words)[0] / (decontaminate.MATCH * len(h))
            if score >= decontaminate.MIN_SCORE:
                want[doc_id, item] = score
    found = {k: v for k, v in got.items() if k in want}
    assert set(got) <= set(want) and all(abs(want[k] - v) < 1e-9 for k, v in found.items())
    sure = {k for k, v in want.items() if v >= 0.6}
    assert sure <= set(got) and len(got) >= 0.97 * len(want)
    kept = decontaminate.drop_contaminated(docs, benchmark)
    leaked = {d for d, _ in got}
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == sorted(
        r.doc_id for r in docs.collect() if r.doc_id is not None and r.doc_id not in leaked)
    assert decontaminate.find_contamination(empty(spark), benchmark).count() == 0
    assert decontaminate.find_contamination(docs, benchmark.limit(0)).count() == 0


def test_a_passage_that_many_documents_share_is_found_in_all(spark, sf_dir):
    items, _, _ = planted(spark, sf_dir, 0)
    docs = awkward(spark, [(100 + k, f"start {k} {items[0][1]} end", "en", "a") for k in range(300)])
    got = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark")).filter("score = 1").collect()
    assert {r.doc_id for r in got} == {100 + k for k in range(300)} and all(r.first_word == 2 for r in got)


def slow_alignment(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.lists(st.integers(0, 3), max_size=15))
def test_alignment_against_the_full_table(a, b):
    assert decontaminate.align(np.array(a), np.array(b, dtype=int))[0] == slow_alignment(a, b)


def test_mixture_meets_its_quotas(spark):
    rows = [(100 + i, "w " * (1 + i % 7), "en", "big") for i in range(900)] + [(2000 + i, "w " * (1 + i % 5), "en", f"s{i % 3}") for i in range(60)]
    docs = awkward(spark, rows)
    options = mixing.MixOptions(entropy=0.9, max_repeats=4.0, block_tokens=200)
    uses = mixing.mix_sources(docs, options=options).collect()
    tokens = {}
    for r in docs.collect():
        tokens[r.source] = tokens.get(r.source, 0) + len((r.text or "").split())
    total = sum(tokens.values())
    used = {}
    for u in uses:
        used[u.source] = used.get(u.source, 0) + u.n_tokens
    longest = max(len((r.text or "").split()) for r in docs.collect())
    assert None in used  # documents without a source are a source
    assert all(used[s] / tokens[s] <= 4.0 + longest / tokens[s] for s in used) and abs(sum(used.values()) - total) <= longest * len(tokens)
    assert {u.doc_id for u in uses} <= {r.doc_id for r in docs.collect() if (r.text or "").split()}
    assert len({(u.block, u.position) for u in uses}) == len(uses)
    assert mixing.mix_sources(empty(spark)).count() == 0


@pytest.mark.parametrize("entropy, repeats", [(0.5, 100.0), (0.95, 100.0), (1.0, 3.0)])
def test_exponent_by_plain_bisection(spark, entropy, repeats):
    sizes = [9000, 500, 300, 200, 20]
    p = np.array(sizes) / sum(sizes)

    def weights(e):
        return p**e / (p**e).sum()

    def largest(ok):
        low, high = 0.0, 1.0
        for _ in range(60):
            low, high = ((low + high) / 2, high) if ok((low + high) / 2) else (low, (low + high) / 2)
        return low

    want = max(largest(lambda e: -(weights(e) * np.log(weights(e))).sum() >= entropy * np.log(5)), largest(lambda e: (weights(e) / p).max() > repeats))
    sources = spark.createDataFrame([(str(k), n) for k, n in enumerate(sizes)], "source string, tokens bigint")
    got = mixing.solve_exponent(sources, mixing.MixOptions(entropy=entropy, max_repeats=repeats))
    assert abs(got - want) < 2e-6


def test_word_counts(spark):
    texts = [None, "", " ", "a", " a", "a ", "a  b\n\nc\t", "\x0b\x0ca\rb", "é ü x", "x" * 1000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.coalesce(1).select(mixing.count_tokens(F.col("t"))).collect()]
    assert got == [len((t or "").encode().split()) for t in texts]


@pytest.mark.parametrize("k, blocks", [(5, (7, 11)), (20, (256, 4096))])
def test_top_k_against_all_products(spark, k, blocks):
    rng = np.random.default_rng(4)
    vectors = np.round(rng.normal(size=(300, 16)) * 20).astype(int)
    vectors[::7] = vectors[0]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([*rows, rows[3]], "id bigint, v array<bigint>")
    got = topk.top_k(df, df.filter("id % 20 = 0"), k, *blocks).collect()
    want = {}
    for q in range(0, 300, 20):
        scores = vectors @ vectors[q]
        best = sorted((-int(s), i) for i, s in enumerate(scores) if i != q)[:k]
        want |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(best)}
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in got} == want


def test_bounds_are_never_too_low():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(50, 30)) * 40, rng.normal(size=(60, 30)) * 40
    exact, former = a @ b.T, None
    for n in topk.LEVELS:
        bound = topk.segment_statistics(a, n) @ topk.segment_statistics(b, n).T
        assert (bound >= exact - 1e-6).all()
        assert former is None or bound.mean() < former
        former = bound.mean()


def test_top_k_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, None), (40, [nan, 1.0]), (60, [inf, 0.0]), (80, [1.0, None]), (100, []), (120, [0.5]), (None, [1.0, 1.0]), (7, [-1.0, 3e4, 2.0]), (0, [1.0, 2.0])]
    vectors = topk.quantized(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    got = [tuple(r) for r in topk.top_k(vectors, vectors.filter("id % 20 = 0"), 2).orderBy("query_id", "rank").collect()]
    v = {0: [64, 128, 0], 100: [0, 0, 0], 120: [32, 0, 0], 7: [-64, 1920000, 128]}
    want = []
    for q in (0, 100, 120):
        best = sorted((-sum(x * y for x, y in zip(v[q], v[i])), i) for i in v if i != q)[:2]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == want
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as C

    docs = awkward(spark, [(900, "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" among other words here", "en", "a")]).unionByName(
        table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id") + 10_000), allowMissingColumns=True)
    kept = docs
    for name, stage in C.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, sf_dir)
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        assert kept.columns == docs.columns
        if name == "secret_scan":
            assert kept.count() == before.count()
        else:
            assert kept.exceptAll(before).count() == 0
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert "[SECRET]" in texts[900] and 1 in texts and 7 not in texts and 2 not in texts
    assert C.STAGES[-1][1](spark, kept, sf_dir).count() > 0
    for _, stage in C.STAGES:
        assert stage(spark, empty(spark), sf_dir).count() == 0
    assert C.run(spark, sf_dir).columns == ["block", "position", "doc_id", "source", "copy", "n_tokens"]
