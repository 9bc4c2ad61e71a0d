"""Fingerprints, links and groups against brute force."""

import numpy as np
import xxhash
from helpers import awkward, empty, table

from visitlake.llm import simhash as S
from visitlake.llm.components import connected_components
from visitlake.llm.queries import QUERIES


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64(b" ".join(words[i : i + 4]), seed=42).intdigest() for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, fps, bits=4):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    distinct = np.array(sorted(set(fps)), dtype=np.uint64)
    for i, j in zip(*np.nonzero(np.bitwise_count(distinct[:, None] ^ distinct[None, :]) <= bits)):
        a, b = find(i), find(j)
        parent[a] = b
    place = {int(f): k for k, f in enumerate(distinct)}
    groups = {}
    for d, f in zip(ids, fps):
        groups.setdefault(find(place[f]), []).append(d)
    smallest = {g: min((d for d in members if d is not None), default=None) for g, members in groups.items()}
    return [smallest[find(place[f])] for f in fps]


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").collect()
    fps = [slow_fingerprint(r.text) for r in docs]
    want = dict(zip((r.doc_id for r in docs), zip((f"{f:016x}" for f in fps), slow_components([r.doc_id for r in docs], fps))))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash_groups"](spark, sf_dir).collect()} == want


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = S.simhash_groups(docs).collect()
    ids, fps = zip(*((r.doc_id, r.fp & (1 << 64) - 1) for r in rows))
    assert len(rows) == docs.count() and sorted(fps) == sorted(slow_fingerprint(r.text) for r in docs.collect())
    assert [r.component_id for r in rows] == slow_components(ids, fps)
    assert S.simhash_groups(empty(spark)).count() == 0
    kept = S.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    left = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert sorted(left) == sorted({r.component_id for r in rows} - {None})
    assert kept.filter("doc_id is null").count() == 2


def test_one_row_of_a_group_stays_whatever_its_ids(spark):
    copied, other, third = (" ".join(f"{w}{i}" for i in range(60)) for w in ("copied", "other", "third"))
    rows = [(None, copied, "en", "a")] * 3 + [(90, other, "en", "a"), (90, third, "en", "a"), (91, other, "en", "a"), (80, third, "en", "b")]
    rows += [(70, "unlike " + other[:90], "en", "a"), (70, "its " + third[:50], "en", "a")]
    kept = S.keep_one_per_group(awkward(spark, rows)).filter("doc_id >= 70 or text like 'copied%'").collect()
    want = [(None, copied), (90, other), (80, third), (70, rows[-2][1]), (70, rows[-1][1])]
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted(want, key=repr)


def linked(spark, fps, **options):
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp bigint")
    links = S.fingerprint_links(df, **options).collect()
    mask = (1 << 64) - 1
    assert all(((r.a & mask) ^ (r.b & mask)).bit_count() <= 4 for r in links)
    roots = {r.node & mask: r.root for r in connected_components(S.fingerprint_links(df, **options)).collect()}
    return links, [roots.get(int(f), int(np.uint64(f).astype(np.int64))) for f in fps]


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_links_of_dense_and_sparse_fingerprints(spark):
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [c ^ sum(np.uint64(1) << np.uint64(b) for b in rng.choice(64, rng.integers(0, 8), replace=False)) for c in centres for _ in range(20)]
    fps = sorted({int(f) for f in (*centres, *near, 0, (1 << 64) - 1)})
    want = slow_components(range(len(fps)), fps)
    for block in (1024, 7):
        _, roots = linked(spark, fps, block=block)
        assert same_partition(roots, want)


def test_a_large_group_has_few_links(spark):
    rng = np.random.default_rng(1)
    fps = sorted({int(np.uint64(12345) ^ sum(np.uint64(1) << np.uint64(b) for b in rng.choice(64, 3, replace=False))) for _ in range(1500)})
    links, roots = linked(spark, fps, block=500)
    assert len(set(roots)) == 1 and len(links) < 100 * len(fps)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(500)] + [(7000, 7000), (8000, 8001)]
    roots = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert len({roots[i] for i in range(301)}) == 1 and len({roots[1000 + i] for i in range(501)}) == 1
    assert len(set(roots.values())) == 3 and 7000 not in roots
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_bound_never_exceeds_distance():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    b = a ^ (rng.integers(0, 1 << 63, 5000, dtype=np.uint64) & rng.integers(0, 1 << 63, 5000, dtype=np.uint64))
    counts = lambda x: [np.bitwise_count((x >> np.uint64(2 * s)) & np.uint64(3)).astype(int) for s in range(32)]
    manhattan = sum(abs(x - y) for x, y in zip(counts(a), counts(b)))
    assert (np.bitwise_count(S._unary_np(a) ^ S._unary_np(b)) == manhattan).all() and (manhattan <= np.bitwise_count(a ^ b)).all()
