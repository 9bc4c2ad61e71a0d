"""Repeated passages: brute force, passages at every offset of the blocks, awkward tables."""

import random

import pytest

from visitlake.llm import repeats

from helpers import LONG, agrees_with_sql, awkward, empty


def brute(rows, window=20):
    """(id, words, words removed, what is left); rows without id come last, rows that share one do not count as earlier."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    rank = lambda i: (i is None, i or 0)
    first = {}
    for i, words in split:
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            first[key] = min(first.get(key, rank(i)), rank(i))
    out = []
    for i, words in split:
        gone, seen = set(), set()
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if rank(i) > first[key] or key in seen:
                gone |= set(range(s, s + window))
            seen.add(key)
        out.append((i, len(words), len(gone), b" ".join(w for n, w in enumerate(words) if n not in gone).decode()))
    return sorted(out, key=repr)


def found(df, **options):
    rows = repeats.remove_repeats(df, **options).collect()
    for r in rows:
        ends = [x for s in r["removed"] for x in (s["first"], s["end"])]
        assert ends == sorted(set(ends)) and r["n_words"] >= (ends[-1] if ends else 0)
    return sorted(((r["doc_id"], r["n_words"], sum(s["end"] - s["first"] for s in r["removed"]), r["kept"]) for r in rows), key=repr)


@pytest.mark.parametrize("window", [19, 20, 35])
def test_repeats_agree_with_brute_force(spark, window):
    rnd = random.Random(window)
    passages = [[rnd.choice("abcd") for _ in range(60)] for _ in range(4)]
    rows = []
    for _ in range(150):
        words = []
        for _ in range(rnd.randint(0, 4)):
            x = rnd.randint(0, 40)
            words += rnd.choice(passages)[x : x + rnd.randint(5, 45)] + [f"w{rnd.randint(0, 30)}"]
        rows.append((rnd.choice([None, *range(60)]), rnd.choice([" ", "\t\n", "\x0b"]).join(words)))
    rows += [(1, "q " * 300), (900, "q " * 30), (901, " ".join(passages[0][:19]))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(df, window=window) == brute(rows, window)


def test_every_offset_of_a_passage(spark):
    """A passage of just one window, at all offsets of the blocks in both documents."""
    passage = " ".join(f"p{n}" for n in range(20))
    rows = [(n, " ".join(f"d{n}.{i}" for i in range(n)) + " " + passage + f" end{n}") for n in range(25)]
    got = found(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert [r[2] for r in sorted(got)] == [0] + [20] * 24


def test_copies_of_a_document(spark):
    """Thousands of copies under ids of their own: the smallest stays whole, in whatever partition it lies."""
    text = " ".join(f"w{n}" for n in range(40))
    df = spark.range(3000).selectExpr("3000 - id as doc_id", f"'{text}' as text").repartition(8)
    left = {r["doc_id"]: r["kept"] for r in repeats.remove_repeats(df).collect()}
    assert left.pop(1) == text and set(left.values()) == {""}


def test_awkward_rows(spark):
    df = awkward(spark, [(8, LONG, "en", "a"), (8, LONG + " more", "en", "a"), (None, LONG[:5000], "en", "a")])
    assert found(df) == brute([(r["doc_id"], r["text"]) for r in df.collect()])
    assert found(empty(spark)) == []
    with pytest.raises(ValueError):
        repeats.remove_repeats(df, window=18)


def test_edited_copies_share_stretches(spark):
    """Copies with single words changed, their windows mostly known from the stretches of an earlier one."""
    rnd = random.Random(6)
    base = [f"w{rnd.randint(0, 5000)}" for _ in range(1200)]
    rows = []
    for n in range(40):
        words = list(base)
        for _ in range(rnd.randint(0, 6)):
            words[rnd.randrange(len(words))] = f"edit{n}"
        rows.append((rnd.choice([None, 3, 100 + n]), " ".join(words)))
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows)


def test_results_hold_with_full_bitmaps(spark, monkeypatch):
    """Bitmaps far too small let everything through and change nothing."""
    monkeypatch.setattr(repeats, "MAX_BITS", repeats.MIN_BITS)
    monkeypatch.setattr(repeats, "MIN_BITS", repeats._PAGE)
    rnd = random.Random(1)
    rows = [(n, " ".join(str(rnd.randint(0, 10**6)) for _ in range(400))) for n in range(200)]
    rows += [(1000 + n, rows[n][1][50:400]) for n in range(50)]
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows)


def test_query_agrees_with_sql(spark, sf_dir):
    agrees_with_sql(spark, sf_dir, "op13_repeated_passages")
