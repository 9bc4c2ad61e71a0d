"""Small tables that every operator has to cope with."""

import random

LONG = " ".join(random.Random(5).choice(["alpha", "beta", "of", "the", "Ünder", "7", "x.y"]) for _ in range(30_000))
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, row string, key int, spans string, base int"


def awkward(spark, more=()):
    """Nulls in any column, empty, blank and very long texts, repeated rows, and columns with names operators use."""
    rows = [
        (1, "plain words in a short text", "en", "a"), (1, "plain words in a short text", "en", "a"), (2, None, "en", "b"),
        (3, "", None, None), (4, " \t\n ", "fr", "a"), (None, "no id but some text here", "en", None), (None, None, None, None),
        (5, LONG, "en", "a"), (6, "😀 ... !!!", "en", "b"), (7, "plain words in a short text", None, "b"), (8, "word", "fr", "c"), *more,
    ]
    return spark.createDataFrame([(*r, len(r[1] or ""), 0.5, "r", 1, "s", 2) for r in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def agrees_with_sql(spark, sf_dir, name):
    """Runs a registered query of the subpackage against its SQL."""
    from compare import compare, oracle

    ok, note = compare(spark, oracle(sf_dir), sf_dir, name)
    assert ok, note
