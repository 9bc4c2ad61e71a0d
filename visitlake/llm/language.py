"""Language identification: sparse multinomial logistic regression on hashed TF-IDF character n-grams.

The regression is trained by follow-the-regularised-leader with an elastic net, so most weights are exactly zero, and
its probabilities are calibrated by one temperature, fitted on rows that the training left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from visitlake.llm.folds import fold, fraction

BITS = 14  # 2^BITS hashed features
SAMPLE_ROWS = 3000  # rows the regression is fitted on; document frequencies come from all learnable rows
UNDETERMINED = "und"
MIN_SCORE = 0.3  # clean texts of a few words stay well above this


@dataclass(frozen=True)
class FtrlOptions:
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.001
    epochs: int = 4
    calibration_share: float = 0.2


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    bits: int


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def ngram_counts(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 1- to 3-grams of a text and how often each occurs; none for a text without letters.

    Letters are lower-cased; every run of other characters counts as one space.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int32)
    codes = np.where(letter, codes, np.uint32(32))[letter | np.concatenate([[True], letter[:-1]])]
    codes = np.concatenate([np.uint32([32]), codes, np.uint32([32])])
    shift, size = np.uint32(32 - bits), 1 << bits
    one = codes * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ np.uint32(0x5BD1E995)) * np.uint32(0x85EBCA6B) + one[1:]
    three = (two[:-1] ^ np.uint32(0x27D4EB2F)) * np.uint32(0xC2B2AE35) + one[2:]
    mixed = [(h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> shift for h in (one, two, three)]
    counts = np.bincount(np.concatenate(mixed), minlength=size)
    found = np.flatnonzero(counts)
    return found.astype(np.int32), counts[found].astype(np.int32)


def _document_frequencies(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs = np.zeros(1 << bits, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                found, _ = ngram_counts(text.as_py(), bits)
                total[found] += 1
                docs += bool(len(found))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({
            "feature": pa.array(np.append(seen, -1), pa.int64()), "df": pa.array(np.append(total[seen], docs), pa.int64()),
        })

    return run


def _vectors(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [ngram_counts(t.as_py(), bits) for t in batch.column(0)]
            yield pa.RecordBatch.from_pydict({
                "lang": batch.column(1), "calibrates": batch.column(2),
                "features": pa.array([p[0] for p in pairs], pa.list_(pa.int32())),
                "counts": pa.array([p[1] for p in pairs], pa.list_(pa.int32())),
            })

    return run


def _tfidf(features: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[features]
    return values / (np.linalg.norm(values) or 1.0)


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max())
    return raised / raised.sum()


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], features: int, classes: int, options: FtrlOptions) -> np.ndarray:
    """Weights (features x classes) of rows (features, values, class), shuffled anew in each epoch."""
    z, n = np.zeros((features, classes)), np.zeros((features, classes))
    random = np.random.default_rng(0)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - options.l1, 0)
        return -shrunk / ((options.beta + np.sqrt(n)) / options.alpha + options.l2)

    for _ in range(options.epochs):
        for k in random.permutation(len(rows)):
            found, values, truth = rows[k]
            z_row, n_row = z[found], n[found]
            w = weights(z_row, n_row)
            error = _softmax(values @ w)
            error[truth] -= 1
            gradient = values[:, None] * error
            squares = gradient * gradient
            z[found] = z_row + gradient - (np.sqrt(n_row + squares) - np.sqrt(n_row)) / options.alpha * w
            n[found] = n_row + squares
    return weights(z, n)


def fit_temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature that makes held-back labels most likely, by golden-section search over its logarithm.

    Labels are smoothed by one row's share, so that separable rows do not make every answer certain.
    """
    if not len(truth):
        return 1.0
    smooth = 1 / (len(truth) + 2)

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        top = scaled.max(axis=1)
        hit = (1 - smooth) * scaled[np.arange(len(truth)), truth] + smooth * scaled.mean(axis=1)
        return float(np.mean(top + np.log(np.exp(scaled - top[:, None]).sum(axis=1)) - hit))

    low, high, ratio = -4.0, 4.0, (np.sqrt(5) - 1) / 2
    while high - low > 1e-4:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train_language_model(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS, bits: int = BITS,
    options: FtrlOptions = FtrlOptions(),
) -> LanguageModel:
    """Learns from the rows with a language and at least one letter.

    Document frequencies cover all of them. The regression sees at most `sample_rows` different texts (one per language, if
    there are more languages), those that come first in a hashed order and in equal shares per language, as far as a language
    has them; only their feature counts reach the driver. Copies of a text are drawn once. Each distinct language value is a class;
    one whose drawn texts are all held back for calibration is learned from those. Without any learnable row the
    model knows no language.
    """
    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text is not null and lang is not null")
    order = fraction("text", "lang")
    different = F.approx_count_distinct(order, 0.02).alias("n")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(different).orderBy("lang").collect()}
    size = 1 << bits
    df = np.zeros(size)
    total = 0
    counted = known.select("text").mapInArrow(_document_frequencies(bits), "feature bigint, df bigint")
    for row in counted.groupBy("feature").agg(F.sum("df").alias("df")).collect():
        if row["feature"] < 0:
            total = row["df"]
        else:
            df[row["feature"]] = row["df"]
    idf = np.log((1 + total) / (1 + df)) + 1
    if not sizes:
        return LanguageModel((), idf, np.zeros((size, 0)), 1.0, bits)
    share = max(1, sample_rows // len(sizes))
    # some more than the share by the estimated number of texts, then exactly the first of those
    rates = {lang: 1.0 if n <= 2 * share + 100 else (1.2 * share + 60) / n for lang, n in sizes.items()}
    rate = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    texts = known.withColumn("order", order).filter(F.col("order") < rate[F.col("lang")]).dropDuplicates(["lang", "text"])
    first = Window.partitionBy("lang").orderBy("order", F.xxhash64("text"))
    drawn = texts.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= share)
    held_back = fraction("lang", "text") < options.calibration_share
    vectors = drawn.select("text", "lang", held_back.alias("calibrates")).mapInArrow(
        _vectors(bits), "lang string, calibrates boolean, features array<int>, counts array<int>"
    ).toArrow()
    languages = tuple(sizes)
    number = {lang: k for k, lang in enumerate(languages)}
    rows = {True: [], False: []}
    for lang, calibrates, features, counts in zip(*vectors.columns):
        features = features.values.to_numpy()
        if len(features):
            row = (features, _tfidf(features, counts.values.to_numpy(), idf), number[lang.as_py()])
            rows[calibrates.as_py()].append(row)
    for part in rows.values():  # an order that does not depend on how rows were read
        part.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes(), r[1].tobytes()))
    learned = {r[2] for r in rows[False]}
    weights = train_ftrl(rows[False] + [r for r in rows[True] if r[2] not in learned], size, len(languages), options)
    logits = np.array([values @ weights[features] for features, values, _ in rows[True]]).reshape(-1, len(languages))
    temperature = fit_temperature(logits, np.array([r[2] for r in rows[True]], dtype=int))
    return LanguageModel(languages, idf, weights.astype(np.float32), temperature, bits)


def predict_language(text: Column, model: LanguageModel) -> Column:
    """Struct (lang_pred, score): the likeliest language and its calibrated probability.

    A null text, one without letters, or a model without languages gives `und` with score 0.
    """

    @pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        names, scores = [], []
        for text in texts:
            features, counts = ngram_counts(text, model.bits)
            if len(features) and model.languages:
                logits = _tfidf(features, counts, model.idf) @ model.weights[features]
                chances = _softmax(logits / model.temperature)
                best = int(np.argmax(chances))
                names.append(model.languages[best])
                scores.append(float(chances[best]))
            else:
                names.append(UNDETERMINED)
                scores.append(0.0)
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predicted(text)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", folds: int = 4, held_out: int = 2, **options) -> DataFrame:
    """(id, held_out, lang_pred, score) of every row; only rows outside the held-out fold are learned from.

    Null texts give `und`, null languages are not learned from, repeated rows are predicted each; an empty
    table gives an empty one.
    """
    is_held_out = fold(id_col, folds) == held_out
    model = train_language_model(docs.filter(~is_held_out), **options)
    predicted = docs.select(F.col(id_col), is_held_out.alias("held_out"), predict_language(F.col("text"), model).alias("p"))
    return predicted.select(id_col, "held_out", "p.*")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", folds: int = 4, held_out: int = 2, **options) -> DataFrame:
    """`docs` without the rows whose language cannot be told: no letter in the text, or no language above MIN_SCORE."""
    model = train_language_model(docs.filter(fold(id_col, folds) != held_out), **options)
    return docs.filter(predict_language(F.col("text"), model)["score"] >= MIN_SCORE)
