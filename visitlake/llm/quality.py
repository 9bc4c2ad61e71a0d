"""Quality scores from preferences: Bradley-Terry ranking of texts, cut by a quantile of the scores.

A text is described by a fixed number of features. Every pair of a good and a bad training text is a preference, won by the
good one with the logistic chance of the difference of their scores; a score is linear in the features, so the
model is a logistic regression on feature differences without an intercept. The cut is the quantile of the scores of all
learnable rows that leaves as large a share below it as there are bad ones.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from visitlake.llm.folds import fold, fraction
from visitlake.sources.files import staged

SAMPLE_ROWS = 2000  # rows per label the ranking is fitted on; the cut comes from all learnable rows
PAIRS = 100_000  # preferences drawn per epoch
EPOCHS = 12
CUT = 0.3  # score at the cut
HASHED = 256  # hashed word-shape features

NAMES = (
    "log_words", "word_length", "long_words", "distinct_words", "top_word", "upper", "all_upper_words", "digits", "spaces", "lines",
    "line_length", "repeated_lines", "short_lines", "commas", "stops", "exclamations", "pipes", "symbols", "other_letters",
    "stop_ends", "capital_starts", "repeated_pairs", "entropy", "empty",
)


def _character_classes() -> np.ndarray:
    """Lower case, upper case, digits, white space and letters beyond ASCII as one class each, others by themselves."""
    classes = np.arange(5, 134, dtype=np.uint32)
    for number, chars in enumerate((" \n", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "\x80")):
        classes[[ord(c) for c in chars]] = number
    return classes


_CLASSES = _character_classes()


def features(text: str | None) -> np.ndarray:
    """Numbers that describe a text: shares and logarithms of counts, then hashed shares of word shapes.

    A word's shape is its letters, digits and other characters as classes, runs cut to two. An empty text has
    only `empty` set.
    """
    out = np.zeros(len(NAMES) + HASHED)
    text = text or ""
    words = text.split()
    if not words:
        out[NAMES.index("empty")] = 1
        return out
    n, size = len(words), len(text)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ascii_counts = np.bincount(np.minimum(codes, 128), minlength=129)
    upper, lower = ascii_counts[65:91].sum(), ascii_counts[97:123].sum()
    digits, other = ascii_counts[48:58].sum(), ascii_counts[128]
    spaces = ascii_counts[9:14].sum() + ascii_counts[32]
    symbols = size - upper - lower - digits - other - spaces
    lines = [line for line in text.split("\n") if line.strip()]
    counts = Counter(words)
    shares = ascii_counts[ascii_counts > 0] / size
    pairs = max(0, n - 1)
    values = (
        np.log1p(n), np.mean([len(w) for w in words]), sum(len(w) > 12 for w in words) / n, len(counts) / n, max(counts.values()) / n,
        upper / size, sum(w.isupper() and len(w) > 1 for w in words) / n, digits / size, spaces / size, np.log1p(len(lines)),
        np.log1p(size / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)), sum(len(x) < 30 for x in lines) / max(1, len(lines)),
        ascii_counts[44] / n, ascii_counts[46] / n, ascii_counts[33] / n, ascii_counts[124] / n, symbols / size, other / size,
        sum(x.rstrip()[-1:] in ".!?" for x in lines) / max(1, len(lines)), sum(w[0].isupper() for w in words) / n,
        1 - len(set(zip(words, words[1:]))) / pairs if pairs else 0.0, -(shares * np.log2(shares)).sum(), 0.0,
    )
    out[: len(NAMES)] = values
    classes = _CLASSES[np.minimum(codes, 128)]
    kept = classes[np.append(True, np.diff(classes) != 0)]
    if len(kept) > 2:
        trigrams = (kept[:-2] * np.uint32(0x9E3779B1) ^ kept[1:-1] * np.uint32(0x85EBCA6B)) * np.uint32(0xC2B2AE35) + kept[2:] * np.uint32(0x27D4EB2F)
        hashed = np.bincount((trigrams ^ (trigrams >> np.uint32(15))) % HASHED, minlength=HASHED)
        out[len(NAMES) :] = np.sqrt(hashed / len(trigrams))
    return out


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float = 0.0  # raw score that counts as CUT
    scale: float = 1.0  # how steeply scores rise around it

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.spread, -8, 8) @ self.weights


def train_ranking(good: np.ndarray, bad: np.ndarray, l2: float = 1e-4, rate: float = 0.1) -> QualityModel:
    """Bradley-Terry weights from preferences of good over bad rows, by AdaGrad on logistic loss of differences.

    Pairs are drawn anew in every epoch from a fixed seed. Without rows of either kind all weights are zero.
    """
    both = np.concatenate([good, bad])
    width = both.shape[1]
    if not len(good) or not len(bad):
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(width))
    mean, spread = both.mean(axis=0), both.std(axis=0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    good, bad = (np.clip((x - mean) / spread, -8, 8) for x in (good, bad))
    random = np.random.default_rng(0)
    weights, squares = np.zeros(width), np.full(width, 1e-8)
    for _ in range(EPOCHS):
        winners, losers = random.integers(len(good), size=PAIRS), random.integers(len(bad), size=PAIRS)
        for at in range(0, PAIRS, 256):
            difference = good[winners[at : at + 256]] - bad[losers[at : at + 256]]
            miss = 1 / (1 + np.exp(np.clip(difference @ weights, -30, 30)))
            gradient = -(miss @ difference) / len(difference) + l2 * weights
            squares += gradient * gradient
            weights = weights - rate * gradient / np.sqrt(squares)
    return QualityModel(mean, spread, weights)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t.as_py()) for t in batch.column(0)]
        yield pa.RecordBatch.from_pydict({"quality": batch.column(1), "x": pa.array(rows, pa.list_(pa.float64()))})


def _raw_score(text: Column, model: QualityModel) -> Column:
    @pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        rows = np.stack([features(t) for t in texts]) if len(texts) else np.zeros((0, len(model.weights)))
        return pd.Series(model.raw(rows), index=texts.index)

    return scored(text)


def fit_ranking(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Ranking of the rows of `docs` (id, text) that a sample of `labels` (id, quality) names.

    The sample is the SAMPLE_ROWS labels of either kind that come first in a hashed order, so it is small enough to
    broadcast, and no text but theirs is shuffled. Of rows that share an id, the one whose text hashes least
    teaches, so the driver gets a row per drawn label at most.
    """
    drawn = [
        labels.filter(F.col("quality") == q).orderBy(fraction("id", "quality"), "id").limit(SAMPLE_ROWS) for q in (0, 1)
    ]
    marked = docs.join(F.broadcast(drawn[0].unionByName(drawn[1]).distinct()), "id")
    first = F.min(F.struct(F.xxhash64("text").alias("order"), "text")).alias("first")
    marked = marked.groupBy("id", "quality").agg(first).select("first.text", "quality")
    sample = marked.mapInArrow(_vectors, "quality int, x array<double>").toArrow()
    rows = np.array([x.values.to_numpy() for x in sample["x"]]).reshape(-1, len(NAMES) + HASHED)
    order = np.lexsort(rows.T[::-1]) if len(rows) else np.array([], dtype=int)  # not the order in which rows were read
    rows, quality = rows[order], sample["quality"].to_numpy()[order]
    return train_ranking(rows[quality == 1], rows[quality == 0])


def with_cut(model: QualityModel, scored: DataFrame, labels: DataFrame) -> QualityModel:
    """`model` with its cut between the raw scores (id, raw) of all labelled rows: as many are below as are bad."""
    known = scored.join(labels, "id").select("raw", "quality")
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return model
    total = sizes[0] + sizes[1]
    share = sizes[0] / total
    points = [share, min(1.0, share + 1 / total), (1 + share) / 2]
    below, above, middle = known.agg(F.percentile_approx("raw", points, 10_000).alias("q")).first()["q"]
    cut = (below + above) / 2  # between the last row below and the first above
    return QualityModel(model.mean, model.spread, model.weights, cut, 2 / max(middle - cut, 1e-6))


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 0
) -> DataFrame:
    """(id, held_out, score, predicted) of every row; only labelled rows outside the held-out fold are learned from.

    Null and empty texts have a score like any other. Repeated rows are scored each. Null labels and ids say nothing, and
    contradicting labels of one id count each. Without labels of both kinds every score is CUT; an empty table gives
    an empty one.

    Every text is read once for its raw score, which is stored; the cut needs nothing else.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter(F.col("quality").isin(0, 1) & F.col("id").isNotNull() & (fold("id", folds) != held_out))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    model = fit_ranking(rows, known)
    raw = rows.select("id", (fold("id", folds) == held_out).alias("held_out"), _raw_score(F.col("text"), model).alias("raw"))
    scored, _ = staged(raw, "quality")
    model = with_cut(model, scored.select("id", "raw"), known)
    odds = F.lit(float(model.scale)) * (F.col("raw") - F.lit(float(model.cut))) + F.lit(math.log(CUT / (1 - CUT)))
    score = 1 / (1 + F.exp(-F.greatest(F.least(odds, F.lit(500.0)), F.lit(-500.0))))
    # the same comparison that the cut makes, free of rounding
    predicted = (F.col("raw") >= F.lit(float(model.cut))).cast("int")
    at_least = F.when(predicted == 1, F.greatest(score, F.lit(CUT))).otherwise(F.least(score, F.lit(math.nextafter(CUT, 0))))
    return scored.select(F.col("id").alias(id_col), "held_out", at_least.alias("score"), predicted.alias("predicted"))
