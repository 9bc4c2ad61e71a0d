"""Benchmark decontamination: rare word n-grams seed candidates, local alignment decides.

Words are runs of letters and digits, lower-cased, so punctuation and layout do not matter. A pass over the corpus notes
which n-grams of the benchmark each text holds; a Bloom filter of fixed size keeps all others inside the scan. Every item then
takes the rarest of its n-grams that the corpus holds as seeds, whatever their count, so that an item that thousands of
documents copied keeps its seeds too; the commoner half is left out. Items shorter than an n-gram are seeds as a whole.
Seeds join documents to items, and only texts that a Bloom filter of the joined keys lets pass are read again for them.
Smith-Waterman alignment over words scores the passage around the seeds. A copy with words changed, left out or put in keeps
most of the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.sources.files import staged

GRAM_WORDS = 3
SEEDS = 16  # n-grams per item, the rarest first, or
SEED_SHARE = 0.5  # this share of them, if more: edits make rarer those that a copy has lost
MIN_SEEDS = 2  # seeds of an item that a document must hold to be aligned with it
MIN_SCORE = 0.5  # alignment score as a share of the item's own
MATCH, MISMATCH, GAP = 2, -1, -1
_BLOOM_BITS = 24  # the filter has 2^24 bits, 2 MB, however many items there are

# Bases of the two rolling hashes.
_WORD_BASE, _GRAM_BASE = 0x100000001B3, 0x9E3779B97F4A7C15

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*b"0123456789abcdefghijklmnopqrstuvwxyz"]] = True
_IS_WORD[128:] = True


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit number per word of a text, in order. Bytes beyond ASCII count as letters."""
    data = np.frombuffer((text or "").lower().encode("utf-8", "replace"), dtype=np.uint8)
    word = _IS_WORD[data]
    edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    letters = data[word].astype(np.uint64) + np.uint64(1)
    firsts = np.concatenate([[0], np.cumsum(ends - starts)[:-1]])
    place = np.arange(len(letters)) - np.repeat(firsts, ends - starts)
    sums = np.add.reduceat(letters * _powers(int(place.max()).bit_length())[place], firsts)
    return _mixed(sums)


@cache
def _powers(bits: int) -> np.ndarray:
    """The first 2^bits powers of the word base."""
    return np.cumprod(np.concatenate([[1], np.full((1 << bits) - 1, _WORD_BASE)]).astype(np.uint64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def gram_hashes(words: np.ndarray, n: int = GRAM_WORDS) -> np.ndarray:
    """A 64-bit number per n-gram; a text of fewer words has none."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64)
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out = out * np.uint64(_GRAM_BASE) + words[k : len(words) - n + 1 + k]
    return _mixed(out)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment score of two word sequences, and where it ends in each (exclusive).

    Smith-Waterman with linear gaps, a row of the passage at a time: gaps along the row are a running maximum.
    """
    ramp = np.arange(len(passage) + 1, dtype=np.int64) * -GAP
    row = np.zeros(len(passage) + 1, dtype=np.int64)
    best = (0, 0, 0)
    for k, word in enumerate(item):
        diagonal = row[:-1] + np.where(passage == word, MATCH, MISMATCH)
        new = np.zeros_like(row)
        new[1:] = np.maximum(0, np.maximum(diagonal, row[1:] + GAP))
        row = np.maximum.accumulate(new + ramp) - ramp
        top = int(row.argmax())
        if row[top] > best[0]:
            best = (int(row[top]), k + 1, top)
    return best


def item_score(
    item: np.ndarray, words: np.ndarray, places: np.ndarray, seeds: np.ndarray, first: np.ndarray, last: np.ndarray, min_seeds: int = 1
) -> tuple[float, int, int]:
    """Best score of an item around its seeds in a text, as a share of the item's own score, and its word span.

    `places` are seeds' word positions in the text, `seeds` which ones stand there, `first` and `last` the positions where the
    item has that seed first and last. Seeds whose passages overlap share one passage, which reaches half an item beyond the
    copies they suggest. Passages with fewer than `min_seeds` different seeds are not aligned.
    """
    if not len(places):
        return 0.0, 0, 0
    slack = len(item) // 2 + 4
    begin = np.maximum(places - last - slack, 0)
    end = np.minimum(places - first + len(item) + slack, len(words))
    order = np.argsort(begin, kind="stable")
    begin, end, seeds = begin[order], np.maximum.accumulate(end[order]), seeds[order]
    firsts = np.flatnonzero(np.append(True, begin[1:] >= end[:-1]))
    found = (0.0, 0, 0)
    for left, right in zip(firsts, np.append(firsts[1:], len(begin)) - 1):
        a, b = begin[left], end[right]
        if len(np.unique(seeds[left : right + 1])) < min_seeds:
            continue
        # long unions are taken in pieces that overlap by the longest passage one copy can fill
        width, step = 8 * len(item) + 4 * slack, 4 * len(item)
        for at in range(a, max(a + 1, b - width + step), step):
            passage = words[at : min(at + width, b)]
            score, _, until = align(item, passage)
            if score / (MATCH * len(item)) > found[0]:
                reverse, _, length = align(item[::-1], passage[:until][::-1])
                found = (score / (MATCH * len(item)), int(at + until - length), int(at + until))
    return found


def _seed_places(item: np.ndarray, words: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places, seeds, first, last) for `item_score`: where the text has which of the hashed `seeds`, a row per place."""
    n = min(GRAM_WORDS, len(item))
    of_item, of_text = gram_hashes(item, n), gram_hashes(words, n)
    seeds = np.intersect1d(seeds, of_item)
    here = np.isin(of_item, seeds)
    offsets, which = np.flatnonzero(here), np.searchsorted(seeds, of_item[here])
    first, last = np.full(len(seeds), len(item)), np.zeros(len(seeds), dtype=np.int64)
    np.minimum.at(first, which, offsets)
    np.maximum.at(last, which, offsets)
    places = np.flatnonzero(np.isin(of_text, seeds))
    found = np.searchsorted(seeds, of_text[places])
    return places, found, first[found], last[found]


def _bloom(rows: DataFrame, column: str) -> np.ndarray:
    """Bit set of the column's low bits; collected as at most 2^18 words of 64 bits."""
    bit = F.col(column).bitwiseAND(F.lit((1 << _BLOOM_BITS) - 1))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))
    words = rows.select(F.shiftright(bit, 6).alias("word"), mask.alias("mask"))
    collected = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(1 << (_BLOOM_BITS - 6), dtype=np.int64)
    bits[collected["word"].to_numpy()] = collected["mask"].to_numpy()
    return bits.view(np.uint64)


def _passes(bloom: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & np.uint64((1 << _BLOOM_BITS) - 1)
    return ((bloom[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)


def _corpus_hits(bits: bytes, sizes: list[int]):
    """Rows (key, text) -> (key, gram) of the different n-grams of the given sizes that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = np.frombuffer(bits, dtype=np.uint64)
        for batch in batches:
            keys, grams = [], []
            for key, text in zip(batch.column(0).to_numpy(), batch.column(1)):
                words = word_hashes(text.as_py())
                hashes = np.concatenate([gram_hashes(words, n) for n in sizes])
                hit = np.unique(hashes[_passes(bloom, hashes)])
                if len(hit):
                    keys.append(np.full(len(hit), key))
                    grams.append(hit.view(np.int64))
            if keys:
                yield pa.RecordBatch.from_pydict({"key": np.concatenate(keys).astype(np.int64), "gram": np.concatenate(grams)})

    return run


def _with_keys(bits: bytes):
    """The rows whose first column, the key, passes the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = np.frombuffer(bits, dtype=np.uint64)
        for batch in batches:
            yield batch.filter(pa.array(_passes(bloom, batch.column(0).to_numpy().view(np.uint64))))

    return run


def _item_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, grams, sizes = [], [], []
        for item, text in zip(batch.column(0), batch.column(1)):
            words = word_hashes(text.as_py())
            size = min(GRAM_WORDS, len(words))
            hashes = np.unique(gram_hashes(words, size)) if size else words
            ids += [item.as_py()] * len(hashes)
            grams.append(hashes.view(np.int64))
            sizes.append(np.full(len(hashes), size))
        yield pa.RecordBatch.from_pydict({
            "item": pa.array(ids, batch.schema.field(0).type), "gram": np.concatenate([np.empty(0, np.int64), *grams]).astype(np.int64),
            "size": np.concatenate([np.empty(0, np.int64), *sizes]).astype(np.int32),
        })


def _aligned(min_score: float):
    """Rows (key, id, text, item, item_text, seeds, needed) -> (key, id, item, score, first_word, last_word) that reach the score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, found = [], []
            last_text, words = None, np.empty(0, dtype=np.uint64)
            for k in range(batch.num_rows):
                text, item_text = batch.column(2)[k].as_py(), batch.column(4)[k].as_py()
                if text != last_text:
                    last_text, words = text, word_hashes(text)
                item = word_hashes(item_text)
                seeds = batch.column(5)[k].values.to_numpy().view(np.uint64)
                best = item_score(item, words, *_seed_places(item, words, seeds), batch.column(6)[k].as_py())
                if best[0] >= min_score:
                    kept.append(k)
                    found.append(best)
            rows = pa.array(kept, pa.int64())
            named = {"key": batch.column(0).take(rows), "id": batch.column(1).take(rows), "item": batch.column(3).take(rows)}
            for n, (name, kind) in enumerate((("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64()))):
                named[name] = pa.array([f[n] for f in found], kind)
            yield pa.RecordBatch.from_pydict(named)

    return run


def _key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    return F.xxhash64(docs[id_col], docs[text_col])


def _contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, seeds: int, min_seeds: int, min_score: float
) -> DataFrame:
    """(key, id, item, score, first_word, last_word); the key is that of `_key`."""
    rows = docs.select(_key(docs, id_col, text_col).alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.filter("text is not null")
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("item_text")).filter("item_text is not null").distinct()
    id_type, item_type = rows.schema["id"].dataType.simpleString(), items.schema["item"].dataType.simpleString()

    grams, _ = staged(items.mapInArrow(_item_grams, f"item {item_type}, gram bigint, size int"), "benchmark-grams")
    sizes = sorted(r["size"] for r in grams.select("size").distinct().collect()) or [GRAM_WORDS]
    find = _corpus_hits(_bloom(grams, "gram").tobytes(), sizes)
    # copies of a row are one key, so that none of them meets an item twice
    hits, _ = staged(rows.select("key", "text").mapInArrow(find, "key bigint, gram bigint").distinct(), "gram-hits")
    counts = hits.groupBy("gram").agg(F.count("*").alias("n"))
    grams = grams.select("item", "gram").distinct()  # items of one id take their seeds together
    rarest = Window.partitionBy("item").orderBy("n", "gram")
    of_item = Window.partitionBy("item")
    present = grams.join(counts, "gram").withColumns({"rank": F.row_number().over(rarest), "present": F.count("*").over(of_item)})
    ranked = present.filter(F.col("rank") <= F.greatest(F.lit(seeds), F.ceil(F.col("present") * SEED_SHARE)))
    needed = F.least(F.lit(min_seeds), F.count("*").over(of_item)).alias("needed")
    chosen = ranked.select("gram", "item", needed)
    # as many seeds as an item has n-grams at most
    met = hits.join(chosen, "gram").groupBy("key", "item").agg(F.collect_list("gram").alias("seeds"), F.max("needed").alias("needed"))
    pairs, _ = staged(met.filter(F.size("seeds") >= F.col("needed")), "seeded-pairs")
    texts = rows.mapInArrow(_with_keys(_bloom(pairs, "key").tobytes()), rows.schema)
    joined = pairs.join(items, pairs["item"].eqNullSafe(items["item"])).drop(items["item"]).join(texts, "key")
    wanted = joined.select("key", "id", "text", "item", "item_text", "seeds", "needed")
    out = f"key bigint, id {id_type}, item {item_type}, score double, first_word bigint, last_word bigint"
    return wanted.mapInArrow(_aligned(min_score), out).distinct()


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    seeds: int = SEEDS, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE,
) -> DataFrame:
    """(id, item, score, first_word, last_word) of every document and item whose alignment reaches `min_score`.

    Pairs with `min_seeds` different seeds (fewer where the item has fewer) are aligned. The score is the alignment's as a
    share of what a verbatim copy has, and the words are the passage it covers. Null and empty texts hold nothing; an
    item of fewer than GRAM_WORDS words is found where a text holds all of it, one without words nowhere. A very long text meets an
    item once, with a passage per stretch of seeds. Rows of equal id and text are one; equal items are found each; an empty table on either side gives an empty result. Null ids are reported as null.
    """
    found = _contaminated(docs, benchmark, id_col, text_col, item_col, item_text, seeds, min_seeds, min_score)
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "score", "first_word", "last_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns: str) -> DataFrame:
    """`docs` without the rows that hold a benchmark item."""
    names = {"item_col": "item_id", "item_text": "text"} | columns
    found = _contaminated(docs, benchmark, id_col, text_col, seeds=SEEDS, min_seeds=MIN_SEEDS, min_score=MIN_SCORE, **names)
    keys = found.select("key").distinct()
    return docs.join(keys, _key(docs, id_col, text_col) == keys["key"], "left_anti")
