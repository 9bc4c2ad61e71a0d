"""Removal of passages that occur earlier, found by fixed-block anchors.

Every document is cut into blocks of BLOCK words that do not overlap, and the blocks' hashes are indexed. Every rolling
window of BLOCK words of every document probes the index. A passage of `window` >= 2 BLOCK - 1 words holds a whole block
of each document it stands in, so two equal passages always meet in an anchor: the first one's block, hit by the other's
probe. Blocks that are met from nowhere else are no anchors. Hits are then extended, first by stretches: runs of windows
around anchors, cut where a window's own hash says so, so that copies are cut alike. A stretch that a smaller id holds
as well repeats as a whole. In the other stretches windows are compared one by one. Runs of repeated windows join to
maximal repeats.

Groups of copies of any size cost their rows and no more: places of one anchor, stretch or window meet in an aggregation
that is combined before the shuffle, never in pairs. Blocks, anchors and first stretches go to the tasks as bitmaps of at
most MAX_BITS. A bitmap only ever holds too much; that lets more probes, windows and stretches through, which the
aggregations then tell apart, so results are exact at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.sources.files import delete, staged

WINDOW = 20
BLOCK = 10
# Bits of a bitmap: some for each entry, in powers of two up to 64 MB. An entry sets two of them. Of anchors and stretches
# few may pass by chance, as every anchor makes a dozen windows candidates.
BITS_PER_BLOCK, BITS_PER_ENTRY = 16, 64
MAX_BITS = 1 << 29
MIN_BITS = 1 << 15
_SLICE = 1 << 20  # bytes of text taken into arrays at once
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so that a changed word always changes the sum
# One window in so many ends a stretch.
STRETCH = 32
_OTHER_STEP = np.uint64(0xD6E8FEB86659FD93)
_PAGE = 32768  # bits of one row of a bitmap that is being made


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Words of the texts, some texts at a time, and the number of the first one's row."""
    part, size, first = [], 0, 0
    for n, text in enumerate(texts):
        words = (text.as_py() or b"").split()
        part.append(words)
        size += sum(map(len, words))
        if size >= _SLICE:
            yield first, part
            part, size, first = [], 0, n + 1
    if part:
        yield first, part


def _word_hashes(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes per word of all texts in a row, and where each text begins and the last ends."""
    digests = b"".join(xxhash.xxh3_128_digest(w) for text in words for w in text)
    pairs = np.frombuffer(digests, dtype=">u8").astype(np.uint64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1], np.cumsum([0, *map(len, words)])


def _rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` values from each place on, where there are so many."""
    places = len(hashes) - size + 1
    if places <= 0:
        return np.empty(0, dtype=np.uint64)
    sums = np.zeros(places, dtype=np.uint64)
    for j in range(size):
        sums = sums * _STEP + hashes[j : j + places]
    return sums


def _inside(bounds: np.ndarray, size: int) -> np.ndarray:
    """Places from which `size` words belong to one text, and the text of each; as two rows."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.stack([bounds[owner] + np.arange(len(owner)) - before[owner], owner])


def _bit(hashes: np.ndarray, bits: int, step: np.uint64) -> np.ndarray:
    return (hashes * step) >> np.uint64(64 - bits.bit_length() + 1)


def _test(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether both bits of each hash are set; the second is looked up only where the first is."""

    def found(some: np.ndarray, step: np.uint64) -> np.ndarray:
        bit = _bit(some, len(bitmap) * 8, step)
        return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    out = found(hashes, _STEP)
    out[out] = found(hashes[out], _OTHER_STEP)
    return out


def _blocks(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in texts:
        for _, words in _slices(batch.column(0)):
            first, _, bounds = _word_hashes(words)
            at, owner = _inside(bounds, BLOCK)
            found = _rolling(first, BLOCK)[at[(at - bounds[owner]) % BLOCK == 0]]
            yield pa.RecordBatch.from_pydict({"hash": pa.array(np.unique(found).view(np.int64))})


def _probes(index: Broadcast):
    """Rolling windows that hit the index, with how often they occur and, times 2^32, how often as blocks."""

    def run(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(index.value, dtype=np.uint8)
        for batch in texts:
            for _, words in _slices(batch.column(0)):
                first, _, bounds = _word_hashes(words)
                at, owner = _inside(bounds, BLOCK)
                hashes = _rolling(first, BLOCK)[at]
                hit = _test(bitmap, hashes)
                found, group = np.unique(hashes[hit], return_inverse=True)
                block = ((at - bounds[owner]) % BLOCK == 0)[hit]
                n = np.bincount(group, minlength=len(found)) + (np.bincount(group, weights=block, minlength=len(found)).astype(np.int64) << 32)
                yield pa.RecordBatch.from_pydict({"hash": pa.array(found.view(np.int64)), "n": pa.array(n.astype(np.int64))})

    return run


def _same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return batches


def _bitmap(rows: DataFrame, entries: int, hashes_of=_same, bits_per_entry: int = BITS_PER_ENTRY) -> Broadcast:
    """Bitmap of the hashes that a function makes of rows, for the tasks.

    Pages are made where their bits meet and put together here.
    """
    bits = min(MAX_BITS, max(MIN_BITS, 1 << (bits_per_entry * max(entries, 1) - 1).bit_length()))

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in hashes_of(batches):
            values = batch.column(0).to_numpy().view(np.uint64)
            bit = np.unique(np.concatenate([_bit(values, bits, step) for step in (_STEP, _OTHER_STEP)])).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"page": pa.array((bit // _PAGE).astype(np.int32)), "bit": pa.array(bit % _PAGE)})

    # dealt by page first, so that no task holds more than its own pages
    dealt = rows.mapInArrow(pages, "page int, bit bigint").repartition("page")
    found = dealt.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")).toArrow()
    whole = np.zeros((bits // _PAGE, _PAGE // 8), dtype=np.uint8)
    for page, part in zip(found["page"].to_pylist(), found["bits"]):
        whole[page] = np.frombuffer(part.as_py(), dtype=np.uint8)
    return rows.sparkSession.sparkContext.broadcast(whole.tobytes())


def _candidates(bitmap: np.ndarray, words: list[list[bytes]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows that hold an anchor: the text of each, its place there, and two hashes."""
    first, second, bounds = _word_hashes(words)
    anchor = np.zeros(len(first) + 1, dtype=np.int64)
    at, _ = _inside(bounds, BLOCK)
    anchor[at + 1] = _test(bitmap, _rolling(first, BLOCK)[at])
    anchors = np.cumsum(anchor)
    at, owner = _inside(bounds, window)
    hit = anchors[at + window - BLOCK + 1] > anchors[at]
    at, owner = at[hit], owner[hit]
    a, b = _rolling(first, window)[at], _rolling(second, window)[at]
    return owner, at - bounds[owner], a.view(np.int64), b.view(np.int64)


def _id_hashes(ids: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(str(x).encode()) for x in ids.to_pylist()], dtype=np.uint64)


def _stretches(owner: np.ndarray, start: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The stretch of each window (sorted by text and place); of each stretch its first window and two hashes."""
    new = (np.diff(owner, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1) | (a.view(np.uint64) % np.uint64(STRETCH) == 0)
    first, of = np.flatnonzero(new), np.cumsum(new) - 1
    if not len(first):
        return of, first, a, b
    weights = np.cumprod(np.full(np.diff(np.append(first, len(a))).max(), _STEP, dtype=np.uint64))
    weight = weights[np.arange(len(a)) - first[of]]
    return of, first, *(np.add.reduceat(x.view(np.uint64) * weight, first).view(np.int64) for x in (a, b))


def _entries(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """What stands in the bitmap of first stretches for a stretch (96 bits of hash) of an id."""
    return a.view(np.uint64) + b.astype(np.int64).view(np.uint64) * _STEP + ids


def _stretch_rows(anchors: Broadcast, window: int):
    """Function from rows (id, text) to (id, a, b) of the texts' stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(anchors.value, dtype=np.uint8)
        for batch in batches:
            for at, words in _slices(batch.column(1)):
                owner, *found = _candidates(bitmap, words, window)
                _, first, a, b = _stretches(owner, *found)
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column(0).take(pa.array(at + owner[first])), "a": pa.array(a), "b": pa.array((b >> 32).astype(np.int32))
                })

    return run


def _stretch_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        yield pa.RecordBatch.from_pydict({"hash": pa.array(_entries(a, b, _id_hashes(batch.column(0))).view(np.int64))})


def _open_windows(bitmap: np.ndarray, stretches: np.ndarray, ids: pa.Array, words: list[list[bytes]], window: int):
    """As `_candidates`, and whether each window lies in a stretch that may be the first of its kind."""
    owner, start, a, b = _candidates(bitmap, words, window)
    of, first, x, y = _stretches(owner, start, a, b)
    may_be_first = _test(stretches, _entries(x, y >> 32, _id_hashes(ids)[owner[first]]))
    return owner, start, a, b, may_be_first[of]


def _windows(anchors: Broadcast, stretches: Broadcast, window: int):
    """Function from rows (id, text) to each text's distinct windows in stretches that may be first, as 96 bits of hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, open_ = np.frombuffer(anchors.value, dtype=np.uint8), np.frombuffer(stretches.value, dtype=np.uint8)
        for batch in batches:
            for at, words in _slices(batch.column(1)):
                ids = batch.column(0).slice(at, len(words))
                owner, _, a, b, may_be_first = _open_windows(bitmap, open_, ids, words, window)
                owner, a, b = owner[may_be_first], a[may_be_first], b[may_be_first]
                order = np.lexsort((a, owner))
                new = (np.diff(a[order], prepend=0) != 0) | (np.diff(owner[order], prepend=-1) != 0)
                chosen = order[new]
                yield pa.RecordBatch.from_pydict({
                    "id": ids.take(pa.array(owner[chosen])), "a": pa.array(a[chosen]), "b": pa.array((b[chosen] >> 32).astype(np.int32))
                })

    return run


def _spans(starts: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """First words and ends of the maximal runs that sorted windows cover."""
    if not len(starts):
        return [], []
    new = np.concatenate([[True], starts[1:] > starts[:-1] + window])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return starts[new].tolist(), (starts[last] + window).tolist()


def _cutter(anchors: Broadcast, stretches: Broadcast, window: int):
    """Function from rows (id, text, windows that are nowhere earlier) to (id, n_words, spans removed, text left)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, open_ = np.frombuffer(anchors.value, dtype=np.uint8), np.frombuffer(stretches.value, dtype=np.uint8)
        for batch in batches:
            firsts = batch.column(2)
            for at, words in _slices(batch.column(1)):
                owner, start, a, _, may_be_first = _open_windows(bitmap, open_, batch.column(0).slice(at, len(words)), words, window)
                borders = np.searchsorted(owner, np.arange(len(words) + 1))
                left, spans = [], []
                for n, text in enumerate(words):
                    own, places = a[borders[n] : borders[n + 1]], start[borders[n] : borders[n + 1]]
                    kept = np.zeros(len(own), dtype=bool)
                    kept[np.unique(own, return_index=True)[1]] = True
                    listed = firsts[at + n].values.to_numpy() if firsts[at + n].is_valid else own[:0]
                    kept &= may_be_first[borders[n] : borders[n + 1]] & np.isin(own, listed)
                    begins, ends = _spans(places[~kept], window)
                    cuts = [0, *(x for pair in zip(begins, ends) for x in pair), len(text)]
                    left.append(b" ".join(w for c in range(0, len(cuts), 2) for w in text[cuts[c] : cuts[c + 1]]))
                    spans.append([{"first": x, "end": y} for x, y in zip(begins, ends)])
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column(0).slice(at, len(words)), "n_words": pa.array(map(len, words), pa.int64()),
                    "removed": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
                    "kept": pa.array(left, pa.binary()).cast(pa.string()),
                })

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, removed, kept) of every row: spans of words that went, and the words left, joined by one space.

    Words are what stands between ASCII white space. A word goes if a run of `window` words that covers it stands earlier
    as well: in a smaller id, or earlier in the same row; runs are those of the input, also where parts of them go.
    `removed` lists maximal spans (first word, end) in order. Null, empty and shorter texts lose nothing. Rows without id
    come after all others. Rows that share an id, or have none, lose nothing to one another. An empty table
    gives an empty one.

    What repeats inside a row is told there, so a window meets others as (hash, id) and the smallest id is found by an
    aggregation. A document's windows must fit a task; nothing else is gathered by document, passage or anchor.
    """
    if window < 2 * BLOCK - 1:
        raise ValueError(f"windows of fewer than {2 * BLOCK - 1} words may hold no block")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    texts, id_type = rows.select("text"), rows.schema["id"].dataType.simpleString()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    index = _bitmap(texts, size // (6 * BLOCK), _blocks, BITS_PER_BLOCK)
    met = texts.mapInArrow(_probes(index), "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))
    anchors, path = staged(met.filter((F.col("n").bitwiseAND(0xFFFFFFFF) > 1) & (F.shiftright("n", 32) > 0)).select("hash"), "anchors")
    index.destroy()
    bitmap = _bitmap(anchors, anchors.count())
    delete(docs.sparkSession, path)

    hashed = f"id {id_type}, a bigint, b int"
    first_stretches = rows.mapInArrow(_stretch_rows(bitmap, window), hashed).groupBy("a", "b").agg(F.min("id").alias("id"))
    known, path = staged(first_stretches.select("id", "a", "b"), "stretches")
    stretches = _bitmap(known, known.count(), _stretch_entries)
    delete(docs.sparkSession, path)

    places = rows.mapInArrow(_windows(bitmap, stretches, window), hashed)
    earliest = places.groupBy("a", "b").agg(F.min("id").alias("of"))
    firsts = earliest.groupBy("of").agg(F.collect_list("a").alias("firsts"))
    joined = rows.join(firsts, F.col("id").eqNullSafe(F.col("of")), "left").select("id", "text", "firsts")
    cut = joined.mapInArrow(
        _cutter(bitmap, stretches, window), f"id {id_type}, n_words bigint, removed array<struct<first:int,end:int>>, kept string"
    )
    return cut.withColumnRenamed("id", id_col)
