"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ORDER long, with counts from all training texts. A symbol is looked for
in the longest context first. A context that has not seen it escapes to the next shorter one, with a chance that is
estimated from the number of distinct symbols it has seen, and the symbols of the longer context are excluded
there. Each text is its UTF-8 bytes and one end mark, and begins in a context of marks; the mark is a byte
that no UTF-8 text holds.

Since a context's symbols are among those of its suffixes, what is excluded follows from the context alone, so the code length
of every (context, symbol) is known once the counts are. The trie of order 2 has at most 256^3 leaves, whatever
the size of the corpus: that bounds what tasks hold, and what is collected and broadcast.

Higher orders grow with the corpus. Their trie is a stored table of grams (context and symbol, a byte each), never
collected. The last three bytes of a context hold all that orders from 3 on need of one another, so grams are coded in
groups of those, and the trie of order 2 gives the rest. Texts are joined to the coded grams.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.llm.folds import fold
from visitlake.sources.files import delete, staged

ORDER = 2
DEEP_ORDER = 5  # at most 6, so that a gram and a text's number in its slice fit 64 bits
MARK = 0xFF
# Tokens whose training count is at least this share of all are summed beside the join: at most 1 / HOT_SHARE of them.
HOT_SHARE = 1e-5
# The same for the most frequent grams, at most so many.
HOT_GRAMS = 1 << 21
END = ""  # the end token; no word is empty
_CHUNK = 1 << 22  # bytes taken into arrays at once
_WINDOW = 1 << 18  # grams, or rows of grams, taken into arrays at once
_HELD = 1 << 19  # counted grams that a task holds before it passes them on
_SLICE = 512  # rows scored at once, at most
_SLICE_BYTES = 1 << 20  # bytes of text scored at once, unless one text has more
_PART = 1 << 19  # grams of texts that are passed on at once


def _leaves(data: np.ndarray) -> np.ndarray:
    """Number (context, symbol) of each symbol of marked texts; the first ORDER bytes are context only."""
    wide = data.astype(np.int32)
    return (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]


def _marked(texts: list[bytes]) -> np.ndarray:
    """Texts with two marks before the first and one after each; the context of each text begins with marks.

    The one mark after a text and the one put before the next make that context.
    """
    mark = bytes([MARK])
    return np.frombuffer(mark * 2 + (mark * 2).join(texts) + mark, dtype=np.uint8)


def _chunks(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= _CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def _symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of all symbols of the texts, and where each text's symbols begin."""
    leaves = _leaves(_marked(texts))
    lengths = np.array([len(t) + 1 for t in texts])
    # after each text but the last stands the mark that opens the next one; it is no symbol
    skipped = np.cumsum(lengths + 1)[:-1] - 1
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return np.delete(leaves, skipped), starts


def _count_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(256 ** (ORDER + 1), dtype=np.int64)
    for batch in batches:
        for texts in _chunks(t.as_py() for t in batch.column(0)):
            leaves, _ = _symbols(texts)
            counts += np.bincount(leaves, minlength=len(counts))
    seen = np.flatnonzero(counts)
    for at in range(0, len(seen), 1 << 16):
        part = seen[at : at + (1 << 16)]
        yield pa.RecordBatch.from_pydict({"leaf": pa.array(part, pa.int32()), "n": pa.array(counts[part])})


def code_grid(first: int, leaves: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 probability of every symbol in every context of two bytes that begins with `first` (256 x 256), from the counted leaves.

    Orders 2, 1, 0 and a uniform one. In a context with total T and D symbols whose longer context has excluded
    symbols with X of the total and E in number, a symbol counted c times has c / (T - X + D - E) and escape has
    (D - E) / (T - X + D - E); where nothing new is left, escape is certain. The leaves are sorted.
    """
    one = np.bincount(leaves & 0xFFFF, weights=counts, minlength=1 << 16).astype(np.int64).reshape(256, 256)
    here = slice(*np.searchsorted(leaves, [first << 16, (first + 1) << 16]))
    two = np.zeros(1 << 16, dtype=np.int64)
    two[leaves[here] & 0xFFFF] = counts[here]
    grids = [np.broadcast_to(one.sum(axis=0), (256, 256)), one, two.reshape(256, 256)]
    left = np.zeros((256, 256))  # log10 chance of having escaped so far
    out = np.full((256, 256), np.nan)
    excluded = np.zeros((256, 256), dtype=bool)
    for grid in reversed(grids):
        fresh = (grid > 0) & ~excluded
        total, distinct = (grid * fresh).sum(axis=1), fresh.sum(axis=1)
        whole = np.maximum(total + distinct, 1)[:, None]
        # a symbol of several orders has its code from the longest
        found = fresh & np.isnan(out)
        out[found] = (left + np.log10(np.maximum(grid, 1) / whole))[found]
        left = left + np.where(distinct[:, None] > 0, np.log10(np.maximum(distinct, 1)[:, None] / whole), 0.0)
        excluded = excluded | (grid > 0)
    rest = np.maximum((~excluded).sum(axis=1), 1)[:, None]
    unseen = ~excluded
    out[unseen] = (left - np.log10(rest))[unseen]
    return out.astype(np.float32)


def code_table(leaves: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """`code_grid` of all first bytes (256 x 256 x 256): 67 MB, for models of order 2 only."""
    return np.stack([code_grid(first, leaves, counts) for first in range(256)])


@lru_cache(maxsize=1)
def _table_of(leaves: bytes, counts: bytes) -> np.ndarray:
    return code_table(np.frombuffer(leaves, np.int32), np.frombuffer(counts, np.int64)).reshape(-1)


def train_ppm(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(leaves, counts) of the trie over whole texts; null texts count as empty ones, an empty table has no leaves."""
    counted = docs.select(F.coalesce(text_col, F.lit("")).cast("binary")).mapInArrow(_count_leaves, "leaf int, n bigint")
    trie = counted.groupBy("leaf").agg(F.sum("n").alias("n")).toArrow().sort_by("leaf")
    return trie["leaf"].to_numpy().astype(np.int32), trie["n"].to_numpy().astype(np.int64)


def ppm_scores(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """log10 probability of each text and its end."""
    out = [np.empty(0)]
    for part in _chunks(texts):
        leaves, starts = _symbols(part)
        out.append(np.add.reduceat(table[leaves].astype(np.float64), starts))
    return np.concatenate(out)


def _low(order: int) -> int:
    """Bits of the last `order` bytes of a context and the symbol."""
    return (1 << 8 * (order + 1)) - 1


def _windows(texts: list[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams of all symbols of the texts and the number of the text each is from, some at a time."""
    mark = bytes([MARK]) * order
    data = np.frombuffer(mark + mark.join(texts) + mark[:1], dtype=np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    # a text's symbols and its end; the other marks before the next text are no symbols
    bounds = np.concatenate([[0], np.cumsum(lengths + order)])
    for at in range(0, len(data) - order, _WINDOW):
        size = min(_WINDOW, len(data) - order - at)
        grams = np.zeros(size, dtype=np.int64)
        for j in range(order + 1):
            grams = grams << 8 | data[at + j : at + j + size]
        owner = np.repeat(np.arange(len(texts)), np.diff(np.clip(bounds - at, 0, size)))
        symbols = at + np.arange(size) - bounds[owner] <= lengths[owner]
        yield grams[symbols], owner[symbols]


def _count_grams(order: int):
    """Function from rows (text, in training) to (gram, n); grams of other rows count zero. Sums over many batches."""

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return grams, np.bincount(at, weights=np.concatenate([n for _, n in parts]), minlength=len(grams)).astype(np.int64)

    def rows(grams: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(grams), 1 << 16):
            yield pa.RecordBatch.from_pydict({"gram": pa.array(grams[at : at + (1 << 16)]), "n": pa.array(n[at : at + (1 << 16)])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            training = np.array(batch.column(1).to_pylist(), dtype=np.int64)
            done = 0
            for texts in _chunks(t.as_py() for t in batch.column(0)):
                for grams, owner in _windows(texts, order):
                    found, counts = np.unique(grams << 1 | training[done + owner], return_counts=True)
                    parts.append((found >> 1, counts * (found & 1)))
                    held += len(found)
                    if held > 2 * _HELD:
                        parts = [merged(parts)]
                        held = len(parts[0][0])
                        if held > _HELD:
                            yield from rows(*parts[0])
                            parts, held = [], 0
                done += len(texts)
        if parts:
            yield from rows(*merged(parts))

    return run


def deep_codes(
    grams: np.ndarray, counts: np.ndarray, nodes3: np.ndarray, counts3: np.ndarray, leaves: np.ndarray, leaf_counts: np.ndarray,
    grid, order: int,
) -> np.ndarray:
    """log10 probability of each gram's symbol in its context, escapes and exclusion as in `code_grid`.

    The grams are distinct and all there are with the same last four bytes of context, counted or not. `nodes3` (sorted)
    are all nodes of order 3 in their contexts with their counts, `leaves` (sorted) those of order 2 likewise; `grid` gives the
    codes of a first byte.
    """
    leaves, leaf_counts = np.append(leaves, np.int32(0x7FFFFFFF)), np.append(leaf_counts, 0)
    sizes = {2: np.bincount(leaves[:-1] >> 8, weights=leaf_counts[:-1], minlength=1 << 16)}
    kinds = {2: np.bincount(leaves[:-1] >> 8, minlength=1 << 16)}
    nodes, n, in_context, rows = {3: nodes3}, {3: counts3}, {}, {}

    def counted(found: np.ndarray, k: int) -> np.ndarray:
        """Counts of nodes of order k."""
        if k > 2:
            return n[k][np.searchsorted(nodes[k], found)]
        at = np.searchsorted(leaves, found)
        return np.where(leaves[at] == found, leaf_counts[at], 0)

    for k in range(3, order + 1):
        if k > 3:
            nodes[k], at = np.unique(grams & _low(k), return_inverse=True)
            n[k] = np.bincount(at, weights=counts, minlength=len(nodes[k]))
        contexts, in_context[k] = np.unique(nodes[k] >> 8, return_inverse=True)
        sizes[k] = np.bincount(in_context[k], weights=n[k], minlength=len(contexts))
        kinds[k] = np.bincount(in_context[k], weights=n[k] > 0, minlength=len(contexts))
        rows[k] = np.searchsorted(contexts, (grams & _low(k)) >> 8)
    rows[2] = grams >> 8 & 0xFFFF
    left, out = np.zeros(len(grams)), np.full(len(grams), np.nan)
    for k in range(order, 1, -1):
        total, distinct = sizes[k][rows[k]], kinds[k][rows[k]].astype(np.float64)
        if k < order:
            shorter = counted(nodes[k + 1] & _low(k), k) * (n[k + 1] > 0)
            total = total - np.bincount(in_context[k + 1], weights=shorter)[rows[k + 1]]
            distinct = distinct - kinds[k + 1][rows[k + 1]]
        whole = np.maximum(total + distinct, 1)
        own = counted(grams & _low(k), k)
        out = np.where(np.isnan(out) & (own > 0), left + np.log10(np.maximum(own, 1) / whole), out)
        left = left + np.where(distinct > 0, np.log10(np.maximum(distinct, 1) / whole), 0.0)
    # below order 2 as in the grids, without their escape from order 2
    total, distinct = sizes[2][rows[2]], kinds[2][rows[2]]
    escape = np.where(distinct > 0, np.log10(np.maximum(distinct, 1) / np.maximum(total + distinct, 1)), 0.0)
    first = grams >> 16 & 0xFF
    low = np.empty(len(grams))
    for byte in np.unique(first):
        low[first == byte] = grid(int(byte))[grams[first == byte] >> 8 & 0xFF, grams[first == byte] & 0xFF]
    return np.where(np.isnan(out), left + low - escape, out)


def _coder(leaves: bytes, leaf_counts: bytes, order: int):
    """Function from rows (is gram, gram or node of order 3, n) of a partition to grams with codes.

    Rows are sorted by the context's second last byte, its last three, nodes before grams, and its last four. Whole groups
    of the last are coded together, at most 256^2 grams at order 5, beside at most 256 nodes for each context of three
    bytes among them, and one grid of codes is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = np.frombuffer(leaves, np.int32), np.frombuffer(leaf_counts, np.int64)
        grid = lru_cache(maxsize=1)(lambda first: code_grid(first, *trie))
        heads = np.empty((2, 0), dtype=np.int64)

        def coded(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal heads
            heads = np.concatenate([heads, rows[1:, rows[0] == 0]], axis=1)
            heads = heads[:, np.argsort(heads[0])]
            _, grams, n = rows[:, rows[0] == 1]
            if len(grams):
                codes = deep_codes(grams, n, *heads, *trie, grid, order)
                for at in range(0, len(codes), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    yield pa.RecordBatch.from_pydict({"gram": pa.array(grams[part]), "n": pa.array(n[part]), "code": pa.array(codes[part])})

        parts, held, limit = [], 0, _WINDOW
        for batch in batches:
            parts.append(np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)]))
            held += batch.num_rows
            if held < limit:
                continue
            rows = np.concatenate(parts, axis=1)
            last = rows[:, -1]
            context = _low(4 if last[0] else 3) & ~0xFF
            group = (rows[0] == last[0]) & ((rows[1] ^ last[1]) & context == 0)
            cut = len(group) - int(np.argmin(group[::-1])) if not group.all() else 0
            if cut:
                yield from coded(rows[:, :cut])
                heads = heads[:, heads[0] >> 8 == (last[1] & _low(3)) >> 8]
            parts, held = [rows[:, cut:].copy()], held - cut
            limit = held + _WINDOW
        if held:
            yield from coded(np.concatenate(parts, axis=1))

    return run


def gram_counts(docs: DataFrame, in_training: Column, text_col: str, order: int) -> tuple[DataFrame, str]:
    """(gram, n) of all texts' grams, stored, and its path: n counts those of the rows `in_training`, and may be zero."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    counted = docs.select(text, in_training).mapInArrow(_count_grams(order), "gram bigint, n bigint")
    return staged(counted.groupBy("gram").agg(F.sum("n").alias("n")), "grams")


def _trie_of(grams: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(leaves, counts) of order 2, as `train_ppm` has them."""
    leaf = F.col("gram").bitwiseAND(_low(2)).cast("int").alias("leaf")
    trie = grams.filter("n > 0").groupBy(leaf).agg(F.sum("n").alias("n")).toArrow().sort_by("leaf")
    return trie["leaf"].to_numpy().astype(np.int32), trie["n"].to_numpy().astype(np.int64)


def gram_codes(grams: DataFrame, leaves: np.ndarray, leaf_counts: np.ndarray, order: int) -> DataFrame:
    """(gram, n, code) of all grams, stored."""
    bits = lambda low, size: F.shiftright("gram", low).bitwiseAND((1 << size) - 1)
    nodes = grams.groupBy(F.col("gram").bitwiseAND(_low(3)).alias("gram")).agg(F.sum("n").alias("n"))
    rows = nodes.select(F.lit(0).alias("kind"), "gram", "n").unionByName(grams.select(F.lit(1).alias("kind"), "gram", "n"))
    dealt = rows.repartition(bits(8, 24)).sortWithinPartitions(bits(16, 8), bits(8, 24), "kind", bits(8, 32))
    coded = dealt.mapInArrow(_coder(leaves.tobytes(), leaf_counts.tobytes(), order), "gram bigint, n bigint, code double")
    return staged(coded, "gram-codes")[0]


def _hot_grams(codes: DataFrame) -> tuple[Column, tuple[np.ndarray, np.ndarray]]:
    """Whether a row of `gram_codes` is among the HOT_GRAMS most frequent, and those: sorted grams, their codes.

    The limit is found from counts in steps of an eighth of a power of two.
    """
    step = F.when(F.col("n") > 0, F.floor(F.log2("n") * 8)).otherwise(-1)
    counts = {r["step"]: r["count"] for r in codes.groupBy(step.alias("step")).count().collect()}
    taken, least = 0, 1 << 10
    for at in sorted(counts, reverse=True):
        taken += counts[at]
        if at < 0 or taken > HOT_GRAMS:
            break
        least = at
    hot = codes.filter(step >= least).select("gram", F.col("code").cast("float").alias("code")).toArrow().sort_by("gram")
    return step >= least, (hot["gram"].to_numpy(), hot["code"].to_numpy())


def _deep_scores(texts: list[bytes], hot: tuple[np.ndarray, np.ndarray], order: int) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Sum over the hot grams (sorted, and their codes) of each text, and its other grams with their counts.

    Long texts come in parts: all but the last result hold sums of zero, and grams to be added to the last one's.
    """
    keys, codes = hot
    sums, rest, held = np.zeros(len(texts)), [np.empty((3, 0), dtype=np.int64)], 0

    def lists() -> pa.Array:
        owner, found, n = np.concatenate(rest, axis=1)
        by_text = np.argsort(owner, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
        pairs = pa.StructArray.from_arrays([pa.array(found[by_text]), pa.array(n[by_text])], names=["gram", "n"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)

    for grams, owner in _windows(texts, order):
        if held > _PART:
            yield np.zeros(len(texts)), lists()
            rest, held = [np.empty((3, 0), dtype=np.int64)], 0
        # grams first, so that the search goes through the keys in order
        both, n = np.unique(grams * _SLICE + owner, return_counts=True)
        found, owner = both // _SLICE, both % _SLICE
        at = np.minimum(np.searchsorted(keys, found), max(len(keys) - 1, 0))
        hit = keys[at] == found if len(keys) else np.zeros(len(found), dtype=bool)
        sums += np.bincount(owner[hit], weights=codes[at[hit]] * n[hit], minlength=len(texts))
        rest.append(np.stack([owner[~hit], found[~hit], n[~hit]]))
        held += int((~hit).sum())
    yield sums, lists()


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for text in batch.column(0):
            counts.update(text.as_py().lower().split())
        words = pa.array([*counts, END.encode()], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_pydict({"token": words, "n": pa.array([*counts.values(), batch.num_rows], pa.int64())})


_SCORED = "n_tokens bigint, hot_known bigint, hot_sum double, cold array<struct<token:string,n:bigint>>, score double, grams array<struct<gram:bigint,n:bigint>>"


def _scorer(model, hot: dict[bytes, float], columns: int):
    """Function that adds to rows (others..., row number, text) the sums over hot tokens and grams, and the other tokens and grams.

    `model` makes in the task the function from texts to their scores and the grams still to be added.
    """
    cold_type = pa.list_(pa.struct([("token", pa.string()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = model()
        for whole in batches:
            names = [*whole.schema.names[:columns], "n_tokens", "hot_known", "hot_sum", "cold", "score", "grams"]
            for at, size in _byte_slices(whole.column(columns)):
                batch = whole.slice(at, size)
                texts = [t.as_py() for t in batch.column(columns)]
                totals, known, sums, ends, tokens, counts = [], [], [], [0], [], []
                for text in texts:
                    seen = Counter(text.lower().split())
                    seen[END.encode()] = 1
                    hits = [(hot[w], n) for w, n in seen.items() if w in hot]
                    totals.append(seen.total())
                    known.append(sum(n for _, n in hits))
                    sums.append(sum(x * n for x, n in hits))
                    rest = [(w, n) for w, n in seen.items() if w not in hot]
                    tokens.extend(w for w, _ in rest)
                    counts.extend(n for _, n in rest)
                    ends.append(len(tokens))
                pairs = pa.StructArray.from_arrays(
                    [pa.array(tokens, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], fields=list(cold_type.value_type)
                )
                added = [
                    pa.array(totals, pa.int64()), pa.array(known, pa.int64()), pa.array(sums, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
                ]
                score, grams = None, None
                for more in scores(texts):
                    if grams is not None:  # a part of long texts' grams, under their row numbers alone
                        nothing = [pa.nulls(size, t) for t in (pa.int64(), pa.int64(), pa.float64(), cold_type, pa.float64())]
                        others = [pa.nulls(size, c.type) for c in batch.columns[: columns - 1]]
                        yield pa.RecordBatch.from_arrays([*others, batch.column(columns - 1), *nothing, grams], names=names)
                    score, grams = more
                yield pa.RecordBatch.from_arrays([*batch.columns[:columns], *added, pa.array(score), grams], names=names)

    return run


def _byte_slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Where slices begin and how many rows they have."""
    first, size = 0, 0
    for n, text in enumerate(texts):
        size += len(text.as_buffer() or b"") if text.is_valid else 0
        if size >= _SLICE_BYTES or n + 1 - first == _SLICE:
            yield first, n + 1 - first
            first, size = n + 1, 0
    if first < len(texts):
        yield first, len(texts) - first


def _flat_model(leaves: bytes, trie_counts: bytes):
    def made():
        table = _table_of(leaves, trie_counts)
        none = pa.scalar([], pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())])))
        return lambda texts: [(ppm_scores(texts, table), pa.repeat(none, len(texts)))]

    return made


def _deep_model(hot: tuple[np.ndarray, np.ndarray], order: int):
    return lambda: lambda texts: _deep_scores(texts, hot, order)


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 1, order: int = ORDER
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; null texts count as empty.

    Both models learn from the rows outside the held-out fold. `score` is the trie's log10 probability of the text and its end.
    `base_score` sums log10((c + 0.5) / (N + 0.5 (V + 1))) over the words and the end. Repeated rows are scored each
    and each counts; without training rows every count is zero; an empty table gives an empty one.

    Token counts are combined per batch before the shuffle. Scoring joins each text's distinct tokens to them, but for the
    frequent ones (at most 1 / HOT_SHARE), whose counts go along, so that no token is a hot key of the join. Contexts
    are up to `order` bytes long; above ORDER, grams are joined as tokens are, but for the HOT_GRAMS most frequent.
    """
    if not ORDER <= order <= 6:
        raise ValueError("contexts are 2 to 6 bytes long")
    spark: SparkSession = docs.sparkSession
    is_held_out = fold(id_col, folds) == held_out
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    training = docs.filter(~is_held_out)
    counted = training.select(text.alias("text")).mapInArrow(_count_tokens, "token string, n bigint")
    vocabulary, _ = staged(counted.groupBy("token").agg(F.sum("n").alias("c")).filter("c > 0"), "token-counts")
    sizes = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("N"), F.count("*").alias("V")).first()
    floor, whole = max(1, sizes["N"] * HOT_SHARE), sizes["N"] + 0.5 * (sizes["V"] + 1)
    log_share = lambda c: F.log10((c + 0.5) / F.lit(whole))
    hot_rows = vocabulary.filter(F.col("c") >= floor).select("token", log_share(F.col("c")).alias("x")).collect()
    hot = {r["token"].encode(): r["x"] for r in hot_rows}
    if order > ORDER:
        grams, path = gram_counts(docs, ~is_held_out, text_col, order)
        codes = gram_codes(grams, *_trie_of(grams), order)
        delete(spark, path)
        is_hot, hot_grams = _hot_grams(codes)
        model = _deep_model(hot_grams, order)
    else:
        leaves, trie_counts = train_ppm(training, text_col)
        model = _flat_model(leaves.tobytes(), trie_counts.tobytes())

    rows = docs.select(F.col(id_col).alias("id"), is_held_out.alias("held_out"), F.monotonically_increasing_id().alias("row"), text.alias("text"))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:3])
    parts, _ = staged(rows.mapInArrow(_scorer(model, hot, 3), f"{kept}, {_SCORED}"), "scored")
    scored = parts.filter("n_tokens is not null")
    tokens = scored.select("row", F.inline("cold"))
    counts = vocabulary.filter(F.col("c") < floor)
    found = tokens.join(counts, "token", "left").select("row", "n", F.coalesce("c", F.lit(0)).alias("c"))
    cold = found.groupBy("row").agg(
        F.sum(F.col("n") * log_share(F.col("c"))).alias("cold_sum"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("cold_known")
    )
    if order > ORDER:
        wanted = parts.select("row", F.inline("grams")).withColumnRenamed("n", "times")
        added = wanted.join(codes.filter(~is_hot).select("gram", "code"), "gram")
        rare = added.groupBy("row").agg(F.sum(F.col("times") * F.col("code")).alias("rare"))
        scored = scored.join(rare, "row", "left").withColumn("score", F.col("score") + F.coalesce("rare", F.lit(0.0)))
    return scored.drop("cold", "grams").join(cold, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("hot_known") + F.coalesce("cold_known", F.lit(0))).alias("n_known"), F.lit(sizes["N"]).cast("bigint").alias("train_tokens"),
        (F.col("hot_sum") + F.coalesce("cold_sum", F.lit(0.0))).alias("base_score"), "score",
    )
