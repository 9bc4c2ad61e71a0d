"""SimHash fingerprints and near-duplicate groups.

A fingerprint is embedded by its segments' bit counts: 32 segments of two bits, each holding 0, 1 or 2. The
Manhattan distance of two embeddings never exceeds the number of differing bits, so it is a lower bound. Counts
are kept in unary code (0 -> 00, 1 -> 01, 2 -> 11), in which one step of a segment flips one bit and the Manhattan
distance is the number of differing code bits.

Two fingerprints within 4 bits differ by at most 2 steps in the first or the last 16 segments. Each half is
therefore entered in the grid cell of its counts and in all cells one step away (at most 33); two halves within 2
steps share a cell. Cells join the range search; the lower bound and then the exact bit distance decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from visitlake.llm.components import connected_components
from visitlake.sources.files import staged

SHINGLE_WORDS = 4
MAX_BITS = 4
# Members of a cell that one group of rows holds; larger cells are split in blocks and blocks meet in pairs.
BLOCK = 1024
# Up to this many members all pairs of a cell are compared by array shifts.
SMALL_CELL = 24

_EVEN_BITS = 0x5555555555555555
_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def simhash(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of one text (UTF-8); zero without words.

    A-Z are lower-cased, words are separated by ASCII white space, shingles keep their repeats and a text of
    fewer words is one shingle. A bit is set if it is set in over half of the shingles' XXH64 (seed 42).
    """
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]).tolist()
    starts = [0, *ends[:-1]]
    last = max(0, len(tokens) - words) + 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:last], ends[min(words, len(tokens)) - 1 :])
    hashes = np.array([digest(joined[s : e - 1], 42) for s, e in spans], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """SimHash of a text column as the signed bigint of the same bits; a null text has fingerprint zero."""

    @pandas_udf("bigint")
    def hashed(texts: pd.Series) -> pd.Series:
        values = np.array([simhash(t, words) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64), index=texts.index)

    return hashed(text.cast("binary"))


def _unary(fp: Column) -> Column:
    """Unary code of the 32 two-bit segments' bit counts."""
    even = F.lit(_EVEN_BITS)
    shifted = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(shifted).bitwiseAND(even)
    both = fp.bitwiseAND(shifted).bitwiseAND(even)
    return some.bitwiseOR(F.shiftleft(both, 1))


def grid_cells(fingerprints: DataFrame) -> DataFrame:
    """(cell, fp): each fingerprint in the cells of its two halves and those one step away."""
    moves = F.explode(F.sequence(F.lit(0), F.lit(65))).alias("move")
    half, bit = F.expr("move div 33"), F.expr("cast(move % 33 as int)")
    code = F.expr("shiftrightunsigned(unary, 32 * cast(half as int)) & 4294967295L")
    # bit 32 stays in place; a low bit flips unless the count is 2, a high bit unless it is 0
    allowed = F.expr(
        "step = 32 or (step % 2 = 0 and (shiftright(code, step + 1) & 1) = 0)"
        " or (step % 2 = 1 and (shiftright(code, step - 1) & 1) = 1)"
    )
    cell = F.expr("half * 4294967296L + case when step = 32 then code else code ^ shiftleft(1L, step) end")
    coded = fingerprints.select("fp", _unary(F.col("fp")).alias("unary"))
    steps = coded.select("fp", "unary", moves).select("fp", "unary", half.alias("half"), bit.alias("step"))
    return steps.withColumn("code", code).filter(allowed).select(cell.alias("cell"), "fp")


def _dealt(cells: DataFrame, block: int) -> DataFrame:
    """Members with the pair of blocks (i, j) they take part in; cells of up to `block` members are one block."""
    large = cells.groupBy("cell").count().filter(F.col("count") > block)
    blocks = F.ceil(F.col("count") / block).cast("int")
    sized = cells.join(large.select("cell", blocks.alias("blocks")), "cell", "left")
    own = F.expr("cast(pmod(xxhash64(fp), coalesce(blocks, 1)) as int)")
    other = F.explode(F.expr("sequence(0, coalesce(blocks, 1) - 1)"))
    pairs = sized.select("cell", "fp", own.alias("own"), other.alias("other"))
    return pairs.select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")


def _unary_np(fp: np.ndarray) -> np.ndarray:
    even = np.uint64(_EVEN_BITS)
    shifted = fp >> np.uint64(1)
    return ((fp | shifted) & even) | (((fp & shifted) & even) << np.uint64(1))


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Whether fingerprints lie within `max_bits`: the Manhattan bound first, the bit distance of those it leaves."""
    near = np.bitwise_count(_unary_np(a) ^ _unary_np(b)) <= max_bits
    near[near] = np.bitwise_count(a[near] ^ b[near]) <= max_bits
    return near


def spanning_links(members: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected among `members`, at most one less than there are members."""
    rest, a, b = np.unique(members), [], []
    queue: list = []
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        node = queue.pop()
        near = _near(np.full(len(rest), node), rest, max_bits)
        found = rest[near]
        a.append(np.full(len(found), node))
        b.append(found)
        queue.extend(found)
        rest = rest[~near]
    return np.concatenate(a), np.concatenate(b)


def links_of_groups(group: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups (runs of equal numbers): all pairs of small ones, spanning links of the others."""
    starts = np.flatnonzero(np.diff(group, prepend=group[0] - 1))
    sizes = np.diff(np.append(starts, len(group)))
    a, b = [], []
    in_small = np.repeat(sizes <= SMALL_CELL, sizes)
    g, x = group[in_small], fp[in_small]
    for shift in range(1, int(sizes[sizes <= SMALL_CELL].max(initial=1))):
        same = np.flatnonzero(g[shift:] == g[:-shift])
        left, right = x[same], x[same + shift]
        near = _near(left, right, max_bits)
        a.append(left[near])
        b.append(right[near])
    for k in np.flatnonzero(sizes > SMALL_CELL):
        left, right = spanning_links(fp[starts[k] : starts[k] + sizes[k]], max_bits)
        a.append(left)
        b.append(right)
    none = np.empty(0, dtype=np.uint64)
    a, b = np.concatenate([none, *a]), np.concatenate([none, *b])
    if not len(a):
        return a, b
    ends = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return ends[:, 0], ends[:, 1]


def _link_partition(max_bits: int):
    """Function over the sorted rows (cell, i, j, fp) of a partition; holds one batch and one unfinished group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.empty((0, 4), dtype=np.int64)

        def links(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(rows):
                change = np.any(rows[1:, :3] != rows[:-1, :3], axis=1)
                group = np.concatenate([[0], np.cumsum(change)])
                a, b = links_of_groups(group, np.ascontiguousarray(rows[:, 3]).view(np.uint64), max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=_SCHEMA)

        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(4)], axis=1)
            rows = np.concatenate([kept, rows])
            if not len(rows):
                continue
            unfinished = np.all(rows[:, :3] == rows[-1, :3], axis=1)
            cut = len(rows) - int(np.argmin(unfinished[::-1])) if not unfinished.all() else 0
            yield from links(rows[:cut])
            kept = rows[cut:]
        yield from links(kept)

    return run


def fingerprint_links(fingerprints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp) that connect all that lie within `max_bits` (at most 5).

    Members of one cell are connected by spanning links, so a large group of near copies yields few links and not
    all its pairs. A cell of more than `block` members is split in blocks and each pair of blocks is
    searched by itself, so a group never exceeds two blocks.
    """
    if not 0 <= max_bits <= 5:
        raise ValueError("two halves one step from a shared cell cover at most 5 differing bits")
    dealt = _dealt(grid_cells(fingerprints), block).repartition("cell", "i", "j")
    ordered = dealt.sortWithinPartitions("cell", "i", "j")
    return ordered.mapInArrow(_link_partition(max_bits), "a bigint, b bigint")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """(id, fp, component_id) of every row: its fingerprint and the smallest id linked to it over any number of steps.

    Fingerprints link within `max_bits` differing bits; texts without words (null, empty, blank) have fingerprint
    zero and link like any other. Repeated rows and ids keep their rows. A row without id gets its group's
    smallest id, or null where no row of the group has one. An empty table gives an empty one.
    """
    narrow = docs.select(F.col(id_col).alias(id_col), fingerprint(F.col(text_col), words).alias("fp"))
    marked, _ = staged(narrow, "simhash")
    component = _components(marked, id_col, max_bits).select("fp", "component_id")
    return marked.join(component, "fp").select(id_col, "fp", "component_id")


def _components(marked: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of `marked`; the root names its group, with ids or without."""
    firsts, _ = staged(marked.groupBy("fp").agg(F.min(id_col).alias("first")), "simhash-first")
    roots = connected_components(fingerprint_links(firsts.select("fp"), max_bits), "simhash-links")
    rooted = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "root", "component_id")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every group: the one with the smallest id, or the smallest hash of its text where ids are equal or missing.

    Rows are told apart by a key of their own, so none goes for sharing the id of another. A row that has neither
    id nor words is no copy of anything and stays.
    """
    stored = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"), fingerprint(F.col(text_col)).alias("fp"),
        F.xxhash64(text_col).alias("hash"), F.monotonically_increasing_id().alias("key"),
    )
    rows, _ = staged(stored, "simhash-rows")
    narrow = rows.select("fp", "hash", "key", F.col("row").getField(id_col).alias("id"))
    components = _components(narrow, "id", MAX_BITS)
    order = F.struct(F.col("id").isNull().alias("without"), "id", "hash", "key")
    first = narrow.join(components.select("fp", "root"), "fp").groupBy("root").agg(F.min(order)["key"].alias("key"))
    bare = narrow.filter("id is null and fp = 0").select("key")
    kept = rows.join(first.select("key").union(bare), "key", "left_semi")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
