"""Exact top-k search by inner product, pruned by segment statistics from coarse to fine.

A vector cut in segments of length L has in each a mean m and a deviation s. With x in the segment written as its mean
plus a rest of length s * sqrt(L), the inner product of two segments is L * m * m' plus that of the rests, which
is at most L * s * s'. So with the squared lengths known, sum(L * (m * m' + s * s')) bounds the inner product from above and the
Euclidean distance from below. Finer segments give tighter bounds; the last level's survivors are computed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlake.sources.files import staged

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
PART_BLOCKS = 4  # blocks of candidates that one group of rows holds
TILE = 128  # queries bounded together
FIRST = 2  # times k: the candidates of a block that a query scores before it prunes the others
LEVELS = (1, 4, 16, 32)  # segments per vector, coarse to fine; those below its width are used
_DENSE = 8  # pairs are scored one by one where fewer than one in so many is left
_PAIRS = 1 << 16  # pairs scored at once
_LOWEST = np.iinfo(np.int64).min

_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Rows of sqrt(L) * mean and sqrt(L) * deviation per segment; their inner product is the bound."""
    parts = np.array_split(vectors.astype(np.float64), min(segments, max(1, vectors.shape[1])), axis=1)
    root = np.sqrt([max(1, p.shape[1]) for p in parts])
    means = np.stack([p.mean(axis=1) if p.shape[1] else np.zeros(len(p)) for p in parts], axis=1) * root
    deviations = np.stack([p.std(axis=1) if p.shape[1] else np.zeros(len(p)) for p in parts], axis=1) * root
    return np.concatenate([means, deviations], axis=1)


def _largest(values: np.ndarray) -> float:
    return float(np.abs(values.astype(np.float64)).max(initial=0))


def exact_products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point where that is exact, with Python's integers otherwise.

    A product that a 64-bit integer cannot hold ends in an OverflowError.
    """
    top = _largest(queries) * _largest(candidates) * max(1, queries.shape[1])
    if top < 2**53:
        return (queries.astype(np.float64) @ candidates.T.astype(np.float64)).astype(np.int64)
    return np.array(queries.astype(object) @ candidates.T.astype(object)).astype(np.int64)


def survivors(queries: list[np.ndarray], candidates: list[np.ndarray], floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that some query still wants after all levels, and which query wants which of them.

    `queries` and `candidates` hold the statistics of each level. A level looks only at candidates that the
    coarser ones left, and takes a pair away whose bound is below the query's floor.
    """
    alive = np.arange(len(candidates[0]))
    mask = np.ones((len(floor), len(alive)), dtype=bool)
    for q_stats, v_stats in zip(queries, candidates):
        if not len(alive) or not np.isfinite(floor).any():
            break
        slack = 1e-9 * (1 + np.abs(q_stats).max(initial=0) * np.abs(v_stats).max(initial=0)) * q_stats.shape[1]
        mask &= q_stats @ v_stats[alive].T + slack >= floor[:, None]
        some = mask.any(axis=0)
        alive, mask = alive[some], mask[:, some]
    return alive, mask


def _promising(queries: np.ndarray, candidates: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The same as `survivors` gives, for the n candidates of each query with the highest bounds."""
    mask = np.ones((len(queries), len(candidates)), dtype=bool)
    if n < len(candidates):
        mask[:] = False
        np.put_along_axis(mask, np.argpartition(-(queries @ candidates.T), n, axis=1)[:, :n], True, axis=1)
    alive = np.flatnonzero(mask.any(axis=0))
    return alive, mask[:, alive]


def _masked_products(queries: np.ndarray, candidates: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Exact products where `mask` holds, the least integer elsewhere; pair by pair where few pairs are left."""
    scores = np.full(mask.shape, _LOWEST)
    q, c = np.nonzero(mask)
    if len(q) * _DENSE > mask.size:
        return np.where(mask, exact_products(queries, candidates), scores)
    for at in range(0, len(q), _PAIRS):
        rows, columns = queries[q[at : at + _PAIRS]], candidates[c[at : at + _PAIRS]]
        top = _largest(rows) * _largest(columns) * max(1, rows.shape[1])
        kind = np.int64 if top < 2**62 else object
        scores[q[at : at + _PAIRS], c[at : at + _PAIRS]] = (rows.astype(kind) * columns.astype(kind)).sum(axis=1)
    return scores


def block_top_k(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, floors: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score) of each query's k best candidates of the block that reach its floor.

    `floors` (changed in place) holds the score that k other candidates are known to reach. Without floors each query first
    scores the candidates with the highest bounds, whose scores then prune the others.
    """
    widths = [n for n in LEVELS if n < vectors.shape[1]] or [1]
    of_candidates = [segment_statistics(vectors, n) for n in widths]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def score(rows: slice, alive: np.ndarray, mask: np.ndarray) -> None:
        mask = mask & (ids[alive][None, :] != query_ids[rows][:, None])
        if not mask.any():
            return
        scores = _masked_products(queries[rows], vectors[alive], mask)
        if len(alive) > k:
            kth = np.partition(scores, len(alive) - k, axis=1)[:, len(alive) - k]
            floors[rows] = np.maximum(floors[rows], np.where(kth > _LOWEST, kth.astype(np.float64), -np.inf))
        q, c = np.nonzero((scores >= floors[rows][:, None]) & (scores > _LOWEST))
        best = _best_k(q, ids[alive][c], scores[q, c], k)
        found.append((query_ids[rows][q[best]], ids[alive][c[best]], scores[q[best], c[best]]))

    for at in range(0, len(queries), TILE):
        rows = slice(at, min(at + TILE, len(queries)))
        of_queries = [segment_statistics(queries[rows], n) for n in widths]
        if not np.isfinite(floors[rows]).all():
            score(rows, *_promising(of_queries[-1], of_candidates[-1], FIRST * k))
        score(rows, *survivors(of_queries, of_candidates, floors[rows]))
    if not found:
        return (np.empty(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _best_k(group: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best rows of each group: highest scores, ties to the smaller id."""
    order = np.lexsort((ids, -scores, group))
    starts = np.flatnonzero(np.diff(group[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[place < k]


def _search(k: int, dtype: str):
    """Function over the sorted rows (q_no, part, is_candidate, ids, vectors): a block of queries, then its candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids = queries = floors = None
        for batch in batches:
            for is_candidate, packed_ids, packed in zip(*(batch.column(n) for n in ("is_candidate", "ids", "vectors"))):
                ids = np.frombuffer(packed_ids.as_py(), np.int64)
                vectors = np.frombuffer(packed.as_py(), dtype).reshape(len(ids), -1)
                if is_candidate.as_py():
                    columns = block_top_k(query_ids, queries, ids, vectors, k, floors)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], schema=_FOUND)
                else:
                    query_ids, queries, floors = ids, vectors, np.full(len(ids), -np.inf)

    return run


def _packed(size: int, width: int, dtype: str):
    """Rows (id, vector) of a partition as rows (ids, vectors), each a block of at most `size`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                vectors = np.zeros((part.num_rows, width), dtype=dtype)
                for row, v in enumerate(part.column(1)):
                    vectors[row, : len(v)] = v.values.to_numpy()
                ids = part.column(0).to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_pydict({"ids": [ids.tobytes()], "vectors": [vectors.tobytes()]})

    return run


def quantized(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(id, v array<bigint>): floor(scale * x) of each component; vectors that are null or hold null, infinite or
    undefined components are left out, as are rows without id. An empty vector has no components and stays."""
    x = F.col(vec_col).cast("array<double>")
    usable = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).filter(usable)
    return rows.select(F.col(id_col).cast("bigint").alias("id"), F.transform(x, lambda e: F.floor(e * scale)).alias("v"))


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 20, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query with all other ids.

    Both tables are (id, v array<bigint>), as `quantized` makes them; shorter vectors are taken as followed by
    zeros. Ties go to the smaller id; a query with fewer than k candidates gets all of them; equal rows count once.
    Empty tables give an empty result.

    Queries and candidates are packed in blocks, and every block of queries meets every part of PART_BLOCKS blocks
    of candidates in one group of rows. The k best scores of a group's earlier candidates prune its later ones, so memory
    is bounded by a block of each and a group adds little more than k rows per query to the last step.
    """
    both = vectors.select(F.lit(False).alias("q"), "id", "v").unionByName(queries.select(F.lit(True).alias("q"), "id", "v"))
    sizes = both.agg(
        F.count_if(~F.col("q")).alias("n"), F.count_if("q").alias("m"), F.max(F.size("v")).alias("width"),
        F.max(F.greatest(F.array_max("v"), -F.array_min("v") - 1)).alias("top"),
    ).first()
    dtype = next(t for t in ("int8", "int16", "int32", "int64") if (sizes["top"] or 0) <= np.iinfo(t).max)
    n_blocks, m_blocks = (max(1, -(-n // size)) for n, size in ((sizes["n"], candidate_block), (sizes["m"], query_block)))
    parts = -(-n_blocks // PART_BLOCKS)

    def packed(rows: DataFrame, blocks: int, size: int, name: str) -> DataFrame:
        dealt = rows.distinct().repartition(blocks)
        pack = _packed(size, sizes["width"] or 0, dtype)
        return staged(dealt.mapInArrow(pack, "ids binary, vectors binary"), name)[0]

    asked_blocks = packed(queries, m_blocks, query_block, "query-blocks").withColumn("key", F.xxhash64("ids", "vectors"))
    # numbers go to the keys alone: one task sees a number per block, not the blocks
    numbers = asked_blocks.select("key").distinct().withColumn("q_no", F.row_number().over(Window.orderBy("key")))
    numbered = asked_blocks.join(numbers, "key")
    candidates = packed(vectors, n_blocks, candidate_block, "candidate-blocks")
    last = max(1, asked_blocks.count())
    asked = numbered.select(
        "q_no", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(False).alias("is_candidate"), "ids", "vectors"
    )
    tried = candidates.select(
        F.explode(F.sequence(F.lit(1), F.lit(last))).alias("q_no"),
        F.pmod(F.xxhash64("ids", "vectors"), F.lit(parts)).cast("int").alias("part"), F.lit(True).alias("is_candidate"), "ids", "vectors",
    )
    groups = asked.unionByName(tried).repartition("q_no", "part").sortWithinPartitions("q_no", "part", "is_candidate")
    found = groups.mapInArrow(_search(k, dtype), "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
