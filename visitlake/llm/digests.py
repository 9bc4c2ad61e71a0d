"""Digests over many rows of a key, taken piece by piece."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def ordered_sha256(rows: DataFrame, keys: list[str], order: str, piece: str, separator: str) -> DataFrame:
    """(keys..., sha256): lowercase hex of the UTF-8 pieces of each key in order, joined by the separator.

    Rows of a key are sorted on disk and pass one by one, so a key may have any number of them. Null pieces count as empty.
    """
    between = separator.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def finished(done: list) -> pa.RecordBatch:
            columns = {k: pa.array([key[n] for key, _ in done], types[n]) for n, k in enumerate(keys)}
            return pa.RecordBatch.from_pydict({**columns, "sha256": pa.array([d for _, d in done], pa.string())})

        types = []
        for batch in batches:
            types, done = [batch.schema.types[n] for n in range(len(keys))], []
            for *key, text in zip(*(batch.column(n).to_pylist() for n in range(len(keys) + 1))):
                if key == current:
                    state.update(between)
                else:
                    if state:
                        done.append((current, state.hexdigest()))
                    current, state = key, hashlib.sha256()
                state.update((text or "").encode())
            yield finished(done)
        if state:
            yield finished([(current, state.hexdigest())])

    schema = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    dealt = rows.select(*keys, order, piece).repartition(*keys).sortWithinPartitions(*keys, order)
    return dealt.select(*keys, piece).mapInArrow(run, f"{schema}, sha256 string")
