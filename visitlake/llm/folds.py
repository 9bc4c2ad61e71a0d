"""Which rows a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id's text modulo `folds`; a null id counts as empty text."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % folds).cast("int")


def fraction(*columns: str) -> Column:
    """A number in [0, 1) that follows from the columns' values alone."""
    return F.expr(f"cast(pmod(xxhash64({', '.join(columns)}), 1073741824) as double) / 1073741824")
