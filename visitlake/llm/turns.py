"""Turns of conversations in order, without a task per conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.sources.files import staged

# Characters of role and text that tell the partitions of a sort apart; equal ones stay together.
_SORT_CHARS = 32


def crc32_of(text: Column) -> Column:
    """Unsigned CRC-32 of a text's UTF-8 bytes."""
    return F.crc32(text.cast("binary"))


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 (hex) that tells any two pairs of role and text apart."""
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)


def number_turns(turns: DataFrame, by: list[str], keep: list[str]) -> DataFrame:
    """Adds `pos`, each row's place from 0 on among the rows of equal `by`, in order of turn (null first), role and text.

    `by` are columns without nulls; of the others only `keep` stay. Rows are sorted by range, so that a conversation may
    lie in many partitions, and each partition's share of a conversation is counted from where the one before ends: the
    longest conversation is no task's load. Only rows equal in all their sort keys stay together. The sorted rows are
    stored.
    """
    ranges = [*by, "turn", F.left("role", F.lit(_SORT_CHARS)), F.left("text", F.lit(_SORT_CHARS))]
    order = [*by, F.col("turn").asc_nulls_first(), "role", "text"]
    ordered = turns.repartitionByRange(*ranges).sortWithinPartitions(*order)
    kept = ordered.select(*by, *keep, F.monotonically_increasing_id().alias("_at"))
    stored, _ = staged(kept, "ordered-turns")
    rows = stored.withColumn("_part", F.shiftright("_at", 33))
    parts = rows.groupBy(*by, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*by, "_part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    numbered = rows.join(starts, [*by, "_part"]).withColumn("pos", F.col("_at") + F.col("_shift"))
    return numbered.drop("_at", "_part", "_shift")
