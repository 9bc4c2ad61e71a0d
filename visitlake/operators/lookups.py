"""Bounds within which a lookup table may be broadcast."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# A table is broadcast only when a count shows it stays below both bounds, and below its share of the driver's memory.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 * 1024 * 1024
# The driver holds a broadcast as collected rows, as a hash table that doubles as it grows, and as blocks, and may still have
# the one of the batch before. Each is up to twice as large as the text that is counted.
HEAP_SHARE = 16


def broadcast_room(spark: SparkSession) -> int:
    """Bytes, as `row_bytes` counts them, that the driver's heap takes as one broadcast."""
    return spark._jvm.java.lang.Runtime.getRuntime().maxMemory() // HEAP_SHARE


def row_bytes(*columns: str) -> Column:
    """About the size of a row in memory: that of its JSON text, which holds maps, arrays and structs too."""
    return F.octet_length(F.to_json(F.struct(*columns)))
