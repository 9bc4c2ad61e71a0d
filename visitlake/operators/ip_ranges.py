"""IP ranges: search, listing and the lookup of the range that holds an address.

Ranges do not overlap, so every address lies in at most one. A range is filed under the longest whole-byte
prefix its two ends share (0 to 3 bytes). Under one 3-byte prefix there are at most 256 ranges, and under a
shorter one at most 255, because each such range crosses a border between two values of the next byte. An
address therefore has four buckets to look in, each of bounded size, and the lookup is a set of equi-joins.

Tables whose ranges overlap are refused, unless the caller says what an address in several ranges means: a row for EVERY
one, or the range that begins LAST. Those are filed under every 3-byte prefix they touch and met by one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from visitlake.functions.ip import address_text, ip_to_long, long_to_ip
from visitlake.operators.lookups import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_room, row_bytes
from visitlake.schema import UNKNOWN_AREA, UNKNOWN_COUNTRY

# Shared prefix lengths in bits. All ranges filed under the wide ones together number at most 257 * 255.
NARROW_BITS = (24, 16)
WIDE_BITS = (8, 0)

# What becomes of an address in several ranges: an error, a row for each of them, or the one that begins last (of
# those, the one that ends first).
REFUSE, EVERY, LAST = "refuse", "every", "last"


def find_ip_ranges(ranges: DataFrame, text: str) -> DataFrame:
    """Ranges whose country or area contains `text`, with their ends in dotted form."""
    hit = F.col("country").contains(text) | F.col("area").contains(text)
    return ranges.filter(hit).select(
        long_to_ip(F.col("begin_ip")).alias("begin_ip"), long_to_ip(F.col("end_ip")).alias("end_ip"),
        "country", "area",
    )


def list_range_ends(ranges: DataFrame) -> DataFrame:
    return ranges.select(long_to_ip(F.col("end_ip")).alias("end_ip"))


def _by_octet(ranges: DataFrame) -> DataFrame:
    """(begin_ip, end_ip, _octet, _bytes, _overlaps) of each range under each first octet it touches.

    `_overlaps` tells whether a range that begins no later has not ended. No task has to sort all ranges.
    """
    octet = F.explode(F.sequence(F.shiftright("begin_ip", 24), F.shiftright("end_ip", 24)))
    earlier = Window.partitionBy("_octet").orderBy("begin_ip", "end_ip").rowsBetween(Window.unboundedPreceding, -1)
    seen = ranges.select("begin_ip", "end_ip", row_bytes(*ranges.columns).alias("_bytes"), octet.alias("_octet"))
    last = F.max("end_ip").over(earlier)
    return seen.withColumn("_overlaps", F.coalesce(last >= F.col("begin_ip"), F.lit(False)))


def find_overlaps(ranges: DataFrame) -> DataFrame:
    """Ranges that begin before another one, which begins no later, has ended. There should be none."""
    return _by_octet(ranges).filter("_overlaps").select("begin_ip", "end_ip").distinct()


def _measured(ranges: DataFrame, overlaps: str = REFUSE) -> Row:
    """Rows `n` and bytes `b` of `ranges`, the same filed under all prefixes (`filed_n`, `filed_b`), and whether any `overlaps`.

    One distributed pass. Overlaps are an error unless the caller knows what they mean.
    """
    if overlaps not in (REFUSE, EVERY, LAST):
        raise ValueError(f"overlaps is one of {REFUSE}, {EVERY} and {LAST}, not {overlaps}")
    once = F.col("_octet") == F.shiftright("begin_ip", 24)
    filed = F.shiftright("end_ip", 8) - F.shiftright("begin_ip", 8) + 1
    total = lambda c: F.coalesce(F.sum(F.when(once, c)), F.lit(0))
    counted = _by_octet(ranges).agg(
        F.count_if(once).alias("n"), total(F.col("_bytes")).alias("b"), total(filed).alias("filed_n"),
        total(filed * F.col("_bytes")).alias("filed_b"), (F.count_if("_overlaps") > 0).alias("overlaps"),
    ).first()
    if counted["overlaps"] and overlaps == REFUSE:
        raise ValueError(f"overlapping IP ranges, such as {find_overlaps(ranges).take(3)}")
    return counted


def fits_broadcast(ranges: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the rows and bytes of `ranges` stay within the bounds; overlapping ranges are an error. One distributed pass."""
    counted = _measured(ranges)
    return counted["n"] <= max_rows and counted["b"] <= min(max_bytes, broadcast_room(ranges.sparkSession))


def _prefix(ip: Column, bits: int) -> Column:
    return F.shiftright(ip, 32 - bits)


def _file_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges with the prefix length `_bits` and prefix `_bucket` they are filed under."""
    begin, end = F.col("begin_ip"), F.col("end_ip")
    bits = F.lit(0)
    for b in (8, 16, 24):
        bits = F.when(_prefix(begin, b) == _prefix(end, b), b).otherwise(bits)
    return ranges.withColumn("_bits", bits).withColumn("_bucket", F.expr("shiftright(begin_ip, 32 - _bits)"))


def join_ip_range(
    df: DataFrame,
    ranges: DataFrame,
    ip_col: str,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    overlaps: str = REFUSE,
) -> DataFrame:
    """Left join of `df` to the range (`begin_ip` to `end_ip`) that holds the numeric address `ip_col`.

    Adds the other columns of `ranges`; they must not be null, so that null means no range. Overlapping ranges are an
    error, so no row of `df` is doubled, unless `overlaps` is EVERY (a row for each range that holds the address) or LAST
    (the range that begins last, of those the one that ends first). Ranges that pass a size check, also against the driver's
    memory, are broadcast and the rows of `df` never move. Otherwise they meet by one shuffled join; either way `df` is read once.
    """
    values = [c for c in ranges.columns if c not in ("begin_ip", "end_ip")]
    counted = _measured(ranges, overlaps)
    max_bytes = min(max_bytes, broadcast_room(ranges.sparkSession))
    if counted["overlaps"]:
        small = counted["filed_n"] <= max_rows and counted["filed_b"] <= max_bytes
        return _by_prefix_lookup(df, ranges, ip_col, values, small, overlaps)
    if counted["n"] <= max_rows and counted["b"] <= max_bytes:
        return _probe(df, _file_ranges(ranges), ip_col, values, (*NARROW_BITS, *WIDE_BITS))
    return _by_prefix_lookup(df, ranges, ip_col, values)


def _probe(df: DataFrame, filed: DataFrame, ip_col: str, values: list[str], levels: tuple[int, ...]) -> DataFrame:
    """One broadcast join per prefix length; at most one of them finds a range.

    Rows travel through the joins as one column, and so do a range's values, which keeps the generated code
    of the whole chain small enough to be compiled to machine code.
    """
    ip = F.col("_ip")
    out = df.select(F.struct(*df.columns).alias("_row"), F.col(ip_col).alias("_ip"), F.lit(None).alias("_found"))
    for bits in levels:
        level = filed.filter(F.col("_bits") == bits).select(
            F.col("_bucket").alias("_key"), "begin_ip", "end_ip", F.struct(*values).alias("_value")
        )
        inside = (_prefix(ip, bits) == F.col("_key")) & ip.between(F.col("begin_ip"), F.col("end_ip"))
        out = out.join(F.broadcast(level), inside, "left").select(
            "_row", "_ip", F.coalesce("_found", "_value").alias("_found")
        )
    return out.select("_row.*", *[F.col("_found")[v].alias(v) for v in values])


def _by_prefix(ranges: DataFrame) -> DataFrame:
    """Ranges filed under every 3-byte prefix they touch.

    Where ranges do not overlap, a prefix has at most 256 of them and a table at most 2^24 rows more than it has ranges; every
    overlapping one may add as many as it is wide. Wide ranges are cut by 2-byte prefixes first, so no row makes more than 65536.
    """
    blocks = F.explode(F.sequence(F.shiftright("begin_ip", 16), F.shiftright("end_ip", 16))).alias("_block")
    first, last = F.shiftright("begin_ip", 8), F.shiftright("end_ip", 8)
    inside = F.sequence(F.greatest(first, F.col("_block") * 256), F.least(last, F.col("_block") * 256 + 255))
    return ranges.select("*", blocks).select("*", F.explode(inside).alias("_prefix")).drop("_block")


def _best_first(filed: DataFrame) -> DataFrame:
    """(_prefix, _held): the ranges that can be the LAST one of an address below a prefix, that one before others.

    Of ranges that hold the same addresses below a prefix only one can be, which is found before anything is listed; what
    is left is bounded by the pairs of 256 addresses.
    """
    first = F.col("_prefix") * 256
    order = F.struct(F.col("begin_ip"), -F.col("end_ip"), F.to_json("_value"))
    best = filed.withColumn("_order", order).groupBy(
        "_prefix", F.greatest("begin_ip", first).alias("_from"), F.least("end_ip", first + 255).alias("_to")
    ).agg(F.max("_order").alias("_order"), F.max_by("_value", "_order").alias("_value"))
    listed = F.collect_list(F.struct("_order", "_from", "_to", "_value"))
    larger_first = lambda x, y: F.when(x["_order"] > y["_order"], -1).when(x["_order"] < y["_order"], 1).otherwise(0)
    held = F.transform(F.array_sort("_held", larger_first), lambda r: F.struct(*[r[c].alias(c) for c in ("_from", "_to", "_value")]))
    return best.groupBy("_prefix").agg(listed.alias("_held")).withColumn("_held", held)


def _by_prefix_lookup(
    df: DataFrame, ranges: DataFrame, ip_col: str, values: list[str], small: bool = False, overlaps: str = REFUSE
) -> DataFrame:
    """One left join on the 3-byte prefix of the address; rows of a hot prefix are split by adaptive execution.

    Rows without an address are spread by a hash of the row, as they would meet in one task otherwise. `small` tables are
    broadcast, others never: Spark, which does not know how many prefixes a range touches, would take many for small ones.
    Overlapping ranges bring a row each, or with LAST are listed by prefix, so that rows are not doubled.
    """
    ip = F.col("_ip")
    nowhere = -1 - F.pmod(F.xxhash64(F.to_json(F.struct(*df.columns))), F.lit(1 << 20))
    keyed = df.select(
        F.struct(*df.columns).alias("_row"), F.col(ip_col).alias("_ip"),
        F.coalesce(F.shiftright(F.col(ip_col), 8), nowhere).alias("_key"),
    )
    filed = _by_prefix(ranges).select("_prefix", "begin_ip", "end_ip", F.struct(*values).alias("_value"))
    same = F.col("_key") == F.col("_prefix")
    dealt = F.broadcast if small else lambda side: side.hint("merge")
    if overlaps == LAST:
        holding = F.filter("_held", lambda r: ip.between(r["_from"], r["_to"]))
        if not small:
            # lists are dealt out anew, by another number: a hot prefix is split only where both sides come straight from a shuffle
            same = F.col("_key") + 1 == F.col("_prefix") + 1
        located = keyed.join(dealt(_best_first(filed)), same, "left").withColumn("_value", F.get(holding, F.lit(0))["_value"])
    else:
        located = keyed.join(dealt(filed), same & ip.between(F.col("begin_ip"), F.col("end_ip")), "left")
    return located.select("_row.*", *[F.col("_value")[v].alias(v) for v in values])


def with_ip_address(df: DataFrame, ranges: DataFrame, ip_col: str = "ip", **join_options) -> DataFrame:
    """Adds `ip_country`, `ip_area` and `ip_address` (both in one line) of a dotted address."""
    texts = [F.coalesce(c, F.lit("")).alias(f"ip_{c}") for c in ("country", "area")]
    numbered = df.withColumn("_ip_number", ip_to_long(F.col(ip_col)))
    located = join_ip_range(numbered, ranges.select("begin_ip", "end_ip", *texts), "_ip_number", **join_options)
    return located.withColumns({
        "ip_country": F.coalesce("ip_country", F.lit(UNKNOWN_COUNTRY)),
        "ip_area": F.coalesce("ip_area", F.lit(UNKNOWN_AREA)),
    }).withColumn("ip_address", address_text(F.col("ip_country"), F.col("ip_area"))).drop("_ip_number")
