"""Mixing sources by temperature: how often each document is used, and where.

A source's weight is its share of all tokens to the power of an exponent between 0 and 1. The exponent is bisected: as large as
possible while the weights' entropy reaches a target, but not so small that a source is repeated more than a limit allows.
Weights times a token budget are the sources' quotas. A source's documents stand in a hashed permutation; whole
rounds of it, then a part, fill the quota. Progress through its quota gives each use a block, so every block
holds the sources in proportion, and inside a block all uses are permuted once more.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.sources.files import staged

_SPACE = r"[\x20\x09-\x0D]"
_GRID = 32  # exponents tried at once
_ROUNDS = 5  # each narrows the exponent to one of _GRID steps
_BUCKET_TOKENS = 1_000_000  # tokens of a source that one window sorts, on average


@dataclass(frozen=True)
class MixOptions:
    """`budget` is in multiples of all tokens, `entropy` in shares of the largest possible, `max_repeats` in rounds."""

    budget: float = 1.0
    entropy: float = 0.999
    max_repeats: float = 4.0
    block_tokens: int = 100_000
    seed: str = "mix"


def count_tokens(text: Column) -> Column:
    """Number of words between ASCII white space; none in a null text.

    Counts the runs of white space, by taking the last character of each away, which makes no string per word.
    """
    runs = F.length(text) - F.length(F.regexp_replace(text, rf"{_SPACE}(?!{_SPACE})", ""))
    outer = text.rlike(f"^{_SPACE}").cast("int") + text.rlike(rf"{_SPACE}\z").cast("int")
    return F.when(F.length(text) > 0, runs + 1 - outer).otherwise(0).cast("bigint")


def _place(seed: str, *columns: str) -> Column:
    """A 60-bit number that stands for a hashed order; md5, so that any SQL engine can follow it."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def solve_exponent(sources: DataFrame, options: MixOptions) -> float:
    """The exponent for `sources` (source, tokens > 0), rounded to six places; 1 without sources.

    Entropy and repeats of all sources are sums and minima, so each round is one aggregate for a grid of exponents.
    """
    sizes = sources.agg(F.sum("tokens").alias("all"), F.min("tokens").alias("least"), F.count("*").alias("n")).first()
    if not sizes["n"] or sizes["n"] == 1:
        return 1.0
    logs = sources.select(F.ln(F.col("tokens") / sizes["all"]).alias("l"))
    least = math.log(sizes["least"] / sizes["all"])

    def search(reached) -> float:
        """Largest exponent of [0, 1] for which `reached` holds, given that it holds below and not above some point."""
        low, high = 0.0, 1.0
        for _ in range(_ROUNDS):
            grid = [low + (high - low) * k / _GRID for k in range(_GRID + 1)]
            sums = logs.agg(*[x for e in grid for x in (F.sum(F.exp(e * F.col("l"))), F.sum(F.exp(e * F.col("l")) * F.col("l")))]).first()
            holds = [reached(e, sums[2 * k], sums[2 * k + 1]) for k, e in enumerate(grid)]
            if all(holds):
                return grid[-1]
            first = holds.index(False)
            low, high = grid[max(0, first - 1)], grid[first]
        return low

    # entropy of p^e / Z is ln Z - e * sum(p^e ln p) / Z; the smallest source is repeated most
    wanted = options.entropy * math.log(sizes["n"])
    for_entropy = search(lambda e, z, s: math.log(z) - e * s / z >= wanted)
    too_often = search(lambda e, z, s: options.budget * math.exp((e - 1) * least) / z > options.max_repeats)
    return round(max(for_entropy, too_often), 6)


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", options: MixOptions = MixOptions()
) -> DataFrame:
    """(block, position, id, source, copy, n_tokens): every use of a document in the mixture.

    Documents without words (null, empty, blank) have no tokens and no use; a null source is a source. A row that is repeated
    is used as often as each of its copies. Copies count from 0; ties in the hashed order go by id. An
    empty table gives an empty mixture. The order hashes the text too, so rows without id spread over their source's buckets.

    A source is sorted in buckets of its hashed order of about _BUCKET_TOKENS tokens, whose totals give every
    bucket its start, so no task sorts a whole source; blocks hold about `block_tokens` tokens.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), count_tokens(F.col(text_col)).alias("n_tokens"),
        _place(options.seed, source_col, id_col, text_col).alias("place"),
    ).filter("n_tokens > 0")
    stored, _ = staged(rows, "mix-documents")
    totals, _ = staged(stored.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "mix-sources")
    exponent = solve_exponent(totals, options)
    sums = totals.agg(F.coalesce(F.sum("tokens"), F.lit(1)).alias("t")).first()["t"]
    raised = F.pow(F.col("tokens") / sums, F.lit(exponent))
    whole = totals.agg(F.sum(raised).alias("z")).first()["z"] or 1.0
    budget = int(sums * options.budget)
    blocks = max(1, -(-budget // options.block_tokens))
    quota = F.round(raised / whole * budget).cast("bigint")
    plan = totals.select(F.col("source").alias("of"), "tokens", quota.alias("quota"), F.ceil(F.col("tokens") / _BUCKET_TOKENS).alias("buckets"))

    planned = stored.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    bucketed = planned.withColumn("bucket", F.floor(F.col("place") / F.lit(float(1 << 60)) * F.col("buckets")))
    starts = bucketed.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("size")).select(
        F.col("source").alias("of"), F.col("bucket").alias("b"),
        (F.sum("size").over(Window.partitionBy("source").orderBy("bucket")) - F.col("size")).alias("start"),
    )
    inside = Window.partitionBy("source", "bucket").orderBy("place", "id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    sorted_ = bucketed.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    placed = sorted_.join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("b")))
    before = F.col("start") + F.col("inside")  # tokens of the source before this document
    # uses k = 0, 1, ... begin at token k * tokens + before of the source's quota
    copies = F.ceil((F.col("quota") - before) / F.col("tokens")).cast("int")
    uses = placed.withColumn("before", before).withColumn("copies", copies).filter("copies > 0").select(
        "id", "source", "n_tokens", "before", "tokens", "quota", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    )
    progress = (F.col("copy") * F.col("tokens") + F.col("before")) / F.col("quota")
    block = F.least(F.floor(progress * blocks), F.lit(blocks - 1)).cast("bigint")
    dealt = uses.select(block.alias("block"), "id", "source", "copy", "n_tokens").withColumn(
        "order", _place(options.seed, "block", "source", "id", "copy")
    )
    position = F.row_number().over(Window.partitionBy("block").orderBy("order", "id", "copy", "n_tokens"))
    return dealt.withColumn("position", position).select(
        "block", "position", F.col("id").alias(id_col), F.col("source").alias(source_col), "copy", "n_tokens"
    )
