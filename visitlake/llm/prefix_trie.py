"""Trie of conversation prefixes, its sums rolled up in depth bands.

A node is a distinct sequence of first turns; its key is the sum modulo two (bit by bit) of a hash of each turn and its
place, 120 bits wide, so keys of all prefixes are running sums, and a parent's key is its child's less the last turn's.

Sums over subtrees: a band holds BAND depths. Each node's values first go to the top of its band only; the
tops make a trie BAND times less deep, which is rolled up the same way. The finished totals of the tops are then handed
to the nodes right above them, and every node explodes to its ancestors inside its own band, itself included: at most
BAND rows a node, and as many rounds as the depth has digits to the base BAND.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.llm.turns import crc32_of, number_turns, turn_digest
from visitlake.sources.files import staged

BAND = 16
MOST_LENT = 8  # turns a conversation may take from another: the largest remainder modulo 9
GROUP = 5
_CHUNK = 1024  # turns of a conversation whose running sums one task makes
# Parents of at least this share of all nodes are broadcast, so there are at most 1 / HOT_SHARE.
HOT_SHARE = 1e-3
KEY = ["k1", "k2"]


def lent_turns(conv_id: str = "conv_id") -> Column:
    """How many first turns a conversation takes from the first of its group."""
    return F.pmod(crc32_of(F.col(conv_id).cast("string")), F.lit(MOST_LENT + 1))


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, d, digest, bytes) of rebuilt turns, d from 1 on, and (conv_id, length) of all conversations."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.filter("conv_id is not null").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumns({"digest": turn_digest(F.col("role"), F.col("text")), "bytes": F.octet_length("text")})
    placed, _ = staged(number_turns(rows, ["conv_id"], ["digest", "bytes"]), "numbered-turns")
    sizes = placed.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = sizes.withColumns({"h": lent_turns(), "base": F.col("conv_id") - F.col("conv_id") % GROUP})
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    convs = convs.join(bases, "base", "left").withColumn("lent", F.least("h", F.coalesce("there", F.lit(0))))
    convs, _ = staged(convs.select("conv_id", "n", "h", "base", "lent"), "rebuilt-sizes")
    # by chunks, so that no key is as frequent as a conversation is long
    chunk = F.floor(F.col("pos") / _CHUNK)
    shares = convs.select("conv_id", "h", "lent", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / _CHUNK))).alias("chunk"))
    own = placed.withColumn("chunk", chunk).join(shares, ["conv_id", "chunk"]).filter("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("lent") + 1).alias("d"), "digest", "bytes")
    first = placed.filter(F.col("pos") < MOST_LENT).select(F.col("conv_id").alias("base"), "pos", "digest", "bytes")
    taken = convs.select("conv_id", "base", "h").join(first, "base").filter("pos < h")
    steps = own.unionByName(taken.select("conv_id", (F.col("pos") + 1).alias("d"), "digest", "bytes"))
    return steps, convs.select("conv_id", (F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))


def _with_keys(steps: DataFrame) -> DataFrame:
    """Adds the keys of the prefixes that end with each step, and of their parents."""
    hashed = F.sha2(F.concat_ws(":", F.col("d"), F.col("digest")).cast("binary"), 256)
    word = lambda n: F.conv(F.substring(hashed, 1 + 15 * n, 15), 16, 10).cast("bigint")
    rows = steps.select("conv_id", "d", "bytes", word(0).alias("e1"), word(1).alias("e2"), F.floor((F.col("d") - 1) / _CHUNK).alias("chunk"))
    inside = Window.partitionBy("conv_id", "chunk").orderBy("d")
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv_id", "chunk").agg(F.bit_xor("e1").alias("c1"), F.bit_xor("e2").alias("c2"))
    before = sums.select("conv_id", "chunk", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(c) for c in ("c1", "c2")])
    running = rows.withColumns({f"x{n}": F.bit_xor(f"e{n}").over(inside) for n in (1, 2)}).join(before, ["conv_id", "chunk"])
    keys = {f"k{n}": F.col(f"x{n}").bitwiseXOR(F.col(f"c{n}")) for n in (1, 2)}
    parents = {f"p{n}": F.col(f"k{n}").bitwiseXOR(F.col(f"e{n}")) for n in (1, 2)}
    return running.withColumns(keys).withColumns(parents).select("conv_id", "d", "bytes", *KEY, "p1", "p2")


def subtree_sums(steps: DataFrame, nodes: DataFrame, values: list[str], depth: int, band: int = BAND) -> DataFrame:
    """(k1, k2, values...) summed over the subtree of every node.

    `steps` (conv_id, d, k1, k2) has the nodes on the path of every conversation, d from 0 to at most `depth` without gaps;
    `nodes` (conv_id, d, k1, k2, values...) has each node once, with any conversation through it.
    """
    of_band = F.floor(F.col("d") / band).alias("band")
    paths = steps.groupBy("conv_id", of_band).agg(F.collect_list(F.struct("d", *KEY)).alias("path"))
    placed = nodes.withColumn("band", of_band).join(paths, ["conv_id", "band"])
    above = F.expr("filter(path, x -> x.d <= d)")
    placed, _ = staged(placed.select("conv_id", "d", *KEY, *values, above.alias("above")), "trie-bands")
    if depth >= band:
        top = F.expr(f"filter(above, x -> x.d % {band} = 0)[0]")
        totals = placed.select(top.alias("top"), *values).groupBy("top.k1", "top.k2").agg(*[F.sum(v).alias(v) for v in values])
        tops = placed.filter(F.col("d") % band == 0).select("conv_id", F.col("d"), *KEY).join(totals, KEY)
        shallow = lambda rows: rows.filter(F.col("d") % band == 0).withColumn("d", F.floor(F.col("d") / band))
        finished = subtree_sums(shallow(steps), tops.withColumn("d", F.floor(F.col("d") / band)), values, depth // band, band)
        # the node right above a band's top, on any conversation through it
        borders = placed.filter((F.col("d") % band == 0) & (F.col("d") > 0)).select("conv_id", (F.col("d") - 1).alias("d"), *KEY)
        over = steps.select("conv_id", "d", F.col("k1").alias("p1"), F.col("k2").alias("p2"))
        handed = borders.join(over, ["conv_id", "d"]).join(finished, KEY)
        handed = handed.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(*[F.sum(v).alias(f"_{v}") for v in values])
        grown = {v: F.col(v) + F.coalesce(F.col(f"_{v}"), F.lit(0)) for v in values}
        placed = placed.join(handed, KEY, "left").withColumns(grown)
    spread = placed.select(F.explode("above").alias("node"), *values)
    return spread.groupBy("node.k1", "node.k2").agg(*[F.sum(v).alias(v) for v in values])


def prefix_trie(turns: DataFrame, band: int = BAND) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie over rebuilt conversations, and (k1, k2, conv_id): the node each conversation ends at.

    Nodes: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, and the key
    k1, k2. Turns are put in order of `turn` (null first), ties by role and text; repeated rows are turns of their own; null
    roles and texts are empty. Rows without conv_id belong to no conversation and take no part. A conversation that
    is left without turns ends at the root. An empty table has no node at all.

    No task holds a conversation, a node's members or its children: positions and running sums go by chunks, groups are
    combined before the shuffle, and parents with very many children are broadcast, at most 1 / HOT_SHARE of them.
    """
    rebuilt, lengths = rebuild(turns)
    keyed = _with_keys(rebuilt)
    roots = lengths.select("conv_id", F.lit(0).cast("bigint").alias("d"), F.lit(0).alias("bytes"), *[F.lit(0).cast("bigint").alias(c) for c in (*KEY, "p1", "p2")])
    steps, _ = staged(keyed.unionByName(roots), "trie-steps")
    grouped = steps.groupBy("d", *KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *[F.max(c).alias(c) for c in ("bytes", "p1", "p2")]
    )
    nodes, _ = staged(grouped, "trie-nodes")
    total, depth = nodes.agg(F.count("*"), F.coalesce(F.max("d"), F.lit(0))).first()
    children = nodes.filter("d > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    counted, _ = staged(counted.withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("bigint"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes"),
    }), "trie-counted")
    values = ["n_leaves", "saved_tokens"]
    sums = subtree_sums(steps.select("conv_id", "d", *KEY), counted.select("conv_id", "d", *KEY, *values), values, depth, band)

    hot = F.col("n_children") >= max(1, total * HOT_SHARE)
    parents = counted.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("d") + 1).alias("d"), F.col("conv_id").alias("parent"), "n_children")
    on = ["p1", "p2", "d"]
    few = F.broadcast(parents.filter(hot).select(*on, F.col("parent").alias("hot_parent")))
    many = parents.filter(~hot).select(*on, F.col("parent").alias("cold_parent"))
    named = counted.drop(*values).join(few, on, "left").join(many, on, "left").join(sums, KEY)
    ends = steps.select("conv_id", "d", *KEY).join(lengths.withColumnRenamed("length", "d"), ["conv_id", "d"]).select(*KEY, "conv_id")
    return named.select(
        "conv_id", F.col("d").alias("depth"), F.coalesce("hot_parent", "cold_parent").alias("parent_conv_id"),
        "n_convs", "n_children", *values, *KEY,
    ), ends
