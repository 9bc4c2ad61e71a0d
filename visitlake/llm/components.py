"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.sources.files import delete, staged


def connected_components(links: DataFrame, label: str = "links") -> DataFrame:
    """(node, root) for every node of `links` (a, b: bigint); nodes of one component share their root.

    Each round gives every node the neighbour that comes first in a hashed order (or itself), replaces the ends
    of all links by what they were given and drops links that became loops. The hashed order makes the
    number of nodes shrink by a constant factor per round whatever the shape of the graph, and nodes only meet
    their links by joins and aggregations that combine before the shuffle: no list of neighbours is ever built,
    so a node may have any number of links. Each round's results are written to the shared scratch folder, which
    cuts the lineage. An empty table has no components.
    """
    edges = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges, path = staged(edges, label)
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                                 F.struct(F.col("b").alias("node"), F.col("a").alias("other"))))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(steps))).alias("h"), F.col(c).alias("n"))
        both = edges.select(ends.alias("e")).select("e.*")
        best = both.groupBy("node").agg(F.min(rank("other")).alias("best"))
        step, _ = staged(best.select("node", F.least(rank("node"), F.col("best"))["n"].alias("root")), label)
        steps.append(step)
        left = edges.join(step.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
        joined = left.join(step.select(F.col("node").alias("b"), F.col("root").alias("y")), "b").filter("x <> y")
        shrunk = joined.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        former = path
        edges, path = staged(shrunk, label)
        delete(links.sparkSession, former)
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps[0]
    for step in steps[1:]:
        later = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found
