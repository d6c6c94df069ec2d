"""Connected components of links, as rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)``; root is the smallest node it is linked with.

    Each round takes the smallest root among a node's neighbours, then the root of that root, so that
    chains shorten by more than half. Minima are combined before they are shuffled, joins are against
    one row per node, so that a node with very many links is not gathered in one task. Nodes may be of
    any type that sorts. No links give no rows; repeated links and links to itself change nothing.
    """
    # each row gives both directions, so that links computed anew in another order can't come apart
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(links.where("a <> b").select(F.inline(ways)).distinct(), "links")
    roots = both.groupBy("a").agg(F.min("b").alias("low"))
    roots = written(roots.select(F.col("a").alias("node"), F.least("a", "low").alias("root")), "roots")
    while True:
        near = both.join(roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("root").alias("near"))
        lower = roots.join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        of_root = roots.select(F.col("node").alias("low"), F.col("root").alias("next"))
        moved = written(
            lower.join(of_root, "low").select("node", F.least("low", "next").alias("root"), F.col("root").alias("was")),
            "roots",
        )
        roots = moved.select("node", "root")
        if moved.where("root <> was").isEmpty():
            return roots
