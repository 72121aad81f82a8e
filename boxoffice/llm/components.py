"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.common import cut


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One round: each node ties its larger (or its smaller) neighbours to the smallest node it knows."""
    if large:  # every link seen from both ends
        seen = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:  # seen from the larger end only
        seen = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = seen.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    tied = seen.join(least, "a")
    if large:
        out = tied.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Pairs (a, b) of longs -> (node, root): every linked node with its component's smallest node.

    Nodes with a null end or linked to themselves only do not appear; no link
    gives an empty table. Each round is one written table; the number of rounds
    grows with the logarithm of the largest component.
    """
    links = cut(links.filter("a is not null and b is not null and a != b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        found = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if found[0] == 0 or found == state:
            break
        state = found
        links = cut(_star(_star(links, True), False))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
