"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baobab.llm.common import cut


def _sum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Columns node and root (the smallest node that it reaches) for every node
    that has a link.  ``links``: columns a and b, of one ordered type, not null.

    Each round points every neighbour that is larger than a node at the node's
    smallest neighbour, then every neighbour that is smaller; links only ever
    shrink to stars, and the number of rounds grows with the logarithm of the
    component size.  The smallest neighbour is a partial aggregate, written out,
    and the join back on the node is a plain one that Spark can split, so a node
    with very many links is no burden to one task.  Links are written to the
    checkpoint folder after every round; a count and a checksum come to the
    driver, and the last round is the one that leaves both as they were."""
    now = cut(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = _sum(now)
    while True:
        # large star: from every node to its larger neighbours
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = (
            both.where("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        # small star: from every node to its smaller neighbours and itself
        large = cut(large)
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")))
        joined = large.join(least, "a")
        small = (
            joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(joined.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        now = cut(small)
        before, state = state, _sum(now)
        if before == state:
            break
    # each node now has one link, to its root
    stars = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
