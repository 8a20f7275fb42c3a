"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import remove, store


def _least(edges: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Smallest neighbour of each node. Stored, so that the join with the edges reads two plain
    shuffles and adaptive execution can split the partition of a hub."""
    return store(edges.groupBy("u").agg(F.min("v").alias("m")), label)


def _checksum(df: DataFrame) -> tuple:
    """Order-free fingerprint of the edge table."""
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node reachable.

    Each round writes its edges and removes those of the round before. It ends when a round
    changes nothing; the rounds grow with the logarithm of the longest chain. Self links and
    repeated links are fine; an empty table gives an empty table.
    """
    spark = edges.sparkSession
    current, path = store(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links"
    )
    state = _checksum(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least, p1 = _least(both, "links-large")
        large, p2 = store(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(),
            "links-step",
        )
        least2, p3 = _least(large, "links-small")
        after, p4 = store(
            large.join(least2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .unionByName(least2.select("u", F.col("m").alias("v"))).distinct(),
            "links",
        )
        new = _checksum(after)
        remove(spark, path, p1, p2, p3)
        current, path = after, p4
        if new == state:
            break
        state = new
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
