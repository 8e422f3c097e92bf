"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.store import Store


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, store: Store, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from every node that has an edge.

    ``edges`` holds two bigint columns ``a`` and ``b``; direction, repeats,
    nulls and self-loops do not matter.  Returns ``node, root`` for every node
    whose root is a smaller node; roots themselves and nodes without edges are
    absent.  Each round is two aggregations and joins over the edges; a round's
    minimum per node is combined before the shuffle, so a star with any number
    of leaves never meets in one task unaggregated.  The rounds are written to the
    shared folder and the previous one is deleted.
    """
    now = store.save(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    before = _signature(now)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        # large star: every neighbour above u moves to the smallest of u and its neighbours
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        # small star: u and its smaller neighbours move to the smallest of them
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = (
            large.join(small_least, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .unionByName(small_least.select("u", F.col("m").alias("v")))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        after = store.save(moved, "edges")
        sign = _signature(after)
        store.drop(now)
        now = after
        if sign == before:
            break
        before = sign
    else:
        raise RuntimeError("connected components did not converge")
    return now.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
