"""Connected components by alternating large-star and small-star steps, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.llm.common import materialize


#: Graphs of up to so many edges need no split of hubs: a task holds all of their rows with ease.
SMALL = 100_000


def _pull(edges: DataFrame, total: int) -> DataFrame:
    """Each edge with ``m``, the least neighbour of its ``u``; in large graphs hubs (under a thousand) are broadcast."""
    if total <= SMALL:
        return edges.withColumn("m", F.min("v").over(Window.partitionBy("u")))
    limit = max(1000, total // 1000)
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    hubs = least.where(F.col("n") > limit).select("u", "m")
    hot = edges.join(F.broadcast(hubs), "u")
    cold = edges.join(F.broadcast(hubs.select("u")), "u", "left_anti").join(least.where(F.col("n") <= limit).select("u", "m"), "u")
    return hot.select("u", "v", "m").unionByName(cold.select("u", "v", "m"))


def connected_components(edges: DataFrame, left: str = "src", right: str = "dst", name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Columns ``node`` and ``component`` (the least node that can be reached) for every node that has an edge.

    Null ends, loops and repeated edges are ignored; no edges give an empty result. Every round writes its
    edges to the shared folder and compares two aggregates; nothing of the graph goes to the driver.
    """
    a, b = F.col(left), F.col(right)
    now = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now, before = materialize(now, name), None
    for _ in range(max_rounds):
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if not mark["n"] or (mark["n"], mark["h"]) == before:
            break
        before, total = (mark["n"], mark["h"]), 2 * mark["n"]
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pull(both, total).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        small = _pull(large if total <= SMALL else large.distinct(), total)
        now = materialize(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).distinct(), name)
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
