"""Connected components of a graph that is a table of edges.

Alternating large-star and small-star steps: each step joins the edges with the least neighbour of
each node, so nothing of the graph leaves the executors, and every component is a star around its
least node after about log(size) rounds. A node with very many edges is one key of the join's large
side alone, which adaptive execution splits; its minimum is aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.shared import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b) with a > b. large: link larger neighbours to the least one; else the smaller ones."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = both.join(least, "u")
    if large:
        out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return out.where(F.col("a") > F.col("b")).distinct()


def components(edges: DataFrame, path: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of edges (a bigint, b bigint): root is the least node of its component.

    Loops and repeated or reversed edges are allowed; rows with a null are dropped. Tables of each
    round are written below path. No edges: no rows.
    """
    now = saved(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        f"{path}/0",
    )
    mark = None
    for k in range(1, max_rounds + 1):
        now = saved(_star(_star(now, True), False), f"{path}/{k}")
        seen = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
