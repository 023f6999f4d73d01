"""Closure over edges: canonical members of connected components and propagation of tags."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _folder(spark) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="folioframe-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/folioframe/graph-{uuid.uuid4().hex[:12]}"


def canonical(edges: DataFrame, src: str, dst: str, max_rounds: int = 60) -> DataFrame:
    """(node, canonical) with the least node that can be reached, edges read both ways.

    Each round takes the least label among neighbours and then the label of that label (pointer jumping). Rounds are
    written to the shared folder, so lineage stays short and a lost executor costs one round.
    """
    spark, path = edges.sparkSession, _folder(edges.sparkSession)
    both = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).union(edges.select(F.col(dst).alias("u"), F.col(src).alias("v"))).distinct()
    both.write.parquet(f"{path}/edges")
    both = spark.read.parquet(f"{path}/edges")
    labels = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label"))
    for k in range(max_rounds):
        labels.write.parquet(f"{path}/{k}")
        labels = spark.read.parquet(f"{path}/{k}")
        near = both.join(labels.select(F.col("u").alias("v"), F.col("label").alias("n")), "v").groupBy("u").agg(F.min("n").alias("n"))
        next_ = labels.join(near, "u").select("u", F.least("label", "n").alias("new"), "label")
        jump = labels.select(F.col("u").alias("new"), F.col("label").alias("far"))
        moved = next_.join(jump, "new").select("u", F.least("new", "far").alias("new"), "label")
        moved.write.parquet(f"{path}/{k}-moved")
        moved = spark.read.parquet(f"{path}/{k}-moved")
        if moved.where("new <> label").isEmpty():
            return labels.select(F.col("u").alias("node"), F.col("label").alias("canonical"))
        labels = moved.select("u", F.col("new").alias("label"))
    raise RuntimeError(f"labels did not settle in {max_rounds} rounds")


def propagate(tagged: DataFrame, edges: DataFrame, node: str, tag: str, src: str, dst: str) -> DataFrame:
    """Every (node, tag) that follows from tagged along edges src -> dst, cycles included.

    Only newly reached pairs are joined in the next round; rounds are written to the shared folder.
    """
    spark, path = tagged.sparkSession, _folder(tagged.sparkSession)
    steps = edges.select(F.col(src).alias(node), F.col(dst).alias("__to")).distinct()
    fresh, k = tagged.select(node, tag).distinct(), 0
    fresh.write.parquet(f"{path}/0")
    while True:
        known = spark.read.parquet(*(f"{path}/{i}" for i in range(k + 1)))
        front = spark.read.parquet(f"{path}/{k}")
        found = front.join(steps, node).select(F.col("__to").alias(node), tag).distinct().join(known, [node, tag], "left_anti")
        k += 1
        found.write.parquet(f"{path}/{k}")
        if spark.read.parquet(f"{path}/{k}").isEmpty():
            return known


def levels(edges: DataFrame, src: str, dst: str, max_rounds: int = 1000) -> DataFrame:
    """(node, level) in topological order: nodes without a predecessor have level 0, others one more than their last predecessor.

    A node on or behind a cycle has level null. Each round takes away the nodes with no predecessor left and is written to the shared folder.
    """
    spark, path = edges.sparkSession, _folder(edges.sparkSession)
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).distinct()
    nodes = e.select(F.col("u").alias("node")).union(e.select("v")).distinct()
    nodes.write.parquet(f"{path}/nodes")
    e.write.parquet(f"{path}/edges-0")
    nodes.limit(0).withColumn("level", F.lit(0)).write.parquet(f"{path}/done-start")
    done, left = [f"{path}/done-start"], spark.read.parquet(f"{path}/nodes")
    for k in range(max_rounds):
        e = spark.read.parquet(f"{path}/edges-{k}")
        free = left.join(e.select(F.col("v").alias("node")).distinct(), "node", "left_anti")
        free.withColumn("level", F.lit(k)).write.parquet(f"{path}/done-{k}")
        free = spark.read.parquet(f"{path}/done-{k}").select("node")
        if free.isEmpty():
            break
        done.append(f"{path}/done-{k}")
        left.join(free, "node", "left_anti").write.parquet(f"{path}/left-{k}")
        left = spark.read.parquet(f"{path}/left-{k}")
        e.join(free.withColumnRenamed("node", "u"), "u", "left_anti").write.parquet(f"{path}/edges-{k + 1}")
    else:
        raise RuntimeError(f"more than {max_rounds} levels")
    return spark.read.parquet(*done).select("node", "level").unionByName(left.select("node", F.lit(None).cast("int").alias("level")))


def cyclic(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Nodes from which a cycle's nodes cannot be taken away from either side: those on a cycle or on a path between two."""
    behind = levels(edges, src, dst).where("level is null").select("node")
    before = levels(edges, dst, src).where("level is null").select("node")
    return behind.join(before, "node", "left_semi")


def shortest_cycle(edges: DataFrame, src: str, dst: str, max_rounds: int = 1000) -> DataFrame:
    """(place, node) of a shortest cycle from its least node on, places from 0; no rows if there is no cycle.

    Breadth-first from all nodes on cycles at once. Each search goes through greater nodes alone, as a cycle is met from its
    least node; of equally short cycles that with the least such node is given. Rounds are written to the shared folder and
    hold each (start, node) once, so they sum to the square of the nodes that `cyclic` gives at most.
    """
    spark, path = edges.sparkSession, _folder(edges.sparkSession)
    core = cyclic(edges, src, dst)
    e = edges.select(F.col(src).alias("node"), F.col(dst).alias("to")).distinct()
    e.join(core, "node", "left_semi").join(core.withColumnRenamed("node", "to"), "to", "left_semi").select("node", "to").write.parquet(f"{path}/core")
    e = spark.read.parquet(f"{path}/core")
    kind = e.schema["node"].dataType.simpleString()
    found = e.where("to >= node").select(F.col("node").alias("start"), F.col("to").alias("node"), F.col("node").alias("parent"))
    for k in range(max_rounds):
        found.write.parquet(f"{path}/{k}")
        front = spark.read.parquet(f"{path}/{k}")
        start = front.where("start = node").agg(F.min("start")).first()[0]
        if start is not None:
            break
        if front.isEmpty():
            return spark.createDataFrame([], f"place int, node {kind}")
        known = spark.read.parquet(*(f"{path}/{i}" for i in range(k + 1))).select("start", "node")
        near = front.select("start", "node").join(e, "node").where("to >= start").select("start", F.col("to").alias("node"), F.col("node").alias("parent"))
        found = near.groupBy("start", "node").agg(F.min("parent").alias("parent")).join(known, ["start", "node"], "left_anti")
    else:
        raise RuntimeError(f"no cycle of {max_rounds} nodes or fewer")
    cycle, node = [], start
    for i in range(k, -1, -1):
        node = spark.read.parquet(f"{path}/{i}").where((F.col("start") == F.lit(start)) & (F.col("node") == F.lit(node))).first()["parent"]
        cycle.append(node)
    return spark.createDataFrame(list(enumerate(reversed(cycle))), f"place int, node {kind}")
