"""Connected components and what is read off them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import drop, save


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of edges (a, b); label is the smallest node reachable.

    In a round each node that has a smaller neighbour hangs on the smallest; pointers are doubled until all
    hang on a node without one. Then edges are drawn between those alone, so that at most half of
    the nodes that have edges stay in the next round, and most often few. Tables are written to the shared
    folder after each step, so that plans stay short and a lost executor costs one step. The driver
    gets one row a step.
    """
    pairs = save(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "cc-edges")
    labels = None
    while True:
        up = save(pairs.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"), F.lit(True).alias("moved")), "cc-pointers")
        while up.where("moved").limit(1).count():
            over = up.select(F.col("node").alias("_over"), F.col("label").alias("_label"))
            jumped = up.join(over, F.col("label") == F.col("_over"), "left").select("node", F.coalesce("_label", "label").alias("label"), F.col("_label").isNotNull().alias("moved"))
            up = replaced(up, save(jumped, "cc-pointers"))
        step = up.select(F.col("node").alias("_from"), F.col("label").alias("_to"))
        if labels is None:
            labels = save(up.select("node", "label"), "cc-labels")
        else:
            moved = labels.join(step, F.col("label") == F.col("_from"), "left").select("node", F.coalesce("_to", "label").alias("label"))
            labels = replaced(labels, save(moved.unionByName(up.select("node", "label")), "cc-labels"))
        one = pairs.join(step, F.col("a") == F.col("_from"), "left").select(F.coalesce("_to", "a").alias("a"), "b")
        two = one.join(step, F.col("b") == F.col("_from"), "left").select("a", F.coalesce("_to", "b").alias("b"))
        pairs = replaced(pairs, save(two.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges"))
        drop(up)
        if not pairs.limit(1).count():
            drop(pairs)
            return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())


def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    drop(old)
    return new


def grouped(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """nodes with group_id: the component's label, or the node itself."""
    labels = connected_components(edges).select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    return nodes.join(labels, nodes[node] == labels["_node"], "left").withColumn("group_id", F.coalesce("_label", F.col(node))).drop("_node", "_label")


def size_buckets(groups: DataFrame) -> DataFrame:
    """bucket, groups: how many groups (group_id) have how many members."""
    sizes = groups.groupBy("group_id").agg(F.count("*").alias("n"))
    bucket = F.when(F.col("n") == 1, "1").when(F.col("n") <= 5, "2-5").when(F.col("n") <= 50, "6-50").when(F.col("n") <= 500, "51-500").otherwise(">500")
    return sizes.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("groups"))


def largest_groups(groups: DataFrame, n: int = 10) -> DataFrame:
    return groups.groupBy("group_id").agg(F.count("*").alias("members")).orderBy(F.desc("members"), "group_id").limit(n)


def dominant(groups: DataFrame, value: str = "profile", position: str = "position") -> DataFrame:
    """group_id, the value most members have, members; of equal ones the value seen first."""
    counts = groups.groupBy("group_id", value).agg(F.count("*").alias("n"), F.min(position).alias("first"))
    best = F.max_by(value, F.struct("n", -F.col("first")))
    return counts.groupBy("group_id").agg(best.alias(value), F.sum("n").alias("members"))
