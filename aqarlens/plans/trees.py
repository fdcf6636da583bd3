"""Fitted Spark ML trees as node tables: export, evaluation by joins, importances.

A tree's nodes are numbered from 1 at the root; node ``i`` has the children
``2 i`` and ``2 i + 1``.  The table has at most ``trees * 2 ** (depth + 1)``
rows, whatever the training rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NODE_SCHEMA = "tree int, weight double, node long, feature int, threshold double, gain double, prediction double"


def _trees(model) -> tuple[list, list[float]]:
    """(JVM trees, weights) of a tree, forest or boosted model or of a pipeline that ends in one."""
    last = model.stages[-1] if hasattr(model, "stages") else model
    if not hasattr(last, "trees"):
        return [last._java_obj], [1.0]
    weights = list(last.treeWeights)
    mean = type(last).__name__.startswith("RandomForest")
    return [t._java_obj for t in last.trees], [w / sum(weights) for w in weights] if mean else weights


def node_table(spark: SparkSession, model) -> DataFrame:
    """``NODE_SCHEMA`` rows of all nodes; feature, threshold and gain are null at leaves.

    The model's prediction is the sum over trees of ``weight`` times the leaf's.
    """
    rows = []
    trees, weights = _trees(model)
    for number, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
        open_nodes = [(1, tree.rootNode())]
        while open_nodes:
            at, node = open_nodes.pop()
            if node.getClass().getSimpleName() == "LeafNode":
                rows.append((number, weight, at, None, None, None, float(node.prediction())))
                continue
            split = node.split()
            rows.append((number, weight, at, split.featureIndex(), float(split.threshold()), float(node.gain()), float(node.prediction())))
            open_nodes += [(2 * at, node.leftChild()), (2 * at + 1, node.rightChild())]
    return spark.createDataFrame(rows, NODE_SCHEMA)


def _depth(nodes: DataFrame) -> int:
    """Levels below the root."""
    return (nodes.agg(F.max(F.length(F.bin("node")))).first()[0] or 1) - 1


def predict_by_nodes(rows: DataFrame, nodes: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """``(key, prediction)`` of each row: a join with the node table per level, then the weighted sum over trees.

    ``key`` tells rows apart; rows that share one share their sum.  The node table's size is bounded by the model's parameters, so it is broadcast.
    """
    depth = _depth(nodes)
    trees = nodes.select("tree", "weight").distinct()
    values = F.array(*[F.col(name).cast("double") for name in features])
    walk = rows.select(F.col(key).alias("key"), values.alias("x")).crossJoin(F.broadcast(trees)).withColumn("at", F.lit(1).cast("long"))
    inner = nodes.where("feature is not null").select(F.col("tree").alias("t"), F.col("node"), "feature", "threshold")
    for _ in range(depth):
        walk = walk.join(F.broadcast(inner), (F.col("tree") == F.col("t")) & (F.col("at") == F.col("node")), "left")
        right = (F.element_at("x", F.col("feature") + 1) > F.col("threshold")).cast("long")
        walk = walk.select("key", "x", "tree", "weight", F.when(F.col("node").isNull(), F.col("at")).otherwise(2 * F.col("at") + right).alias("at"))
    leaves = nodes.where("feature is null").select(F.col("tree").alias("t"), F.col("node"), F.col("prediction").alias("leaf"))
    ended = walk.join(F.broadcast(leaves), (F.col("tree") == F.col("t")) & (F.col("at") == F.col("node")))
    return ended.groupBy(F.col("key").alias(key)).agg(F.sum(F.col("weight") * F.col("leaf")).alias("prediction"))


def node_rows(rows: DataFrame, nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(tree, node, n)``: how many rows pass each inner node."""
    values = F.array(*[F.col(name).cast("double") for name in features])
    inner = F.broadcast(nodes.where("feature is not null").select(F.col("tree"), F.col("node"), "feature", "threshold"))
    reached = None
    walk = rows.select(values.alias("x")).crossJoin(F.broadcast(nodes.select("tree").distinct())).withColumn("node", F.lit(1).cast("long"))
    for _ in range(max(1, _depth(nodes))):
        met = walk.join(inner, ["tree", "node"])
        counted = met.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"))
        reached = counted if reached is None else reached.unionByName(counted)
        right = (F.element_at("x", F.col("feature") + 1) > F.col("threshold")).cast("long")
        walk = met.select("x", "tree", (2 * F.col("node") + right).alias("node"))
    return reached


def gain_importance(rows: DataFrame, nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, score)``: gain times rows summed per feature and tree, scaled to one, then averaged over trees.

    The same as Spark ML's importances, from the node table and the training rows.
    """
    weighed = nodes.where("feature is not null").join(node_rows(rows, nodes, features), ["tree", "node"])
    per_tree = weighed.groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("g"))
    whole = per_tree.groupBy("tree").agg(F.sum("g").alias("all"))
    share = per_tree.join(whole, "tree").groupBy("feature").agg(F.sum(F.col("g") / F.col("all")).alias("share"))
    total = share.agg(F.sum("share").alias("total"))
    names = F.element_at(F.array(*[F.lit(name) for name in features]), F.col("feature") + 1)
    return share.crossJoin(F.broadcast(total)).select(names.alias("feature"), (F.col("share") / F.col("total")).alias("score"))
