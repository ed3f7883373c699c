"""A fitted forest as a table, scored by joins.

``node_table`` turns the stored form of a Spark ML forest into one row per
node, which any engine can read.  ``score_by_nodes`` walks all trees level by
level: at every level the current node of each (feature vector, tree) pair is
joined to the table and replaced by the child that the split chooses.  Equal
feature vectors are walked once, so what is multiplied by the number of trees
is the distinct vectors, not the rows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.columns import require_columns
from zonecast.operators.demand import materialized
from zonecast.session import shared_path

NODE_SCHEMA = ("tree int, node int, feature string, threshold double, left_child int, right_child int, "
               "value double, weight double, n_rows bigint, depth int")


def _parts(model: PipelineModel) -> tuple[list[str], RandomForestRegressionModel]:
    forest, assembler = model.stages[-1], model.stages[0]
    if not isinstance(forest, RandomForestRegressionModel) or not isinstance(assembler, VectorAssembler):
        raise ValueError("a pipeline of a vector assembler and a forest is needed, as random_forest fits it")
    return assembler.getInputCols(), forest


def node_table(model: PipelineModel) -> DataFrame:
    """One row per node: ``tree, node, feature, threshold, left_child, right_child, value, weight, n_rows, depth``.

    Rows with ``feature <= threshold`` go to the left child.  A leaf has no
    feature and is its own child, so walking on from it stays there.
    ``value`` is the mean label of the node's (resampled) training rows,
    ``weight`` their resampled number, ``n_rows`` the plain one (of distinct
    rows, if the forest was fitted to those).  The table has at most ``trees * 2^(depth + 1)`` rows.
    """
    features, forest = _parts(model)
    spark = SparkSession.getActiveSession()
    path = shared_path(spark, "zonecast-forest")
    forest.write().overwrite().save(path)
    raw = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    leaf = F.col("leftChild") < 0
    name = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("split.featureIndex") + 1)
    nodes = raw.select(
        "tree", F.col("id").alias("node"), F.when(~leaf, name).alias("feature"),
        F.when(~leaf, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(leaf, F.col("id")).otherwise(F.col("leftChild")).alias("left_child"),
        F.when(leaf, F.col("id")).otherwise(F.col("rightChild")).alias("right_child"),
        F.col("prediction").alias("value"), F.get("impurityStats", F.lit(0)).alias("weight"), F.col("rawCount").alias("n_rows"))
    return _with_depth(nodes, forest.getMaxDepth())


def _with_depth(nodes: DataFrame, max_depth: int) -> DataFrame:
    """Levels from the root down, one join a level over the (bounded) table."""
    nodes = materialized(nodes, "parquet")
    kids = nodes.where("left_child <> node").select("tree", F.col("node").alias("parent"), F.explode(F.array("left_child", "right_child")).alias("node"))
    level = nodes.where("node = 0").select("tree", "node", F.lit(0).alias("depth"))
    levels = level
    for d in range(1, max_depth + 1):
        level = kids.join(level.select("tree", F.col("node").alias("parent")), ["tree", "parent"]).select("tree", "node", F.lit(d).alias("depth"))
        levels = levels.unionByName(level)
    return materialized(nodes.join(levels, ["tree", "node"]), "parquet")


def check_nodes(nodes: DataFrame) -> DataFrame:
    """Per tree: ``tree, n_nodes, n_leaves, depth, lost_rows, wrong_means``.

    ``lost_rows`` counts inner nodes whose children do not add up to their
    training rows, ``wrong_means`` those whose value is not the weighted mean
    of their children's: both are 0 in a sound table.
    """
    def child(side):
        return nodes.select("tree", F.col("node").alias(f"{side}_child"), F.col("value").alias(f"{side}_value"),
                            F.col("weight").alias(f"{side}_weight"), F.col("n_rows").alias(f"{side}_rows"))
    inner = nodes.where("left_child <> node").join(child("left"), ["tree", "left_child"]).join(child("right"), ["tree", "right_child"])
    mean = (F.col("left_value") * F.col("left_weight") + F.col("right_value") * F.col("right_weight")) / F.col("weight")
    off = F.abs(mean - F.col("value")) > F.lit(1e-9) * F.greatest(F.lit(1.0), F.abs("value"))
    wrong = inner.groupBy("tree").agg(F.count_if((F.col("left_rows") + F.col("right_rows")) != F.col("n_rows")).alias("lost_rows"),
                                      F.count_if(off).alias("wrong_means"))
    shape = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("left_child") == F.col("node")).alias("n_leaves"),
                                      F.max("depth").alias("depth"))
    return shape.join(wrong, "tree", "left").fillna(0, ["lost_rows", "wrong_means"])


def score_by_nodes(df: DataFrame, nodes: DataFrame, features, *, depth: int, n_trees: int,
                   prediction: str = "prediction") -> DataFrame:
    """Rows complete in the features with ``prediction``: the mean over the trees of the leaf values.

    ``depth`` is the depth of the deepest tree.  The node table is joined
    without a hint; it is small by construction, and a larger one is joined
    by shuffles.
    """
    features = list(features)
    require_columns(df, features, "DataFrame")
    rows = df.dropna(subset=features)
    xs = [f"_x{i}" for i in range(len(features))]
    exact = [F.col(f).cast("double").alias(x) for f, x in zip(features, xs, strict=True)]
    vectors = rows.select(*exact).distinct()
    step = nodes.select(F.col("tree").alias("_tree"), F.col("node").alias("_node"), "feature", "threshold", "left_child", "right_child")
    at = vectors.withColumn("_tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1)))).withColumn("_node", F.lit(0))
    for _ in range(depth):
        value = F.coalesce(*[F.when(F.col("feature") == f, F.col(x)) for f, x in zip(features, xs, strict=True)])
        # a leaf has no feature, and both of its children are itself
        onward = F.when(value <= F.col("threshold"), F.col("left_child")).otherwise(F.col("right_child"))
        at = at.join(step, ["_tree", "_node"]).select(*xs, "_tree", onward.alias("_node"))
    leaves = nodes.select(F.col("tree").alias("_tree"), F.col("node").alias("_node"), "value")
    scored = at.join(leaves, ["_tree", "_node"]).groupBy(*xs).agg((F.sum("value") / n_trees).alias(prediction))
    out = rows.select("*", *exact).join(scored, xs)
    return out.select(*[F.col(c) for c in df.columns], prediction)


class NodeForest:
    """A forest held as a node table, with the protocol of the other models: ``feature_columns`` and ``transform``."""

    def __init__(self, nodes: DataFrame, feature_columns, target_column: str, depth: int, n_trees: int):
        self.nodes, self.feature_columns, self.target_column = nodes, list(feature_columns), target_column
        self.depth, self.n_trees = depth, n_trees

    @classmethod
    def from_model(cls, model: PipelineModel, target_column: str = "demand") -> NodeForest:
        features, forest = _parts(model)
        return cls(node_table(model), features, target_column, forest.getMaxDepth(), forest.getNumTrees)

    def save(self, path: str) -> None:
        """The table itself, with what scoring needs besides as its partition-free columns."""
        meta = [F.lit(",".join(self.feature_columns)).alias("features"), F.lit(self.target_column).alias("target"),
                F.lit(self.depth).alias("max_depth"), F.lit(self.n_trees).alias("n_trees")]
        self.nodes.select("*", *meta).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> NodeForest:
        nodes = SparkSession.getActiveSession().read.parquet(path)
        m = nodes.select("features", "target", "max_depth", "n_trees").first()
        return cls(nodes.drop("features", "target", "max_depth", "n_trees"), m["features"].split(","), m["target"], m["max_depth"], m["n_trees"])

    def transform(self, df: DataFrame) -> DataFrame:
        return score_by_nodes(df, self.nodes, self.feature_columns, depth=self.depth, n_trees=self.n_trees)

    predict = transform
