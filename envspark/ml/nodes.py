"""A fitted forest as a table of nodes, and what follows from the table alone.

Spark saves a forest as one row per node. Read back, the table says how a score comes about: a row starts
at the root of each tree and takes one child per step, which is a join of (tree, node) per level. Scores and
importances made from the table equal those of the model, and need nothing but SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from envspark.ml.forest import ZONE_SLOT
from envspark.profiles import Profile, profile_of
from envspark.sources.storage import scratch_path

#: nodes up to which the table is broadcast; 50 trees of depth 10 have 102,350 at most
BROADCAST_NODES = 500_000
INTERMEDIATE = "features"


def tree_nodes(model: PipelineModel, path: str | None = None) -> DataFrame:
    """The nodes of the pipeline's forest: tree, node, feature, threshold, left_values, left, right, value, gain, weight.

    `feature` is the position in the final vector. A row goes left if its feature is at most `threshold` or,
    for features with categories, one of `left_values`. A leaf has no feature. The table is
    written below `path`, or into the shared folder, as a part of Spark's own format.
    """
    forest = model.stages[-1]
    spark = SparkSession.active()
    path = path or scratch_path(spark, "forest")
    forest.write().overwrite().save(path)
    split = F.col("nodeData.split")
    inner, by_value = split["featureIndex"] >= 0, split["numCategories"] >= 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & ~by_value, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner & by_value, split["leftCategoriesOrThreshold"]).alias("left_values"),
        F.when(inner, F.col("nodeData.leftChild")).alias("left"), F.when(inner, F.col("nodeData.rightChild")).alias("right"),
        F.col("nodeData.prediction").alias("value"), F.when(inner, F.col("nodeData.gain")).alias("gain"),
        F.col("nodeData.impurityStats")[0].alias("weight"))


def forest_depth(model: PipelineModel) -> int:
    """Steps from a root to the deepest leaf."""
    return max(t.depth for t in model.stages[-1].trees)


def inputs(model: PipelineModel, df: DataFrame) -> DataFrame:
    """`df` with the forest's input vector, made by the stages before it."""
    return PipelineModel(model.stages[:-1]).transform(df)


def score_by_nodes(nodes: DataFrame, vectors: DataFrame, depth: int, key: Sequence[str],
                   vector: str = INTERMEDIATE) -> DataFrame:
    """`key` and prediction: the mean over trees of the leaf that each row reaches. `key` is unique.

    Every step joins the rows with the nodes that they stand on. The table of nodes is broadcast if it
    is small, which is counted; the rows are shuffled once at most, and combined before that.
    """
    sizes = nodes.agg(F.count("*").alias("n"), F.count_distinct("tree").alias("trees")).first()
    kept = (lambda t: F.broadcast(t)) if sizes.n <= BROADCAST_NODES else (lambda t: t)
    splits = nodes.filter(F.col("feature").isNotNull()).select("tree", "node", "feature", "threshold", "left_values", "left", "right")
    place, at, x = "_tree", "_node", "_vector"
    steps = F.explode(F.sequence(F.lit(0), F.lit(sizes.trees - 1)))
    rows = vectors.select(*key, vector_to_array(vector).alias(x)).withColumn(place, steps).withColumn(at, F.lit(0))
    given = F.get(F.col(x), F.col("feature"))
    goes_left = F.coalesce(given <= F.col("threshold"), F.array_contains("left_values", given))
    child = F.when(F.col("feature").isNull(), F.col(at)).when(goes_left, F.col("left")).otherwise(F.col("right"))
    for _ in range(depth):
        here = kept(splits.withColumnsRenamed({"tree": "_of", "node": "_number"}))
        rows = (rows.join(here, (F.col(place) == F.col("_of")) & (F.col(at) == F.col("_number")), "left")
                .select(*key, x, place, child.alias(at)))
    leaves = kept(nodes.select(F.col("tree").alias("_of"), F.col("node").alias("_number"), "value"))
    reached = rows.join(leaves, (F.col(place) == F.col("_of")) & (F.col(at) == F.col("_number")))
    return reached.groupBy(*key).agg((F.sum("value") / F.lit(float(sizes.trees))).alias("prediction"))


def importance_by_nodes(nodes: DataFrame, profile: str | Profile) -> DataFrame:
    """(feature, importance) from the table: the gain of every split times the rows it saw, as shares of its tree,
    averaged over trees and summed per input; the slots of the zone are one input. Inputs that no split uses have 0."""
    names = list(profile_of(profile).features)
    used = nodes.filter(F.col("feature").isNotNull())
    by_tree = used.groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("gain"))
    share = by_tree.withColumn("share", F.try_divide("gain", F.sum("gain").over(Window.partitionBy("tree"))))
    name = F.coalesce(F.get(F.array(*[F.lit(n) for n in names]), F.col("feature")), F.lit(ZONE_SLOT))
    by_input = share.groupBy(name.alias("feature")).agg(F.sum("share").alias("share"))
    whole = by_input.agg(F.sum("share")).scalar()  # the number of trees that split at all
    every = nodes.sparkSession.createDataFrame([(n,) for n in [*names, ZONE_SLOT]], "feature string")
    shares = by_input.select("feature", F.try_divide(F.col("share"), whole).alias("importance"))
    return every.join(shares, "feature", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))
