"""Trained models as tables: coefficients and tree nodes as rows, written, read back and scored by expressions.

A table has a row per feature, or per node of a tree: a size the learner's parameters fix, whatever the number of rows it
learned from. Scoring brings it in as one constant of the plan; a row walks its trees where it lies, so nothing is shuffled,
no row is repeated per tree, and no learner's library is needed to score.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.operators.features import fill_features
from outagegrid.operators.models import save_model
from outagegrid.session import scratch_path

LINEAR = "feature string, mean double, deviation double, coefficient double"


def linear_table(spark: SparkSession, model: PipelineModel, features: list[str] = fixed.FEATURES) -> DataFrame:
    """feature, mean, deviation, coefficient of a logistic pipeline; the intercept has a row without feature."""
    scaler, learner = model.stages[-2], model.stages[-1]
    rows = [
        (f, float(m), float(d), float(c))
        for f, m, d, c in zip(features, scaler.mean, scaler.std, learner.coefficients, strict=True)
    ]
    return spark.createDataFrame([*rows, (None, None, None, float(learner.intercept))], LINEAR)


def score_linear(df: DataFrame, table: DataFrame, features: list[str] = fixed.FEATURES, name: str = "outage_proba") -> DataFrame:
    """All columns plus the probability. A feature without deviation counts nothing, as in the scaler."""
    entry = F.struct(F.coalesce("feature", F.lit("")), F.struct("mean", "deviation", "coefficient"))
    known = table.agg(F.map_from_entries(F.collect_list(entry))).scalar()
    keyed = fill_features(df, features).withColumn("_known", known)
    margin = F.col("_known")[""]["coefficient"]
    for f in features:
        k = F.col("_known")[f]
        scaled = F.when(k["deviation"] != 0, (F.col(f).cast("double") - k["mean"]) / k["deviation"]).otherwise(0.0)
        margin = margin + scaled * k["coefficient"]
    return keyed.select(*[F.col(c) for c in df.columns], (1 / (1 + F.exp(-margin))).alias(name))


def tree_table(spark: SparkSession, model: PipelineModel, features: list[str] = fixed.FEATURES) -> DataFrame:
    """tree, weight, node, feature, threshold, left, right, value, gain, n of a boosted pipeline. Nodes are numbered from 0;
    leaves have no feature. The learner's own files are such a table already; they are read and not rebuilt."""
    path = scratch_path(spark, "trees")
    save_model(model, path)
    at = f"{path}/stages/{len(model.stages) - 1}_*"
    nodes = spark.read.parquet(f"{at}/data").toDF("treeID", "nodeData")
    weights = spark.read.parquet(f"{at}/treesMetadata").toDF("treeID", "metadata", "weights")
    names = F.array(*[F.lit(f) for f in features])
    n = F.col("nodeData")
    return nodes.join(weights.drop("metadata"), "treeID").select(
        F.col("treeID").alias("tree"), F.col("weights").alias("weight"), n["id"].alias("node"),
        F.when(n["leftChild"] >= 0, F.get(names, n["split"]["featureIndex"])).alias("feature"),
        F.when(n["leftChild"] >= 0, F.get(n["split"]["leftCategoriesOrThreshold"], 0)).alias("threshold"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["prediction"].alias("value"),
        n["gain"].alias("gain"), n["rawCount"].alias("n"),
    )


def score_trees(
    df: DataFrame, table: DataFrame, features: list[str] = fixed.FEATURES, name: str = "outage_proba", depth: int = 30
) -> DataFrame:
    """All columns plus the probability: the sum of the leaves a row ends in, by their trees' weights. ``depth`` is at least
    that of the trees."""
    place = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature")) - 1
    node = F.struct("node", place.cast("int").alias("at"), "threshold", "left", "right", "value")
    trees = (
        table.groupBy("tree", "weight").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
        .agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "nodes")))).scalar()
    )
    x = F.array(*[F.col(f).cast("double") for f in features])
    keyed = fill_features(df, features).withColumns({"_trees": trees, "_x": x})

    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            here = F.get(tree["nodes"], at)
            down = F.when(F.get("_x", here["at"]) <= here["threshold"], here["left"]).otherwise(here["right"])
            return F.when(here["left"] < 0, at).otherwise(down)

        end = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)
        return F.get(tree["nodes"], end)["value"]

    total = F.aggregate("_trees", F.lit(0.0), lambda s, t: s + t["weight"] * leaf(t))
    return keyed.select(*[F.col(c) for c in df.columns], (1 / (1 + F.exp(-2 * total))).alias(name))


def importance(table: DataFrame, n: int = 15) -> DataFrame:
    """feature, importance (share of the gain over all nodes, by their rows), feature_group: the ``n`` largest first."""
    gains = table.where(F.col("feature").isNotNull()).groupBy("feature").agg(F.sum(F.col("gain") * F.col("n")).alias("g"))
    share = F.col("g") / gains.agg(F.sum("g")).scalar()
    group = F.when(F.col("feature").isin(fixed.STORM_FEATURES), "storm").otherwise("temporal")
    return gains.select("feature", share.alias("importance"), group.alias("feature_group")).orderBy(
        F.desc("importance"), "feature"
    ).limit(n)
