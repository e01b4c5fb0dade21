"""Outage models on Spark's own distributed learners."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.operators.features import fill_features
from outagegrid.operators.ordering import exact_quantiles
from outagegrid.operators.sampling import ROW, balanced_sample, uniform_sample
from outagegrid.session import keep, use_checkpoint_folder

ROWS_PER_TASK = 25_000  # of a learner's sample, which is passed over in many short jobs


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features")


def standardizer(features: list[str] = fixed.FEATURES) -> Pipeline:
    """Zero mean and unit deviation, fitted on the rows given. Spark divides by the sample deviation (n - 1)."""
    return Pipeline(
        stages=[
            _assembler(features),
            StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        ]
    )


def packed(sample: DataFrame) -> DataFrame:
    """A learner's sample in as few tasks as its rows need, in one order: boosting runs a job per level of a tree, and draws
    rows by their place. The shuffles that made the sample leave as many parts as the session is set to."""
    rows = keep(sample)
    tasks = max(1, -(-rows.count() // ROWS_PER_TASK))
    keys = [c for c in ROW if c in rows.columns] or rows.columns
    return rows.repartition(tasks, *keys).sortWithinPartitions(*keys)


def fit_logistic(
    train: DataFrame, features: list[str] = fixed.FEATURES, n: int = 300_000, seed: int = 42, c: float = 0.1,
    max_iter: int = 1000, order: list[Column] | None = None, tol: float = 1e-6,
) -> PipelineModel:
    """Balanced logistic regression on standardized features; the scaler sees all rows, the fit a uniform sample.

    The penalty is per row in Spark and per data set in the definition, hence 1 / (c x rows).
    """
    filled = fill_features(train, features)
    scaler = standardizer(features).fit(filled)
    sample = uniform_sample(filled, n, seed, order).persist()
    rows, positives = sample.agg(F.count(F.lit(1)), F.sum("outage_label")).first()
    share = {1: rows / (2.0 * max(positives, 1)), 0: rows / (2.0 * max(rows - positives, 1))}
    weighted = scaler.transform(sample).withColumn(
        "weight", F.when(F.col("outage_label") == 1, share[1]).otherwise(share[0])
    )
    model = LogisticRegression(
        featuresCol="scaled", labelCol="outage_label", weightCol="weight", regParam=1.0 / (c * max(rows, 1)),
        maxIter=max_iter, tol=tol, standardization=False,
    ).fit(weighted)
    sample.unpersist()
    return PipelineModel(stages=[*scaler.stages, model])


def fit_gbt(
    train: DataFrame, features: list[str] = fixed.FEATURES, n: int = 150_000, seed: int = 42, trees: int = 200,
    depth: int = 5, rate: float = 0.05, subsample: float = 0.8, order: list[Column] | None = None,
) -> PipelineModel:
    """Boosted trees on a class-balanced sample."""
    use_checkpoint_folder(train.sparkSession)  # many boosting rounds: cut their lineage now and then
    sample = packed(balanced_sample(fill_features(train, features), n, seed, order)).persist()
    learner = GBTClassifier(
        featuresCol="features", labelCol="outage_label", maxIter=trees, maxDepth=depth, stepSize=rate,
        subsamplingRate=subsample, seed=seed, checkpointInterval=10,
    )
    model = Pipeline(stages=[_assembler(features), learner]).fit(sample)
    sample.unpersist()
    return model


def score(model: PipelineModel, df: DataFrame, features: list[str] = fixed.FEATURES, name: str = "outage_proba") -> DataFrame:
    """All columns plus the probability of an outage."""
    scored = model.transform(fill_features(df, features))
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(name))


def feature_importance(
    spark: SparkSession, model: PipelineModel, features: list[str] = fixed.FEATURES, n: int = 15
) -> DataFrame:
    """The ``n`` most important features of a tree model, with their group. One small row per feature."""
    values = [float(v) for v in model.stages[-1].featureImportances.toArray()]
    rows = spark.createDataFrame(list(zip(features, values)), "feature string, importance double")
    group = F.when(F.col("feature").isin(fixed.STORM_FEATURES), "storm").otherwise("temporal")
    return rows.withColumn("feature_group", group).orderBy(F.desc("importance"), "feature").limit(n)


def quantile_forecast(
    train: DataFrame, by: list[str] = ("fips", "any_storm"), target: str = "log_peak_customers"
) -> DataFrame:
    """Conditional 50 % and 90 % quantiles of the target, by default per county with and without a storm."""
    return exact_quantiles(train, list(by), target, {"q50_log": 0.5, "q90_log": 0.9})


def with_forecast(df: DataFrame, forecast: DataFrame, by: list[str] = ("fips", "any_storm")) -> DataFrame:
    """Attach a forecast; combinations never seen in training get zero."""
    return df.join(forecast, list(by), "left").fillna(0.0, subset=["q50_log", "q90_log"])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
