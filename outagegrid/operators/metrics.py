"""Exact model metrics from running totals per distinct score.

A scored table has ``label`` (0 or 1) and ``proba``; names can be changed where a function takes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


from outagegrid.operators.ordering import running_totals


def threshold_table(scored: DataFrame, label: str = "label", proba: str = "proba", by: list[str] = ()) -> DataFrame:
    """(score, tp, fp, fn, tn, pos_here, neg_here): the confusion counts of predicting positive at or above each score.
    Rows are counted per score before anything is ordered."""
    by = list(by)
    counts = scored.groupBy(*by, F.col(proba).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    running = running_totals(counts, by, [-F.col("score")], ["pos", "neg"])
    return running.select(
        *by, "score", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        (F.col("total_pos") - F.col("cum_pos")).alias("fn"), (F.col("total_neg") - F.col("cum_neg")).alias("tn"),
        F.col("pos").alias("pos_here"), F.col("neg").alias("neg_here"),
    )


def _actual_positive() -> Column:
    return F.col("tp") + F.col("fn")


def _actual_negative() -> Column:
    return F.col("fp") + F.col("tn")


def _share(part: Column, whole: Column) -> Column:
    """``part / whole``, and NaN of an empty whole, which is an error of plain division."""
    return F.coalesce(F.try_divide(part, whole), F.lit(float("nan")))


def curve_metrics(table: DataFrame, by: list[str] = ()) -> DataFrame:
    """(roc_auc, pr_auc, best_threshold, best_f1) from one pass over a threshold table.

    ROC is the trapezoid sum with ties joined; PR is average precision; the threshold is the one with the greatest F1,
    the lowest on ties, and ``best_f1`` is the F1 of predicting at it. With a single class in the labels the ROC area is NaN,
    without positives the average precision too. Scores of unlabelled rows only add nothing.
    """
    precision = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0))
    recall = _share(F.col("tp"), _actual_positive())
    eased_f1 = F.when(F.col("tp") > 0, 2 * precision * recall / (precision + recall + F.lit(1e-8))).otherwise(0.0)
    f1 = _share(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    area = F.col("neg_here") * (F.col("tp") + (F.col("tp") - F.col("pos_here"))) / 2.0
    best = F.max(F.struct(eased_f1.alias("f"), (-F.col("score")).alias("s"), f1.alias("f1")))
    return table.groupBy(*by).agg(
        F.sum(_share(_share(area, _actual_positive()), _actual_negative())).alias("roc_auc"),
        F.sum(_share(F.col("pos_here"), _actual_positive()) * precision).alias("pr_auc"),
        (-best["s"]).alias("best_threshold"),
        best["f1"].alias("best_f1"),
    )


def roc_points(table: DataFrame) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, plus the origin."""
    points = table.select(
        F.col("score").alias("threshold"), (F.col("fp") / _actual_negative()).alias("fpr"),
        (F.col("tp") / _actual_positive()).alias("tpr"),
    )
    return points.unionByName(_one_row(table, {"threshold": None, "fpr": 0.0, "tpr": 0.0}))


def pr_points(table: DataFrame) -> DataFrame:
    """(threshold, precision, recall) at every distinct score, plus the closing point."""
    points = table.select(
        F.col("score").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        (F.col("tp") / _actual_positive()).alias("recall"),
    )
    return points.unionByName(_one_row(table, {"threshold": None, "precision": 1.0, "recall": 0.0}))


def _one_row(table: DataFrame, values: dict[str, float | None]) -> DataFrame:
    return table.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(n) for n, v in values.items()])


def brier(scored: DataFrame, label: str = "label", proba: str = "proba") -> DataFrame:
    error = F.col(proba) - F.col(label)
    return scored.agg(F.avg(error * error).alias("brier"))


def mean_absolute_error(df: DataFrame, target: str, prediction: str) -> DataFrame:
    return df.agg(F.avg(F.abs(F.col(target) - F.col(prediction))).alias("mae"))


def f1_at(scored: DataFrame, threshold: float | Column, label: str = "label", proba: str = "proba") -> DataFrame:
    hit, actual = F.col(proba) >= threshold, F.col(label) == 1
    return scored.agg(
        (2.0 * F.count_if(hit & actual) / (F.count_if(hit) + F.count_if(actual))).alias("f1")
    )


def calibration(scored: DataFrame, bins: int = 15, label: str = "label", proba: str = "proba") -> DataFrame:
    """Mean prediction and observed share in right-closed equal bins of [0, 1]; empty bins do not appear."""
    at = F.greatest(F.lit(0), F.ceil(F.col(proba) * bins) - 1).cast("int")
    return scored.groupBy(at.alias("bin")).agg(
        F.avg(proba).alias("mean_predicted"), F.avg(F.col(label).cast("double")).alias("fraction_positive"),
        F.count(F.lit(1)).alias("n"),
    )


def equal_width_rate(scored: DataFrame, bins: int = 10, label: str = "label", proba: str = "proba") -> DataFrame:
    """Observed share in right-closed equal bins over the range of the scores, the lowest score in the first bin."""
    ends = scored.agg(F.struct(F.min(proba).alias("lo"), F.max(proba).alias("hi"))).scalar()
    placed = scored.select(F.col(proba).alias("p"), F.col(label).alias("y"), ends.alias("e"))
    at = F.ceil((F.col("p") - F.col("e.lo")) / F.nullif(F.col("e.hi") - F.col("e.lo"), F.lit(0.0)) * bins)
    return placed.groupBy(F.greatest(F.lit(1), F.coalesce(at, F.lit(1))).cast("int").alias("bucket")).agg(
        F.avg(F.col("y").cast("double")).alias("outage_rate"), F.count(F.lit(1)).alias("n")
    )


def class_density(scored: DataFrame, bins: int = 50, label: str = "label", proba: str = "proba") -> DataFrame:
    """Density histogram of the scores of each class over that class's own range."""
    ranges = scored.groupBy(F.col(label).alias("class")).agg(
        F.min(proba).alias("lo"), F.max(proba).alias("hi"), F.count(F.lit(1)).alias("total")
    )
    # Two rows at most, one per class, so the broadcast is of a proven size.
    placed = scored.select(F.col(label).alias("class"), F.col(proba).alias("p")).join(F.broadcast(ranges), "class")
    width = F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) / bins
    at = F.least(F.lit(bins - 1), F.coalesce(F.floor((F.col("p") - F.col("lo")) / width), F.lit(0))).cast("int")
    return (
        placed.groupBy("class", at.alias("bin"), "lo", "hi", "total").agg(F.count(F.lit(1)).alias("n"))
        .select("class", "bin", "n", (F.col("n") / F.col("total") / width).alias("density"))
    )


def focal_loss(df: DataFrame, logit: str, label: str = "label", alpha: float = 0.75, gamma: float = 2.0) -> DataFrame:
    """Mean focal loss, with the cross entropy in its overflow-free form."""
    z, y = F.col(logit), F.col(label).cast("double")
    entropy = F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))
    p = 1 / (1 + F.exp(-z))
    miss = F.when(y == 1, 1 - p).otherwise(p)
    weight = F.when(y == 1, F.lit(alpha)).otherwise(F.lit(1 - alpha))
    return df.agg(F.avg(weight * F.pow(miss, F.lit(gamma)) * entropy).alias("focal_loss"))


def pinball_loss(df: DataFrame, target: str, predictions: dict[str, float]) -> DataFrame:
    """Mean over rows and quantiles; ``predictions`` maps a prediction column to its quantile."""
    parts = []
    for column, q in predictions.items():
        error = F.col(target) - F.col(column)
        parts.append(F.greatest(q * error, (q - 1) * error))
    return df.agg(F.avg(sum(parts, F.lit(0.0)) / len(parts)).alias("pinball_loss"))


def combined_loss(focal: DataFrame, pinball: DataFrame, weight: float = 0.6) -> DataFrame:
    return focal.select("focal_loss", pinball.scalar().alias("pinball_loss")).withColumn(
        "combined_loss", weight * F.col("focal_loss") + (1 - weight) * F.col("pinball_loss")
    )


def top_k_recall(
    scored: DataFrame, ks: list[int], tie_break: list[str], label: str = "label", proba: str = "proba",
    customers: str = "customers",
) -> DataFrame:
    """Share of affected customers among positives that the ``k`` highest scores hold, for every ``k`` asked for.

    Only the greatest ``k`` rows are ordered, which is a report size, and the total is a scalar beside them.
    """
    hit = F.when(F.col(label) == 1, F.col(customers)).otherwise(0.0)
    total = scored.agg(F.sum(hit)).scalar()
    order = [F.desc(proba), *tie_break]
    top = scored.select(proba, *tie_break, hit.alias("hit")).orderBy(*order).limit(max(ks))
    running = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        top.select(F.row_number().over(Window.orderBy(*order)).alias("k"), F.sum("hit").over(running).alias("found"))
        .where(F.col("k").isin(ks))
        .select("k", (F.col("found") / (total + F.lit(1e-8))).alias("recall"))
    )


def model_metrics(scored: DataFrame, models: dict[str, str], label: str = "label", digits: int = 4) -> DataFrame:
    """(model, roc_auc, pr_auc, f1, brier) to ``digits`` decimals for every probability column of one scored table, in one
    pass for all models. Ask for the decimals wanted: rounding once more would raise 0.38545 to 0.386."""
    name = F.explode(
        F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("proba")) for m, c in models.items()])
    )
    long = scored.select(F.col(label).alias("label"), name.alias("m")).select("label", "m.model", "m.proba")
    error = F.col("proba") - F.col("label")
    briers = long.groupBy("model").agg(F.avg(error * error).alias("brier"))
    curves = curve_metrics(threshold_table(long, by=["model"]), ["model"])
    return curves.join(briers, "model").select(
        "model", F.round("roc_auc", digits).alias("roc_auc"), F.round("pr_auc", digits).alias("pr_auc"),
        F.round("best_f1", digits).alias("f1"), F.round("brier", digits).alias("brier"),
    )


def best_models(comparison: DataFrame) -> DataFrame:
    """Which model leads each metric; a low Brier score is the better one."""
    return comparison.agg(
        *[F.max_by("model", c).alias(f"best_{c}") for c in ("roc_auc", "pr_auc", "f1")],
        F.min_by("model", "brier").alias("best_brier"),
    )
