"""Splits to trained models, scored hours and ranked counties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outagegrid.operators import metrics, models, priority


def train_and_compare(train: DataFrame, test: DataFrame, **sizes) -> tuple[DataFrame, DataFrame]:
    """(scored test rows, comparison table) for both learners."""
    logistic = models.fit_logistic(train)
    boosted = models.fit_gbt(train, **sizes)
    scored = models.score(boosted, models.score(logistic, test, name="logistic_proba"))
    comparison = metrics.model_metrics(
        scored, {"Logistic Regression": "logistic_proba", "Gradient Boosting": "outage_proba"}, "outage_label"
    )
    return scored, comparison


def ranked_counties(scored: DataFrame, forecast: DataFrame | None = None) -> DataFrame:
    """County priorities from the observed peak, or from a quantile forecast where one is given."""
    if forecast is None:
        return priority.county_priority(priority.row_priority(scored))
    return priority.county_priority(priority.row_priority(models.with_forecast(scored, forecast), F.col("q90_log")))
