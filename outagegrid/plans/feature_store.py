"""Observations and storm events to the hourly feature store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.operators import features, outages, storms


def labelled_hours(obs: DataFrame, threshold_years: list[int], period: str = "year", approx: bool = False) -> DataFrame:
    clean = outages.clean_observations(obs, period)
    stats = outages.county_stats(clean.where(F.col("year").isin(threshold_years)), approx=approx)
    return outages.label_outages(outages.hourly_rollup(clean), stats)


def feature_store(
    obs: DataFrame,
    events: DataFrame,
    threshold_years: list[int] = fixed.THRESHOLD_YEARS,
    period: str = "year",
    approx: bool = False,
) -> DataFrame:
    """Keys, targets and the 28 features, one row per county and hour.

    The storm join comes right after the rollup, because both are laid out by (fips, hour); the threshold join then lays
    the hours out by ``fips``, which the lag, rolling and fragility windows reuse.
    """
    clean = outages.clean_observations(obs, period)
    stats = outages.county_stats(clean.where(F.col("year").isin(threshold_years)), approx=approx)
    hours = storms.join_storms(outages.hourly_rollup(clean), storms.storm_pivot(events))
    labelled = features.calendar_features(outages.label_outages(hours, stats))
    windowed = features.fragility(features.rolling_storms(features.lag_features(labelled)))
    return features.project_features(windowed)
