"""Per-county window features, sequences and the feature projection.

Every window here runs over the hourly rollup, so one (county, year) holds at most 8,784 rows however many reports the
county sent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.functions import timing


def _by_hour(*keys: str):
    return Window.partitionBy(*keys).orderBy("hour")


def calendar_features(hourly: DataFrame) -> DataFrame:
    return hourly.withColumns(timing.calendar(F.col("hour")))


def lag_features(labelled: DataFrame) -> DataFrame:
    """Row lags that restart each year; a missing row counts as zero."""
    peaks = {
        f"lag_{n}h_peak": F.lag("peak_customers_out", n, 0.0).over(_by_hour("fips", "year")) for n in (1, 24, 168)
    }
    labels = {f"lag_{n}h_label": F.lag("outage_label", n, 0).over(_by_hour("fips", "year")) for n in (24, 168)}
    return labelled.withColumns(peaks | labels)


def rolling_storms(hourly: DataFrame) -> DataFrame:
    """Sums over the last 6, 12 and 24 rows, the current one included."""
    return hourly.withColumns(
        {
            f"{c}_sum_{n}h": F.sum(c).over(_by_hour("fips", "year").rowsBetween(1 - n, 0))
            for n in (6, 12, 24)
            for c in ("wind", "any_storm")
        }
    )


def fragility(labelled: DataFrame, rows: int = 720, least: int = 24) -> DataFrame:
    """Share of outage hours in the previous rows, current one excluded; zero until enough history exists."""
    before = _by_hour("fips", "year").rowsBetween(-rows, -1)
    share = F.when(F.count("outage_label").over(before) >= least, F.avg("outage_label").over(before))
    return labelled.withColumn("county_fragility", F.coalesce(share, F.lit(0.0)))


def fill_features(df: DataFrame, features: list[str] = fixed.FEATURES) -> DataFrame:
    return df.fillna(0, subset=features)


def project_features(df: DataFrame, features: list[str] = fixed.FEATURES) -> DataFrame:
    return df.select(*fixed.KEYS_AND_TARGETS, *features)


def fill_missing_hours(hourly: DataFrame) -> DataFrame:
    """Optional densification before the lags: one row for every hour between a county-year's first and last report,
    with zero outages where nothing was reported. Off by default, since the defined lags count rows."""
    span = hourly.groupBy("fips", "year").agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    grid = span.select(
        "fips", "year", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias("hour")
    )
    zero = ["peak_customers_out", "mean_customers_out", "null_count"]
    return grid.join(hourly, ["fips", "year", "hour"], "left").fillna(0, subset=zero)


def sequence_windows(
    df: DataFrame, features: list[str] = fixed.FEATURES, n: int = fixed.SEQUENCE_HOURS
) -> DataFrame:
    """For every row with ``n`` earlier rows of its county: those rows' features and this row's targets."""
    row = F.array(*[F.col(c).cast("double") for c in features])
    return (
        df.select("fips", "hour", "outage_label", "log_peak_customers", row.alias("_row"))
        .withColumn("x", F.collect_list("_row").over(_by_hour("fips").rowsBetween(-n, -1)))
        .where(F.size("x") == n)
        .select("fips", "hour", "x", F.col("outage_label").alias("y_cls"), F.col("log_peak_customers").alias("y_reg"))
    )
