"""Hourly labels from a stream of 15-minute reports.

The lag, rolling and fragility columns count rows and stay batch work; a stream carries the hourly rollup, the storm
flags and the label, which need only the current hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outagegrid.functions.timing import NTZ
from outagegrid.operators import outages, storms


def hourly_stream(reports: DataFrame, lateness: str = "2 hours", period: str = "year") -> DataFrame:
    """Closed hours of a stream of raw reports. State is one small row per county and open hour; reports that come later
    than ``lateness`` are dropped by the watermark."""
    clean = outages.clean_observations(reports, period).withColumn("event_time", F.col("ts").cast("timestamp"))
    first_state = F.min(F.when(F.col("state").isNotNull(), F.struct("ts", "state")))
    hourly = (
        clean.withWatermark("event_time", lateness)
        .groupBy("fips", F.window("event_time", "1 hour"))
        .agg(
            F.max("year").alias("year"),
            F.max("customers_out").alias("peak_customers_out"),
            F.avg("customers_out").alias("mean_customers_out"),
            F.sum("null_flag").alias("null_count"),
            first_state["state"].alias("state"),
        )
    )
    return hourly.withColumn("hour", F.col("window.start").cast(NTZ)).drop("window")


def labelled_stream(reports: DataFrame, stats: DataFrame, pivot: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Stream-static joins with the thresholds and storm flags known when a batch starts."""
    return outages.label_outages(storms.join_storms(hourly_stream(reports, lateness), pivot), stats)


def write_hours(stream: DataFrame, path: str, checkpoint: str):
    """Append closed hours to Parquet, whatever has arrived by now; the checkpoint makes a restart exact."""
    return (
        stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
        .partitionBy("year").trigger(availableNow=True).start(path)
    )
