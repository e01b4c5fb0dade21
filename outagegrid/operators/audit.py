"""Data-quality profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def audit_outages(obs: DataFrame, by: list[str]) -> DataFrame:
    """Profile of raw reports; with an empty ``by`` one row for everything. A missing count is not above zero. Groups
    without a value in ``by`` are profiled too.

    One pass: reports are combined per group and county, then per group, so distinct counties expand no row.
    """
    per_county = obs.groupBy(*by, "fips_code").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("run_start_time").alias("first_report"),
        F.max("run_start_time").alias("last_report"),
        F.count_if(F.col("sum").isNull()).alias("null_sum"),
        F.count_if(F.col("sum") > 0).alias("positive_sum"),
        F.max("sum").alias("max_sum"),
    )
    return per_county.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.min("first_report").alias("first_report"),
        F.max("last_report").alias("last_report"),
        F.coalesce(F.sum("null_sum"), F.lit(0)).alias("null_sum"),
        F.coalesce(F.sum("positive_sum"), F.lit(0)).alias("positive_sum"),
        (F.sum("positive_sum") * 100.0 / F.sum("n")).alias("positive_pct"),
        F.max("max_sum").alias("max_sum"),
        F.count("fips_code").alias("counties"),
    )


def audit_storms(events: DataFrame, by: str = "year") -> DataFrame:
    """Rows, event types, zone-type counts and missing codes, for events without a value in ``by`` too. One pass: events
    are combined per group, zone type and event type; both types are closed sets, so what is gathered per group is small."""
    per_type = events.groupBy(by, "cz_type", "event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("state_fips").isNull()).alias("no_state"),
        F.count_if(F.col("cz_fips").isNull()).alias("no_zone"),
    )
    gathered = per_type.groupBy(by).agg(
        F.sum("n").alias("total_rows"),
        F.size(F.collect_set("event_type")).cast("long").alias("event_types"),
        F.collect_list(F.when(F.col("cz_type").isNotNull(), F.struct("cz_type", "n"))).alias("_zones"),
        F.sum("no_state").alias("null_state_fips"),
        F.sum("no_zone").alias("null_cz_fips"),
    )
    kinds = F.array_sort(F.array_distinct(F.transform("_zones", lambda z: z["cz_type"])))
    total = lambda kind: F.aggregate(
        F.filter("_zones", lambda z: z["cz_type"] == kind), F.lit(0).cast("long"), lambda sum_, z: sum_ + z["n"]
    )
    return gathered.withColumn("cz_counts", F.map_from_arrays(kinds, F.transform(kinds, total))).drop("_zones")


def audit_totals(obs: DataFrame, events: DataFrame) -> DataFrame:
    """Grand totals in one row."""
    reports = obs.groupBy("fips_code").agg(F.count(F.lit(1)).alias("n"))
    storms = events.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    return reports.agg(
        F.sum("n").alias("total_reports"), F.count("fips_code").alias("total_counties")
    ).select(
        "*",
        storms.agg(F.sum("n")).scalar().alias("total_events"),
        storms.agg(F.count("state")).scalar().alias("total_states"),
    )


def top_event_types(events: DataFrame, n: int = 15) -> DataFrame:
    return (
        events.where(F.col("event_type").isNotNull())
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy(F.desc("events"), "event_type")
        .limit(n)
    )
