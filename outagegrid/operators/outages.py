"""County outage observations: cleaning, hourly rollup, thresholds and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.functions import timing
from outagegrid.operators.ordering import exact_quantiles

HOUR = ["fips", "hour"]


def exclude_territories(state: Column, excluded: list[str] = fixed.TERRITORIES) -> Column:
    """True for rows to keep. An unknown state is kept, which a plain NOT IN would drop."""
    return state.isNull() | ~state.isin(excluded)


def impute_clip(raw: Column) -> Column:
    """No report counts as zero; negative reports are raised to zero."""
    return F.greatest(F.coalesce(F.nanvl(raw.cast("double"), F.lit(None)), F.lit(0.0)), F.lit(0.0))


def clean_observations(
    obs: DataFrame, period: str = "year", excluded: list[str] = fixed.TERRITORIES
) -> DataFrame:
    """(fips_code, state, sum, run_start_time, <period>) to one clean row per report."""
    raw = F.col("sum")
    ts = timing.parse_iso_ts(F.col("run_start_time"))
    return obs.where(exclude_territories(F.col("state"), excluded)).select(
        F.col("fips_code").cast("string").alias("fips"),
        "state",
        ts.alias("ts"),
        timing.floor_hour(ts).alias("hour"),
        F.col(period).alias("year"),
        impute_clip(raw).alias("customers_out"),
        F.nanvl(raw.cast("double"), F.lit(None)).isNull().cast("int").alias("null_flag"),
    )


def hourly_rollup(clean: DataFrame) -> DataFrame:
    """One row per county and hour, from one pass over the reports. Reports are combined per county, hour and state name on
    the map side first, as a hash aggregate of plain numbers, so a county with a third of all reports costs each task at
    most one row per hour and state name before the shuffle. ``state`` is the first state given in the hour, the first by
    name among equally early ones; names are compared among those few rows only."""
    by_state = (
        clean.where(F.col("fips").isNotNull() & F.col("hour").isNotNull())
        .groupBy(*HOUR, "state")
        .agg(
            F.min("ts").alias("_first"), F.max("year").alias("year"), F.max("customers_out").alias("peak_customers_out"),
            F.sum("customers_out").alias("_sum"), F.count("customers_out").alias("_n"), F.sum("null_flag").alias("null_count"),
        )
    )
    given = F.when(F.col("state").isNotNull(), F.struct("_first", "state"))
    return by_state.groupBy(*HOUR).agg(
        F.max("year").alias("year"),
        F.max("peak_customers_out").alias("peak_customers_out"),
        (F.sum("_sum") / F.sum("_n")).alias("mean_customers_out"),
        F.sum("null_count").alias("null_count"),
        F.min(given)["state"].alias("state"),
    )


def county_stats(clean: DataFrame, q: float = 0.9, approx: bool = False) -> DataFrame:
    """(fips, county_p90, county_mean_baseline) over the reports given; filter to the threshold years first."""
    if approx:
        return clean.groupBy("fips").agg(
            F.approx_percentile("customers_out", F.lit(q), F.lit(10000)).alias("county_p90"),
            F.avg("customers_out").alias("county_mean_baseline"),
        )
    return exact_quantiles(clean, ["fips"], "customers_out", {"county_p90": q}, mean="county_mean_baseline")


def distinct_counties(clean: DataFrame) -> DataFrame:
    return clean.select("fips").distinct()


def label_outages(hourly: DataFrame, stats: DataFrame, floor: float = fixed.OUTAGE_FLOOR) -> DataFrame:
    """Left join with the thresholds. No broadcast hint: thresholds grow with the number of counties, so the choice is
    left to the size Spark measures. The hourly side holds at most one row per county and hour, so it has no hot key,
    and the shuffle on ``fips`` serves the county windows that follow."""
    peak = F.col("peak_customers_out")
    joined = hourly.join(stats, "fips", "left")
    joined = joined.withColumns(
        {
            "county_p90": F.coalesce("county_p90", F.lit(fixed.DEFAULT_P90)),
            "county_mean_baseline": F.coalesce("county_mean_baseline", F.lit(fixed.DEFAULT_MEAN)),
        }
    )
    return joined.withColumns(
        {
            "outage_label": ((peak > F.col("county_p90")) & (peak > floor)).cast("int"),
            "log_peak_customers": F.log1p(peak),
        }
    )


def outage_rates(labelled: DataFrame, by: list[str]) -> DataFrame:
    """Rows and positive share in percent."""
    return labelled.groupBy(*by).agg(
        F.count("outage_label").alias("total_rows"), (F.avg("outage_label") * 100).alias("outage_rate_pct")
    )
