"""County priority, what-if scenarios and the views over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.functions import codes
from outagegrid.operators.ordering import exact_quantiles, rank_within
from outagegrid.session import keep

QUEUE_NAMES = {
    "fips_str": "FIPS", "state_abbr": "State", "scenario_proba": "P(Outage)", "peak_customers_out": "Peak Customers",
    "outage_rate": "Outage Rate", "priority_score": "Priority Score", "risk_label": "Risk",
}


def share_of_max(df: DataFrame, value: str) -> Column:
    """value / (largest value of the whole table + 1e-8), the maximum taken once as a scalar subquery."""
    return F.col(value) / (df.agg(F.max(value)).scalar() + F.lit(1e-8))


def row_priority(scored: DataFrame, q90_log: Column | None = None) -> DataFrame:
    """``priority_score`` per row. Without ``q90_log`` the observed peak stands in for the forecast, as the published
    ranking does; pass a forecast column to rank without looking at the outcome."""
    q90_log = F.log1p("peak_customers_out") if q90_log is None else q90_log
    customers = F.expm1(F.greatest(F.lit(0.0), F.least(F.lit(20.0), q90_log)))
    return scored.withColumn(
        "priority_score", F.col("outage_proba") * customers * (1 + share_of_max(scored, "county_p90"))
    )


def county_priority(scored: DataFrame) -> DataFrame:
    """One row per county with means, maxima, counts, rate and rank by greatest score."""
    first_state = F.min(F.when(F.col("state").isNotNull(), F.struct("hour", "state")))
    counties = scored.groupBy("fips").agg(
        F.avg("outage_proba").alias("mean_outage_proba"),
        F.max("outage_proba").alias("max_outage_proba"),
        F.avg("priority_score").alias("mean_priority_score"),
        F.max("priority_score").alias("max_priority_score"),
        F.max("peak_customers_out").alias("peak_customers_out"),
        F.sum("outage_label").alias("outage_events"),
        F.count("outage_label").alias("total_hours"),
        first_state["state"].alias("state"),
    ).withColumn("outage_rate", F.col("outage_events") / F.col("total_hours"))
    # Ranking reads its input more than once, and scoring may be costly: store the one row per county first.
    return rank_within(keep(counties), [], [-F.col("max_priority_score"), F.col("fips")])


def top_counties(priority: DataFrame, n: int = 10) -> DataFrame:
    return priority.orderBy(F.desc("max_priority_score"), "fips").limit(n).select(
        "rank", "fips", "state", "max_outage_proba", "peak_customers_out", "max_priority_score"
    )


def with_state(priority: DataFrame) -> DataFrame:
    padded = codes.pad_fips(F.col("fips"))
    return priority.withColumns(
        {"fips_str": padded, "state_fips": F.substring(padded, 1, 2), "state_abbr": codes.state_abbr(padded)}
    )


def scenario(
    priority: DataFrame,
    storm: str = "No Active Storm",
    horizon_h: int = 24,
    weights: tuple[float, float, float] = fixed.PRIORITY_WEIGHTS,
) -> DataFrame:
    """Scenario probability, priority and tier of every county. The customer maximum is that of all counties."""
    factor = fixed.STORM_MULTIPLIERS[storm]
    decay = fixed.HORIZON_DECAY[horizon_h]
    w_proba, w_impact, w_rate = weights
    proba = F.least(F.lit(fixed.PROBABILITY_CAP), F.col("max_outage_proba") * factor * decay)
    score = (
        w_proba * F.col("scenario_proba")
        + w_impact * share_of_max(priority, "peak_customers_out")
        + w_rate * F.col("outage_rate")
    )
    return (
        with_state(priority)
        .withColumn("scenario_proba", proba)
        .withColumns(
            {
                "priority_score": F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)),
                "risk_label": codes.risk_tier(F.col("scenario_proba")),
                "risk_colour": codes.risk_colour(F.col("scenario_proba")),
            }
        )
    )


def priority_queue(scen: DataFrame, states: list[str] = (), k: int = 50) -> DataFrame:
    """The first ``k`` counties by priority, of the given states or of all."""
    chosen = scen.where(F.col("state_abbr").isin(list(states))) if states else scen
    return chosen.orderBy(F.desc("priority_score"), "fips").limit(k)


def queue_table(queue: DataFrame) -> DataFrame:
    """A queue under its display names with a 1-based index. A queue is at most its ``k`` rows long."""
    place = F.row_number().over(Window.orderBy(F.desc("priority_score"), "fips"))
    return queue.select(place.alias("index"), *[F.col(c).alias(n) for c, n in QUEUE_NAMES.items()])


def top_by_probability(scen: DataFrame, n: int = 200) -> DataFrame:
    return scen.orderBy(F.desc("max_outage_proba"), "fips").limit(n).withColumn(
        "label", codes.county_label(F.col("fips_str"), F.col("state_abbr"), F.col("scenario_proba"))
    )


def risk_mix(scen: DataFrame) -> DataFrame:
    return scen.groupBy("risk_label").agg(F.count(F.lit(1)).alias("counties")).orderBy(F.desc("counties"), "risk_label")


def state_mix(queue: DataFrame, n: int = 10) -> DataFrame:
    counts = queue.groupBy("state_abbr").agg(F.count(F.lit(1)).alias("counties"))
    return counts.orderBy(F.desc("counties"), "state_abbr").limit(n)


def state_mean_risk(scen: DataFrame, n: int = 8) -> DataFrame:
    means = scen.where(F.col("state_abbr") != "?").groupBy("state_abbr").agg(
        F.avg("scenario_proba").alias("mean_proba")
    )
    return means.orderBy(F.desc("mean_proba"), "state_abbr").limit(n)


def kpi_row(scen: DataFrame) -> DataFrame:
    p = F.col("scenario_proba")
    return scen.agg(
        F.count_if(p >= 0.85).alias("critical_counties"),
        F.count_if((p >= 0.65) & (p < 0.85)).alias("high_counties"),
        F.sum("peak_customers_out").alias("customers_at_risk"),
    )


def score_quantile(scen: DataFrame, q: float = 0.97) -> DataFrame:
    return exact_quantiles(scen, [], "priority_score", {"score_quantile": q})


def score_histogram(queue: DataFrame, bins: int = 20, value: str = "priority_score") -> DataFrame:
    """Equal-width bins over the range of the data, the largest value in the last bin."""
    ends = queue.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    spread = queue.select(value, ends.alias("e")).select(
        F.col("e.lo").alias("lo"), ((F.col("e.hi") - F.col("e.lo")) / bins).alias("width"), F.col(value).alias("x")
    )
    at = F.floor((F.col("x") - F.col("lo")) / F.nullif("width", F.lit(0.0)))
    binned = spread.withColumn("bin", F.least(F.lit(bins - 1), F.coalesce(at, F.lit(0))).cast("int"))
    return binned.groupBy("bin").agg(
        F.count(F.lit(1)).alias("counties"), F.max(F.col("lo") + F.col("bin") * F.col("width")).alias("from_score")
    )


def dispatch_total(queue: DataFrame, n: int = 10) -> DataFrame:
    return priority_queue(queue, k=n).agg(F.sum("peak_customers_out").alias("dispatch_customers"))


def risk_profile(scen: DataFrame) -> DataFrame:
    """Risk for each of the next 24 hours: a slow wave times the decay of the nearest horizon."""
    h = F.col("hour_ahead")
    decay = (
        F.when(h <= 4, fixed.HORIZON_DECAY[3]).when(h <= 9, fixed.HORIZON_DECAY[6])
        .when(h <= 18, fixed.HORIZON_DECAY[12]).otherwise(fixed.HORIZON_DECAY[24])
    )
    risk = F.col("scenario_proba") * (1 + 0.1 * F.sin(h / 4)) * decay
    return scen.select("fips", "scenario_proba", F.explode(F.sequence(F.lit(1), F.lit(24))).alias("hour_ahead")).select(
        "fips", "hour_ahead", F.least(F.lit(fixed.PROBABILITY_CAP), risk).alias("risk")
    )


def county_lookup(scen: DataFrame, fips_str: list[str]) -> DataFrame:
    """The rows of one or two counties to show side by side; none if unknown."""
    return scen.where(F.col("fips_str").isin(fips_str))


def retrospective(scen: DataFrame, n: int = 5) -> DataFrame:
    return queue_table(priority_queue(scen, k=n)).select(
        F.col("index").alias("rank"), "FIPS", "State", "P(Outage)", "Peak Customers", "Priority Score"
    )
