"""Queries of the county half: observations, storms, features, splits and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.operators import audit, features, outages, sampling, storms
from outagegrid.plans.catalog import CTES, as_bigint, observations, query, rounded
from outagegrid.plans.feature_store import feature_store as build_feature_store
from outagegrid.plans.feature_store import labelled_hours
from outagegrid.plans.views import frame

THRESHOLD_PERIODS = [1, 2]
GROUP_SQL = ", ".join(fixed.GROUPS)

CTES["c_clean"] = """
SELECT CAST(fips_code AS VARCHAR) AS fips, state, run_start_time AS ts, date_trunc('hour', run_start_time) AS hour,
       period AS year, greatest(coalesce(customers_raw, 0e0), 0e0) AS customers_out,
       CASE WHEN customers_raw IS NULL THEN 1 ELSE 0 END AS null_flag
FROM v_obs WHERE state IS NULL OR state NOT IN ('AS', 'GU', 'PR', 'VI', 'MP')"""
CTES["c_hourly"] = """
SELECT fips, hour, max(year) AS year, max(customers_out) AS peak_customers_out, avg(customers_out) AS mean_customers_out,
       CAST(sum(null_flag) AS BIGINT) AS null_count, arg_min(state, ts) FILTER (state IS NOT NULL) AS state
FROM c_clean GROUP BY fips, hour"""
CTES["c_stats"] = """
SELECT fips, quantile_cont(customers_out, 0.9) AS county_p90, avg(customers_out) AS county_mean_baseline
FROM c_clean WHERE year IN (1, 2) GROUP BY fips"""
CTES["c_storm_clean"] = """
SELECT CAST(state_fips * 1000 + cz_fips AS VARCHAR) AS fips,
       CASE WHEN event_type IN ('Thunderstorm Wind', 'High Wind', 'Strong Wind', 'Tornado') THEN 'wind'
            WHEN event_type IN ('Winter Storm', 'Winter Weather', 'Ice Storm', 'Heavy Snow', 'Blizzard', 'Sleet') THEN 'winter'
            WHEN event_type IN ('Flash Flood', 'Flood', 'Heavy Rain') THEN 'flood'
            WHEN event_type IN ('Hurricane (Typhoon)', 'Tropical Storm') THEN 'tropical' ELSE 'other' END AS event_group,
       begin_ts, end_ts, period
FROM v_storm
WHERE cz_type = 'C' AND begin_ts IS NOT NULL AND event_type IN (
  'Thunderstorm Wind', 'High Wind', 'Strong Wind', 'Tornado', 'Winter Storm', 'Winter Weather', 'Ice Storm',
  'Heavy Snow', 'Blizzard', 'Sleet', 'Flash Flood', 'Flood', 'Heavy Rain', 'Hurricane (Typhoon)', 'Tropical Storm',
  'Extreme Cold/Wind Chill', 'Cold/Wind Chill', 'Lightning', 'Dense Fog', 'Freezing Fog')"""
CTES["c_storm_span"] = """
SELECT fips, event_group, date_trunc('hour', begin_ts) AS h0,
       CASE WHEN coalesce(end_ts, begin_ts + INTERVAL '3' HOUR) = date_trunc('hour', coalesce(end_ts, begin_ts + INTERVAL '3' HOUR))
            THEN coalesce(end_ts, begin_ts + INTERVAL '3' HOUR)
            ELSE date_trunc('hour', coalesce(end_ts, begin_ts + INTERVAL '3' HOUR)) + INTERVAL '1' HOUR END AS h1
FROM c_storm_clean"""
CTES["c_storm_hours"] = """
SELECT fips, h0 + INTERVAL '1' HOUR * CAST(i AS INT) AS hour, event_group
FROM (SELECT *, unnest(range(0, greatest(1, least(72, date_diff('hour', h0, h1))))) AS i FROM c_storm_span)"""
CTES["c_pivot"] = """
SELECT *, CASE WHEN wind + winter + flood + tropical + other > 0 THEN 1 ELSE 0 END AS any_storm,
       least(10, 3 * wind + 5 * tropical + 2 * winter + 2 * flood + other) AS storm_severity
FROM (SELECT fips, hour, count(*) FILTER (event_group = 'wind') AS wind, count(*) FILTER (event_group = 'winter') AS winter,
             count(*) FILTER (event_group = 'flood') AS flood, count(*) FILTER (event_group = 'tropical') AS tropical,
             count(*) FILTER (event_group = 'other') AS other
      FROM c_storm_hours GROUP BY fips, hour)"""
CTES["c_labelled"] = """
SELECT *, CASE WHEN peak_customers_out > county_p90 AND peak_customers_out > 10 THEN 1 ELSE 0 END AS outage_label,
       ln(1 + peak_customers_out) AS log_peak_customers
FROM (SELECT h.*, coalesce(s.county_p90, 50e0) AS county_p90, coalesce(s.county_mean_baseline, 0e0) AS county_mean_baseline
      FROM c_hourly h LEFT JOIN c_stats s USING (fips))"""
CTES["c_stormy"] = """
SELECT l.*, coalesce(p.wind, 0) AS wind, coalesce(p.winter, 0) AS winter, coalesce(p.flood, 0) AS flood,
       coalesce(p.tropical, 0) AS tropical, coalesce(p.other, 0) AS other, coalesce(p.any_storm, 0) AS any_storm,
       coalesce(p.storm_severity, 0) AS storm_severity
FROM c_labelled l LEFT JOIN c_pivot p USING (fips, hour)"""
CTES["c_features"] = """
SELECT *, extract(hour FROM hour) AS hour_of_day, extract(month FROM hour) AS month,
       extract(isodow FROM hour) - 1 AS dayofweek, CASE WHEN extract(isodow FROM hour) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       extract(quarter FROM hour) AS quarter, extract(doy FROM hour) AS day_of_year,
       sin(2 * pi() * extract(hour FROM hour) / 24) AS hour_sin, cos(2 * pi() * extract(hour FROM hour) / 24) AS hour_cos,
       sin(2 * pi() * extract(month FROM hour) / 12) AS month_sin, cos(2 * pi() * extract(month FROM hour) / 12) AS month_cos,
       lag(peak_customers_out, 1, 0e0) OVER w AS lag_1h_peak, lag(peak_customers_out, 24, 0e0) OVER w AS lag_24h_peak,
       lag(peak_customers_out, 168, 0e0) OVER w AS lag_168h_peak, lag(outage_label, 24, 0) OVER w AS lag_24h_label,
       lag(outage_label, 168, 0) OVER w AS lag_168h_label,
       CAST(sum(wind) OVER w6 AS BIGINT) AS wind_sum_6h, CAST(sum(wind) OVER w12 AS BIGINT) AS wind_sum_12h,
       CAST(sum(wind) OVER w24 AS BIGINT) AS wind_sum_24h, CAST(sum(any_storm) OVER w6 AS BIGINT) AS any_storm_sum_6h,
       CAST(sum(any_storm) OVER w12 AS BIGINT) AS any_storm_sum_12h, CAST(sum(any_storm) OVER w24 AS BIGINT) AS any_storm_sum_24h,
       CASE WHEN count(outage_label) OVER wf >= 24 THEN avg(outage_label) OVER wf ELSE 0e0 END AS county_fragility
FROM c_stormy
WINDOW w AS (PARTITION BY fips, year ORDER BY hour),
       w6 AS (PARTITION BY fips, year ORDER BY hour ROWS BETWEEN 5 PRECEDING AND CURRENT ROW),
       w12 AS (PARTITION BY fips, year ORDER BY hour ROWS BETWEEN 11 PRECEDING AND CURRENT ROW),
       w24 AS (PARTITION BY fips, year ORDER BY hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW),
       wf AS (PARTITION BY fips, year ORDER BY hour ROWS BETWEEN 720 PRECEDING AND 1 PRECEDING)"""

MEASURES = "round(peak_customers_out, 9) AS peak_customers_out"


def _clean(spark, folder):
    return outages.clean_observations(observations(spark, folder), "period")


def _storm_events(spark, folder):
    return frame(spark, folder, "v_storm")


def _labelled(spark, folder):
    return labelled_hours(observations(spark, folder), THRESHOLD_PERIODS, "period")


def _stormy(spark, folder):
    return storms.join_storms(_labelled(spark, folder), storms.storm_pivot(_storm_events(spark, folder)))


@query("SELECT fips, state, ts, hour, year, customers_out, null_flag FROM c_clean")
def observations_clean(spark, folder):
    return _clean(spark, folder)


@query(
    "SELECT fips, hour, year, peak_customers_out, round(mean_customers_out, 9) AS mean_customers_out, null_count, state "
    "FROM c_hourly"
)
def hourly_rollup(spark, folder):
    return rounded(outages.hourly_rollup(_clean(spark, folder)), mean_customers_out=9)


@query(
    "SELECT fips, round(county_p90, 9) AS county_p90, round(county_mean_baseline, 9) AS county_mean_baseline FROM c_stats"
)
def county_stats(spark, folder):
    clean = _clean(spark, folder)
    stats = outages.county_stats(clean.where(F.col("year").isin(THRESHOLD_PERIODS)))
    return rounded(stats, county_p90=9, county_mean_baseline=9)


@query("SELECT DISTINCT fips FROM c_clean")
def distinct_counties(spark, folder):
    return outages.distinct_counties(_clean(spark, folder))


@query(
    "SELECT fips, hour, year, state, peak_customers_out, round(mean_customers_out, 9) AS mean_customers_out, null_count, "
    "round(county_p90, 9) AS county_p90, round(county_mean_baseline, 9) AS county_mean_baseline, outage_label, "
    "round(log_peak_customers, 9) AS log_peak_customers FROM c_labelled"
)
def outage_labels(spark, folder):
    return rounded(
        _labelled(spark, folder), mean_customers_out=9, county_p90=9, county_mean_baseline=9, log_peak_customers=9
    )


@query(
    "SELECT fips, count(outage_label) AS total_rows, round(avg(outage_label) * 100, 9) AS outage_rate_pct "
    "FROM c_labelled GROUP BY fips"
)
def hourly_outage_labels(spark, folder):
    return rounded(outages.outage_rates(_labelled(spark, folder), ["fips"]), outage_rate_pct=9)


@query(
    "SELECT year, count(outage_label) AS total_rows, round(avg(outage_label) * 100, 9) AS outage_rate_pct "
    "FROM c_labelled GROUP BY year"
)
def outage_rate_by_year(spark, folder):
    return rounded(outages.outage_rates(_labelled(spark, folder), ["year"]), outage_rate_pct=9)


@query("SELECT fips, event_group, begin_ts, end_ts FROM c_storm_clean")
def storm_events_clean(spark, folder):
    return storms.clean_storms(_storm_events(spark, folder))


@query(
    "SELECT event_id, date_trunc('second', begin_ts) AS begin_ts, date_trunc('second', end_ts) AS end_ts FROM v_storm"
)
def storm_clock_text(spark, folder):
    """Stamps written as storm-file text (day without leading zero for every other event) and parsed again."""
    events = _storm_events(spark, folder)

    def text(c):
        return F.upper(
            F.when(F.col("event_id") % 2 == 0, F.date_format(c, "d-MMM-yy HH:mm:ss"))
            .otherwise(F.date_format(c, "dd-MMM-yy HH:mm:ss"))
        )

    written = events.select(
        "event_id", text("begin_ts").alias("BEGIN_DATE_TIME"), text("end_ts").alias("END_DATE_TIME")
    )
    return storms.parse_event_clock(written).select("event_id", "begin_ts", "end_ts")


@query("SELECT period AS year, count(*) AS events FROM c_storm_clean GROUP BY period")
def event_counts_by_year(spark, folder):
    events = _storm_events(spark, folder)
    return storms.event_counts(storms.clean_storms(events, keep=["period"]), "period").withColumnRenamed("period", "year")


@query("SELECT fips, hour, event_group FROM c_storm_hours")
def storm_hours(spark, folder):
    return storms.expand_hours(storms.clean_storms(_storm_events(spark, folder)))


@query(f"SELECT fips, hour, {GROUP_SQL}, any_storm, storm_severity FROM c_pivot")
def storm_pivot(spark, folder):
    return storms.storm_pivot(_storm_events(spark, folder))


@query(
    "SELECT storm_severity, any_storm, count(*) AS county_hours FROM c_pivot GROUP BY storm_severity, any_storm"
)
def storm_severity(spark, folder):
    pivot = storms.storm_pivot(_storm_events(spark, folder))
    return pivot.groupBy("storm_severity", "any_storm").agg(F.count(F.lit(1)).alias("county_hours"))


@query(f"SELECT fips, hour, year, peak_customers_out, outage_label, {GROUP_SQL}, any_storm, storm_severity FROM c_stormy")
def hourly_with_storms(spark, folder):
    return _stormy(spark, folder).select(
        "fips", "hour", "year", "peak_customers_out", "outage_label", *fixed.GROUPS, "any_storm", "storm_severity"
    )


CALENDAR = ["hour_of_day", "month", "dayofweek", "is_weekend", "quarter", "day_of_year"]
CYCLE = ["hour_sin", "hour_cos", "month_sin", "month_cos"]


@query(
    "SELECT fips, hour, " + ", ".join(f"CAST({c} AS INT) AS {c}" for c in CALENDAR) + ", "
    + ", ".join(f"round({c}, 9) AS {c}" for c in CYCLE) + " FROM c_features"
)
def calendar_features(spark, folder):
    df = features.calendar_features(outages.hourly_rollup(_clean(spark, folder)))
    return rounded(df.select("fips", "hour", *CALENDAR, *CYCLE), **dict.fromkeys(CYCLE, 9))


LAGS = ["lag_1h_peak", "lag_24h_peak", "lag_168h_peak", "lag_24h_label", "lag_168h_label"]


@query("SELECT fips, hour, year, " + ", ".join(LAGS) + " FROM c_features")
def lag_features(spark, folder):
    return features.lag_features(_labelled(spark, folder)).select("fips", "hour", "year", *LAGS)


ROLLING = [f"{c}_sum_{n}h" for c in ("wind", "any_storm") for n in (6, 12, 24)]


@query("SELECT fips, hour, year, " + ", ".join(ROLLING) + " FROM c_features")
def rolling_storm_sums(spark, folder):
    return features.rolling_storms(_stormy(spark, folder)).select("fips", "hour", "year", *ROLLING)


@query("SELECT fips, hour, year, round(county_fragility, 9) AS county_fragility FROM c_features")
def county_fragility(spark, folder):
    df = features.fragility(_labelled(spark, folder)).select("fips", "hour", "year", "county_fragility")
    return rounded(df, county_fragility=9)


REAL_FEATURES = [*CYCLE, "lag_1h_peak", "lag_24h_peak", "lag_168h_peak", "county_fragility", "county_p90", "county_mean_baseline"]
WHOLE_FEATURES = [f for f in fixed.FEATURES if f not in REAL_FEATURES]


def _flagship(spark, folder):
    return build_feature_store(observations(spark, folder), _storm_events(spark, folder), THRESHOLD_PERIODS, "period")


@query(
    "SELECT fips, hour, year, state, outage_label, peak_customers_out, round(log_peak_customers, 9) AS log_peak_customers, "
    + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in WHOLE_FEATURES) + ", "
    + ", ".join(f"round({c}, 9) AS {c}" for c in REAL_FEATURES) + " FROM c_features"
)
def feature_store(spark, folder):
    df = as_bigint(_flagship(spark, folder), *WHOLE_FEATURES)
    return rounded(df, log_peak_customers=9, **dict.fromkeys(REAL_FEATURES, 9))


SPLIT = {"train": [1, 2], "validation": [3], "test": [4]}
CTES["c_split"] = """
SELECT *, CASE WHEN year IN (1, 2) THEN 'train' WHEN year = 3 THEN 'val' ELSE 'test' END AS split FROM c_labelled"""


def _split(spark, folder):
    return sampling.assign_split(_labelled(spark, folder), **SPLIT)


@query(
    "SELECT split, count(outage_label) AS total_rows, round(avg(outage_label) * 100, 9) AS outage_rate_pct "
    "FROM c_split GROUP BY split"
)
def split_rates(spark, folder):
    return rounded(outages.outage_rates(_split(spark, folder), ["split"]), outage_rate_pct=9)


# Samples in the queries follow an order that SQL can state as well; the default order is a seeded hash.
HOUR_NUMBER = "(CAST(epoch(hour) AS BIGINT) // 3600)"
MIXED_SQL = f"(({HOUR_NUMBER} * 7919 + CAST(fips AS BIGINT) * 104729) % 1000003)"


def _mixed_order():
    hours = F.floor(F.unix_seconds(F.col("hour").cast("timestamp")) / 3600)
    return [(hours * 7919 + F.col("fips").cast("bigint") * 104729) % 1000003, F.col("fips"), F.col("hour")]


def _mixed_digit():
    """The leading part of the mixed order, some thousands of values."""
    return F.floor(_mixed_order()[0] / 256)


@query(
    f"""SELECT fips, hour, year, outage_label FROM (
  SELECT *, row_number() OVER (PARTITION BY year, outage_label ORDER BY {MIXED_SQL}, fips, hour) AS rn,
         count(*) FILTER (outage_label = 1) OVER (PARTITION BY year) AS positives FROM c_labelled)
WHERE outage_label = 1 OR rn <= 4 * positives"""
)
def negative_downsample(spark, folder):
    kept = sampling.negative_downsample(_labelled(spark, folder), order=_mixed_order(), digit=_mixed_digit())
    return kept.select("fips", "hour", "year", "outage_label")


@query(
    f"""SELECT fips, hour, outage_label FROM (
  SELECT *, row_number() OVER (PARTITION BY outage_label ORDER BY {MIXED_SQL}, fips, hour) AS rn,
         count(*) FILTER (outage_label = 1) OVER () AS positives FROM c_labelled)
WHERE rn <= least(150000, positives)"""
)
def balanced_sample(spark, folder):
    kept = sampling.balanced_sample(_labelled(spark, folder), order=_mixed_order(), digit=_mixed_digit())
    return kept.select("fips", "hour", "outage_label")


@query(f"SELECT fips, hour, outage_label FROM c_labelled ORDER BY {MIXED_SQL}, fips, hour LIMIT 1000")
def uniform_sample(spark, folder):
    return sampling.uniform_sample(_labelled(spark, folder), 1000, order=_mixed_order(), digit=_mixed_digit()).select(
        "fips", "hour", "outage_label"
    )


@query(
    """SELECT fips, hour, outage_label FROM c_labelled WHERE fips IN (
  SELECT fips FROM (SELECT DISTINCT fips FROM c_labelled) ORDER BY (CAST(fips AS BIGINT) * 7919) % 10007, fips LIMIT 4)"""
)
def county_sample(spark, folder):
    order = [(F.col("fips").cast("bigint") * 7919) % 10007, F.col("fips")]
    return sampling.county_sample(_labelled(spark, folder), 4, order=order).select("fips", "hour", "outage_label")


@query(
    """SELECT fips, hour, outage_label AS y_cls, round(log_peak_customers, 9) AS y_reg, CAST(24 AS INT) AS steps,
       p24 AS oldest_peak_lag, p1 AS newest_peak_lag, CAST(storms AS BIGINT) AS storm_hours
FROM (SELECT *, count(*) OVER w AS steps, lag(lag_1h_peak, 24) OVER o AS p24, lag(lag_1h_peak, 1) OVER o AS p1,
             sum(any_storm) OVER w AS storms
      FROM c_features
      WINDOW o AS (PARTITION BY fips ORDER BY hour),
             w AS (PARTITION BY fips ORDER BY hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
WHERE steps = 24"""
)
def sequence_windows(spark, folder):
    """The 24 x 28 windows, shown through their shape, two corner values and the sum of one feature."""
    lag, storm = fixed.FEATURES.index("lag_1h_peak"), fixed.FEATURES.index("any_storm")
    windows = features.sequence_windows(_flagship(spark, folder))
    return windows.select(
        "fips", "hour", "y_cls", F.round("y_reg", 9).alias("y_reg"), F.size("x").alias("steps"),
        F.col("x")[0][lag].alias("oldest_peak_lag"), F.col("x")[23][lag].alias("newest_peak_lag"),
        F.aggregate("x", F.lit(0.0), lambda s, row: s + row[storm]).cast("bigint").alias("storm_hours"),
    )


AUDIT_SQL = """count(*) AS total_rows, count(DISTINCT fips_code) AS counties, min(run_start_time) AS first_report,
       max(run_start_time) AS last_report, count(*) FILTER (customers_raw IS NULL) AS null_sum,
       count(*) FILTER (customers_raw > 0) AS positive_sum,
       round(count(*) FILTER (customers_raw > 0) * 1e2 / count(*), 9) AS positive_pct, max(customers_raw) AS max_sum"""


@query(f"SELECT period, {AUDIT_SQL} FROM v_obs GROUP BY period")
def audit_outages(spark, folder):
    return rounded(audit.audit_outages(observations(spark, folder), ["period"]), positive_pct=9)


@query(f"SELECT {AUDIT_SQL} FROM v_obs")
def audit_outages_total(spark, folder):
    return rounded(audit.audit_outages(observations(spark, folder), []), positive_pct=9)


@query(
    """SELECT period, count(*) AS total_rows, count(DISTINCT event_type) AS event_types,
       count(*) FILTER (cz_type = 'C') AS county_zones, count(*) FILTER (cz_type = 'Z') AS forecast_zones,
       count(*) FILTER (state_fips IS NULL) AS null_state_fips, count(*) FILTER (cz_fips IS NULL) AS null_cz_fips
FROM v_storm GROUP BY period"""
)
def audit_storms(spark, folder):
    profile = audit.audit_storms(_storm_events(spark, folder), "period")
    zone = {n: F.try_element_at("cz_counts", F.lit(z)).alias(n) for z, n in (("C", "county_zones"), ("Z", "forecast_zones"))}
    return profile.select(
        "period", "total_rows", "event_types", *zone.values(), "null_state_fips", "null_cz_fips"
    )


@query(
    """SELECT (SELECT count(*) FROM v_obs) AS total_reports, (SELECT count(DISTINCT fips_code) FROM v_obs) AS total_counties,
       (SELECT count(*) FROM v_storm) AS total_events, (SELECT count(DISTINCT state) FROM v_storm) AS total_states"""
)
def audit_totals(spark, folder):
    return audit.audit_totals(observations(spark, folder), _storm_events(spark, folder))


@query("SELECT event_type, count(*) AS events FROM v_storm GROUP BY event_type ORDER BY events DESC, event_type LIMIT 15")
def top_event_types(spark, folder):
    return audit.top_event_types(_storm_events(spark, folder))
