"""Edge cases of observations, storms and county features on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.functions import codes, timing
from outagegrid.operators import audit, features, outages, storms
from outagegrid.plans.feature_store import feature_store


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def obs(spark):
    rows = [
        (1001, "AL", None, "2015-01-01 00:00:00", 2015),
        (1001, None, -5.0, "2015-01-01 00:15:00", 2015),
        (1001, "AL", 40.0, "2015-01-01 00:30:00", 2015),
        (1001, "AL", float("nan"), "2015-01-01 01:00:00", 2015),
        (72001, "PR", 99.0, "2015-01-01 00:00:00", 2015),
        (6001, None, 7.0, "2015-01-01 00:00:00", 2015),
    ]
    return spark.createDataFrame(rows, "fips_code int, state string, sum double, run_start_time string, year int")


def test_cleaning_rules(obs):
    rows = outages.clean_observations(obs).orderBy("fips", "ts").collect()
    assert [(r.fips, r.customers_out, r.null_flag) for r in rows] == [
        ("1001", 0.0, 1), ("1001", 0.0, 0), ("1001", 40.0, 0), ("1001", 0.0, 1), ("6001", 7.0, 0),
    ]


def test_rollup(obs):
    rows = {(r.fips, r.hour): r for r in outages.hourly_rollup(outages.clean_observations(obs)).collect()}
    first = rows["1001", at("2015-01-01 00:00:00")]
    assert (first.peak_customers_out, first.null_count, first.state) == (40.0, 1, "AL")
    assert first.mean_customers_out == pytest.approx(40 / 3)
    assert rows["6001", at("2015-01-01 00:00:00")].state is None


def test_label_needs_both_bounds_strictly(spark):
    hourly = spark.createDataFrame(
        [("a", 10.0), ("b", 11.0), ("c", 60.0), ("d", 50.0), ("e", 12.0)], "fips string, peak_customers_out double"
    )
    stats = spark.createDataFrame(
        [("a", 1.0, 1.0), ("b", 1.0, 1.0), ("e", 12.0, 1.0)],
        "fips string, county_p90 double, county_mean_baseline double",
    )
    got = {r.fips: (r.outage_label, r.county_p90) for r in outages.label_outages(hourly, stats).collect()}
    assert got == {"a": (0, 1.0), "b": (1, 1.0), "c": (1, 50.0), "d": (0, 50.0), "e": (0, 12.0)}


def test_approximate_thresholds_are_near(spark):
    clean = spark.range(1000).select(F.lit("a").alias("fips"), F.col("id").cast("double").alias("customers_out"))
    assert outages.county_stats(clean, approx=True).first().county_p90 == pytest.approx(899.1, abs=2)
    assert outages.county_stats(clean).first().county_p90 == pytest.approx(899.1)


def test_storm_text_clock(spark):
    texts = ["28-APR-15 13:05:00", "1-jan-16 0:05:00", "31-FEB-15 00:00:00", "nonsense", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(timing.parse_storm_ts(F.col("t")).alias("x"))
    assert [r.x for r in df.collect()] == [at("2015-04-28 13:05:00"), at("2016-01-01 00:05:00"), None, None, None]


def test_ceiling_of_a_full_hour_stays(spark):
    df = spark.createDataFrame([(at("2020-05-05 03:00:00"),), (at("2020-05-05 03:00:00.000001"),)], "t timestamp_ntz")
    assert [r.x for r in df.select(timing.ceil_hour(F.col("t")).alias("x")).collect()] == [
        at("2020-05-05 03:00:00"), at("2020-05-05 04:00:00"),
    ]


def event(begin, end, kind="Tornado", zone="C", county=1):
    return (zone, kind, at(begin), None if end is None else at(end), 1, county)


EVENTS = "cz_type string, event_type string, begin_ts timestamp_ntz, end_ts timestamp_ntz, state_fips int, cz_fips int"


@pytest.mark.parametrize(
    "end, hours",
    [
        (None, 4),  # open: three hours from 00:30 end at 03:30, so four started hours
        ("2015-01-01 00:30:00", 1),
        ("2014-12-31 20:00:00", 1),  # reversed
        ("2015-01-01 02:00:00", 2),  # end exclusive
        ("2015-02-01 00:00:00", 72),  # capped
    ],
)
def test_hour_expansion(spark, end, hours):
    df = spark.createDataFrame([event("2015-01-01 00:30:00", end)], EVENTS)
    rows = sorted(r.hour for r in storms.expand_hours(storms.clean_storms(df)).collect())
    assert len(rows) == hours
    assert rows == [at("2015-01-01 00:00:00") + dt.timedelta(hours=i) for i in range(hours)]


def test_pivot_counts_and_severity(spark):
    rows = [event("2015-01-01 00:00:00", "2015-01-01 01:00:00", k) for k in ("Tornado", "High Wind", "Tropical Storm")]
    rows += [
        event("2015-01-01 00:00:00", "2015-01-01 01:00:00", "Hail"),
        event("2015-01-01 00:00:00", "2015-01-01 01:00:00", "Flood", "Z"),
        event("2015-01-01 00:00:00", "2015-01-01 01:00:00", "Lightning", county=2),
    ]
    pivot = {r.fips: r.asDict() for r in storms.storm_pivot(spark.createDataFrame(rows, EVENTS)).collect()}
    assert pivot["1001"]["wind"] == 2 and pivot["1001"]["tropical"] == 1 and pivot["1001"]["flood"] == 0
    assert pivot["1001"]["storm_severity"] == 10 and pivot["1002"]["storm_severity"] == 1
    assert pivot["1002"]["any_storm"] == 1


def test_pivot_conserves_expanded_hours(spark):
    rows = [event(f"2015-01-{d:02d} 03:10:00", f"2015-01-{d + d % 3:02d} 07:00:00", county=1 + d % 2) for d in range(1, 25)]
    clean = storms.clean_storms(spark.createDataFrame(rows, EVENTS))
    hours = storms.expand_hours(clean)
    total = storms.storm_flags(hours).agg(F.sum(sum(F.col(g) for g in fixed.GROUPS))).first()[0]
    assert total == hours.count()
    events = spark.createDataFrame(rows, EVENTS)
    columns = ["fips", "hour", *fixed.GROUPS, "any_storm", "storm_severity"]
    expanded, marked = storms.storm_flags(hours).select(columns), storms.storm_pivot(events).select(columns)
    assert sorted(map(tuple, expanded.collect())) == sorted(map(tuple, marked.collect()))


@pytest.fixture(scope="module")
def long_county(spark):
    """800 hours of one county over a year's end: a label in every tenth hour."""
    start = F.lit("2015-12-20 00:00:00").cast("timestamp_ntz")
    hour = start + F.make_dt_interval(hours=F.col("id").cast("int"))
    return spark.range(800).select(
        F.lit("1001").alias("fips"), hour.alias("hour"), F.lit(2015).alias("year"),
        (F.col("id") % 10 == 0).cast("int").alias("outage_label"), F.col("id").cast("double").alias("peak_customers_out"),
        (F.col("id") % 2).alias("wind"), F.lit(1).alias("any_storm"), F.log1p("id").alias("log_peak_customers"), "id",
    )


def test_fragility_window(long_county):
    got = [r.county_fragility for r in features.fragility(long_county).orderBy("id").collect()]
    labels = [int(i % 10 == 0) for i in range(800)]
    for i in (0, 22, 23, 24, 25, 100, 719, 720, 721, 799):
        before = labels[max(0, i - 720):i]
        assert got[i] == pytest.approx(sum(before) / len(before) if len(before) >= 24 else 0.0)


def test_lags_and_rolling_restart_each_year(long_county):
    split = long_county.withColumn("year", F.when(F.col("id") < 400, 2015).otherwise(2016))
    rows = features.rolling_storms(features.lag_features(split)).orderBy("id").collect()
    assert rows[399].lag_1h_peak == 398 and rows[400].lag_1h_peak == 0 and rows[424].lag_24h_peak == 400
    assert rows[5].any_storm_sum_6h == 6 and rows[4].any_storm_sum_6h == 5 and rows[400].any_storm_sum_24h == 1
    assert rows[399].wind_sum_12h == 6 and rows[568].lag_168h_peak == 400 and rows[567].lag_168h_peak == 0


def test_sequences_skip_short_counties(long_county):
    short = long_county.where("id < 24").withColumn("fips", F.lit("2"))
    both = long_county.where("id < 30").unionByName(short)
    got = features.sequence_windows(both, ["peak_customers_out", "wind"]).orderBy("hour").collect()
    assert [r.fips for r in got] == ["1001"] * 6
    assert len(got[0].x) == 24 and got[0].x[0] == [0.0, 0.0] and got[0].x[23] == [23.0, 1.0]
    assert [r.y_cls for r in got] == [0, 0, 0, 0, 0, 0]


def test_missing_hours_can_be_filled(long_county):
    hourly = long_county.where("id % 3 = 0").select(
        "fips", "hour", "year", "peak_customers_out", F.lit(0.0).alias("mean_customers_out"), F.lit(0).alias("null_count")
    )
    assert features.fill_missing_hours(hourly).count() == 799


def test_calendar_days_count_from_monday(spark):
    df = spark.createDataFrame([(at("2024-01-01 00:00:00"),), (at("2024-01-07 00:00:00"),)], "hour timestamp_ntz")
    rows = features.calendar_features(df).collect()
    assert (rows[0].dayofweek, rows[0].is_weekend, rows[1].dayofweek, rows[1].is_weekend) == (0, 0, 6, 1)
    assert rows[0].month_sin == pytest.approx(0.5) and rows[0].day_of_year == 1


def test_feature_store_columns(spark, obs):
    events = spark.createDataFrame([event("2015-01-01 00:00:00", None)], EVENTS)
    store = feature_store(obs, events)
    assert store.columns == fixed.KEYS_AND_TARGETS + fixed.FEATURES and len(fixed.FEATURES) == 28
    first = store.where("fips = '1001'").orderBy("hour").first()
    assert first.wind == 1 and first.storm_severity == 3 and first.null_count == 1


def test_codes(spark):
    row = spark.range(1).select(
        codes.pad_fips(F.lit("1001")).alias("a"), codes.state_abbr(F.lit("01001")).alias("b"),
        codes.state_abbr(F.lit("43001")).alias("c"), codes.compose_fips(F.lit(1), F.lit(7)).alias("d"),
        codes.year_of_file(F.lit("eaglei_outages_2017.csv"), "outage").alias("e"),
        codes.year_of_file(F.lit("StormEvents_details-ftp_v1.0_d2016_c2020.csv"), "storm").alias("f"),
        codes.storm_multiplier("Hurricane Cat 5").alias("g"), codes.storm_multiplier("unheard of").alias("h"),
        codes.risk_tier(F.lit(0.85)).alias("i"), codes.risk_tier(F.lit(0.3999)).alias("j"),
        codes.action_tier(F.lit("hospital"), F.lit(0.85)).alias("k"),
        codes.action_tier(F.lit("school"), F.lit(0.76)).alias("l"), codes.voltage_class(F.lit("69;345")).alias("m"),
    ).first()
    assert tuple(row) == (
        "01001", "AL", "?", "1007", 2017, 2016, 5.5, 2.0, "CRITICAL", "LOW", "prepare", "consider_closing", "transmission",
    )


def test_audits_on_edge_rows(spark, obs):
    row = audit.audit_outages(obs.where("year = 2015").fillna(0.0, ["sum"]), ["year"]).first()
    assert row.total_rows == 6 and row.counties == 3
    empty = audit.audit_outages(obs.where("false"), ["year"])
    assert empty.count() == 0
