"""Inputs that come in several documents, headers, names or without keys."""

import json

from pyspark.sql import functions as F

from outagegrid.operators import alerts, audit, outages, storms
from outagegrid.plans import catalog_scoring  # noqa: F401
from outagegrid.sources import files, geojson

LINES = [((40.0, -73.0), (40.1, -73.1)), ((41.5, -74.0), (41.6, -74.1))]


def feature(kind, coordinates, **properties):
    return {"properties": properties, "geometry": {"type": kind, "coordinates": coordinates}}


def document(features):
    return (json.dumps({"features": features}),)


def test_feature_numbers_run_over_documents(spark):
    lines = [feature("LineString", [[b, a] for a, b in ends]) for ends in LINES]
    whole = spark.createDataFrame([document(lines)], "value string")
    split = spark.createDataFrame([document(lines[:1]), document(lines[1:]), document([]), ("{}",)], "value string")
    for documents in (whole, split):
        rows = geojson.line_rows(documents).collect()
        assert sorted(r.line_id for r in rows) == [0, 1]
        assert {((r.lat0, r.lon0), (r.lat1, r.lon1)) for r in rows} == set(LINES)
    subs = [feature("Point", [-73.0 - k, 40.0], name=f"s{k}") for k in range(5)]
    rows = geojson.substation_rows(spark.createDataFrame([document(subs[:2]), document(subs[2:])], "value string")).collect()
    assert len({r.node_id for r in rows}) == len({r.ord for r in rows}) == 5


def test_columns_go_by_each_files_header(spark, tmp_path):
    from outagegrid import fixed

    name = fixed.OUTAGE_FILES.replace("*", "{}")
    (tmp_path / name.format("2018")).write_text("fips_code,county,state,sum,run_start_time\n1001,A,AL,7,2018-01-01 00:00:00\n")
    (tmp_path / name.format("2019")).write_text("state,sum,fips_code,run_start_time,county\nAL,1003,7,2019-01-01 00:00:00,B\n")
    rows = files.scan_outage_csv(spark, str(tmp_path)).collect()
    assert sorted((r.fips_code, r.sum, r.state) for r in rows) == [(7, 1003.0, "AL"), (1001, 7.0, "AL")]


def test_rollup_takes_the_first_state_by_time_then_name(spark):
    rows = [
        ("1", "2020-01-01 00:15:00", "B", 1.0), ("1", "2020-01-01 00:15:00", "A", 3.0), ("1", "2020-01-01 00:00:00", None, 5.0),
        ("1", "2020-01-01 01:30:00", "A", 2.0), ("1", "2020-01-01 01:00:00", "Z", 4.0), ("2", "2020-01-01 00:00:00", None, 6.0),
    ]
    clean = spark.createDataFrame(rows, "fips string, ts string, state string, customers_out double").select(
        "fips", "state", F.to_timestamp_ntz("ts").alias("ts"), F.date_trunc("hour", F.to_timestamp("ts")).cast("timestamp_ntz").alias("hour"),
        F.lit(2020).alias("year"), "customers_out", F.lit(0).alias("null_flag"),
    )
    got = {(r.fips, r.hour.hour): (r.state, r.peak_customers_out, r.mean_customers_out) for r in outages.hourly_rollup(clean).collect()}
    assert got == {("1", 0): ("A", 5.0, 3.0), ("1", 1): ("Z", 4.0, 3.0), ("2", 0): (None, 6.0, 6.0)}


def test_audits_keep_groups_without_a_year(spark):
    obs = spark.createDataFrame(
        [(1, 2.0, "a", 2018), (1, None, "b", 2018), (2, 0.0, "c", None)], "fips_code int, sum double, run_start_time string, year int"
    )
    got = {r.year: (r.total_rows, r.counties, r.null_sum, r.positive_sum) for r in audit.audit_outages(obs, ["year"]).collect()}
    assert got == {2018: (2, 1, 1, 1), None: (1, 1, 0, 0)}
    assert audit.audit_outages(obs, []).first().counties == 2
    assert audit.audit_outages(obs.where("false"), []).first().total_rows == 0
    events = spark.createDataFrame(
        [("C", "x", 1, 1, 2018), ("C", "y", None, 1, 2018), ("Z", "x", 1, None, None), (None, None, 1, 1, None)],
        "cz_type string, event_type string, state_fips int, cz_fips int, year int",
    )
    got = {r.year: (r.total_rows, r.event_types, r.cz_counts, r.null_state_fips, r.null_cz_fips) for r in audit.audit_storms(events).collect()}
    assert got == {2018: (2, 2, {"C": 2}, 1, 0), None: (2, 1, {"Z": 1}, 0, 1)}


def test_storms_without_a_county_code_are_left_to_the_audit(spark):
    events = spark.sql(
        "SELECT 'C' AS cz_type, 'Tornado' AS event_type, timestamp_ntz'2020-01-01 00:00:00' AS begin_ts, "
        "timestamp_ntz'2020-01-05 00:00:00' AS end_ts, s AS state_fips, 1 AS cz_fips FROM VALUES (1), (CAST(NULL AS INT)) AS t(s)"
    )
    clean = storms.clean_storms(events)
    assert [r.fips for r in clean.collect()] == ["1001"]
    assert storms.expand_hours(clean).count() == 72 and storms.expand_hours(clean, cap_hours=None).count() == 96


def test_feeders_of_one_name_are_two(spark):
    rows = [("sub_1", "Elm", "hospital", 1, 0.9), ("sub_2", "Elm", "school", 1, 0.8), ("sub_2", "Elm", "school", 1, 0.8)]
    df = spark.createDataFrame(
        rows, "feeding_substation_id string, feeding_substation string, facility_type string, hop_distance int, substation_risk double"
    )
    got = {r.feeding_substation_id: r.facilities for r in alerts.shared_feeders(df).collect()}
    assert got == {"sub_1": 1, "sub_2": 2}
