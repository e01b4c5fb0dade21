"""Files in and out, in fresh folders, and the stream."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from outagegrid.operators import alerts, outages, storms
from outagegrid.sources import files, geojson
from outagegrid.streaming import hourly


def texts(spark, *documents):
    rows = [(d if isinstance(d, str) else json.dumps(d),) for d in documents]
    return spark.createDataFrame(rows, "value string")


def test_outage_files(spark, tmp_path):
    (tmp_path / "eaglei_outages_2016.csv").write_text(
        "fips_code,county,state,sum,run_start_time\n1001,Autauga,AL,12.0,2016-01-01 00:00:00\n1003,Baldwin,AL,,2016-01-01 00:15:00\n"
    )
    (tmp_path / "eaglei_outages_2017.csv").write_text(
        "fips_code,county,state,sum,run_start_time\n1001,Autauga,AL,3,2017-01-01 00:00:00\n"
    )
    (tmp_path / "notes.csv").write_text("a,b\n1,2\n")
    df = files.scan_outage_csv(spark, str(tmp_path))
    rows = sorted(map(tuple, df.select("fips_code", "sum", "year").collect()), key=str)
    assert rows == [(1001, 12.0, 2016), (1001, 3.0, 2017), (1003, None, 2016)]
    assert outages.clean_observations(df).count() == 3
    out = str(tmp_path / "landed")
    files.land_parquet(df, out)
    files.land_parquet(df.where("year = 2017").withColumn("sum", F.lit(99.0)), out)  # replaces one year only
    back = files.scan_parquet(spark, out, ["fips_code", "sum", "year"])
    assert sorted(map(tuple, back.collect()), key=str) == [(1001, 12.0, 2016), (1001, 99.0, 2017), (1003, None, 2016)]
    assert files.scan_parquet(spark, out, ["sum"], [2014, 2017]).count() == 1
    assert [r.year for r in files.discover_years(spark, out, 2017).collect()] == [2017]


def test_storm_files(spark, tmp_path):
    (tmp_path / "StormEvents_details-ftp_v1.0_d2015_c20200101.csv").write_text(
        "STATE,CZ_TYPE,CZ_FIPS,STATE_FIPS,EVENT_TYPE,BEGIN_DATE_TIME,END_DATE_TIME,EPISODE_NARRATIVE\n"
        'ALABAMA,C,1,1,Tornado,28-APR-15 13:05:00,28-APR-15 14:05:00,"Said ""go"",\nthen left"\n'
        "ALABAMA,Z,1,1,Flood,bad,,x\n"
    )
    events = storms.parse_event_clock(files.scan_storm_csv(spark, str(tmp_path)))
    assert events.count() == 2 and events.select("year").distinct().first().year == 2015
    pivot = storms.storm_pivot(events)
    assert [(r.fips, r.wind) for r in pivot.orderBy("hour").collect()] == [("1001", 1), ("1001", 1)]


def test_pushdown_reaches_the_scan(spark, tmp_path):
    out = str(tmp_path / "p")
    files.land_parquet(spark.range(10).select("id", F.lit(2016).alias("year"), F.lit("x").alias("wide")), out)
    plan = files.scan_parquet(spark, out, ["id", "year"], [2016]).where("id > 3")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,3)]" in plan and "ReadSchema: struct<id:bigint>" in plan
    assert "PartitionFilters: [isnotnull(year" in plan


def test_fallback_chain(spark, tmp_path):
    (tmp_path / "subs.csv").write_text("name,voltage,lat,lon,subtype\nA,138,40.7,-73.5,transmission\nB,69,40.8,-73.4,\n")
    chain = (
        lambda: geojson.substation_rows(geojson.read_documents(spark, str(tmp_path / "none.geojson"))),
        lambda: files.read_substation_csv(spark, str(tmp_path / "subs.csv")),
    )
    rows = files.first_available(*chain).orderBy("ord").collect()
    assert [(r.node_id, r.name, r.voltage) for r in rows] == [("sub_0", "A", "138"), ("sub_1", "B", "69")]
    with pytest.raises(FileNotFoundError):
        files.first_available(chain[0])


def test_facilities_keep_row_numbers_and_properties(spark, tmp_path):
    (tmp_path / "hospitals.csv").write_text("name,beds,lat,lon\nH0,10,40.1,-73\nH1,,,\nH2,30,40.3,-73\n")
    (tmp_path / "schools.csv").write_text("name,lat,lon,county,enrollment\n")
    rows = files.read_facilities(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r.node_id, r.props.get("beds")) for r in rows] == [("hospital_0", "10"), ("hospital_2", "30")]
    empty = tmp_path / "nothing"
    empty.mkdir()
    assert files.read_facilities(spark, str(empty)) is None


def test_row_numbers_over_many_tasks(spark):
    df = spark.range(0, 1000, 1, 7)
    numbered = files.with_row_number(df)
    assert numbered.where("ord <> id").count() == 0 and numbered.count() == 1000


def test_service_responses(spark):
    page = {"features": [
        {"attributes": {"NAME": "H", "BEDS": 5, "LATITUDE": 40.5, "LONGITUDE": -73.5, "TRAUMA": None}},
        {"attributes": {"LATITUDE": 40.6, "LONGITUDE": -73.6}},
        {"attributes": {"NAME": "lost", "LATITUDE": None, "LONGITUDE": -73.6}},
        {},
    ]}
    rows = geojson.service_rows(texts(spark, page, {"features": []}, {}), "hospital").orderBy("lat").collect()
    assert [(r.name, r.beds, r.trauma, r.helipad) for r in rows] == [
        ("H", 5, None, "N"), ("Unknown", 0, "NOT AVAILABLE", "N"),
    ]
    assert geojson.service_rows(texts(spark, page), "school").columns == [
        "name", "city", "county", "enrollment", "lat", "lon",
    ]


def test_empty_map_responses(spark):
    empty = {"version": 0.6, "generator": "x", "elements": []}
    assert geojson.element_rows(texts(spark, *[empty] * 20)).count() == 0
    one = {"elements": [{"type": "node", "id": 7, "lat": 1.0, "lon": 2.0, "tags": {"power": "substation"}}]}
    assert geojson.element_rows(texts(spark, empty, one)).first().tags == {"power": "substation"}


def feature(kind, coordinates, **properties):
    geometry = None if kind is None else {"type": kind, "coordinates": coordinates}
    return {"type": "Feature", "properties": properties, "geometry": geometry}


def test_substation_shapes(spark):
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    hole = [[1, 0], [2, 0], [2, 2], [1, 2], [1, 0]]
    doc = {"features": [
        feature("Point", [3, 4], osmid=11, name="P", voltage="138000"),
        feature("Polygon", [square], name=None),
        feature(None, None, name="gone"),
        feature("Polygon", [square, hole]),
        feature("MultiPolygon", [[square], [[[10, 0], [12, 0], [12, 2], [10, 2], [10, 0]]]]),
        feature("LineString", [[0, 0], [2, 0], [2, 4]]),
    ]}
    rows = geojson.substation_rows(texts(spark, doc)).orderBy("ord").collect()
    assert [(r.node_id, r.lon, r.lat) for r in rows] == [
        ("sub_11", 3.0, 4.0), ("sub_1", 1.0, 1.0), ("sub_3", 0.5, 1.0), ("sub_4", 6.0, 1.0),
        ("sub_5", pytest.approx((2 * 1 + 4 * 2) / 6), pytest.approx((0 * 2 + 4 * 2) / 6)),
    ]
    assert rows[0].subtype == "transmission" and rows[1].name == "Substation_1" and rows[1].voltage == "115"


def test_line_features(spark):
    doc = {"features": [
        feature("LineString", [[0, 1], [5, 5], [2, 3]], voltage="69"), feature("LineString", [[0, 1]]),
        feature("MultiLineString", [[[0, 1], [2, 3]]]), feature(None, None),
    ]}
    rows = geojson.line_rows(texts(spark, doc)).collect()
    assert [(r.line_id, r.lat0, r.lon0, r.lat1, r.lon1, r.voltage) for r in rows] == [(0, 1.0, 0.0, 3.0, 2.0, "69")]


def test_storm_outline_round_trip(spark, tmp_path):
    folder = str(tmp_path / "storms")
    geojson.write_storm_geojson(geojson.named_storms(spark), folder)
    ring = geojson.read_storm_ring(spark, f"{folder}/name=sandy_2012")
    assert len(ring) == 65 and ring[0] == pytest.approx(ring[-1])
    document = json.loads(geojson.storm_document(geojson.named_storms(spark)).first().value)
    assert document["type"] == "FeatureCollection" and document["features"][0]["properties"]["storm"] == "sandy_2012"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        geojson.read_storm_ring(spark, str(tmp_path / "none.geojson"))


def test_alert_documents(spark, tmp_path):
    nested = {"storm": "s", "storm_type": "t", "at_risk_substations": [], "alerts": [
        {"facility_id": "h", "priority": "CRITICAL", "hop_distance": 1, "alert_score": 2.5, "feeding_substation": "x"},
    ], "summary": {"total_alerts": 1}}
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(nested, indent=2))
    risky, rows, summary = geojson.read_alert_document(spark, str(path))
    assert risky.count() == 0 and rows.first().alert_score == 2.5 and summary.first().total_alerts == 1
    out = str(tmp_path / "folder")
    geojson.write_alert_document(out, "s", "t", risky, rows)
    again = geojson.read_alert_folder(spark, out)
    assert again[1].first().facility_id == "h" and again[2].first().critical_count == 1 and again[0].count() == 0
    files.export_csv(alerts.alert_brief(rows), str(tmp_path / "brief"))
    text = "".join(p.read_text() for p in Path(tmp_path / "brief").glob("part-*"))
    assert text.startswith("priority,facility_name,facility_type,feeding_substation,substation_risk,hop_distance,action")


def test_stream_equals_batch(spark, tmp_path):
    start = dt.datetime(2016, 1, 1)
    rows = [(1001 + 2 * (i % 2), "AL", float(i), str(start + dt.timedelta(minutes=15 * i)), 2016) for i in range(40)]
    schema = "fips_code int, state string, sum double, run_start_time string, year int"
    df = spark.createDataFrame(rows, schema)
    df.write.json(str(tmp_path / "in"))
    reports = spark.readStream.schema(schema).json(str(tmp_path / "in"))
    stats = spark.createDataFrame([("1001", 5.0, 1.0)], "fips string, county_p90 double, county_mean_baseline double")
    pivot = storms.storm_pivot(
        spark.createDataFrame(
            [("C", "Tornado", start, None, 1, 1)],
            "cz_type string, event_type string, begin_ts timestamp_ntz, end_ts timestamp_ntz, state_fips int, cz_fips int",
        )
    )
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    hourly.write_hours(hourly.labelled_stream(reports, stats, pivot), out, state).awaitTermination()
    # A late marker report moves the watermark past the last hour; the second run appends what is closed by then.
    spark.createDataFrame([(1, "AL", 0.0, "2016-01-03 00:00:00", 2016)], schema).write.mode("append").json(str(tmp_path / "in"))
    hourly.write_hours(hourly.labelled_stream(reports, stats, pivot), out, state).awaitTermination()
    columns = ["fips", "hour", "peak_customers_out", "null_count", "state", "wind", "outage_label"]
    batch = outages.label_outages(storms.join_storms(outages.hourly_rollup(outages.clean_observations(df)), pivot), stats)
    got = sorted(map(tuple, spark.read.parquet(out).select(columns).collect()))
    assert got == sorted(map(tuple, batch.select(columns).collect())) and len(got) == 20
