"""Queries of sources and sinks: rows of the tables written in an exchange format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from outagegrid.functions import codes
from outagegrid.functions.timing import parse_iso_ts
from outagegrid.operators import alerts, graph, priority, sampling, storms
from outagegrid.plans import catalog_outages  # noqa: F401  its queries are landed below
from outagegrid.plans.catalog import ORACLES, QUERIES, observations, query, rounded
from outagegrid.plans.catalog_grid import _areas, _facilities, _subs, _tables
from outagegrid.plans.catalog_outages import SPLIT, _flagship
from outagegrid.plans.catalog_scoring import _queue
from outagegrid.plans.views import frame
from outagegrid.session import scratch_path
from outagegrid.sources import files, geojson


def _documents(rows, key, properties, geometry):
    """Rows as GeoJSON features, seven to a document."""
    feature = F.concat(F.lit('{"properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}"))
    listed = rows.groupBy(F.floor(key / 7)).agg(F.array_join(F.sort_array(F.collect_list(feature)), ",").alias("f"))
    return listed.select(F.concat(F.lit('{"features":['), "f", F.lit("]}")).alias("value"))


@query("SELECT fips_code, state, customers_raw AS sum, run_start_time, period AS year FROM v_obs WHERE period >= 2")
def land_and_scan_parquet(spark, folder):
    """Yearly partitions written with dynamic overwrite and read back with a partition filter."""
    path = scratch_path(spark, "landed")
    files.land_parquet(observations(spark, folder).withColumnRenamed("period", "year"), path)
    return files.scan_parquet(spark, path, ["fips_code", "state", "sum", "run_start_time", "year"], [2, 3, 4])


@query(
    """SELECT fips_code, state, customers_raw AS sum, run_start_time AS ts, CAST(2000 + period AS INT) AS year FROM v_obs"""
)
def scan_outage_csv(spark, folder):
    """Reports written as yearly outage files and scanned by header name, with the year from the file name."""
    root = scratch_path(spark, "outage-files")
    obs = observations(spark, folder)
    for period in (1, 2, 3, 4):
        columns = ["fips_code", F.col("run_start_time").cast("string").alias("run_start_time"), "state", "sum"]
        columns = columns[period % 4 :] + columns[: period % 4]  # another order of columns each year
        part = obs.where(F.col("period") == period).select(*columns)
        files.export_csv(part, f"{root}/eaglei_outages_{2000 + period}.csv")
    back = files.scan_outage_csv(spark, root)
    return back.select("fips_code", "state", "sum", parse_iso_ts(F.col("run_start_time")).alias("ts"), "year")


@query(
    """SELECT cz_type, event_type, date_trunc('second', begin_ts) AS begin_ts, date_trunc('second', end_ts) AS end_ts,
       state_fips, cz_fips, state, CAST(2000 + period AS INT) AS year FROM v_storm"""
)
def scan_storm_csv(spark, folder):
    """Events written as yearly storm files, scanned and their clocks parsed."""
    root = scratch_path(spark, "storm-files")
    events = frame(spark, folder, "v_storm")

    def text(c):
        return F.upper(F.date_format(c, "dd-MMM-yy HH:mm:ss"))

    for period in (1, 2, 3, 4):
        columns = [
            F.col("state").alias("STATE"), F.col("cz_type").alias("CZ_TYPE"), F.col("cz_fips").alias("CZ_FIPS"),
            F.col("state_fips").alias("STATE_FIPS"), F.col("event_type").alias("EVENT_TYPE"),
            text("begin_ts").alias("BEGIN_DATE_TIME"), text("end_ts").alias("END_DATE_TIME"),
            F.lit('two\nlines, "quoted"').alias("EPISODE_NARRATIVE"),
        ]
        part = events.where(F.col("period") == period).select(*(columns if period % 2 else columns[::-1]))
        files.export_csv(part, f"{root}/StormEvents_details-ftp_v1.0_d{2000 + period}_c20240101.csv")
    back = storms.parse_event_clock(files.scan_storm_csv(spark, root))
    return back.select(
        F.col("CZ_TYPE").alias("cz_type"), F.col("EVENT_TYPE").alias("event_type"), "begin_ts", "end_ts",
        F.col("STATE_FIPS").alias("state_fips"), F.col("CZ_FIPS").alias("cz_fips"), F.col("STATE").alias("state"), "year",
    )


@query("SELECT DISTINCT period AS year FROM v_obs WHERE period >= 2")
def discover_years(spark, folder):
    path = scratch_path(spark, "landed")
    files.land_parquet(observations(spark, folder).withColumnRenamed("period", "year"), path)
    return files.discover_years(spark, path, first=2)


@query(
    """SELECT CAST(row_number() OVER (ORDER BY priority_score DESC, fips) AS INT) AS "index", fips_str AS "FIPS",
       risk_label AS "Risk", peak_customers_out AS "Peak Customers" FROM p_queue"""
)
def export_priority_csv(spark, folder):
    path = scratch_path(spark, "queue")
    table = priority.queue_table(_queue(spark, folder))
    files.export_csv(table, path)
    back = spark.read.schema(table.schema).option("header", True).csv(path)
    return back.select("index", "FIPS", "Risk", "Peak Customers")


@query(
    """SELECT node_id, name, CAST(beds AS INT) AS beds, coalesce(CASE WHEN beds % 4 = 0 THEN 'LEVEL 1' END, 'NOT AVAILABLE') AS trauma,
       'Unknown' AS city_name, lat, lon FROM v_fac WHERE beds % 7 <> 0"""
)
def service_response_rows(spark, folder):
    """Facilities as feature-service responses: one response text per facility, some without trauma, some without a
    place (these are dropped)."""
    fac = frame(spark, folder, "v_fac")
    place = F.col("beds") % 7 != 0
    attributes = F.struct(
        F.concat_ws("|", "node_id", "name").alias("NAME"), F.col("beds").alias("BEDS"),
        F.when(F.col("beds") % 4 == 0, "LEVEL 1").alias("TRAUMA"),
        F.when(place, F.col("lat")).alias("LATITUDE"), F.when(place, F.col("lon")).alias("LONGITUDE"),
    )
    body = F.struct(F.array(F.struct(attributes.alias("attributes"))).alias("features"))
    documents = fac.select(F.to_json(body).alias("value"))
    rows = geojson.service_rows(documents, "hospital")
    names = F.split("name", "\\|")
    return rows.select(
        names[0].alias("node_id"), names[1].alias("name"), "beds", "trauma", F.lit("Unknown").alias("city_name"),
        "lat", "lon",
    )


@query("SELECT 'node' AS type, CAST(ord AS BIGINT) AS id, lat, lon, voltage FROM v_sub WHERE ord % 2 = 0")
def map_response_elements(spark, folder):
    """Substations as map-service responses; every other response has an empty element list."""
    element = F.struct(
        F.lit("node").alias("type"), F.col("ord").alias("id"), "lat", "lon",
        F.create_map(F.lit("voltage"), F.col("voltage")).alias("tags"),
    )
    listed = F.when(F.col("ord") % 2 == 0, F.array(element)).otherwise(F.array().cast(
        "array<struct<type:string,id:int,lat:double,lon:double,tags:map<string,string>>>"))
    documents = _subs(spark, folder).select(F.to_json(F.struct(listed.alias("elements"))).alias("value"))
    return geojson.element_rows(documents).select("type", "id", "lat", "lon", F.col("tags")["voltage"].alias("voltage"))


@query(
    """SELECT node_id, CASE WHEN ord % 5 = 0 THEN 'Substation_' || CAST(ord AS VARCHAR) ELSE name END AS name, voltage,
       CASE WHEN voltage LIKE '%138%' OR voltage LIKE '%345%' THEN 'transmission' ELSE 'distribution' END AS subtype,
       round(lat, 6) AS lat, round(lon, 6) AS lon FROM v_sub WHERE ord % 6 <> 0"""
)
def substation_geojson(spark, folder):
    """Substations as GeoJSON features: points and squares around the same place, some unnamed, some without geometry."""
    lon, lat, d = F.col("lon"), F.col("lat"), F.lit(0.01)
    corners = [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]
    square = F.array(F.array(*[F.array(lon + x * d, lat + y * d) for x, y in corners]))
    point = F.to_json(F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")))
    area = F.to_json(F.struct(F.lit("Polygon").alias("type"), square.alias("coordinates")))
    geometry = F.when(F.col("ord") % 6 == 0, "null").when(F.col("ord") % 2 == 0, area).otherwise(point)
    name = F.when(F.col("ord") % 5 == 0, "").otherwise(F.col("name"))
    properties = F.to_json(F.struct(F.col("ord").cast("string").alias("osmid"), name.alias("name"), "voltage"))
    rows = geojson.substation_rows(_documents(_subs(spark, folder), F.col("ord"), properties, geometry))
    return rounded(rows.select("node_id", "name", "voltage", "subtype", "lat", "lon"), lat=6, lon=6)


@query(
    "SELECT lat0, lon0, lat1, lon1, coalesce(voltage, '115') AS voltage, count(*) OVER () AS distinct_ids FROM v_line "
    "WHERE line_id % 4 <> 0"
)
def line_geojson(spark, folder):
    """Lines as GeoJSON features with an inner vertex; every fourth one has a single point and is skipped."""
    lines = frame(spark, folder, "v_line")
    path = F.array(
        F.array("lon0", "lat0"), F.array((F.col("lon0") + F.col("lon1")) / 2, F.col("lat0")), F.array("lon1", "lat1")
    )
    path = F.when(F.col("line_id") % 4 == 0, F.slice(path, 1, 1)).otherwise(path)
    geometry = F.to_json(F.struct(F.lit("LineString").alias("type"), path.alias("coordinates")))
    properties = F.to_json(F.struct("voltage"))
    rows = geojson.line_rows(_documents(lines, F.col("line_id"), properties, geometry))
    # Numbers run over all documents: as many as there are lines.
    numbers = rows.agg(F.count_distinct("line_id").alias("n")).scalar()
    return rows.select("lat0", "lon0", "lat1", "lon1", "voltage", numbers.alias("distinct_ids"))


@query(
    """SELECT facility_id, facility_name, feeding_substation, substation_risk, hop_distance, alert_score, in_storm_zone, beds
FROM g_alerts"""
)
def alert_document(spark, folder):
    """The alert result written as a document folder and its alert rows read back."""
    path = scratch_path(spark, "alerts")
    t = _tables(spark, folder)
    geojson.write_alert_document(path, "fixture", "Hurricane Cat 1", t.at_risk, t.alerts)
    _, alerts, _ = geojson.read_alert_folder(spark, path)
    return alerts.select(
        "facility_id", "facility_name", "feeding_substation", "substation_risk", "hop_distance", "alert_score",
        "in_storm_zone", "beds",
    )


@query("SELECT node_id, name, node_type, lat, lon, CAST(beds AS VARCHAR) AS beds FROM v_fac")
def facility_props(spark, folder):
    """Facility rows keep every source column in their property map."""
    fac = frame(spark, folder, "v_fac").select("name", "lat", "lon", "beds", "ord", "node_type")
    kinds = ("hospital", "fire_station", "school")
    out = None
    for kind in kinds:
        rows = files.facility_rows(fac.where(F.col("node_type") == kind), kind)
        out = rows if out is None else out.unionByName(rows)
    return out.select("node_id", "name", "node_type", "lat", "lon", F.try_element_at("props", F.lit("beds")).alias("beds"))


@query("SELECT event_id, CAST(coalesce(regexp_extract(props, '\"k\": ([0-9]+)', 1), '0') AS INT) AS k FROM events")
def props_lookup(spark, folder):
    """Two-key fallback on JSON properties: a key that is absent, the one that is there, then zero."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    props = F.from_json("props", "map<string,string>")
    return events.select("event_id", codes.first_of(props, ["K", "k"], "0").cast("int").alias("k"))


@query("SELECT node_id, node_type FROM g_nodes WHERE node_id NOT IN (SELECT u FROM g_edges UNION ALL SELECT v FROM g_edges)")
def isolated_nodes(spark, folder):
    """Facilities without a substation in reach, and substations without a neighbour."""
    nodes = graph.build_nodes(_subs(spark, folder), _facilities(spark, folder))
    linked = graph.both_ways(graph.build_edges(nodes)).select(F.col("node").alias("node_id"))
    return nodes.select("node_id", "node_type").join(linked, "node_id", "left_anti")


def _landed(name):
    """A stage's result written as a table and read back."""

    def landed(spark, folder):
        path = scratch_path(spark, name)
        files.write_table(QUERIES[name](spark, folder), path)
        return spark.read.parquet(path)

    landed.__name__ = f"landed_{name}"
    query(ORACLES[name])(landed)


for _name in ("storm_pivot", "county_stats"):
    _landed(_name)


# --- results landed and read back, fallback sources, exports ------------------------------------------


@query("SELECT fips, round(max_outage_proba, 6) AS max_outage_proba, CAST(rank AS BIGINT) AS rank FROM p_counties")
def county_priority_table(spark, folder):
    """County priorities written once and read by those who need two columns of them."""
    path = scratch_path(spark, "priority")
    files.write_table(QUERIES["county_priority"](spark, folder), path)
    return spark.read.parquet(path).select(
        "fips", F.round("max_outage_proba", 6).alias("max_outage_proba"), F.col("rank").cast("bigint").alias("rank")
    )


@query("SELECT fips, hour, CAST(year AS INT) AS year, outage_label, CAST(any_storm AS INT) AS any_storm FROM c_features WHERE year IN (2, 4)")
def landed_feature_store(spark, folder):
    """The feature store in yearly partitions; two years and a few columns of it are read."""
    path = scratch_path(spark, "features")
    files.land_parquet(_flagship(spark, folder), path)
    back = files.scan_parquet(spark, path, ["fips", "hour", "year", "outage_label", "any_storm"], [2, 4])
    return back.withColumn("any_storm", F.col("any_storm").cast("int")).withColumn("year", F.col("year").cast("int"))


@query("SELECT fips, hour, outage_label, split FROM c_split WHERE split <> 'test'")
def landed_splits(spark, folder):
    """Splits as partitions of one table: a fit reads its own folder only."""
    path = scratch_path(spark, "splits")
    files.land_parquet(sampling.assign_split(_flagship(spark, folder), **SPLIT), path, by="split")
    return spark.read.parquet(path).where(F.col("split") != "test").select("fips", "hour", "outage_label", "split")


@query("""
SELECT name, coalesce(nullif(voltage, '115'), '115') AS voltage, 'distribution' AS subtype, round(lat, 6) AS lat, round(lon, 6) AS lon,
       count(*) OVER () AS numbers FROM v_sub""")
def substation_fallback(spark, folder):
    """There is no map document, so the chain of sources goes on to the table of substations; voltages that are missing get
    the default, and every row a number of its own."""
    root = scratch_path(spark, "substations")
    voltage = F.when(F.col("voltage") != "115", F.col("voltage")).alias("voltage")
    files.export_csv(_subs(spark, folder).select("name", voltage, "lat", "lon"), f"{root}/substations.csv")
    rows = files.first_available(
        lambda: geojson.substation_rows(geojson.read_documents(spark, f"{root}/substations.geojson")),
        lambda: files.read_substation_csv(spark, f"{root}/substations.csv"),
    )
    numbers = rows.agg(F.count_distinct("node_id")).scalar()
    return rounded(rows.select("name", "voltage", "subtype", "lat", "lon", numbers.alias("numbers")), lat=6, lon=6)


@query("""
SELECT node_type, name, round(lat, 6) AS lat, round(lon, 6) AS lon, CAST(beds AS VARCHAR) AS beds FROM v_fac
WHERE node_type <> 'fire_station' AND beds % 7 <> 0""")
def facility_csv(spark, folder):
    """Two of the three facility tables exist; rows without a place are dropped, every column is in the property map."""
    root = scratch_path(spark, "facilities")
    lat = F.when(F.col("beds") % 7 != 0, F.col("lat")).alias("lat")
    for kind, file in (("hospital", "hospitals.csv"), ("school", "schools.csv")):
        rows = frame(spark, folder, "v_fac").where(F.col("node_type") == kind)
        files.export_csv(rows.select("name", lat, "lon", "beds"), f"{root}/{file}")
    back = files.read_facilities(spark, root)
    return rounded(
        back.select("node_type", "name", "lat", "lon", F.try_element_at("props", F.lit("beds")).alias("beds")), lat=6, lon=6
    )


def _responses(spark, folder, kind, **attributes):
    fac = frame(spark, folder, "v_fac").where(F.col("node_type") == kind)
    body = F.struct(*[c.alias(k) for k, c in attributes.items()], F.col("lat").alias("LATITUDE"), F.col("lon").alias("LONGITUDE"))
    features_ = F.struct(F.array(F.struct(body.alias("attributes"))).alias("features"))
    return geojson.service_rows(fac.select(F.to_json(features_).alias("value")), kind)


@query("""
SELECT name, CASE WHEN beds % 3 = 0 THEN 'City' ELSE 'Unknown' END AS city_or_none, lat, lon FROM v_fac
WHERE node_type = 'fire_station'""")
def fire_station_responses(spark, folder):
    """Fire stations of a feature service, two thirds of them with an empty city."""
    city = F.when(F.col("beds") % 3 == 0, "City").otherwise("")
    rows = _responses(spark, folder, "fire_station", NAME=F.col("name"), CITY=city)
    known = F.when(F.length("city") > 0, F.col("city")).otherwise("Unknown")
    return rows.select("name", known.alias("city_or_none"), "lat", "lon")


@query("SELECT name, CAST(beds AS INT) AS enrollment, lat, lon FROM v_fac WHERE node_type = 'school'")
def school_responses(spark, folder):
    rows = _responses(spark, folder, "school", NAME=F.col("name"), ENROLLMENT=F.col("beds"))
    return rows.select("name", "enrollment", "lat", "lon")


@query("""
SELECT priority, facility_name, facility_type, feeding_substation, substation_risk, hop_distance, action FROM g_alerts""")
def export_alert_csv(spark, folder):
    """The alert brief as a CSV export and read back."""
    path = scratch_path(spark, "alerts")
    brief = alerts.alert_brief(_tables(spark, folder).alerts)
    files.export_csv(brief, path)
    return spark.read.schema(brief.schema).option("header", True).csv(path)


@query("SELECT storm, i, round(lon, 6) AS lon, round(lat, 6) AS lat FROM a_places WHERE part = 0 AND ring = 0")
def storm_geojson_round_trip(spark, folder):
    """Outlines written as one document per storm and read back as areas."""
    path = scratch_path(spark, "storms")
    outlines = _areas(spark, folder).where((F.col("part.at") == 0) & ~F.col("hole")).select(F.col("storm").alias("name"), "ring")
    geojson.write_storm_geojson(outlines, path)
    back = geojson.area_rows(geojson.read_documents(spark, path))
    places = back.select("storm", F.posexplode("ring").alias("i", "p"))
    return rounded(places.select("storm", "i", F.col("p.lon").alias("lon"), F.col("p.lat").alias("lat")), lon=6, lat=6)


CENTRE_SQL = """
SELECT name, ord % 7 AS shape, round(lon + CASE ord % 7 WHEN 4 THEN 0.03e0 ELSE 0e0 END, 6) AS lon,
       round(lat + CASE ord % 7 WHEN 2 THEN 0.01e0 * 4 / 6 ELSE 0e0 END, 6) AS lat, count(*) OVER () AS numbers
FROM v_sub WHERE ord % 7 <> 6"""


@query(CENTRE_SQL)
def geometry_centroids(spark, folder):
    """Substations drawn as every kind of geometry, a seventh of them without coordinates; none has an id of its own, so all
    are numbered over the documents."""
    lon, lat = F.col("lon"), F.col("lat")
    at = lambda x, y: F.array(lon + F.lit(x), lat + F.lit(y))
    text = lambda c: F.to_json(c)
    square = lambda x: F.array(F.array(*[at(x + a, b) for a, b in [(-0.01, -0.01), (0.01, -0.01), (0.01, 0.01), (-0.01, 0.01), (-0.01, -0.01)]]))
    line = F.array(at(-0.01, 0.0), at(0.01, 0.0))
    shapes = [
        ("MultiPoint", text(F.array(at(-0.01, 0.02), at(0.01, -0.02)))), ("LineString", text(line)),
        ("MultiLineString", text(F.array(line, F.array(at(0.0, -0.01), at(0.0, 0.03))))), ("Polygon", text(square(0.0))),
        ("MultiPolygon", text(F.array(square(0.0), square(0.06)))), ("GeometryCollection", None), ("MultiPoint", F.lit("[]")),
    ]
    part = lambda kind, c: F.concat(F.lit(f'{{"type":"{kind}","coordinates":'), c, F.lit("}"))
    nested = F.concat(
        F.lit('{"type":"GeometryCollection","geometries":['), part("Point", text(at(1.0, 1.0))),
        F.lit(',{"type":"GeometryCollection","geometries":['), part("LineString", text(F.array(at(2.0, 2.0), at(3.0, 3.0)))), F.lit(","),
        part("Polygon", text(square(0.0))), F.lit("]}]}"),
    )
    geometry = nested
    for k, (kind, coordinates) in enumerate(shapes):
        if coordinates is not None:
            geometry = F.when(F.col("ord") % 7 == k, part(kind, coordinates)).otherwise(geometry)
    properties = F.to_json(F.struct(F.concat_ws("|", "name", (F.col("ord") % 7).cast("string")).alias("name"), "voltage"))
    rows = geojson.substation_rows(_documents(_subs(spark, folder), F.col("ord"), properties, geometry))
    numbers = rows.agg(F.count_distinct("node_id")).scalar()
    label = F.split("name", "\\|")
    return rounded(
        rows.select(label[0].alias("name"), label[1].cast("int").alias("shape"), "lon", "lat", numbers.alias("numbers")), lon=6, lat=6
    )
