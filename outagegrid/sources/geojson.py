"""GeoJSON, map-service JSON and alert documents.

Readers take a table of texts (column ``value``, one document per row), so a folder of response pages is read page by
page in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.functions import codes, geo
from outagegrid.operators.alerts import alert_summary

FEATURES = (
    "struct<features:array<struct<properties:map<string,string>,"
    "geometry:struct<type:string,coordinates:string,geometries:string>>>>"
)
ELEMENTS = "struct<elements:array<struct<type:string,id:bigint,lat:double,lon:double,tags:map<string,string>>>>"
OUTLINE = "struct<features:array<struct<geometry:struct<type:string,coordinates:array<array<array<double>>>>>>>"
AT_RISK = (
    "struct<node_id:string,name:string,lat:double,lon:double,voltage:string,subtype:string,base_risk:double,"
    "adjusted_risk:double,in_storm_zone:boolean>"
)
ALERT = (
    "struct<facility_id:string,facility_name:string,facility_type:string,priority:string,lat:double,lon:double,"
    "feeding_substation:string,feeding_sub_lat:double,feeding_sub_lon:double,substation_risk:double,hop_distance:int,"
    "alert_score:double,in_storm_zone:boolean,beds:int,trauma:string,action:string>"
)
SUMMARY = (
    "struct<total_at_risk_substations:bigint,total_alerts:bigint,critical_count:bigint,high_count:bigint,"
    "medium_count:bigint>"
)
DOCUMENT = (
    f"struct<storm:string,storm_type:string,at_risk_substations:array<{AT_RISK}>,alerts:array<{ALERT}>,"
    f"summary:{SUMMARY}>"
)

# --- fixed values: service field, output column, type, value when absent ---------------------------
SERVICE_FIELDS = {
    "hospital": [
        ("NAME", "name", "string", "Unknown"), ("ADDRESS", "address", "string", ""), ("CITY", "city", "string", ""),
        ("BEDS", "beds", "int", 0), ("TRAUMA", "trauma", "string", "NOT AVAILABLE"), ("HELIPAD", "helipad", "string", "N"),
    ],
    "fire_station": [
        ("NAME", "name", "string", "Unknown"), ("CITY", "city", "string", ""), ("COUNTY", "county", "string", ""),
    ],
    "school": [
        ("NAME", "name", "string", "Unknown"), ("CITY", "city", "string", ""), ("COUNTY", "county", "string", ""),
        ("ENROLLMENT", "enrollment", "int", 0),
    ],
}


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """path, value: one row per document."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def service_rows(documents: DataFrame, kind: str) -> DataFrame:
    """``features[].attributes`` of a feature service to facility rows; rows without a place are dropped. A key that is
    absent gets the default, a key that is null stays null."""
    shape = "struct<features:array<struct<attributes:map<string,string>>>>"
    a = F.col("a")
    columns = [
        F.when(F.map_contains_key(a, F.lit(field)), F.try_element_at(a, F.lit(field)))
        .otherwise(F.lit(str(default))).cast("double" if kind_ == "int" else kind_).cast(kind_).alias(name)
        for field, name, kind_, default in SERVICE_FIELDS[kind]
    ]
    return (
        documents.select(F.explode(F.from_json("value", shape)["features"]).alias("f"))
        .select(F.coalesce("f.attributes", F.create_map().cast("map<string,string>")).alias("a"))
        .select(
            *columns, F.try_element_at(a, F.lit("LATITUDE")).cast("double").alias("lat"),
            F.try_element_at(a, F.lit("LONGITUDE")).cast("double").alias("lon"),
        )
        .dropna(subset=["lat", "lon"])
    )


def element_rows(documents: DataFrame) -> DataFrame:
    """``elements[]`` of a map query; an empty list gives no rows."""
    return documents.select(F.explode(F.from_json("value", ELEMENTS)["elements"]).alias("e")).select("e.*")


BUCKETS = 4096


def _features(documents: DataFrame) -> DataFrame:
    """All features with ``ord``, their number over all documents: documents go by a digest of their ``path`` where they have
    one and of their text otherwise, features by their place in the document. A document that is there twice is read once.

    Digests are dealt to ranges by their first digits. Running sums go over the ranges' totals, a table of at most ``BUCKETS``
    rows, and over the documents inside each range."""
    key = "path" if "path" in documents.columns else "value"
    parsed = documents.select(F.sha2(F.coalesce(F.col(key), F.lit("")), 256).alias("_digest"), "value").dropDuplicates(["_digest"]).select(
        "_digest", F.from_json("value", FEATURES)["features"].alias("features")
    )
    range_ = F.conv(F.substring("_digest", 1, 3), 16, 10).cast("int").alias("_range")
    sizes = parsed.select("_digest", range_, F.greatest(F.size("features"), F.lit(0)).cast("long").alias("n"))
    earlier = (Window.unboundedPreceding, -1)
    totals = sizes.groupBy("_range").agg(F.sum("n").alias("n")).select(
        "_range", F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(*earlier)), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_range").orderBy("_digest").rowsBetween(*earlier)
    starts = sizes.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(totals, "_range").select(
        "_digest", (F.col("_before") + F.col("_inside")).alias("_start")
    )
    return parsed.join(starts, "_digest").select("_start", F.posexplode("features").alias("_at", "f")).select(
        (F.col("_start") + F.col("_at")).alias("ord"), F.col("f.properties").alias("p"), F.col("f.geometry.type").alias("kind"),
        F.col("f.geometry.coordinates").alias("coordinates"), F.col("f.geometry.geometries").alias("geometries"),
    )


#: Shape of the coordinates by type; a type stands for its multiple by a list of one.
SHAPES = {
    "Point": ("array<double>", 0, True), "MultiPoint": ("array<array<double>>", 0, False),
    "LineString": ("array<array<double>>", 1, True), "MultiLineString": ("array<array<array<double>>>", 1, False),
    "Polygon": ("array<array<array<double>>>", 2, True), "MultiPolygon": ("array<array<array<array<double>>>>", 2, False),
}
NESTED = 4  # collections inside collections that are opened


def _parts(geometries: Column, dimension: int) -> Column:
    """The coordinates of all geometries of one dimension: points, lines or polygons."""
    found = []
    for kind, (shape, of, single) in SHAPES.items():
        if of == dimension:
            some = F.transform(F.filter(geometries, lambda g: g["type"] == kind), lambda g: F.from_json(g["coordinates"], shape))
            found.append(some if single else F.flatten(some))
    return F.filter(F.concat(*found), lambda x: x.isNotNull())


def _place(c: Column) -> Column:
    return F.struct(c[0].alias("lon"), c[1].alias("lat"))


def _with_centre(features: DataFrame) -> DataFrame:
    """Add ``at``, the centroid: of the polygons where there are any, else of the lines, else of the points. Collections are
    opened first. Null without coordinates."""
    opened = F.array(F.struct(F.col("kind").alias("type"), "coordinates", "geometries"))
    inner = "array<struct<type:string,coordinates:string,geometries:string>>"
    for _ in range(NESTED):
        opened = F.flatten(F.transform(
            opened,
            lambda g: F.when(
                g["type"] == "GeometryCollection", F.coalesce(F.from_json(g["geometries"], inner), F.array().cast(inner))
            ).otherwise(F.array(g).cast(inner)),
        ))
    parts = features.withColumn("_g", opened).select("*", *[_parts(F.col("_g"), d).alias(f"_d{d}") for d in range(3)])
    areas = F.flatten(F.transform("_d2", _rings))
    lines = F.transform("_d1", lambda line: F.transform(line, _place))
    at = (
        F.when(F.size("_d2") > 0, geo.area_centroid(areas)).when(F.size("_d1") > 0, geo.line_centroid(lines))
        .when(F.size("_d0") > 0, geo.mean_place(F.transform("_d0", _place)))
    )
    return parts.withColumn("at", at).drop("_g", "_d0", "_d1", "_d2")


def _places(coordinates: Column) -> Column:
    """[[lon, lat], ...] text to an array of places."""
    pairs = F.from_json(coordinates, "array<array<double>>")
    return F.transform(pairs, lambda c: F.struct(c[0].alias("lon"), c[1].alias("lat")))


def _rings(polygon: Column) -> Column:
    """One polygon's rings, all but the first marked as holes."""
    return F.transform(
        polygon,
        lambda ring, i: F.struct(
            (i > 0).alias("hole"),
            F.transform(ring, lambda c: F.struct(c[0].alias("lon"), c[1].alias("lat"))).alias("ring"),
        ),
    )


def unplaced(documents: DataFrame) -> DataFrame:
    """The number of features by type whose geometry is there and has no coordinates: those ``substation_rows`` drops."""
    found = _with_centre(_features(documents).where(F.col("kind").isNotNull()))
    return found.where(F.col("at.lon").isNull() | F.col("at.lat").isNull()).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def substation_rows(documents: DataFrame) -> DataFrame:
    """GeoJSON features to substations at their centroids. Features without geometry or coordinates are skipped."""
    found = _with_centre(_features(documents).where(F.col("kind").isNotNull()))
    found = found.where(F.col("at.lon").isNotNull() & F.col("at.lat").isNotNull())
    osm_id = F.coalesce(F.try_element_at("p", F.lit("osmid")), F.col("ord").cast("string"))
    voltage = codes.first_of(F.col("p"), ["voltage"], fixed.DEFAULT_VOLTAGE)
    name = F.try_element_at("p", F.lit("name"))
    return found.select(
        F.concat(F.lit("sub_"), osm_id).alias("node_id"),
        F.when(F.length(name) > 0, name).otherwise(F.concat(F.lit("Substation_"), osm_id)).alias("name"),
        voltage.alias("voltage"), codes.voltage_class(voltage).alias("subtype"),
        F.col("at.lat").alias("lat"), F.col("at.lon").alias("lon"), "ord",
    )


def line_rows(documents: DataFrame) -> DataFrame:
    """GeoJSON line features with at least two points to their two ends."""
    lines = _features(documents).where(F.col("kind") == "LineString").withColumn("c", _places(F.col("coordinates")))
    first, last = F.col("c")[0], F.element_at("c", -1)
    return lines.where(F.size("c") >= 2).select(
        F.col("ord").alias("line_id"), first["lat"].alias("lat0"), first["lon"].alias("lon0"),
        last["lat"].alias("lat1"), last["lon"].alias("lon1"),
        codes.first_of(F.col("p"), ["voltage"], fixed.DEFAULT_VOLTAGE).alias("voltage"),
    )


def area_rows(documents: DataFrame) -> DataFrame:
    """storm, part, hole, ring: all polygons of all features, a row per ring. A storm is named by the property ``storm``,
    else ``name``; features of one name are parts of one storm, those without a name have a number of their own."""
    found = _features(documents).where(F.col("kind").isin("Polygon", "MultiPolygon"))
    one = F.array(F.from_json("coordinates", "array<array<array<double>>>"))
    polygons = F.when(F.col("kind") == "Polygon", one).otherwise(F.from_json("coordinates", "array<array<array<array<double>>>>"))
    named = F.coalesce(*[F.nullif(F.try_element_at("p", F.lit(k)), F.lit("")) for k in ("storm", "name")])
    return (
        found.select(F.coalesce(named, F.concat(F.lit("area_"), F.col("ord").cast("string"))).alias("storm"), "ord", F.posexplode(polygons).alias("at", "polygon"))
        .select("storm", F.struct("ord", "at").alias("part"), F.explode(_rings(F.col("polygon"))).alias("r"))
        .select("storm", "part", "r.hole", "r.ring")
    )


def read_storm_ring(spark: SparkSession, path: str) -> list[tuple[float, float]]:
    """The outline of the first feature of one storm file, as a parameter for the risk operators. A missing file raises."""
    ring = F.from_json("value", OUTLINE)["features"][0]["geometry"]["coordinates"][0]
    row = read_documents(spark, path).select(ring.alias("r")).first()
    if row is None or row.r is None:
        raise ValueError(f"no usable storm outline in {path}")
    return [(p[0], p[1]) for p in row.r]


def storm_document(storms: DataFrame) -> DataFrame:
    """Storms (name, ring) to one FeatureCollection text each, with a single feature."""
    positions = F.transform("ring", lambda p: F.array(p["lon"], p["lat"]))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("name"), F.col("name").alias("storm")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(positions).alias("coordinates")).alias("geometry"),
    )
    collection = F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))
    return storms.select("name", F.to_json(collection).alias("value"))


def named_storms(spark: SparkSession, vertices: int = 64) -> DataFrame:
    """The three historical storm circles (name, ring)."""
    rows = [(n, float(la), float(lo), float(r)) for n, (la, lo, r) in fixed.STORM_CIRCLES.items()]
    centres = spark.createDataFrame(rows, "name string, lat double, lon double, radius_km double")
    return centres.select(
        "name", geo.circle_ring(F.col("lat"), F.col("lon"), F.col("radius_km"), vertices).alias("ring")
    )


def write_storm_geojson(storms: DataFrame, folder: str) -> None:
    """One text folder per storm name below ``folder``."""
    storm_document(storms).write.mode("overwrite").partitionBy("name").text(folder)


def write_alert_document(path: str, storm: str, storm_type: str, at_risk_subs: DataFrame, alerts: DataFrame) -> None:
    """The alert result as a folder: two row tables and a one-row summary, all JSON lines. The rows are not gathered into
    one nested text, which would pass through a single task."""
    at_risk_subs.write.mode("overwrite").json(f"{path}/at_risk_substations")
    alerts.write.mode("overwrite").json(f"{path}/alerts")
    alert_summary(at_risk_subs, alerts).select(
        F.lit(storm).alias("storm"), F.lit(storm_type).alias("storm_type"), "*"
    ).write.mode("overwrite").json(f"{path}/summary")


def read_alert_folder(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(at-risk substations, alerts, summary) of a folder written above."""

    def read(part: str, shape: str, extra: str = "") -> DataFrame:
        columns = shape.removeprefix("struct<").removesuffix(">").replace(":", " ")
        return spark.read.schema(extra + columns).json(f"{path}/{part}")

    return (
        read("at_risk_substations", AT_RISK),
        read("alerts", ALERT),
        read("summary", SUMMARY, "storm string, storm_type string, "),
    )


def read_alert_document(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same three tables from one nested document; ``ord`` keeps the order of its lists."""
    doc = read_documents(spark, path).select(F.from_json("value", DOCUMENT).alias("d"))

    def rows(field: str) -> DataFrame:
        return doc.select(F.posexplode(f"d.{field}").alias("ord", "r")).select("r.*", F.col("ord").cast("long").alias("ord"))

    return rows("at_risk_substations"), rows("alerts"), doc.select("d.storm", "d.storm_type", "d.summary.*")
