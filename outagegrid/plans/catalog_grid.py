"""Queries of the grid half: neighbours, graph, storm risk, alerts and map layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from outagegrid.functions import geo
from outagegrid.operators import alerts, areas, graph, spatial
from outagegrid.plans.alerting import storm_alerts
from outagegrid.plans.catalog import CTES, query, rounded
from outagegrid.plans.views import RING, frame
from outagegrid.sources import geojson

STORM, AVERAGE_RISK = "Hurricane Cat 1", 0.3

KM = "sqrt(({0}.lat - {1}.lat) * ({0}.lat - {1}.lat) + ({0}.lon - {1}.lon) * ({0}.lon - {1}.lon)) * 111e0"
CTES["g_sub_near"] = f"""
SELECT * FROM (SELECT a.node_id, a.ord, a.lat, a.lon, b.node_id AS near_id, {KM.format('a', 'b')} AS km,
                      row_number() OVER (PARTITION BY a.node_id ORDER BY {KM.format('a', 'b')}, b.ord) AS rank
               FROM v_sub a JOIN v_sub b ON a.node_id <> b.node_id AND {KM.format('a', 'b')} < 25)
WHERE rank <= 3"""
CTES["g_fac_near"] = f"""
SELECT * FROM (SELECT a.node_id, b.node_id AS near_id, {KM.format('a', 'b')} AS km,
                      row_number() OVER (PARTITION BY a.node_id ORDER BY {KM.format('a', 'b')}, b.ord) AS rank
               FROM v_fac a JOIN v_sub b ON {KM.format('a', 'b')} < 20)
WHERE rank <= 2"""
CTES["g_sub_edges"] = """
SELECT DISTINCT least(node_id, near_id) AS u, greatest(node_id, near_id) AS v, 'distribution' AS edge_type,
       round(km, 2) AS distance_km, CAST(NULL AS VARCHAR) AS voltage FROM g_sub_near"""
CTES["g_fac_edges"] = """
SELECT least(node_id, near_id) AS u, greatest(node_id, near_id) AS v, 'service' AS edge_type,
       round(km, 2) AS distance_km, CAST(NULL AS VARCHAR) AS voltage FROM g_fac_near"""
CTES["g_edges"] = "SELECT * FROM g_sub_edges UNION ALL SELECT * FROM g_fac_edges"
CTES["g_ends"] = """
SELECT line_id, voltage, 0 AS e, lat0 AS lat, lon0 AS lon FROM v_line
UNION ALL SELECT line_id, voltage, 1 AS e, lat1 AS lat, lon1 AS lon FROM v_line"""
CTES["g_line_near"] = f"""
SELECT * FROM (SELECT a.line_id, a.e, a.voltage, b.node_id AS near_id, {KM.format('a', 'b')} AS km,
                      row_number() OVER (PARTITION BY a.line_id, a.e ORDER BY {KM.format('a', 'b')}, b.ord) AS rank
               FROM g_ends a JOIN v_sub b ON {KM.format('a', 'b')} < 30)
WHERE rank <= 2"""
CTES["g_line_edges"] = """
SELECT u, v, edge_type, distance_km, voltage FROM (
  SELECT least(a.near_id, b.near_id) AS u, greatest(a.near_id, b.near_id) AS v, 'transmission' AS edge_type,
         round(b.km, 2) AS distance_km, coalesce(a.voltage, '115') AS voltage,
         row_number() OVER (PARTITION BY least(a.near_id, b.near_id), greatest(a.near_id, b.near_id)
                            ORDER BY a.line_id, a.e) AS n
  FROM g_line_near a JOIN g_line_near b ON a.line_id = b.line_id AND a.e = b.e AND a.rank = 1 AND b.rank = 2
  WHERE a.km < 5) WHERE n = 1"""
CTES["g_nodes"] = """
SELECT node_id, 'substation' AS node_type, name, voltage,
       CASE WHEN voltage LIKE '%138%' OR voltage LIKE '%230%' OR voltage LIKE '%345%' THEN 'transmission' ELSE 'distribution' END AS subtype,
       lat, lon, CAST(NULL AS VARCHAR) AS priority, CAST(NULL AS INT) AS priority_score, CAST(NULL AS INT) AS beds,
       CAST(ord AS BIGINT) AS ord FROM v_sub
UNION ALL
SELECT node_id, node_type, name, NULL, NULL, lat, lon,
       CASE node_type WHEN 'hospital' THEN 'CRITICAL' WHEN 'fire_station' THEN 'HIGH' ELSE 'MEDIUM' END,
       CASE node_type WHEN 'hospital' THEN 10 WHEN 'fire_station' THEN 7 ELSE 4 END, beds, ord FROM v_fac"""
CTES["g_base"] = """
SELECT *, round(least(0.99e0, 0.3e0 * CASE WHEN lon > -73.4e0 THEN 0.85e0 WHEN lon > -73.6e0 THEN 1e0 ELSE 1.15e0 END), 4) AS base_risk
FROM g_nodes WHERE node_type = 'substation'"""
CTES["g_ring_edges"] = """
SELECT a.lon AS x0, a.lat AS y0, b.lon AS x1, b.lat AS y1 FROM v_ring a JOIN v_ring b ON b.i = a.i + 1"""
CTES["g_edge_tests"] = """
SELECT s.node_id,
       CASE WHEN (y0 > lat) <> (y1 > lat) AND lon < (x1 - x0) * (lat - y0) / nullif(y1 - y0, 0e0) + x0 THEN 1 ELSE 0 END AS crossing,
       CASE WHEN (x1 - x0) * (lat - y0) - (y1 - y0) * (lon - x0) = 0 AND lon BETWEEN least(x0, x1) AND greatest(x0, x1)
             AND lat BETWEEN least(y0, y1) AND greatest(y0, y1) THEN 1 ELSE 0 END AS touching,
       greatest(0e0, least(1e0, ((lon - x0) * (x1 - x0) + (lat - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS t,
       lon, lat, x0, y0, x1, y1
FROM v_sub s CROSS JOIN g_ring_edges"""
CTES["g_inside"] = """
SELECT node_id, sum(crossing) % 2 = 1 AND max(touching) = 0 AS in_storm_zone,
       min(sqrt((lon - (x0 + t * (x1 - x0))) * (lon - (x0 + t * (x1 - x0))) + (lat - (y0 + t * (y1 - y0))) * (lat - (y0 + t * (y1 - y0))))) * 111e0 AS edge_km
FROM g_edge_tests GROUP BY node_id"""
CTES["g_exposed"] = """
SELECT b.*, i.in_storm_zone, i.edge_km,
       CASE WHEN i.in_storm_zone THEN least(0.999e0, base_risk * 2e0)
            WHEN i.edge_km < 30 THEN least(0.999e0, base_risk * 2e0 * (1 - i.edge_km / 60)) ELSE base_risk END AS adjusted_risk
FROM g_base b JOIN g_inside i USING (node_id)"""
CTES["g_risky"] = """
SELECT node_id, name, lat, lon, voltage, subtype, round(base_risk, 4) AS base_risk, round(adjusted_risk, 4) AS adjusted_risk,
       in_storm_zone, ord FROM g_exposed WHERE adjusted_risk > 0.4e0"""
CTES["g_steps"] = "SELECT u AS a, v AS b FROM g_edges UNION SELECT v, u FROM g_edges"
CTES["g_walk"] = """
SELECT node_id AS src, node_id AS node, 0 AS hop FROM g_risky
UNION
SELECT w.src, s.b, w.hop + 1 FROM g_walk w JOIN g_steps s ON s.a = w.node WHERE w.hop < 3"""
CTES["g_hops"] = "SELECT src, node, min(hop) AS hop FROM g_walk GROUP BY src, node"
CTES["g_advice"] = """
SELECT * FROM (VALUES
 ('hospital', 0.85e0, 9e0, 'act_now'), ('hospital', 0.65e0, 0.85e0, 'prepare'), ('hospital', -1e0, 0.65e0, 'monitor'),
 ('fire_station', 0.85e0, 9e0, 'act_now'), ('fire_station', -1e0, 0.85e0, 'prepare'),
 ('school', 0.75e0, 9e0, 'consider_closing'), ('school', -1e0, 0.75e0, 'monitor')) AS t(kind, above, upto, action)"""
CTES["g_alerts"] = """
SELECT node_id AS facility_id, name AS facility_name, node_type AS facility_type, priority, lat, lon, feeding_substation_id, feeding_substation,
       feeding_sub_lat, feeding_sub_lon, round(risk, 4) AS substation_risk, hop AS hop_distance,
       round(score, 4) AS alert_score, in_storm_zone, beds, 'N/A' AS trauma, action, ord
FROM (SELECT f.*, r.node_id AS feeding_substation_id, r.name AS feeding_substation, r.lat AS feeding_sub_lat, r.lon AS feeding_sub_lon, r.in_storm_zone,
             r.adjusted_risk AS risk, h.hop, r.adjusted_risk * f.priority_score / sqrt(h.hop) AS score,
             row_number() OVER (PARTITION BY f.node_id ORDER BY r.adjusted_risk * f.priority_score / sqrt(h.hop) DESC,
                                r.adjusted_risk DESC, r.ord) AS n
      FROM g_hops h JOIN g_nodes f ON f.node_id = h.node JOIN g_risky r ON r.node_id = h.src
      WHERE f.node_type <> 'substation' AND h.hop > 0 AND h.hop <= CASE f.node_type WHEN 'hospital' THEN 2 ELSE 3 END) b
JOIN g_advice a ON a.kind = b.node_type AND b.risk > a.above AND b.risk <= a.upto
WHERE n = 1"""


def _subs(spark, folder):
    return frame(spark, folder, "v_sub")


def _facilities(spark, folder):
    beds = F.create_map(F.lit("beds"), F.col("beds").cast("string")).alias("props")
    return frame(spark, folder, "v_fac").select("node_id", "name", "node_type", "ord", "lat", "lon", beds)


def _nodes(spark, folder):
    return graph.build_nodes(_subs(spark, folder), _facilities(spark, folder))


def _exposed(spark, folder):
    return alerts.storm_exposure(graph.base_risk(_nodes(spark, folder), AVERAGE_RISK), RING, STORM)


def _risky(spark, folder):
    return alerts.at_risk(graph.base_risk(_nodes(spark, folder), AVERAGE_RISK), RING, STORM)


def _tables(spark, folder):
    return storm_alerts(_subs(spark, folder), _facilities(spark, folder), RING, STORM, AVERAGE_RISK)


@query("SELECT node_id, near_id, round(km, 6) AS km, CAST(rank AS INT) AS rank FROM g_sub_near")
def knn_rank(spark, folder):
    subs = _subs(spark, folder).select("node_id", "ord", "lat", "lon")
    near = spatial.nearest(subs, subs, ["node_id"], 3, 25, exclude_self=True)
    return rounded(near.select("node_id", "near_id", "km", "rank"), km=6)


@query("SELECT u, v, edge_type, distance_km, voltage FROM g_sub_edges")
def knn_substations(spark, folder):
    return graph.substation_edges(_subs(spark, folder))


@query("SELECT u, v, edge_type, distance_km, voltage FROM g_fac_edges")
def facility_service_edges(spark, folder):
    return graph.service_edges(_facilities(spark, folder), _subs(spark, folder))


@query("SELECT u, v, edge_type, distance_km, voltage FROM g_line_edges")
def line_edges(spark, folder):
    return graph.line_edges(frame(spark, folder, "v_line"), _subs(spark, folder))


@query("SELECT u, v, edge_type, distance_km, voltage FROM g_edges")
def grid_edges(spark, folder):
    return graph.build_edges(_nodes(spark, folder))


@query("SELECT u, v, edge_type, distance_km, voltage FROM g_line_edges UNION ALL SELECT * FROM g_fac_edges")
def grid_edges_from_lines(spark, folder):
    return graph.build_edges(_nodes(spark, folder), frame(spark, folder, "v_line"))


@query("SELECT node_id, node_type, name, voltage, subtype, lat, lon, priority, priority_score, beds, ord FROM g_nodes")
def graph_nodes(spark, folder):
    beds = F.try_element_at("props", F.lit("beds")).cast("int").alias("beds")
    return _nodes(spark, folder).select(*[c for c in graph.NODE_COLUMNS if c != "props"], beds)


@query(
    """SELECT node_type, count(*) AS type_nodes, (SELECT count(*) FROM g_nodes) AS total_nodes,
       (SELECT count(*) FROM g_edges) AS total_edges FROM g_nodes GROUP BY node_type"""
)
def graph_summary(spark, folder):
    nodes = _nodes(spark, folder)
    return graph.graph_summary(nodes, graph.build_edges(nodes))


@query("SELECT node_id, lon, base_risk FROM g_base")
def base_risk(spark, folder):
    return graph.base_risk(_nodes(spark, folder), AVERAGE_RISK).select("node_id", "lon", "base_risk")


@query("SELECT node_id, in_storm_zone FROM g_inside")
def point_in_polygon(spark, folder):
    inside = geo.inside_ring(F.col("lon"), F.col("lat"), RING)
    return _subs(spark, folder).select("node_id", inside.alias("in_storm_zone"))


@query("SELECT node_id, round(edge_km, 6) AS edge_km FROM g_inside")
def boundary_distance(spark, folder):
    km = geo.boundary_km(F.col("lon"), F.col("lat"), RING)
    return _subs(spark, folder).select("node_id", F.round(km, 6).alias("edge_km"))


# Every nation is a storm of two parts, the first with a hole, which overlaps other storms. Both sides draw the same rings.
AREA_RINGS = [
    (0, 0, [(0.0, 0.0), (0.62, 0.05), (0.55, 0.31), (0.3, 0.2), (0.02, 0.33)]),
    (0, 1, [(0.2, 0.06), (0.42, 0.08), (0.3, 0.15)]),
    (1, 0, [(0.7, 0.1), (0.95, 0.1), (0.8, 0.35)]),
]
CTES["a_rings"] = "SELECT * FROM (VALUES {}) AS t(part, ring, i, dx, dy)".format(
    ", ".join(f"({p}, {r}, {i}, {x}e0, {y}e0)" for p, r, ring in AREA_RINGS for i, (x, y) in enumerate([*ring, ring[0]]))
)
CTES["a_places"] = """
SELECT concat('storm_', CAST(n_nationkey AS VARCHAR)) AS storm, part, ring, i,
       (-74e0 + (n_nationkey % 5) * 0.3e0) + dx AS lon, (40.45e0 + (n_nationkey // 5) * 0.11e0) + dy AS lat
FROM nation CROSS JOIN a_rings"""
CTES["a_edges"] = """
SELECT a.storm, a.part, a.lon AS x0, a.lat AS y0, b.lon AS x1, b.lat AS y1
FROM a_places a JOIN a_places b ON b.storm = a.storm AND b.part = a.part AND b.ring = a.ring AND b.i = a.i + 1"""
CTES["a_tests"] = """
SELECT s.node_id, storm, part,
       CASE WHEN (y0 > lat) <> (y1 > lat) AND lon < (x1 - x0) * (lat - y0) / nullif(y1 - y0, 0e0) + x0 THEN 1 ELSE 0 END AS crossing,
       CASE WHEN (x1 - x0) * (lat - y0) - (y1 - y0) * (lon - x0) = 0 AND lon BETWEEN least(x0, x1) AND greatest(x0, x1)
             AND lat BETWEEN least(y0, y1) AND greatest(y0, y1) THEN 1 ELSE 0 END AS touching,
       greatest(0e0, least(1e0, ((lon - x0) * (x1 - x0) + (lat - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS t,
       lon, lat, x0, y0, x1, y1
FROM v_sub s CROSS JOIN a_edges"""
CTES["a_exposed"] = """
SELECT node_id, storm, bool_or(inside) AS in_storm_zone, min(km) AS edge_km FROM (
  SELECT node_id, storm, part, sum(crossing) % 2 = 1 AND max(touching) = 0 AS inside,
         min(sqrt((lon - (x0 + t * (x1 - x0))) * (lon - (x0 + t * (x1 - x0))) + (lat - (y0 + t * (y1 - y0))) * (lat - (y0 + t * (y1 - y0))))) * 111e0 AS km
  FROM a_tests GROUP BY node_id, storm, part) GROUP BY node_id, storm"""


def _areas(spark, folder):
    """The nations' storms as GeoJSON documents, read back as an area table."""
    key = F.col("n_nationkey")
    lon, lat = F.lit(-74.0) + (key % 5) * F.lit(0.3), F.lit(40.45) + F.floor(key / 5) * F.lit(0.11)
    ring = lambda places: F.array(*[F.array(lon + x, lat + y) for x, y in [*places, places[0]]])
    parts = [F.array(*[ring(places) for p, _, places in AREA_RINGS if p == part]) for part in (0, 1)]
    feature = F.struct(
        F.struct(F.concat(F.lit("storm_"), key.cast("string")).alias("storm")).alias("properties"),
        F.struct(F.lit("MultiPolygon").alias("type"), F.array(*parts).alias("coordinates")).alias("geometry"),
    )
    nations = spark.read.parquet(f"{folder}/nation.parquet")
    return geojson.area_rows(nations.select(key.cast("string").alias("path"), F.to_json(F.struct(F.array(feature).alias("features"))).alias("value")))


@query("SELECT node_id, storm FROM a_exposed WHERE in_storm_zone")
def point_in_area(spark, folder):
    return areas.points_in_areas(_subs(spark, folder), _areas(spark, folder)).select("node_id", "storm")


@query("SELECT node_id, storm, round(edge_km, 6) AS edge_km FROM a_exposed WHERE edge_km < 30")
def area_boundary_distance(spark, folder):
    """Distances to the boundaries of all storms within 30 km, from inside and outside."""
    found = areas.exposure(_subs(spark, folder), areas.area_index(_areas(spark, folder), 30.0), 30.0)
    return found.where(F.col("edge_km").isNotNull()).select("node_id", "storm", F.round("edge_km", 6).alias("edge_km"))


@query("""
SELECT node_id, storm, in_storm_zone, round(risk, 6) AS adjusted_risk FROM (
  SELECT b.node_id, e.storm, e.in_storm_zone,
         CASE WHEN in_storm_zone THEN least(0.999e0, base_risk * m)
              WHEN edge_km < 30 THEN least(0.999e0, base_risk * m * (1 - edge_km / 60)) END AS risk
  FROM (SELECT *, CASE WHEN CAST(substr(storm, 7) AS INT) % 2 = 0 THEN 2e0 ELSE 1.5e0 END AS m FROM a_exposed) e
  JOIN g_base b ON b.node_id = e.node_id
  UNION ALL SELECT node_id, NULL, false, base_risk FROM g_base) WHERE risk > 0.4e0""")
def at_risk_by_area(spark, folder):
    """Substations at risk under each of several storms at once, and those at risk without any."""
    storms = _areas(spark, folder)
    even = F.substring("storm", 7, 9).cast("int") % 2 == 0
    types = storms.select("storm").distinct().withColumn("storm_type", F.when(even, "Hurricane Cat 1").otherwise("Winter Storm"))
    found = areas.at_risk_by_area(graph.base_risk(_nodes(spark, folder), AVERAGE_RISK), storms, types)
    return found.select("node_id", "storm", "in_storm_zone", F.round("adjusted_risk", 6).alias("adjusted_risk"))


@query(
    "SELECT node_id, base_risk, in_storm_zone, round(edge_km, 6) AS edge_km, round(adjusted_risk, 6) AS adjusted_risk "
    "FROM g_exposed"
)
def adjusted_risk(spark, folder):
    df = _exposed(spark, folder).select("node_id", "base_risk", "in_storm_zone", "edge_km", "adjusted_risk")
    return rounded(df, edge_km=6, adjusted_risk=6)


@query(
    "SELECT node_id, name, lat, lon, voltage, subtype, base_risk, adjusted_risk, in_storm_zone FROM g_risky "
    "ORDER BY adjusted_risk DESC, ord"
)
def at_risk_substations(spark, folder):
    return alerts.by_risk(_risky(spark, folder)).drop("ord")


@query("SELECT src, node, hop FROM g_hops")
def k_hop(spark, folder):
    return graph.k_hop(graph.build_edges(_nodes(spark, folder)), _risky(spark, folder))


ALERTS = ", ".join(alerts.ALERT_COLUMNS)


@query(f"SELECT {ALERTS} FROM g_alerts ORDER BY alert_score DESC, ord, facility_id")
def facility_alerts(spark, folder):
    return alerts.by_score(_tables(spark, folder).alerts).select(*alerts.ALERT_COLUMNS)


@query(
    f"SELECT {ALERTS} FROM g_alerts WHERE priority = 'CRITICAL' ORDER BY alert_score DESC, ord, facility_id LIMIT 12"
)
def alert_queue(spark, folder):
    return alerts.alert_queue(_tables(spark, folder).alerts, "CRITICAL").select(*alerts.ALERT_COLUMNS)


@query("SELECT facility_name, feeding_substation, substation_risk, action FROM g_alerts WHERE priority = 'CRITICAL' "
       "ORDER BY alert_score DESC, ord, facility_id LIMIT 1")
def top_critical_alert(spark, folder):
    top = alerts.alert_queue(_tables(spark, folder).alerts, "CRITICAL", 1)
    return top.select("facility_name", "feeding_substation", "substation_risk", "action")


@query("SELECT priority, facility_name, facility_type, feeding_substation, substation_risk, hop_distance, action FROM g_alerts")
def alert_brief(spark, folder):
    return alerts.alert_brief(_tables(spark, folder).alerts)


@query(
    """SELECT count(*) AS total_alerts, count(*) FILTER (priority = 'CRITICAL') AS critical_count,
       count(*) FILTER (priority = 'HIGH') AS high_count, count(*) FILTER (priority = 'MEDIUM') AS medium_count,
       (SELECT count(*) FROM g_risky) AS total_at_risk_substations FROM g_alerts"""
)
def alert_summary(spark, folder):
    t = _tables(spark, folder)
    return alerts.alert_summary(t.at_risk, t.alerts)


SHARED = """
SELECT feeding_substation_id, feeding_substation, count(*) AS facilities, count(*) FILTER (facility_type = 'hospital') AS hospitals,
       count(*) FILTER (facility_type = 'fire_station') AS fire_stations,
       count(*) FILTER (facility_type = 'school') AS schools, max(substation_risk) AS substation_risk
FROM g_alerts WHERE hop_distance = 1 GROUP BY feeding_substation_id, feeding_substation"""


@query(SHARED)
def shared_feeders(spark, folder):
    return alerts.shared_feeders(_tables(spark, folder).alerts)


@query(
    f"""SELECT a.feeding_substation_id, a.feeding_substation, s.facilities, facility_id, facility_name, facility_type
FROM g_alerts a JOIN ({SHARED}) s ON a.feeding_substation_id = s.feeding_substation_id AND s.facilities >= 2
WHERE hop_distance = 1"""
)
def feeder_members(spark, folder):
    return alerts.feeder_members(_tables(spark, folder).alerts)


@query(
    'SELECT name AS "Substation", voltage AS "kV", subtype AS "Type", adjusted_risk AS "Risk", '
    'in_storm_zone AS "In Storm Zone" FROM g_risky'
)
def substation_view(spark, folder):
    return alerts.substation_view(_risky(spark, folder))


@query(
    """SELECT e.u, e.v, e.edge_type, e.distance_km, a.lat AS u_lat, a.lon AS u_lon, b.lat AS v_lat, b.lon AS v_lon,
       p.node_id IS NOT NULL AND q.node_id IS NOT NULL AS both_at_risk,
       CASE WHEN p.node_id IS NOT NULL AND q.node_id IS NOT NULL THEN '#ef4444' ELSE '#1d4ed8' END AS colour
FROM g_edges e JOIN v_sub a ON a.node_id = e.u JOIN v_sub b ON b.node_id = e.v
LEFT JOIN g_risky p ON p.node_id = e.u LEFT JOIN g_risky q ON q.node_id = e.v"""
)
def edge_layer(spark, folder):
    nodes = _nodes(spark, folder)
    return alerts.edge_layer(nodes, graph.build_edges(nodes), _risky(spark, folder)).drop("tooltip", "geometry")


@query(
    """SELECT n.node_id, n.name, n.voltage, n.subtype, n.lat, n.lon, coalesce(r.adjusted_risk, 0e0) AS risk,
       coalesce(r.in_storm_zone, false) AS in_zone,
       CASE WHEN r.in_storm_zone THEN 'in_zone' WHEN r.adjusted_risk > 0.4e0 THEN 'elevated' ELSE 'normal' END AS style,
       CASE WHEN r.in_storm_zone THEN '#ef4444' WHEN r.adjusted_risk > 0.4e0 THEN '#f59e0b' ELSE '#3b82f6' END AS colour,
       CASE WHEN r.in_storm_zone THEN 12 WHEN r.adjusted_risk > 0.4e0 THEN 9 ELSE 6 END AS radius
FROM g_base n LEFT JOIN g_risky r USING (node_id)"""
)
def substation_layer(spark, folder):
    return alerts.substation_layer(_nodes(spark, folder), _risky(spark, folder)).drop("geometry")


@query(
    """SELECT facility_id, priority,
       CASE priority WHEN 'CRITICAL' THEN '#ef4444' WHEN 'HIGH' THEN '#f59e0b' ELSE '#3b82f6' END AS colour,
       feeding_sub_lat, feeding_sub_lon, lat, lon, feeding_substation || ' → ' || facility_name AS route FROM g_alerts"""
)
def route_layer(spark, folder):
    return alerts.route_layer(_tables(spark, folder).alerts).drop("geometry")


@query(
    """SELECT facility_id, facility_name, facility_type, priority,
       CASE priority WHEN 'CRITICAL' THEN '#ef4444' WHEN 'HIGH' THEN '#f59e0b' ELSE '#3b82f6' END AS colour,
       feeding_substation, substation_risk, hop_distance, alert_score, action, lat, lon,
       CASE WHEN facility_type = 'hospital' AND beds > 0 THEN beds END AS popup_beds, CAST(NULL AS VARCHAR) AS popup_trauma
FROM g_alerts"""
)
def alert_layer(spark, folder):
    return alerts.alert_layer(_tables(spark, folder).alerts).drop("geometry")


@query(
    """SELECT node_id, i, round(degrees(lo + atan2(sin(br) * sin(arc) * cos(la), cos(arc) - sin(la) * sin(la2))), 6) AS lon,
       round(degrees(la2), 6) AS lat
FROM (SELECT *, asin(sin(la) * cos(arc) + cos(la) * sin(arc) * cos(br)) AS la2
      FROM (SELECT node_id, CAST(i AS INT) AS i, radians(lat) AS la, radians(lon) AS lo, 100 / 6371.0088e0 AS arc,
                   (i % 16) * 2 * pi() / 16 AS br
            FROM v_sub, unnest(range(0, 17)) AS r(i)))"""
)
def storm_circle(spark, folder):
    """A 100 km circle of 16 vertices around every substation, vertex by vertex."""
    ring = geo.circle_ring(F.col("lat"), F.col("lon"), F.lit(100.0), 16)
    return _subs(spark, folder).select("node_id", F.posexplode(ring).alias("i", "p")).select(
        "node_id", "i", F.round("p.lon", 6).alias("lon"), F.round("p.lat", 6).alias("lat")
    )


@query(
    """SELECT a.node_id, b.node_id AS near_id,
       round(asin(least(1e0, sqrt(sin(radians(b.lat - a.lat) / 2) * sin(radians(b.lat - a.lat) / 2)
             + cos(radians(a.lat)) * cos(radians(b.lat)) * sin(radians(b.lon - a.lon) / 2) * sin(radians(b.lon - a.lon) / 2))))
             * 2 * 6371.0088e0, 6) AS great_circle_km
FROM g_sub_near n JOIN v_sub a ON a.node_id = n.node_id JOIN v_sub b ON b.node_id = n.near_id"""
)
def haversine_links(spark, folder):
    subs = _subs(spark, folder).select("node_id", "ord", "lat", "lon")
    near = spatial.nearest(subs, subs, ["node_id"], 3, 25, exclude_self=True)
    km = geo.haversine_km(F.col("lat"), F.col("lon"), F.col("near_lat"), F.col("near_lon"))
    return near.select("node_id", "near_id", F.round(km, 6).alias("great_circle_km"))
