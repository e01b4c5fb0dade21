"""Neighbours, graph, storm risk and alerts."""

import math
import os

import pytest
from pyspark.sql import functions as F

from outagegrid.functions import geo
from outagegrid.operators import alerts, graph, spatial
from outagegrid.plans.alerting import storm_alerts
from outagegrid.sources import files, geojson

SQUARE = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]


def brute(queries, points, k, cap, own=False):
    out = {}
    for q, (lat, lon) in queries.items():
        near = sorted(
            (math.sqrt((lat - la) ** 2 + (lon - lo) ** 2) * 111, o, p)
            for p, (o, la, lo) in points.items()
            if not (own and p == q)
        )
        out[q] = [(p, round(d, 6)) for d, _, p in near if d < cap][:k]
    return out


def found(df, key="node_id"):
    out = {}
    for r in df.orderBy(key, "rank").collect():
        out.setdefault(r[key], []).append((r.near_id, round(r.km, 6)))
    return out


def grid_points(spark, n, dense):
    """``dense`` of ``n`` points in a spot of some hundred metres, a tenth of them on one place; the rest spread out."""
    i = F.col("id")
    spot = i < dense
    lat = F.when(spot & (i % 10 == 0), 40.7).when(spot, 40.7 + (i * 7919 % 1009) / 4e5).otherwise(40.2 + (i * 6007 % 9001) / 9001)
    lon = F.when(spot & (i % 10 == 0), -73.4).when(spot, -73.4 + (i * 104729 % 1013) / 4e5).otherwise(-74 + (i * 1299709 % 20011) / 10005)
    return spark.range(n).select(
        F.concat(F.lit("p"), i).alias("node_id"), i.alias("ord"), lat.alias("lat"), lon.alias("lon")
    )


@pytest.mark.parametrize("dense", [0, 300])
def test_nearest_equals_brute_force(spark, dense):
    points = grid_points(spark, 600, dense).persist()
    rows = points.collect()
    table = {r.node_id: (r.ord, r.lat, r.lon) for r in rows}
    got = found(spatial.nearest(points, points, ["node_id"], 3, 25, exclude_self=True))
    want = {q: v for q, v in brute({r.node_id: (r.lat, r.lon) for r in rows}, table, 3, 25, True).items() if v}
    assert got == want
    if dense:
        queries = points.select(F.concat(F.lit("q"), "ord").alias("node_id"), (F.col("lat") + 0.003).alias("lat"), "lon")
        asked = {r.node_id: (r.lat, r.lon) for r in queries.collect()}
        assert found(spatial.nearest(queries, points, ["node_id"], 2, 20)) == {
            q: v for q, v in brute(asked, table, 2, 20).items() if v
        }


def test_dense_points_are_refined(spark):
    def prepared(dense):
        unit = 25 / 111
        return grid_points(spark, 600, dense).select((F.col("lat") / unit).alias("pu"), (F.col("lon") / unit).alias("pv"))

    assert spatial._depth(prepared(0)) <= 1 < spatial._depth(prepared(300))


def test_nearest_ties_go_by_order_and_cap_is_strict(spark):
    points = spark.createDataFrame(
        [("b", 2, 0.1, 0.0), ("a", 1, -0.1, 0.0), ("far", 0, 25 / 111, 5.0)], "node_id string, ord int, lat double, lon double"
    )
    queries = spark.createDataFrame([("q", 0.0, 0.0), ("r", 0.0, 5.0)], "node_id string, lat double, lon double")
    got = found(spatial.nearest(queries, points, ["node_id"], 1, 25))
    assert got == {"q": [("a", 11.1)]}


@pytest.fixture(scope="module")
def chain(spark):
    """Substations s0, s1 and facilities: s0 - h0 - s1 - f0, and an isolated school."""
    subs = spark.createDataFrame(
        [("s0", "S zero", "138", 0.5, 0.5, 0), ("s1", "S one", "69", 0.5, 5.0, 1)],
        "node_id string, name string, voltage string, lat double, lon double, ord int",
    )
    facilities = spark.createDataFrame(
        [("h0", "hospital", "H", 0.5, 2.0, {"BEDS": "7"}, 0), ("f0", "fire_station", "F", 0.5, 5.1, {}, 1),
         ("c0", "school", "C", 9.0, 9.0, {}, 2), ("x0", "hospital", "X", None, 1.0, {}, 3)],
        "node_id string, node_type string, name string, lat double, lon double, props map<string,string>, ord int",
    )
    edges = spark.createDataFrame(
        [("h0", "s0", "service", 1.0, None), ("h0", "s1", "service", 1.0, None), ("f0", "s1", "service", 1.0, None)],
        "u string, v string, edge_type string, distance_km double, voltage string",
    )
    return graph.build_nodes(subs, facilities), edges


def test_nodes_without_place_are_dropped(chain):
    nodes, _ = chain
    rows = {r.node_id: r for r in nodes.collect()}
    assert set(rows) == {"s0", "s1", "h0", "f0", "c0"}
    assert rows["s0"].subtype == "transmission" and rows["s1"].subtype == "distribution"
    assert rows["h0"].priority == "CRITICAL" and rows["f0"].priority_score == 7


def test_hops_pass_through_facilities(chain):
    nodes, edges = chain
    got = {(r.src, r.node): r.hop for r in graph.k_hop(edges, nodes.where("node_id = 's0'")).collect()}
    assert got == {("s0", "s0"): 0, ("s0", "h0"): 1, ("s0", "s1"): 2, ("s0", "f0"): 3}


def test_alerts_pick_the_best_feeder_and_respect_hop_limits(chain, spark):
    nodes, edges = chain
    risky = spark.createDataFrame(
        [("s0", "S zero", 0.5, 0.5, "138", "transmission", 0.3, 0.9, True, 0)],
        "node_id string, name string, lat double, lon double, voltage string, subtype string, base_risk double, "
        "adjusted_risk double, in_storm_zone boolean, ord long",
    )
    got = {r.facility_id: r for r in alerts.facility_alerts(nodes, edges, risky).collect()}
    assert set(got) == {"h0", "f0"}
    assert got["h0"].beds == 7 and got["h0"].alert_score == 9.0 and got["h0"].trauma == "N/A"
    assert got["f0"].hop_distance == 3 and got["f0"].alert_score == pytest.approx(0.9 * 7 / math.sqrt(3), abs=1e-4)
    both = risky.unionByName(risky.withColumns({"node_id": F.lit("s1"), "name": F.lit("S one"), "ord": F.lit(1).cast("long")}))
    got = {r.facility_id: r for r in alerts.facility_alerts(nodes, edges, both).collect()}
    assert got["h0"].feeding_substation == "S zero"  # equal score and risk: the earlier substation
    assert got["f0"].feeding_substation == "S one" and got["f0"].hop_distance == 1
    assert alerts.alert_summary(both, alerts.facility_alerts(nodes, edges, both)).first().asDict() == {
        "total_alerts": 2, "critical_count": 1, "high_count": 1, "medium_count": 0, "total_at_risk_substations": 2,
    }


def test_polygon_boundary_is_outside(spark):
    points = spark.createDataFrame(
        [(0.5, 0.5, True), (0.0, 0.5, False), (1.0, 1.0, False), (1.5, 0.5, False), (0.5, 1e-9, True)],
        "lon double, lat double, want boolean",
    )
    got = points.select("want", geo.inside_ring(F.col("lon"), F.col("lat"), SQUARE).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_boundary_distance_and_risk_zones(spark):
    subs = spark.createDataFrame(
        [("in", 0.5, 0.5, 0.3), ("near", 0.5, 1.1, 0.3), ("far", 0.5, 3.0, 0.3), ("cap", 0.5, 0.4, 0.9)],
        "node_id string, lat double, lon double, base_risk double",
    )
    got = {r.node_id: r for r in alerts.storm_exposure(subs, SQUARE, "Hurricane Cat 1").collect()}
    assert got["in"].adjusted_risk == pytest.approx(0.6) and got["cap"].adjusted_risk == 0.999
    assert got["near"].edge_km == pytest.approx(11.1)
    assert got["near"].adjusted_risk == pytest.approx(0.6 * (1 - 11.1 / 60)) and got["far"].adjusted_risk == 0.3
    calm = {r.node_id: r for r in alerts.storm_exposure(subs, SQUARE, "No Active Storm").collect()}
    assert calm["near"].adjusted_risk < calm["near"].base_risk


def test_base_risk_bands_and_defaults(spark, chain):
    subs = spark.createDataFrame(
        [("a", "substation", -73.0), ("b", "substation", -73.5), ("c", "substation", -73.6), ("d", "school", -73.0)],
        "node_id string, node_type string, lon double",
    )
    got = {r.node_id: r.base_risk for r in graph.base_risk(subs, 0.3).collect()}
    assert got == {"a": 0.255, "b": 0.3, "c": 0.345}
    none = spark.createDataFrame([("1001", 0.1, 0.2)], "fips string, mean_outage_proba double, max_outage_proba double")
    assert tuple(graph.region_risk(none).first()) == (0.45, 0.75)


def test_line_edges_keep_the_first(spark):
    subs = spark.createDataFrame(
        [("s0", 0, 0.0, 0.0), ("s1", 1, 0.0, 0.1), ("s2", 2, 0.0, 0.9)], "node_id string, ord int, lat double, lon double"
    )
    lines = spark.createDataFrame(
        [(0, 0.0, 0.01, 0.0, 0.09, None), (1, 0.0, 0.0, 0.0, 0.5, "345")],
        "line_id int, lat0 double, lon0 double, lat1 double, lon1 double, voltage string",
    )
    rows = graph.line_edges(lines, subs).collect()
    assert [(r.u, r.v, r.distance_km, r.voltage) for r in rows] == [("s0", "s1", 9.99, "115")]


def test_circle_keeps_its_radius(spark):
    for storm in geojson.named_storms(spark).collect():
        lat, lon, radius = geojson.fixed.STORM_CIRCLES[storm.name]
        assert len(storm.ring) == 65 and tuple(storm.ring[0]) == pytest.approx(tuple(storm.ring[64]))
        ring = spark.createDataFrame([(p.lon, p.lat) for p in storm.ring], "lon double, lat double")
        km = ring.select(geo.haversine_km(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon")).alias("k")).collect()
        assert all(r.k == pytest.approx(radius, rel=1e-9) for r in km)


def test_sample_grid_runs_end_to_end(spark):
    subs, facilities = files.sample_grid(spark)
    assert (subs.count(), facilities.count(), files.empty_schools(spark).count()) == (20, 30, 0)
    ring = [(-75.0, 40.0), (-72.0, 40.0), (-72.0, 41.5), (-75.0, 41.5), (-75.0, 40.0)]
    tables = storm_alerts(subs, facilities, ring, "Hurricane Cat 3", 0.3)
    assert tables.at_risk.count() == 20 and tables.alerts.count() == 30
    assert alerts.shared_feeders(tables.alerts).agg(F.sum("facilities")).first()[0] == 30
    assert tables.alerts.where("substation_risk > 0.85 and facility_type = 'fire_station' and action != 'act_now'").count() == 0


GOLDEN = os.environ.get("OUTAGEGRID_GOLDEN")


@pytest.mark.skipif(not GOLDEN, reason="set OUTAGEGRID_GOLDEN to a published alert document to compare with it")
def test_published_alert_document(spark):
    """Feeders, hops, risks and scores of a published document follow from its own coordinates and base risks."""
    risky, published, summary = geojson.read_alert_document(spark, GOLDEN)
    number = F.regexp_extract("node_id", "([0-9]+)$", 1).cast("int")
    subs = risky.select("node_id", "name", "voltage", "subtype", "lat", "lon", number.alias("ord")).persist()
    fac = published.select(
        F.col("facility_id").alias("node_id"), F.col("facility_type").alias("node_type"),
        F.col("facility_name").alias("name"), "lat", "lon",
        F.create_map(F.lit("beds"), F.col("beds").cast("string"), F.lit("trauma"), F.col("trauma")).alias("props"), "ord",
    )
    nodes = graph.build_nodes(subs, fac)
    edges = graph.build_edges(nodes)
    assert edges.where("edge_type = 'distribution'").count() == 34 and edges.count() == 90
    stormy = alerts.adjusted_risk(F.col("base_risk"), F.lit(3.5), F.col("in_storm_zone"), F.lit(0.0))
    ours = risky.withColumns({"adjusted_risk": F.round(stormy, 4), "ord": number.cast("long")})
    theirs = risky.select("node_id", F.col("adjusted_risk").alias("want"))
    assert ours.join(theirs, "node_id").where("adjusted_risk <> want").count() == 0
    columns = [c for c in alerts.ALERT_COLUMNS if c != "action"]
    got = sorted(map(tuple, alerts.facility_alerts(nodes, edges, ours).select(columns).collect()))
    assert got == sorted(map(tuple, published.select(columns).collect()))
    totals = alerts.alert_summary(ours, published).first().asDict()
    assert totals == {k: v for k, v in summary.first().asDict().items() if k in totals}


def test_hops_leave_the_edges_where_they_lie(spark):
    edges = spark.range(200).select(
        F.concat(F.lit("n"), F.col("id")).alias("u"), F.concat(F.lit("n"), (F.col("id") * 7 + 1) % 200).alias("v")
    )
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        adjacency = graph.land_adjacency(edges)
        reached = graph.hops(adjacency, spark.createDataFrame([("n0",), ("n5",)], "node_id string"), 3)
        plan = reached._jdf.queryExecution().sparkPlan().toString() + reached._jdf.queryExecution().executedPlan().toString()
        rows = {(r.src, r.node): r.hop for r in reached.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # Joins on node read the buckets as they lie: what is moved by node is the walks' ends, once a round.
    assert "Bucketed: true" in plan and plan.count("Bucketed: false") == 0
    near = {}
    for u, v in [(r.u, r.v) for r in edges.collect()]:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    for src in ("n0", "n5"):
        ring, seen = {src}, {src: 0}
        for hop in (1, 2, 3):
            ring = {n for m in ring for n in near[m]} - seen.keys()
            seen |= {n: hop for n in ring}
        assert {n: h for (s, n), h in rows.items() if s == src} == seen


def test_substations_that_share_order_and_risk_give_one_alert(spark):
    nodes = spark.createDataFrame(
        [("sub_b", "substation", "B", 1), ("sub_a", "substation", "A", 1), ("hospital_1", "hospital", "H", 9)],
        "node_id string, node_type string, name string, ord long",
    ).selectExpr("*", "40.0 AS lat", "-73.0 AS lon", "map('beds', '3') AS props")
    edges = spark.createDataFrame([("hospital_1", "sub_a"), ("hospital_1", "sub_b")], "u string, v string")
    risky = nodes.where("node_type = 'substation'").selectExpr("node_id", "name", "lat", "lon", "ord", "0.9 AS adjusted_risk", "true AS in_storm_zone")
    got = alerts.facility_alerts(nodes, edges, risky).collect()
    assert [(r.facility_id, r.feeding_substation_id, r.hop_distance) for r in got] == [("hospital_1", "sub_a", 1)]


def test_queries_are_dealt_by_their_number(spark, monkeypatch):
    """A task opens the cells of a bounded number of queries, however few bytes all of them have."""
    monkeypatch.setattr(spatial, "QUERIES_PER_TASK", 50)
    points = grid_points(spark, 600, 0)
    near = spatial.nearest(points, points, ["node_id"], 3, 25, exclude_self=True)
    assert near.rdd.getNumPartitions() >= 12


def test_a_full_cell_of_the_last_level_is_read_in_parts(spark):
    """Far more points than a leaf's worth within some centimetres."""
    i = F.col("id")
    points = spark.range(200).select(
        F.concat(F.lit("p"), i).alias("node_id"), i.alias("ord"),
        (40.7 + (i * 79 % 211) / 1e9).alias("lat"), (-73.4 + (i * 37 % 199) / 1e9).alias("lon"),
    ).persist()
    unit = 25 / 111
    placed = points.select((F.col("lat") / unit).alias("pu"), (F.col("lon") / unit).alias("pv"), *[
        F.col(c).alias(f"near_{n}") for c, n in (("node_id", "id"), ("ord", "ord"), ("lat", "lat"), ("lon", "lon"))
    ])
    assert max(len(r.pts) for r in spatial._leaves(placed, spatial.DEEPEST).collect()) == spatial.LEAF_POINTS
    rows = points.collect()
    table = {r.node_id: (r.ord, r.lat, r.lon) for r in rows}
    got = spatial.nearest(points, points, ["node_id"], 3, 25, exclude_self=True)
    want = brute({r.node_id: (r.lat, r.lon) for r in rows}, table, 3, 25, True)
    assert {q: [p for p, _ in v] for q, v in found(got).items()} == {q: [p for p, _ in v] for q, v in want.items()}
