"""The area index against plain loops over all edges."""

import math
import random

import pytest

from outagegrid.operators import areas
from outagegrid.sources import geojson

POINTS = "node_id string, lon double, lat double, base_risk double, storm_rank int, edges string"
AREAS = "storm string, part int, hole boolean, ring array<struct<lon:double,lat:double>>"


def plain(points, rings, reach):
    out = {}
    for name, lon, lat, *_ in points:
        if lon is None or lat is None:
            continue
        for storm in {r[0] for r in rings}:
            inside, near = False, math.inf
            for part in {r[1] for r in rings if r[0] == storm}:
                odd = touch = False
                for s, p, _, ring in rings:
                    ring = [q for q in ring if None not in q]
                    if (s, p) != (storm, part) or len(ring) < 3:
                        continue
                    for (x0, y0), (x1, y1) in zip(ring, [*ring[1:], ring[0]]):
                        dx, dy = x1 - x0, y1 - y0
                        odd ^= (y0 > lat) != (y1 > lat) and lon < dx * (lat - y0) / dy + x0
                        on = dx * (lat - y0) - dy * (lon - x0) == 0
                        touch |= on and min(x0, x1) <= lon <= max(x0, x1) and min(y0, y1) <= lat <= max(y0, y1)
                        size = dx * dx + dy * dy
                        t = max(0.0, min(1.0, ((lon - x0) * dx + (lat - y0) * dy) / size)) if size else 0.0
                        near = min(near, math.hypot(lon - (x0 + t * dx), lat - (y0 + t * dy)) * 111)
                inside |= odd and not touch
            if inside or near < reach:
                out[name, storm] = inside, near if near < reach else None
    return out


def check(spark, points, rings, reach, cell):
    p = spark.createDataFrame([(*r, 0.5, 1, "x") for r in points], POINTS)
    a = spark.createDataFrame([(s, k, h, [{"lon": x, "lat": y} for x, y in ring]) for s, k, h, ring in rings], AREAS)
    rows = areas.exposure(p, areas.area_index(a, reach, cell), reach, cell).collect()
    found = {(r.node_id, r.storm): (r.in_storm_zone, r.edge_km) for r in rows}
    want = plain(points, rings, reach)
    assert len(rows) == len(found) and found.keys() == want.keys()
    for key, (inside, km) in want.items():
        assert found[key][0] == inside and (found[key][1] is None) == (km is None)
        assert km is None or found[key][1] == pytest.approx(km, abs=1e-9)


@pytest.mark.parametrize("cell", [0.125, 0.5, 5.0])
def test_index_equals_all_edges(spark, cell):
    r = random.Random(7)
    near_grid = lambda: round(r.uniform(-2, 2) * 8) / 8 if r.random() < 0.5 else r.uniform(-2, 2)
    rings = []
    for storm in "abc":
        for part in range(2):
            places = [(near_grid(), near_grid()) for _ in range(r.randint(3, 9))]
            rings.append((storm, part, False, places))
            rings.append((storm, part, True, [(x / 2, y / 2) for x, y in places]))
    rings += [("thin", 0, False, [(0.0, 0.0), (1.0, 0.0), (0.5, 0.0)]), ("none", 0, False, [(0.0, 0.0), (1.0, 1.0)])]
    rings.append(("gap", 0, False, [(0.0, 0.0), (None, 1.0), (1.0, 0.0), (1.0, 1.0)]))
    points = [(f"p{i}", near_grid(), near_grid()) for i in range(150)]
    points += [(f"v{i}", *q) for i, q in enumerate(rings[0][3])] + [("nowhere", None, 1.0), ("far", 150.0, 80.0)]
    check(spark, points, rings, 30.0, cell)


def test_empty(spark):
    check(spark, [("p", 0.0, 0.0)], [("x", 0, False, [])], 30.0, 0.125)
    check(spark, [("p", None, None)], [("x", 0, False, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)])], 30.0, 0.125)


def test_areas_of_documents(spark):
    text = """{"features": [
      {"properties": {"storm": "s"}, "geometry": {"type": "Polygon", "coordinates": [[[0,0],[4,0],[4,4],[0,0]],[[2,1],[3,1],[3,2],[2,1]]]}},
      {"properties": {"name": "s"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[9,9],[10,9],[10,10],[9,9]]],[[[7,7],[8,7],[8,8],[7,7]]]]}},
      {"properties": {}, "geometry": {"type": "Polygon", "coordinates": [[[0,0],[1,0],[1,1],[0,0]]]}},
      {"properties": {"name": "n"}, "geometry": null}, {"properties": {"name": "p"}, "geometry": {"type": "Point", "coordinates": [1,2]}}]}"""
    rows = geojson.area_rows(spark.createDataFrame([("a", text)], "path string, value string"))
    found = sorted((r.storm, tuple(r.part), r.hole, len(r.ring)) for r in rows.collect())
    assert found == [("area_2", (2, 0), False, 4), ("s", (0, 0), False, 4), ("s", (0, 0), True, 4), ("s", (1, 0), False, 4), ("s", (1, 1), False, 4)]
    at = spark.createDataFrame([("in", 2.0, 0.5), ("hole", 2.7, 1.2), ("other", 9.8, 9.2), ("out", 8.5, 8.5)], "node_id string, lon double, lat double")
    got = {(r.node_id, r.storm) for r in areas.points_in_areas(at, rows).collect()}
    assert got == {("in", "s"), ("other", "s")}
