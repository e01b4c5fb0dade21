"""Planar-degree distances, polygons and circles as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from outagegrid.fixed import KM_PER_DEGREE

EARTH_KM = 6371.0088
RING_TYPE = "array<struct<lon:double,lat:double>>"


def degree_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Euclidean degrees times 111, with no correction for latitude: the distance every grid rule is stated in."""
    dy, dx = lat_a - lat_b, lon_a - lon_b
    return F.sqrt(dy * dy + dx * dx) * F.lit(float(KM_PER_DEGREE))


def haversine_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    return F.asin(F.least(F.lit(1.0), F.sqrt(h))) * (2 * EARTH_KM)


def ring_edges(ring: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.size(ring) - 2),
        lambda i: F.struct(
            F.get(ring, i)["lon"].alias("x0"), F.get(ring, i)["lat"].alias("y0"),
            F.get(ring, i + 1)["lon"].alias("x1"), F.get(ring, i + 1)["lat"].alias("y1"),
        ),
    )


def _edge_constants(ring: list[tuple[float, float]]) -> Column:
    """The edges of one closed storm outline as a constant of the plan."""
    return F.array(
        *[
            F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(("x0", "y0", "x1", "y1"), (*a, *b))])
            for a, b in zip(ring, ring[1:])
        ]
    )


def crosses_east(lon: Column, lat: Column, e: Column) -> Column:
    """Whether a ray east from the place crosses the edge."""
    x = (e["x1"] - e["x0"]) * (lat - e["y0"]) / F.nullif(e["y1"] - e["y0"], F.lit(0.0)) + e["x0"]
    return F.coalesce(((e["y0"] > lat) != (e["y1"] > lat)) & (lon < x), F.lit(False))


def touches(lon: Column, lat: Column, e: Column) -> Column:
    """Whether the place is on the edge."""
    turn = (e["x1"] - e["x0"]) * (lat - e["y0"]) - (e["y1"] - e["y0"]) * (lon - e["x0"])
    return (
        (turn == 0)
        & lon.between(F.least(e["x0"], e["x1"]), F.greatest(e["x0"], e["x1"]))
        & lat.between(F.least(e["y0"], e["y1"]), F.greatest(e["y0"], e["y1"]))
    )


def edge_degrees(lon: Column, lat: Column, e: Column) -> Column:
    """Distance of the place to the edge."""
    dx, dy = e["x1"] - e["x0"], e["y1"] - e["y0"]
    along = ((lon - e["x0"]) * dx + (lat - e["y0"]) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    ex, ey = lon - (e["x0"] + t * dx), lat - (e["y0"] + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def inside_ring(lon: Column, lat: Column, ring: list[tuple[float, float]]) -> Column:
    """Even-odd rule, with points on an edge counted as outside. A bounding-box test runs first."""
    edges = _edge_constants(ring)
    odd = F.size(F.filter(edges, lambda e: crosses_east(lon, lat, e))) % 2 == 1
    xs, ys = [float(p[0]) for p in ring], [float(p[1]) for p in ring]
    in_box = lon.between(min(xs), max(xs)) & lat.between(min(ys), max(ys))
    return F.when(in_box, odd & ~F.exists(edges, lambda e: touches(lon, lat, e))).otherwise(False)


def boundary_km(lon: Column, lat: Column, ring: list[tuple[float, float]]) -> Column:
    """Shortest distance to any edge of the ring, degrees times 111."""
    return F.array_min(F.transform(_edge_constants(ring), lambda e: edge_degrees(lon, lat, e))) * F.lit(float(KM_PER_DEGREE))


def circle_ring(lat: Column, lon: Column, radius_km: Column, vertices: int = 64) -> Column:
    """A closed ring of great-circle destination points around a centre."""
    arc = radius_km / F.lit(EARTH_KM)
    la, lo = F.radians(lat), F.radians(lon)

    def vertex(i: Column) -> Column:
        bearing = (i % vertices) * F.lit(2 * math.pi) / vertices
        la2 = F.asin(F.sin(la) * F.cos(arc) + F.cos(la) * F.sin(arc) * F.cos(bearing))
        lo2 = lo + F.atan2(F.sin(bearing) * F.sin(arc) * F.cos(la), F.cos(arc) - F.sin(la) * F.sin(la2))
        return F.struct(F.degrees(lo2).alias("lon"), F.degrees(la2).alias("lat"))

    return F.transform(F.sequence(F.lit(0), F.lit(vertices)), vertex)


def area_centroid(rings: Column) -> Column:
    """Area-weighted centroid of ``array<struct<hole: boolean, ring: array<place>>>``: holes count against the area
    whichever way they are wound. Where the area is zero, the vertex mean of the first ring."""

    def ring_sum(r: Column, value) -> Column:
        return F.aggregate(ring_edges(r["ring"]), F.lit(0.0), lambda s, e: s + value(e))

    def cross(e: Column) -> Column:
        return e["x0"] * e["y1"] - e["x1"] * e["y0"]

    def piece(r: Column) -> Column:
        area = ring_sum(r, cross)
        sign = F.signum(area) * F.when(r["hole"], -1.0).otherwise(1.0)
        return F.struct(
            (sign * area).alias("a"),
            (sign * ring_sum(r, lambda e: (e["x0"] + e["x1"]) * cross(e))).alias("cx"),
            (sign * ring_sum(r, lambda e: (e["y0"] + e["y1"]) * cross(e))).alias("cy"),
        )

    return _weighted_centre(F.transform(rings, piece), F.get(rings, F.lit(0))["ring"], 3)


def line_centroid(lines: Column) -> Column:
    """Length-weighted centre of ``array<array<place>>``; the vertex mean where all lengths are zero."""

    def piece(e: Column) -> Column:
        dx, dy = e["x1"] - e["x0"], e["y1"] - e["y0"]
        length = F.sqrt(dx * dx + dy * dy)
        return F.struct(
            length.alias("a"), (length * (e["x0"] + e["x1"]) / 2).alias("cx"),
            (length * (e["y0"] + e["y1"]) / 2).alias("cy"),
        )

    edges = F.flatten(F.transform(F.filter(lines, lambda line: F.size(line) > 1), ring_edges))
    return _weighted_centre(F.transform(edges, piece), F.flatten(lines), 1)


def mean_place(places: Column) -> Column:
    mean = lambda axis: F.aggregate(places, F.lit(0.0), lambda s, p: s + p[axis]) / F.nullif(F.size(places), F.lit(0))
    return F.struct(mean("lon").alias("lon"), mean("lat").alias("lat"))


def _weighted_centre(pieces: Column, places: Column, scale: int) -> Column:
    def total(part: str) -> Column:
        return F.aggregate(pieces, F.lit(0.0), lambda s, p: s + p[part])

    def mean(axis: str) -> Column:
        return F.aggregate(places, F.lit(0.0), lambda s, p: s + p[axis]) / F.size(places)

    weight = F.nullif(total("a") * scale, F.lit(0.0))
    return F.struct(
        F.coalesce(total("cx") / weight, mean("lon")).alias("lon"),
        F.coalesce(total("cy") / weight, mean("lat")).alias("lat"),
    )
