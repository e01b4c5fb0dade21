"""Storm areas as tables: polygons of several parts and holes, indexed by grid cells, met by points with one equi-join.

An area table has one row per ring: ``storm``, ``part``, ``hole`` and ``ring``, an array of places. Edges are cut into the
cells of a fixed grid. Going east from a point to count crossings, most edges of its row of cells need no test: an edge that
spans the row and lies east of the point's cell crosses for every point in the cell. Such edges are one parity bit of the
cell; the edges in the cell, and those that begin or end inside the row, are kept to be tested. Cells inside an area have
their bit and no or few edges, cells outside have no row. Edges within reach of a cell are kept for distances too.

Points join the index on their cell, and each pair of a point and a storm is then one row with all it needs: no further
shuffle, no ring on the driver, no constant in the plan. A hot cell is a skewed key of an equi-join, which adaptive
execution splits on the points' side.

A point is in an area if an odd number of a part's edges cross east of it and none of that part's edges touches it. Rings are closed
if they are not; rings of fewer than three places and places that are null are left out. Points without a place are in no area.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.functions import codes, geo
from outagegrid.operators.alerts import adjusted_risk

CELL = 0.125  # degrees
MARGIN = 1e-9  # degrees an edge is widened by when it is put into cells; tests themselves are exact
EDGE = ("x0", "y0", "x1", "y1")


def area_edges(areas: DataFrame) -> DataFrame:
    """storm, part, x0, y0, x1, y1 of all rings, closed."""
    places = F.filter("ring", lambda p: p["lon"].isNotNull() & p["lat"].isNotNull())
    closed = F.when(F.element_at("places", 1) == F.element_at("places", -1), F.col("places")).otherwise(
        F.concat("places", F.slice("places", 1, 1))
    )
    rings = areas.select("storm", "part", places.alias("places")).where(F.size("places") >= 3)
    return (
        rings.withColumn("places", closed).select("storm", "part", F.explode(geo.ring_edges(F.col("places"))).alias("e"))
        .select("storm", "part", "e.*")
    )


def _cell_of(x: Column, cell: float) -> Column:
    return F.floor(x / F.lit(cell))


def _banded(edges: DataFrame, cell: float, reach: float) -> DataFrame:
    """Every edge once per row of cells it comes within ``reach`` of, with the range of cells it comes near there."""
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    wide = F.lit(reach + MARGIN)
    rows = edges.withColumn("iy", F.explode(F.sequence(_cell_of(low - wide, cell), _cell_of(high + wide, cell))))
    floor_, ceiling = F.col("iy") * F.lit(cell), (F.col("iy") + 1) * F.lit(cell)

    def x_at(y: Column) -> Column:
        along = (y - F.col("y0")) / F.nullif(F.col("y1") - F.col("y0"), F.lit(0.0))
        return F.col("x0") + along * (F.col("x1") - F.col("x0"))

    a, b = x_at(F.greatest(low, floor_ - wide)), x_at(F.least(high, ceiling + wide))
    left = F.coalesce(F.least(a, b), F.least("x0", "x1")) - wide
    right = F.coalesce(F.greatest(a, b), F.greatest("x0", "x1")) + wide
    return rows.select(
        "*", _cell_of(left, cell).alias("from_x"), _cell_of(right, cell).alias("to_x"),
        ((low <= floor_) & (high >= ceiling)).alias("spans"),
    )


def _struct() -> Column:
    return F.struct(*EDGE)


def area_index(areas: DataFrame, reach_km: float = 0.0, cell: float = CELL) -> DataFrame:
    """storm, ix, iy, parts (``odd``: parity of edges that surely cross; ``edges`` to test), near (edges within reach)."""
    edges = area_edges(areas)
    of_row = Window.partitionBy("storm", "part", "iy")
    rows = _banded(edges, cell, 0.0).withColumn("first_x", F.min("from_x").over(of_row))
    # West of an edge, points may cross it. Where it spans the row, they do.
    cells = rows.select("*", F.explode(F.sequence("first_x", "to_x")).alias("ix"))
    sure = F.col("spans") & (F.col("ix") < F.col("from_x"))
    parts = (
        cells.groupBy("storm", "part", "ix", "iy")
        .agg((F.count_if(sure) % 2 == 1).alias("odd"), F.collect_list(F.when(~sure, _struct())).alias("edges"))
        .groupBy("storm", "ix", "iy").agg(F.collect_list(F.struct("odd", "edges")).alias("parts"))
    )
    near = (
        _banded(edges, cell, reach_km / fixed.KM_PER_DEGREE)
        .select("storm", F.explode(F.sequence("from_x", "to_x")).alias("ix"), "iy", _struct().alias("e"))
        .groupBy("storm", "ix", "iy").agg(F.collect_list("e").alias("near"))
    )
    return parts.join(near, ["storm", "ix", "iy"], "full")


def _in_parts(parts: Column, lon: Column, lat: Column) -> Column:
    def crossings(part: Column) -> Column:
        return F.size(F.filter(part["edges"], lambda e: geo.crosses_east(lon, lat, e))) + part["odd"].cast("int")

    return F.exists(
        F.coalesce(parts, F.array()),
        lambda p: (crossings(p) % 2 == 1) & ~F.exists(p["edges"], lambda e: geo.touches(lon, lat, e)),
    )


def exposure(points: DataFrame, index: DataFrame, reach_km: float = 0.0, cell: float = CELL) -> DataFrame:
    """``points`` once per storm they are in or within reach of, with ``in_storm_zone`` and ``edge_km`` (null beyond
    reach). ``reach_km`` and ``cell`` are those of the index."""
    lon, lat = F.col("lon"), F.col("lat")
    km = F.array_min(F.transform("near", lambda e: geo.edge_degrees(lon, lat, e))) * F.lit(float(fixed.KM_PER_DEGREE))
    met = points.withColumns({"ix": _cell_of(lon, cell), "iy": _cell_of(lat, cell)}).join(index, ["ix", "iy"])
    return (
        met.withColumns({"in_storm_zone": _in_parts(F.col("parts"), lon, lat), "edge_km": km})
        .withColumn("edge_km", F.when(F.col("edge_km") < reach_km, F.col("edge_km")))
        .where(F.col("in_storm_zone") | F.col("edge_km").isNotNull()).drop("ix", "iy", "parts", "near")
    )


def points_in_areas(points: DataFrame, areas: DataFrame, cell: float = CELL) -> DataFrame:
    """``points`` once per storm they are in."""
    return exposure(points, area_index(areas, 0.0, cell), 0.0, cell).drop("in_storm_zone", "edge_km")


def at_risk_by_area(
    substations: DataFrame, areas: DataFrame, storm_types: DataFrame, threshold: float = fixed.AT_RISK_ABOVE, cell: float = CELL
) -> DataFrame:
    """Substations (with ``base_risk``) above the threshold under every storm that reaches them, by the storm's own type
    (``storm_types``: storm, storm_type). A substation that is above the threshold without any storm also has a row whose
    storm is null, once and not per storm."""
    reach = float(fixed.EDGE_OF_STORM_KM)
    known = substations.withColumn("base_risk", F.coalesce("base_risk", F.lit(fixed.DEFAULT_MEAN_RISK)))
    reached = exposure(known, area_index(areas, reach, cell), reach, cell).join(storm_types, "storm", "left")
    risk = adjusted_risk(F.col("base_risk"), codes.storm_multiplier(F.col("storm_type")), F.col("in_storm_zone"), F.col("edge_km"))
    alone = known.withColumns({
        "storm": F.lit(None).cast("string"), "storm_type": F.lit(None).cast("string"), "in_storm_zone": F.lit(False),
        "edge_km": F.lit(None).cast("double"), "adjusted_risk": F.col("base_risk"),
    })
    return reached.withColumn("adjusted_risk", risk).unionByName(alone).where(F.col("adjusted_risk") > threshold)
