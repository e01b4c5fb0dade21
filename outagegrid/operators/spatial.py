"""Exact nearest neighbours within a distance cap, as equi-joins on grid cells.

A cap turns "nearest" into a local question: with cells as wide as the cap, every neighbour lies in the 3x3 block around
the query. Where points are dense that block may hold a large share of all points, so cells are refined step by step,
and per query only cells that can still hold a winner are opened. No pair list of a whole cell is ever built, and no
candidate is capped: a cell is skipped only when enough points are known to lie nearer than its nearest corner.

A query becomes many rows while its cells are opened, which no shuffle before that shows. Queries are therefore dealt out by
their number, and of a leaf, which is one row with its points, a query takes along its nearest ones only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outagegrid.fixed import KM_PER_DEGREE
from outagegrid.functions.geo import degree_km
from outagegrid.session import keep

SPLIT_BITS = 2  # each refinement cuts a cell into 4 x 4
DEEPEST = 8  # 25 km cells end below half a metre
LEAF_POINTS = 64
QUERIES_PER_TASK = 10_000
SLACK = 1 + 1e-9  # covers rounding in cell arithmetic; only ever opens more cells


def _cell(unit: str, level: int) -> Column:
    return F.floor(F.col(unit) * float(1 << (SPLIT_BITS * level))).cast("long")


def _cells(points: DataFrame, level: int) -> DataFrame:
    return points.groupBy(_cell("pu", level).alias("cy"), _cell("pv", level).alias("cx")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _depth(points: DataFrame) -> int:
    """The first level at which no cell holds more than a leaf's worth of points: one small aggregate job."""
    levels = F.explode(
        F.array(
            *[
                F.struct(F.lit(level).alias("level"), _cell("pu", level).alias("cy"), _cell("pv", level).alias("cx"))
                for level in range(DEEPEST + 1)
            ]
        )
    )
    fullest = (
        points.select(levels.alias("c")).groupBy("c.level", "c.cy", "c.cx").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("level").agg(F.max("n").alias("most"))
        .where(F.col("most") <= LEAF_POINTS)
        .agg(F.min("level"))
    )
    level = fullest.first()[0]
    return DEEPEST if level is None else level


def _prune(frontier: DataFrame, keys: list[str], level: int, need: int) -> DataFrame:
    """Drop cells that lie wholly behind ``need`` known points of the same query."""
    width = 1.0 / (1 << (SPLIT_BITS * level))

    def sides(unit: str, cell: str) -> tuple[Column, Column]:
        low, high = F.col(cell) * width, (F.col(cell) + 1) * width
        near = F.greatest(low - F.col(unit), F.col(unit) - high, F.lit(0.0))
        far = F.greatest(F.col(unit) - low, high - F.col(unit))
        return near, far

    (near_y, far_y), (near_x, far_x) = sides("qu", "cy"), sides("qv", "cx")
    by_far = Window.partitionBy(*keys).orderBy("_far", "cy", "cx").rowsBetween(Window.unboundedPreceding, 0)
    return (
        frontier.withColumns(
            {
                "_near": F.sqrt(near_y * near_y + near_x * near_x),
                "_far": F.sqrt(far_y * far_y + far_x * far_x),
            }
        )
        .withColumn("_sure", F.sum("n").over(by_far))
        .withColumn("_bound", F.min(F.when(F.col("_sure") >= need, F.col("_far"))).over(Window.partitionBy(*keys)))
        .where(F.col("_near") <= F.least(F.lit(1.0), F.coalesce("_bound", F.lit(1.0))) * SLACK)
        .drop("_near", "_far", "_sure", "_bound", "n")
    )


def _dealt(queries: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a query together, and no more queries a task than it can open cells for in memory."""
    tasks = -(-queries.count() // QUERIES_PER_TASK)
    least = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return queries.repartition(max(least, tasks), *keys)


def _leaves(points: DataFrame, depth: int) -> DataFrame:
    """(cy, cx, pts): a cell's points in a row, or in several where a cell of the last level holds more than a leaf's worth."""
    placed = points.withColumns({"cy": _cell("pu", depth), "cx": _cell("pv", depth)})
    nth = F.row_number().over(Window.partitionBy("cy", "cx").orderBy("near_ord", "near_id"))
    return (
        placed.withColumn("_part", F.floor((nth - 1) / LEAF_POINTS)).groupBy("cy", "cx", "_part")
        .agg(F.collect_list(F.struct("near_ord", "near_id", "near_lat", "near_lon")).alias("pts")).drop("_part")
    )


def nearest(
    queries: DataFrame, points: DataFrame, keys: list[str], k: int, cap_km: float, exclude_self: bool = False
) -> DataFrame:
    """The ``k`` nearest points nearer than ``cap_km`` of every query row.

    ``queries`` has unique ``keys`` and ``lat, lon``; ``points`` has ``node_id, ord, lat, lon``. Result: the query columns
    with ``near_id, near_lat, near_lon, km, rank``; equal distances go by ``ord``. With ``exclude_self`` a point whose
    ``node_id`` equals the query's first key is not its own neighbour.
    """
    need = k + int(exclude_self)
    unit = cap_km / KM_PER_DEGREE * SLACK
    # Of points at one and the same place only the first few by ``ord`` can ever be chosen.
    same_place = Window.partitionBy("near_lat", "near_lon").orderBy("near_ord", "near_id")
    points = (
        points.select(
            F.col("node_id").alias("near_id"), F.col("ord").alias("near_ord"),
            F.col("lat").alias("near_lat"), F.col("lon").alias("near_lon"),
        )
        .withColumn("_nth", F.row_number().over(same_place))
        .where(F.col("_nth") <= need)
        .drop("_nth")
        .withColumns({"pu": F.col("near_lat") / unit, "pv": F.col("near_lon") / unit})
    )
    points = keep(points)  # every level reads them
    depth = _depth(points)
    around = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)])
    frontier = (
        _dealt(queries, keys).withColumns({"qu": F.col("lat") / unit, "qv": F.col("lon") / unit})
        .select("*", F.explode(around).alias("_a"))
        .select(
            *queries.columns, "qu", "qv",
            (_cell("qu", 0) + F.col("_a.dy")).alias("cy"), (_cell("qv", 0) + F.col("_a.dx")).alias("cx"),
        )
    )
    if depth > 0:
        frontier = _prune(frontier.join(_cells(points, 0), ["cy", "cx"]), keys, 0, need)
        for level in range(1, depth + 1):
            children = _cells(points, level).select(
                F.shiftright("cy", SPLIT_BITS).alias("_py"), F.shiftright("cx", SPLIT_BITS).alias("_px"),
                F.col("cy").alias("_cy"), F.col("cx").alias("_cx"), "n",
            )
            opened = frontier.join(
                children, (F.col("cy") == F.col("_py")) & (F.col("cx") == F.col("_px"))
            ).select(*queries.columns, "qu", "qv", F.col("_cy").alias("cy"), F.col("_cx").alias("cx"), "n")
            frontier = _prune(opened, keys, level, need)

    def measured(p: Column) -> Column:
        km = degree_km(F.col("lat"), F.col("lon"), p["near_lat"], p["near_lon"])
        names = ("near_ord", "near_id", "near_lat", "near_lon")
        return F.struct(km.alias("km"), *[p[c].alias(c) for c in names])

    def chosen(p: Column) -> Column:
        return (p["km"] < cap_km) & (p["near_id"] != F.col(keys[0])) if exclude_self else p["km"] < cap_km

    best = F.slice(F.array_sort(F.filter(F.transform("pts", measured), chosen)), 1, k)
    pairs = frontier.join(_leaves(points, depth), ["cy", "cx"]).select(*queries.columns, F.explode(best).alias("_b")).select(
        *queries.columns, "_b.near_id", "_b.near_lat", "_b.near_lon", "_b.near_ord", "_b.km"
    )
    by_distance = Window.partitionBy(*keys).orderBy("km", "near_ord", "near_id")
    return pairs.withColumn("rank", F.row_number().over(by_distance)).where(F.col("rank") <= k).drop("near_ord")
