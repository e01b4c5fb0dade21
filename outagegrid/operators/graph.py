"""Grid graph tables: nodes, edges, base risk and hop distances."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.functions.codes import voltage_class
from outagegrid.operators.spatial import nearest
from outagegrid.session import keep, scratch_path

NODE_COLUMNS = [
    "node_id", "node_type", "name", "voltage", "subtype", "lat", "lon", "priority", "priority_score", "props", "ord",
]
EDGE_COLUMNS = ["u", "v", "edge_type", "distance_km", "voltage"]


def build_nodes(subs: DataFrame, facilities: DataFrame) -> DataFrame:
    """Substations (node_id, name, voltage, lat, lon, ord [, subtype]) and facilities (node_id, node_type, name, lat, lon,
    props, ord) in one table. Substations come first in order."""
    substations = subs.select(
        "node_id", F.lit("substation").alias("node_type"), "name", "voltage",
        (F.col("subtype") if "subtype" in subs.columns else voltage_class(F.col("voltage"))).alias("subtype"),
        "lat", "lon", F.lit(None).cast("string").alias("priority"), F.lit(None).cast("int").alias("priority_score"),
        F.lit(None).cast("map<string,string>").alias("props"), F.col("ord").cast("long").alias("ord"),
    )
    priority, weight = facility_rule("priority"), facility_rule("weight")
    others = facilities.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        "node_id", "node_type", "name", F.lit(None).cast("string").alias("voltage"),
        F.lit(None).cast("string").alias("subtype"), "lat", "lon", priority.alias("priority"),
        weight.alias("priority_score"), "props", F.col("ord").cast("long").alias("ord"),
    )
    return substations.unionByName(others)


def facility_rule(field: str, node_type: Column | None = None) -> Column:
    """Priority, weight or most hops of a facility type; NULL for other types."""
    node_type = F.col("node_type") if node_type is None else node_type
    at = {"priority": 0, "weight": 1, "max_hops": 2}[field]
    rule = F.lit(None)
    for name, values in fixed.FACILITY_TYPES.items():
        rule = F.when(node_type == name, F.lit(values[at])).otherwise(rule)
    return rule


def of_type(nodes: DataFrame, node_type: str) -> DataFrame:
    return nodes.where(F.col("node_type") == node_type)


def distinct_edges(edges: DataFrame, first_by: list[str]) -> DataFrame:
    """One row per unordered pair, with the attributes of the edge that comes first."""
    values = ["edge_type", "distance_km", "voltage"]
    return (
        edges.groupBy(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
        .agg(F.min_by(F.struct(*values), F.struct(*first_by)).alias("e"))
        .select("u", "v", *[F.col(f"e.{c}").alias(c) for c in values])
    )


def substation_edges(
    subs: DataFrame, k: int = fixed.SUBSTATION_LINKS, cap_km: float = fixed.SUBSTATION_LINK_KM
) -> DataFrame:
    """Each substation to its nearest others."""
    places = subs.select("node_id", "ord", "lat", "lon")
    links = nearest(places, places, ["node_id"], k, cap_km, exclude_self=True)
    return distinct_edges(
        links.select(
            F.col("node_id").alias("a"), F.col("near_id").alias("b"), F.lit("distribution").alias("edge_type"),
            F.round("km", 2).alias("distance_km"), F.lit(None).cast("string").alias("voltage"), "ord", "rank",
        ),
        ["ord", "rank"],
    )


def service_edges(
    facilities: DataFrame, subs: DataFrame, k: int = fixed.FACILITY_LINKS, cap_km: float = fixed.FACILITY_LINK_KM
) -> DataFrame:
    """Each facility to its nearest substations. A facility with none in reach stays isolated."""
    links = nearest(facilities.select("node_id", "lat", "lon"), subs, ["node_id"], k, cap_km)
    return links.select(
        F.least("node_id", "near_id").alias("u"), F.greatest("node_id", "near_id").alias("v"),
        F.lit("service").alias("edge_type"), F.round("km", 2).alias("distance_km"),
        F.lit(None).cast("string").alias("voltage"),
    )


def line_edges(
    lines: DataFrame, subs: DataFrame, end_km: float = fixed.LINE_END_KM, partner_km: float = fixed.LINE_PARTNER_KM
) -> DataFrame:
    """Lines (line_id, lat0, lon0, lat1, lon1, voltage) to edges: the substation at a line end and the next nearest one.

    The partner is the second nearest substation of the line end: if that one is out of reach, so is every later one.
    """
    ends = lines.select(
        "line_id", "voltage",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("end"), F.col("lat0").alias("lat"), F.col("lon0").alias("lon")),
                F.struct(F.lit(1).alias("end"), F.col("lat1").alias("lat"), F.col("lon1").alias("lon")),
            )
        ).alias("_e"),
    ).select("line_id", "voltage", "_e.*")
    near = nearest(ends, subs, ["line_id", "end"], 2, partner_km)
    pairs = near.groupBy("line_id", "end").agg(
        F.max(F.when(F.col("rank") == 1, F.col("near_id"))).alias("a"),
        F.max(F.when(F.col("rank") == 1, F.col("km"))).alias("a_km"),
        F.max(F.when(F.col("rank") == 2, F.col("near_id"))).alias("b"),
        F.max(F.when(F.col("rank") == 2, F.col("km"))).alias("b_km"),
        F.max("voltage").alias("voltage"),
    )
    pairs = pairs.where((F.col("a_km") < end_km) & F.col("b").isNotNull()).select(
        "a", "b", F.lit("transmission").alias("edge_type"), F.round("b_km", 2).alias("distance_km"),
        F.coalesce("voltage", F.lit(fixed.DEFAULT_VOLTAGE)).alias("voltage"), "line_id", "end",
    )
    return distinct_edges(pairs, ["line_id", "end"])


def build_edges(nodes: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Grid edges from line data where there is any, else by proximity, and the facility links."""
    subs = of_type(nodes, "substation")
    facilities = nodes.where(F.col("node_type") != "substation")
    grid = substation_edges(subs) if lines is None else line_edges(lines, subs)
    return grid.unionByName(service_edges(facilities, subs)).select(*EDGE_COLUMNS)


def region_risk(county_priority: DataFrame, counties: list[str] = fixed.RISK_COUNTIES) -> DataFrame:
    """(avg_risk, max_risk) of the region's counties, with defaults where none was scored."""
    return county_priority.where(F.substring("fips", 1, 5).isin(counties)).agg(
        F.coalesce(F.avg("mean_outage_proba"), F.lit(fixed.DEFAULT_MEAN_RISK)).alias("avg_risk"),
        F.coalesce(F.max("max_outage_proba"), F.lit(fixed.DEFAULT_MAX_RISK)).alias("max_risk"),
    )


def base_risk(nodes: DataFrame, average: Column | float = fixed.DEFAULT_MEAN_RISK) -> DataFrame:
    """Substations with ``base_risk``: the regional average, lower in the east and higher in the west."""
    average = average if isinstance(average, Column) else F.lit(float(average))
    lon = F.col("lon")
    factor = F.when(lon > fixed.EAST_OF, fixed.EAST_FACTOR).when(lon > fixed.CENTRE_OF, 1.0).otherwise(fixed.WEST_FACTOR)
    return of_type(nodes, "substation").withColumn(
        "base_risk", F.round(F.least(F.lit(fixed.BASE_RISK_CAP), average * factor), 4)
    )


def both_ways(edges: DataFrame) -> DataFrame:
    pair = F.explode(
        F.array(
            F.struct(F.col("u").alias("node"), F.col("v").alias("next")),
            F.struct(F.col("v").alias("node"), F.col("u").alias("next")),
        )
    )
    return edges.select(pair.alias("p")).select("p.node", "p.next")


def _cut(df: DataFrame, hop: int, k: int) -> DataFrame:
    """Store every third round. Two or three rounds share their shuffles within one plan; without a cut the plan of many
    rounds would grow with each of them."""
    return keep(df) if hop % 3 == 0 and hop < k else df


def land_adjacency(edges: DataFrame, buckets: int | None = None) -> DataFrame:
    """(node, next) both ways, written once as a table bucketed and sorted by ``node``. Joins on ``node`` then read it where it
    lies: rounds of hops move their own rows only, never the edges."""
    spark = edges.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"adjacency_{uuid.uuid4().hex}"
    (
        both_ways(edges).repartition(buckets, "node").write.bucketBy(buckets, "node").sortBy("node")
        .option("path", scratch_path(spark, "adjacency")).saveAsTable(name)
    )
    return spark.table(name)


def _union(rounds: list[DataFrame]) -> DataFrame:
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionByName(r)
    return out


def hops(adjacency: DataFrame, sources: DataFrame, k: int = fixed.MOST_HOPS) -> DataFrame:
    """(src, node, hop) for every node within ``k`` hops of every source (a table with ``node_id``), sources included.

    A round holds the ends of all walks of its length, one row per source and node. A node is as far as its shortest walk,
    so rounds need no look at earlier ones; a walk that turns back adds rows of rings already reached, no further ones."""
    state = sources.select(F.col("node_id").alias("src"), F.col("node_id").alias("node")).distinct()
    rounds = [state.withColumn("hop", F.lit(0))]
    for hop in range(1, k + 1):
        state = _cut(state.join(adjacency, "node").select("src", F.col("next").alias("node")).distinct(), hop, k)
        rounds.append(state.withColumn("hop", F.lit(hop)))
    return _union(rounds).groupBy("src", "node").agg(F.min("hop").alias("hop"))


def k_hop(edges: DataFrame, sources: DataFrame, k: int = fixed.MOST_HOPS) -> DataFrame:
    return hops(land_adjacency(edges), sources, k)


def best_walks(adjacency: DataFrame, sources: DataFrame, best: Column, k: int = fixed.MOST_HOPS) -> DataFrame:
    """(node, hop, best): for every node and walk length up to ``k`` the greatest ``best`` among the sources that reach
    it. State is one row per node, not one per source and node; partial maxima are taken before each shuffle."""
    state = sources.select(F.col("node_id").alias("node"), best.alias("best"))
    rounds = []
    for hop in range(1, k + 1):
        state = _cut(
            state.join(adjacency, "node").groupBy(F.col("next").alias("node")).agg(F.max("best").alias("best")), hop, k
        )
        rounds.append(state.withColumn("hop", F.lit(hop)))
    return _union(rounds)


def best_source(edges: DataFrame, sources: DataFrame, best: Column, k: int = fixed.MOST_HOPS) -> DataFrame:
    return best_walks(land_adjacency(edges), sources, best, k)


def graph_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Node counts by type, most frequent first, with the totals."""
    per_type = nodes.groupBy("node_type").agg(F.count(F.lit(1)).alias("type_nodes"))
    return per_type.select(
        "node_type", "type_nodes",
        per_type.agg(F.sum("type_nodes")).scalar().alias("total_nodes"),
        edges.agg(F.count(F.lit(1))).scalar().alias("total_edges"),
    ).orderBy(F.desc("type_nodes"), "node_type")
