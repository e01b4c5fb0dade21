"""Storm risk at substations, facility alerts and the map layer tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.functions import codes, geo
from outagegrid.operators.graph import best_walks, facility_rule, land_adjacency, of_type

ORDER_BITS = 48
LAST_ORDER = (1 << ORDER_BITS) - 1
AT_RISK_COLUMNS = [
    "node_id", "name", "lat", "lon", "voltage", "subtype", "base_risk", "adjusted_risk", "in_storm_zone",
]
ALERT_COLUMNS = [
    "facility_id", "facility_name", "facility_type", "priority", "lat", "lon", "feeding_substation", "feeding_sub_lat",
    "feeding_sub_lon", "substation_risk", "hop_distance", "alert_score", "in_storm_zone", "beds", "trauma", "action",
]
BRIEF_COLUMNS = [
    "priority", "facility_name", "facility_type", "feeding_substation", "substation_risk", "hop_distance", "action",
]


def adjusted_risk(base: Column, multiplier: Column, inside: Column, edge_km: Column) -> Column:
    """Full storm factor inside, fading with distance near the edge, none farther off. With a factor of 1 the fade still
    lowers the risk just outside."""
    cap = F.lit(fixed.PROBABILITY_CAP)
    return (
        F.when(inside, F.least(cap, base * multiplier))
        .when(edge_km < fixed.EDGE_OF_STORM_KM, F.least(cap, base * multiplier * (1 - edge_km / fixed.EDGE_FADE_KM)))
        .otherwise(base)
    )


def storm_exposure(substations: DataFrame, ring: list[tuple[float, float]], storm_type: str) -> DataFrame:
    """Substations (with ``base_risk``) plus ``in_storm_zone``, ``edge_km`` and the unrounded ``adjusted_risk``."""
    lon, lat = F.col("lon"), F.col("lat")
    known = F.coalesce("base_risk", F.lit(fixed.DEFAULT_MEAN_RISK))
    risk = adjusted_risk(known, codes.storm_multiplier(storm_type), F.col("in_storm_zone"), F.col("edge_km"))
    return (
        substations.withColumn("base_risk", known)
        .withColumns({"in_storm_zone": geo.inside_ring(lon, lat, ring), "edge_km": geo.boundary_km(lon, lat, ring)})
        .withColumn("adjusted_risk", risk)
    )


def at_risk(
    substations: DataFrame,
    ring: list[tuple[float, float]],
    storm_type: str = "Hurricane Cat 3",
    threshold: float = fixed.AT_RISK_ABOVE,
) -> DataFrame:
    """Substations above the threshold, with ``ord`` kept for tie-breaks. The threshold sees the unrounded risk."""
    return (
        storm_exposure(substations, ring, storm_type)
        .where(F.col("adjusted_risk") > threshold)
        .withColumns({"base_risk": F.round("base_risk", 4), "adjusted_risk": F.round("adjusted_risk", 4)})
        .select(*AT_RISK_COLUMNS, "ord")
    )


def by_risk(at_risk_subs: DataFrame) -> DataFrame:
    return at_risk_subs.orderBy(F.desc("adjusted_risk"), "ord")


def alert_score(risk: Column, weight: Column, hops: Column) -> Column:
    return risk * weight / F.sqrt(hops)


def facility_alerts(nodes: DataFrame, edges: DataFrame, at_risk_subs: DataFrame, k: int = fixed.MOST_HOPS) -> DataFrame:
    return alerts_on(nodes, land_adjacency(edges), at_risk_subs, k)


def alerts_on(nodes: DataFrame, adjacency: DataFrame, at_risk_subs: DataFrame, k: int = fixed.MOST_HOPS) -> DataFrame:
    """One alert per facility in reach: the feeder with the highest score, ties by risk, then substation order, then id.

    A feeder travels along the edges as one number, its risk in ten-thousandths followed by its reversed order, so every
    round is a hash aggregate of plain numbers; names are joined once at the end.
    """
    packed = F.shiftleft(F.round(F.col("adjusted_risk") * 10_000).cast("long"), ORDER_BITS) + (
        F.lit(LAST_ORDER) - F.col("ord")
    )
    reached = best_walks(adjacency, at_risk_subs, packed, k)
    risk = F.shiftrightunsigned("best", ORDER_BITS) / 10_000
    facilities = nodes.where(facility_rule("weight").isNotNull()).select(
        F.col("node_id").alias("node"), F.col("name").alias("facility_name"), F.col("node_type").alias("facility_type"),
        facility_rule("priority").alias("priority"), "lat", "lon", "props", F.col("ord").alias("_facility_ord"),
    )
    rules = nodes.select(
        F.col("node_id").alias("node"), facility_rule("weight").alias("weight"), facility_rule("max_hops").alias("most")
    )
    best = (
        reached.join(rules, "node")
        .where(F.col("hop") <= F.col("most"))
        .groupBy("node")
        .agg(F.max(F.struct(alert_score(risk, F.col("weight"), F.col("hop")).alias("score"), "best", "hop")).alias("w"))
        .select("node", "w.score", "w.best", "w.hop")
    )
    feeder = F.struct(
        F.col("node_id").alias("feeding_substation_id"), F.col("name").alias("feeding_substation"),
        F.col("lat").alias("feeding_sub_lat"), F.col("lon").alias("feeding_sub_lon"), "in_storm_zone",
    )
    # Substations that share risk and order are one number; the first id stands for them.
    feeders = at_risk_subs.groupBy(packed.alias("best")).agg(F.min(feeder).alias("f")).select("best", "f.*")
    return (
        best.join(facilities, "node").join(feeders, "best")
        .select(
            F.col("node").alias("facility_id"), "facility_name", "facility_type", "priority", "lat", "lon",
            "feeding_substation_id", "feeding_substation", "feeding_sub_lat", "feeding_sub_lon", risk.alias("substation_risk"),
            F.col("hop").alias("hop_distance"), F.round("score", 4).alias("alert_score"), "in_storm_zone",
            codes.first_of(F.col("props"), ["beds", "BEDS"], "0").cast("double").cast("int").alias("beds"),
            codes.first_of(F.col("props"), ["trauma", "TRAUMA"], "N/A").alias("trauma"),
            codes.action_tier(F.col("facility_type"), risk).alias("action"), F.col("_facility_ord").alias("ord"),
        )
    )


def by_score(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(F.desc("alert_score"), "ord", "facility_id")


def alert_queue(alerts: DataFrame, priority: str = "All", n: int = 12) -> DataFrame:
    """The first ``n`` alerts of one priority, or of all."""
    chosen = alerts if priority == "All" else alerts.where(F.col("priority") == priority)
    return by_score(chosen).limit(n)


def alert_brief(alerts: DataFrame) -> DataFrame:
    return alerts.select(*BRIEF_COLUMNS)


def alert_summary(at_risk_subs: DataFrame, alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        *[
            F.count_if(F.col("priority") == p).alias(f"{p.lower()}_count") for p in ("CRITICAL", "HIGH", "MEDIUM")
        ],
    ).withColumn("total_at_risk_substations", at_risk_subs.agg(F.count(F.lit(1))).scalar())


def shared_feeders(alerts: DataFrame) -> DataFrame:
    """Direct feeders with the number of facilities that hang on them. Counts are combined before the shuffle; the
    members stay rows (``feeder_members``) and are not gathered into one list."""
    return alerts.where(F.col("hop_distance") == 1).groupBy("feeding_substation_id", "feeding_substation").agg(
        F.count(F.lit(1)).alias("facilities"),
        *[F.count_if(F.col("facility_type") == t).alias(f"{t}s") for t in fixed.FACILITY_TYPES],
        F.max("substation_risk").alias("substation_risk"),
    )


def feeder_members(alerts: DataFrame, least: int = 2) -> DataFrame:
    """The facilities of every feeder that serves at least ``least`` of them directly."""
    shared = shared_feeders(alerts).where(F.col("facilities") >= least).select("feeding_substation_id", "facilities")
    return alerts.where(F.col("hop_distance") == 1).join(shared, "feeding_substation_id").select(
        "feeding_substation_id", "feeding_substation", "facilities", "facility_id", "facility_name", "facility_type"
    )


def substation_view(at_risk_subs: DataFrame) -> DataFrame:
    return at_risk_subs.select(
        F.col("name").alias("Substation"), F.col("voltage").alias("kV"), F.col("subtype").alias("Type"),
        F.col("adjusted_risk").alias("Risk"), F.col("in_storm_zone").alias("In Storm Zone"),
    )


def _point(lon: str, lat: str) -> Column:
    return F.array(F.col(lon), F.col(lat))


def _geometry(kind: str, coordinates: Column) -> Column:
    return F.to_json(F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")))


def edge_layer(nodes: DataFrame, edges: DataFrame, at_risk_subs: DataFrame) -> DataFrame:
    """Lines between substations, marked where both ends are at risk."""
    risky = at_risk_subs.select("node_id", F.lit(True).alias("risky"))
    subs = of_type(nodes, "substation").where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    ends = subs.select("node_id", "lat", "lon").join(risky, "node_id", "left")

    def side(end: str) -> DataFrame:
        return ends.select(*[F.col(c).alias(f"{end}_{c}" if c != "node_id" else end) for c in ends.columns])

    both = F.coalesce(F.col("u_risky") & F.col("v_risky"), F.lit(False))
    return edges.join(side("u"), "u").join(side("v"), "v").select(
        "u", "v", "edge_type", "distance_km", "u_lat", "u_lon", "v_lat", "v_lon",
        both.alias("both_at_risk"),
        F.when(both, fixed.EDGE_COLOURS["at_risk"]).otherwise(fixed.EDGE_COLOURS["normal"]).alias("colour"),
        F.concat(F.col("edge_type"), F.lit(" | "), F.col("distance_km").cast("string"), F.lit(" km")).alias("tooltip"),
        _geometry("LineString", F.array(_point("u_lon", "u_lat"), _point("v_lon", "v_lat"))).alias("geometry"),
    )


def substation_layer(nodes: DataFrame, at_risk_subs: DataFrame) -> DataFrame:
    """All substations with their class; the ones not at risk show risk 0."""
    risk = at_risk_subs.select("node_id", F.col("adjusted_risk").alias("risk"), F.col("in_storm_zone").alias("in_zone"))
    style = (
        F.when(F.col("in_zone"), "in_zone").when(F.col("risk") > fixed.AT_RISK_ABOVE, "elevated").otherwise("normal")
    )
    styles = {name: at for at, name in enumerate(("colour", "radius"))}
    layer = (
        of_type(nodes, "substation").select("node_id", "name", "voltage", "subtype", "lat", "lon")
        .join(risk, "node_id", "left")
        .fillna({"risk": 0.0, "in_zone": False})
        .withColumn("style", style)
    )
    return layer.withColumns(
        {
            name: codes.lookup({s: v[at] for s, v in fixed.SUBSTATION_STYLES.items()}, F.col("style"), None)
            for name, at in styles.items()
        }
    ).withColumn("geometry", _geometry("Point", _point("lon", "lat")))


def route_layer(alerts: DataFrame) -> DataFrame:
    """A line from each feeder to the facility it serves."""
    return alerts.select(
        "facility_id", "priority", codes.lookup(fixed.TIER_COLOURS, F.col("priority"), "#94a3b8").alias("colour"),
        "feeding_sub_lat", "feeding_sub_lon", "lat", "lon",
        F.concat_ws(" → ", "feeding_substation", "facility_name").alias("route"),
        _geometry("LineString", F.array(_point("feeding_sub_lon", "feeding_sub_lat"), _point("lon", "lat"))).alias(
            "geometry"
        ),
    )


def alert_layer(alerts: DataFrame) -> DataFrame:
    """Facility markers with the fields of their pop-up. Beds show for hospitals that have any, trauma if it says
    something."""
    beds = F.when((F.col("facility_type") == "hospital") & (F.col("beds") > 0), F.col("beds"))
    trauma = F.when(beds.isNotNull() & ~F.col("trauma").isin(fixed.UNINFORMATIVE_TRAUMA), F.col("trauma"))
    return alerts.select(
        "facility_id", "facility_name", "facility_type", "priority",
        codes.lookup(fixed.TIER_COLOURS, F.col("priority"), "#94a3b8").alias("colour"),
        "feeding_substation", "substation_risk", "hop_distance", "alert_score", "action", "lat", "lon",
        beds.alias("popup_beds"), trauma.alias("popup_trauma"),
        _geometry("Point", _point("lon", "lat")).alias("geometry"),
    )
