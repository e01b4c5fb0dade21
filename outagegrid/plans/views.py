"""Domain-shaped views over the benchmark tables. The same text runs in Spark (on the table frames) and in plain SQL.

All views read their whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OBS = """
SELECT CAST(1001 + (user_id % 10) * 6000 AS INT) AS fips_code,
       CASE WHEN user_id % 10 = 9 THEN 'PR' WHEN user_id % 10 = 8 THEN NULL ELSE 'ST' END AS state,
       CASE WHEN event_type = 'signup' THEN NULL
            WHEN event_type = 'error' THEN value - 20e0 ELSE value END AS customers_raw,
       ts AS run_start_time,
       CASE WHEN EXTRACT(DAY FROM ts) <= 10 THEN 1 WHEN EXTRACT(DAY FROM ts) <= 20 THEN 2
            WHEN EXTRACT(DAY FROM ts) <= 25 THEN 3 ELSE 4 END AS period
FROM {events}
"""

STORM = """
SELECT event_id, ts AS begin_ts,
       CASE WHEN event_id % 11 = 0 THEN NULL
            WHEN event_id % 13 = 0 THEN ts - INTERVAL '2' HOUR
            ELSE ts + INTERVAL '1' HOUR * CAST(event_id % 97 AS INT) END AS end_ts,
       CASE WHEN event_id % 3 = 0 THEN 'Z' ELSE 'C' END AS cz_type,
       CASE event_id % 12 WHEN 0 THEN 'Thunderstorm Wind' WHEN 1 THEN 'Winter Storm' WHEN 2 THEN 'Flash Flood'
            WHEN 3 THEN 'Tropical Storm' WHEN 4 THEN 'Lightning' WHEN 5 THEN 'Tornado' WHEN 6 THEN 'Drought'
            WHEN 7 THEN 'Ice Storm' WHEN 8 THEN 'Hurricane (Typhoon)' WHEN 9 THEN 'Heavy Rain'
            WHEN 10 THEN 'Dense Fog' ELSE 'Hail' END AS event_type,
       CAST(1 + (user_id % 10) * 6 AS INT) AS state_fips, 1 AS cz_fips,
       CASE WHEN user_id % 10 = 9 THEN NULL ELSE concat('STATE ', CAST(user_id % 10 AS STRING)) END AS state,
       CASE WHEN EXTRACT(DAY FROM ts) <= 10 THEN 1 WHEN EXTRACT(DAY FROM ts) <= 20 THEN 2
            WHEN EXTRACT(DAY FROM ts) <= 25 THEN 3 ELSE 4 END AS period
FROM {events}
"""

SUB = """
SELECT CAST(s_suppkey AS INT) AS ord, concat('sub_', CAST(s_suppkey AS STRING)) AS node_id, s_name AS name,
       CASE s_suppkey % 3 WHEN 0 THEN '138' WHEN 1 THEN '115' ELSE '69;345' END AS voltage,
       40.5e0 + ((s_suppkey * 7919) % 5000) / 1e4 AS lat,
       -74e0 + ((s_suppkey * 104729) % 21000) / 1e4 AS lon
FROM {supplier}
"""

FAC = """
SELECT concat(CASE c_mktsegment WHEN 'BUILDING' THEN 'hospital_' WHEN 'AUTOMOBILE' THEN 'fire_station_' ELSE 'school_' END,
              CAST(c_custkey AS STRING)) AS node_id, c_name AS name,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'hospital' WHEN 'AUTOMOBILE' THEN 'fire_station' ELSE 'school' END AS node_type,
       CAST(c_custkey % 800 AS INT) AS beds, c_custkey AS ord,
       40.2e0 + ((c_custkey * 6007) % 9000) / 1e4 AS lat,
       -74.3e0 + ((c_custkey * 15485863) % 26000) / 1e4 AS lon
FROM {customer}
"""

LINE = """
SELECT CAST(s_suppkey AS INT) AS line_id,
       40.51e0 + ((s_suppkey * 7919) % 5000) / 1e4 AS lat0, -73.99e0 + ((s_suppkey * 104729) % 21000) / 1e4 AS lon0,
       40.58e0 + ((s_suppkey * 7919) % 5000) / 1e4 AS lat1, -73.90e0 + ((s_suppkey * 104729) % 21000) / 1e4 AS lon1,
       CASE WHEN s_suppkey % 2 = 0 THEN '230' ELSE NULL END AS voltage
FROM {supplier}
"""

# The storm outline is a parameter of the queries: a closed, non-convex ring in (lon, lat) order.
RING = [
    (-73.9, 40.55), (-73.2, 40.52), (-72.9, 40.70), (-73.3, 40.72), (-73.0, 40.90), (-73.7, 40.95), (-73.9, 40.55),
]
RING_SQL = "SELECT * FROM (VALUES {}) AS t(i, lon, lat)".format(
    ", ".join(f"({i}, {x}e0, {y}e0)" for i, (x, y) in enumerate(RING))
)

SCORED = """
SELECT l_orderkey, l_linenumber, l_shipdate AS hour,
       CAST((1 + l_suppkey % 56) * 1000 + l_suppkey % 900 AS INT) AS fips,
       CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE concat('S', CAST(l_suppkey % 56 AS STRING)) END AS state,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
       (((l_orderkey * 31 + l_linenumber * 17) % 700) + CASE WHEN l_returnflag = 'R' THEN 299 ELSE 0 END) / 1e3 AS proba,
       l_extendedprice AS customers, 1e3 + (l_suppkey % 50) * 1e2 AS county_p90
FROM {lineitem}
"""

VIEWS = {
    "v_obs": (OBS, "events"), "v_storm": (STORM, "events"), "v_sub": (SUB, "supplier"), "v_fac": (FAC, "customer"),
    "v_line": (LINE, "supplier"), "v_scored": (SCORED, "lineitem"),
}


def frame(spark: SparkSession, folder: str, view: str) -> DataFrame:
    text, table = VIEWS[view]
    return spark.sql(text, **{table: spark.read.parquet(f"{folder}/{table}.parquet")})


def sql(view: str) -> str:
    if view == "v_ring":
        return RING_SQL
    text, table = VIEWS[view]
    return text.format(**{table: table})
