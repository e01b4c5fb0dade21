"""Substations, facilities and a storm outline to facility alerts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from outagegrid.operators import alerts, graph


@dataclass(frozen=True)
class AlertTables:
    nodes: DataFrame
    edges: DataFrame
    at_risk: DataFrame
    alerts: DataFrame


def storm_alerts(
    subs: DataFrame,
    facilities: DataFrame,
    ring: list[tuple[float, float]],
    storm_type: str,
    average_risk: float,
    lines: DataFrame | None = None,
    hops: int = 3,
) -> AlertTables:
    nodes = graph.build_nodes(subs, facilities)
    edges = graph.build_edges(nodes, lines)
    risky = alerts.at_risk(graph.base_risk(nodes, average_risk), ring, storm_type)
    return AlertTables(nodes, edges, risky, alerts.facility_alerts(nodes, edges, risky, hops))
