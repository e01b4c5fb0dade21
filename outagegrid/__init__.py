"""Outage and grid-risk analytics expressed as Spark DataFrame jobs."""
