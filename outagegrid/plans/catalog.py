"""Named queries over the benchmark tables, each with the same result as plain SQL where SQL can express it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outagegrid.plans import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, folder) under its own name, with its SQL twin."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def full_sql(text: str) -> str:
    """Prefix the CTEs that a statement names, with the ones those name in turn."""
    known = {v: views.sql(v) for v in [*views.VIEWS, "v_ring"]} | CTES
    ordered: list[str] = []
    seen: set[str] = set()

    def visit(body: str) -> None:
        for name in re.findall(r"[a-z_0-9]+", body):
            if name in known and name not in seen:
                seen.add(name)  # a recursive CTE names itself
                visit(known[name])
                ordered.append(name)

    visit(text)
    if not ordered:
        return text
    parts = ",\n".join(f"{n} AS ({known[n].strip()})" for n in ordered)
    return f"WITH RECURSIVE {parts}\n{text.strip()}"


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def as_bigint(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def observations(spark: SparkSession, folder: str) -> DataFrame:
    return views.frame(spark, folder, "v_obs").withColumnRenamed("customers_raw", "sum")
