"""Storm events to county-hour flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.functions import codes, timing

OUTAGE_TYPES = fixed.WIND + fixed.WINTER + fixed.FLOOD + fixed.TROPICAL + fixed.OTHER


def parse_event_clock(events: DataFrame) -> DataFrame:
    """Text begin and end stamps to timestamps, unreadable ones to NULL."""
    return events.withColumns(
        {
            "begin_ts": timing.parse_storm_ts(F.col("BEGIN_DATE_TIME")),
            "end_ts": timing.parse_storm_ts(F.col("END_DATE_TIME")),
        }
    )


def clean_storms(events: DataFrame, keep: list[str] = ()) -> DataFrame:
    """(cz_type, event_type, begin_ts, end_ts, state_fips, cz_fips) to county events of outage-relevant types, with the
    columns in ``keep`` besides. Events without a county code belong to no county; ``audit_storms`` counts them."""
    return events.where(
        (F.col("cz_type") == "C") & F.col("event_type").isin(OUTAGE_TYPES) & F.col("begin_ts").isNotNull()
        & F.col("state_fips").isNotNull() & F.col("cz_fips").isNotNull()
    ).select(
        codes.compose_fips(F.col("state_fips"), F.col("cz_fips")).alias("fips"),
        codes.event_group(F.col("event_type")).alias("event_group"),
        "begin_ts",
        "end_ts",
        *keep,
    )


def _span(open_hours: int, cap_hours: int | None) -> tuple[Column, Column]:
    """The first hour of an event and its number of started hours: end exclusive, at least one, at most the cap."""
    first = timing.floor_hour(F.col("begin_ts"))
    end = F.coalesce("end_ts", F.col("begin_ts") + F.make_dt_interval(hours=F.lit(open_hours)))
    spanned = F.timestamp_diff("HOUR", first, timing.ceil_hour(end))
    if cap_hours is not None:
        spanned = F.least(F.lit(cap_hours), spanned)
    return first, F.greatest(F.lit(1), spanned).cast("int")


def expand_hours(
    storms: DataFrame, open_hours: int = fixed.OPEN_EVENT_HOURS, cap_hours: int | None = fixed.EVENT_HOURS_CAP
) -> DataFrame:
    """One row per event and started hour."""
    first, hours = _span(open_hours, cap_hours)
    return storms.select(
        "*", first.alias("_first"), F.explode(F.sequence(F.lit(0), hours - 1)).alias("hour_offset")
    ).select(
        "fips",
        (F.col("_first") + F.make_dt_interval(hours=F.col("hour_offset"))).alias("hour"),
        "event_group",
    )


def with_flags(counts: DataFrame) -> DataFrame:
    """Group counts per county and hour, plus the any-storm flag and the capped severity."""
    weighted = sum((F.col(g) * w for g, w in fixed.SEVERITY_WEIGHTS.items()), F.lit(0))
    return counts.withColumns(
        {
            "any_storm": (sum((F.col(g) for g in fixed.GROUPS), F.lit(0)) > 0).cast("int"),
            "storm_severity": F.least(weighted, F.lit(fixed.SEVERITY_CAP)),
        }
    )


def storm_flags(hours: DataFrame) -> DataFrame:
    """Flags from expanded rows: conditional counts in fixed columns, whichever groups occur."""
    return with_flags(
        hours.groupBy("fips", "hour").agg(*[F.count_if(F.col("event_group") == g).alias(g) for g in fixed.GROUPS])
    )


def storm_pivot(
    events: DataFrame, open_hours: int = fixed.OPEN_EVENT_HOURS, cap_hours: int | None = fixed.EVENT_HOURS_CAP
) -> DataFrame:
    """Flags of every county-hour with a storm, without expanding events.

    An event leaves two marks, one where it starts and one where it is over. Marks are summed per county and hour, a
    running sum gives the counts between marks, and only those stretches are laid out by hour: the work grows with
    events and with county-hours, not with events times their length. The window holds one row per hour of a county at
    most, however many events fall into it.
    """
    first, hours = _span(open_hours, cap_hours)
    over = first + F.make_dt_interval(hours=hours)
    marks = clean_storms(events).select(
        "fips",
        "event_group",
        F.explode(
            F.array(
                F.struct(first.alias("hour"), F.lit(1).alias("step")),
                F.struct(over.alias("hour"), F.lit(-1).alias("step")),
            )
        ).alias("m"),
    )
    changes = marks.groupBy("fips", F.col("m.hour").alias("hour")).agg(
        *[F.sum(F.when(F.col("event_group") == g, F.col("m.step")).otherwise(0)).alias(g) for g in fixed.GROUPS]
    )
    by_hour = Window.partitionBy("fips").orderBy("hour")
    so_far = by_hour.rowsBetween(Window.unboundedPreceding, 0)
    active = changes.select(
        "fips", "hour", F.lead("hour").over(by_hour).alias("_next"), *[F.sum(g).over(so_far).alias(g) for g in fixed.GROUPS]
    ).where(sum((F.col(g) for g in fixed.GROUPS), F.lit(0)) > 0)
    each_hour = F.sequence("hour", F.col("_next") - F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 1 HOUR"))
    return with_flags(active.select("fips", F.explode(each_hour).alias("hour"), *fixed.GROUPS))


def join_storms(hourly: DataFrame, pivot: DataFrame) -> DataFrame:
    """The hourly side is laid out by (fips, hour) already, so only the storm side, by far the smaller one, moves. No
    storm means zero."""
    added = [*fixed.GROUPS, "any_storm", "storm_severity"]
    return hourly.join(pivot.select("fips", "hour", *added), ["fips", "hour"], "left").fillna(0, subset=added)


def event_counts(storms: DataFrame, by: str = "year") -> DataFrame:
    return storms.groupBy(by).agg(F.count(F.lit(1)).alias("events"))
