"""Ranks, running totals, exact quantiles and exact-size samples that never sort a whole group in one task.

An unpartitioned or hot-key window drags all its rows through one task. Here rows are first put into ordered buckets
whose bounds come from the data, so the heavy window runs per (group, bucket) and only one small row per (group, bucket)
is accumulated across buckets. The bounds are a pure function of the rows (the rows with the smallest hashes), so a task
that is run again after an executor loss puts every row into the same bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES_PER_BUCKET = 8


def bucket_count(df: DataFrame) -> int:
    """A power of two of about four buckets per shuffle partition."""
    wanted = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 1 << max(3, (wanted - 1).bit_length())


def _order_tuple(order: list[Column]) -> Column:
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])


def _with_bucket(
    df: DataFrame, keys: list[str], order: list[Column], carry: list[str], hashed: bool = False
) -> DataFrame:
    """Add ``_o`` (the order tuple) and ``_b`` (its bucket). ``carry`` keeps those columns in the sampling branch, so
    that an aggregate below is planned once and its shuffle is shared. ``hashed`` says that the order starts with a
    64-bit hash: its leading bits are even buckets already, and no sample is drawn."""
    buckets = bucket_count(df)
    place = _order_tuple(order)
    for key in keys:  # stated here as well as implied by the later join, so that all branches read the same rows
        df = df.where(F.col(key).isNotNull())
    if hashed:
        return df.select(*df.columns, place.alias("_o"), F.shiftright(order[0], 65 - buckets.bit_length()).alias("_b"))
    bounds = (
        df.select(place.alias("o"), F.xxhash64(*keys, place).alias("h"), *carry)
        .orderBy("h", *carry)
        .limit(buckets * SAMPLES_PER_BUCKET)
        .agg(F.sort_array(F.collect_list("o")).alias("s"))
        .select(
            F.transform(
                F.sequence(F.lit(1), F.lit(buckets - 1)),
                lambda i: F.get("s", F.floor(i * F.size("s") / buckets).cast("int")),
            )
        )
        .scalar()
    )
    # Binary search over the bounds. Naming each input once lets Catalyst fold the bounds into the expression, where
    # they are one shared value and not a column copied into every row.
    halves = F.array(*[F.lit(1 << i) for i in reversed(range(buckets.bit_length() - 1))])
    bucket = F.aggregate(
        halves, F.lit(0),
        lambda at, half: F.when(F.get("_bounds", at + half - 1) <= place, at + half).otherwise(at),
    )
    return df.withColumn("_bounds", bounds).select(
        *df.columns, place.alias("_o"), F.coalesce(bucket, F.lit(0)).alias("_b")
    )


def running_totals(df: DataFrame, keys: list[str], order: list[Column], sums: list[str]) -> DataFrame:
    """For rows unique in (keys, order): ``cum_<c>`` up to and including the row and ``total_<c>`` of the group."""
    rows = _with_bucket(df, keys, order, sums)
    per_bucket = rows.groupBy(*keys, "_b").agg(*[F.sum(c).alias(c) for c in sums])
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = per_bucket.select(
        *keys, "_b",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
        *[F.sum(c).over(whole).alias(f"total_{c}") for c in sums],
    )
    local = Window.partitionBy(*keys, "_b").orderBy("_o").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(offsets, [*keys, "_b"])
    out = out.select("*", *[(F.sum(c).over(local) + F.col(f"_before_{c}")).alias(f"cum_{c}") for c in sums])
    return out.drop("_o", "_b", *[f"_before_{c}" for c in sums])


def rank_within(
    df: DataFrame, keys: list[str], order: list[Column], name: str = "rank", upto: Column | None = None,
    hashed: bool = False,
) -> DataFrame:
    """Exact row number by ``order`` inside ``keys``. With ``upto`` only ranks up to it are kept, and buckets that lie
    wholly behind it are dropped before anything is sorted. End ``order`` with a unique column, so that equal leading
    values spread over buckets and the result does not depend on input order."""
    rows = _with_bucket(df, keys, order, [], hashed)
    sizes = rows.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = rows.join(offsets, [*keys, "_b"])
    if upto is not None:
        joined = joined.where(F.col("_before") < upto)
    local = Window.partitionBy(*keys, "_b").orderBy("_o")
    ranked = joined.withColumn(name, (F.row_number().over(local) + F.col("_before")).cast("long"))
    if upto is not None:
        ranked = ranked.where(F.col(name) <= upto)
    return ranked.drop("_o", "_b", "_before")


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float], mean: str | None = None
) -> DataFrame:
    """Linearly interpolated quantiles per group: one row per group, one column per entry of ``quantiles``, and the mean
    under the name ``mean`` if one is given.

    Equal values are counted before the first shuffle; after that a hot group is spread over buckets.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    running = running_totals(counts, keys, [F.col(value)], ["n"])
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1
    aggregates, results = [], []
    for name, q in quantiles.items():
        position = F.lit(float(q)) * (F.col("total_n") - 1)
        low, high = F.floor(position), F.ceil(position)
        aggregates += [
            F.max(F.when(low.between(first, last), F.col(value))).alias(f"_{name}_low"),
            F.max(F.when(high.between(first, last), F.col(value))).alias(f"_{name}_high"),
            F.max(position - low).alias(f"_{name}_part"),
        ]
        span = F.col(f"_{name}_high") - F.col(f"_{name}_low")
        results.append((F.col(f"_{name}_low") + span * F.col(f"_{name}_part")).alias(name))
    if mean is not None:
        aggregates.append((F.sum(F.col(value) * F.col("n")) / F.max("total_n")).alias(mean))
        results.append(F.col(mean))
    if keys:
        return running.groupBy(*keys).agg(*aggregates).select(*keys, *results)
    return running.agg(*aggregates).select(*results)


def hash_order(columns: list[str], seed: int) -> list[Column]:
    """A fixed pseudo-random order of rows that are identified by ``columns``."""
    return [F.xxhash64(*[F.col(c) for c in columns], F.lit(seed)), *[F.col(c) for c in columns]]
