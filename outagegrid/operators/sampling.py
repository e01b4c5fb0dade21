"""Splits and exact-size samples.

Samples take the rows that come first in a fixed order (by default a seeded hash of the row keys), so sizes are exact,
repeats agree, and a re-run task picks the same rows.

Selection is by radix. One pass counts rows per group and leading digit of the order; the running count names the digit at
which the wanted size is reached. A second pass keeps rows of smaller digits as they are and ranks the rows of that one
digit only: with a hash, one row in ``2 ** DIGIT_BITS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.operators.ordering import hash_order

ROW = ["fips", "hour"]
DIGIT_BITS = 16
SPREAD = 64  # cells of a group for rows that need no rank


def assign_split(
    df: DataFrame,
    train: list[int] = fixed.TRAIN_YEARS,
    validation: list[int] = fixed.VALIDATION_YEARS,
    test: list[int] = fixed.TEST_YEARS,
) -> DataFrame:
    year = F.col("year")
    split = F.when(year.isin(train), "train").when(year.isin(validation), "val").when(year.isin(test), "test")
    return df.withColumn("split", split).where(F.col("split").isNotNull())


def _order(seed: int, order: list[Column] | None, digit: Column | None) -> tuple[list[Column], Column]:
    """The order and its leading digit, which never falls as the order rises. Of an order of one's own, the first column is
    the digit unless a coarser one is given: the counts have a row for each of its values."""
    if order is None:
        order = hash_order(ROW, seed)
        return order, F.shiftright(order[0], 64 - DIGIT_BITS)
    return order, order[0] if digit is None else digit


def _first_rows(
    df: DataFrame, keys: list[str], order: list[Column], digit: Column, competes: Column, wanted: Column, anyway: Column
) -> DataFrame:
    """Of each group the first ``wanted`` rows that compete, and all rows kept ``anyway``. ``wanted`` is an expression over the
    counts (keys, ``_digit``, ``_n`` competing rows, ``_others`` kept anyway); groups are few: a row of each is broadcast."""
    marked = df.select(
        "*", digit.cast("long").alias("_digit"), F.coalesce(competes, F.lit(False)).alias("_in"),
        F.coalesce(anyway, F.lit(False)).alias("_anyway"),
    ).where(F.col("_in") | F.col("_anyway"))
    counts = marked.groupBy(*keys, "_digit").agg(F.count_if("_in").alias("_n"), F.count_if("_anyway").alias("_others"))
    up_to = Window.partitionBy(*keys).orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0)
    past = F.sum("_n").over(up_to)
    cut = (
        counts.select(*keys, "_digit", "_n", wanted.alias("_wanted"), past.alias("_past"))
        .groupBy(*keys).agg(F.min(F.when(
            F.col("_past") > F.col("_wanted"),
            F.struct(F.col("_digit").alias("at"), (F.col("_wanted") - F.col("_past") + F.col("_n")).alias("need")),
        )).alias("_cut"))
    )
    if keys:
        cut = cut.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_cut")
        same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
        met = marked.join(F.broadcast(cut), same, "left")
    else:
        met = marked.withColumn("_cut", cut.scalar())
    at = F.col("_cut.at")
    on_edge = F.col("_in") & ~F.col("_anyway") & (F.col("_digit") == at)
    met = met.where(F.col("_anyway") | F.col("_cut").isNull() | (F.col("_digit") <= at)).withColumn(
        "_edge", F.coalesce(on_edge, F.lit(False))
    )
    cell = F.when(F.col("_edge"), -1).otherwise(F.pmod(F.xxhash64(*order), F.lit(SPREAD)))
    within = Window.partitionBy(*keys, "_cell").orderBy(*[F.when(F.col("_edge"), c) for c in order])
    ranked = met.withColumn("_cell", cell).withColumn("_rank", F.row_number().over(within))
    return ranked.where(~F.col("_edge") | (F.col("_rank") <= F.col("_cut.need"))).select(*df.columns)


def negative_downsample(
    df: DataFrame, ratio: int = 4, seed: int = 42, order: list[Column] | None = None, by: str = "year",
    digit: Column | None = None,
) -> DataFrame:
    """Every positive row and exactly min(ratio x positives, negatives) negative rows of each year."""
    label = F.col("outage_label")
    wanted = F.sum("_others").over(Window.partitionBy(by)) * ratio
    return _first_rows(df, [by], *_order(seed, order, digit), label == 0, wanted, label == 1)


def balanced_sample(
    df: DataFrame, n: int = 150_000, seed: int = 42, order: list[Column] | None = None, digit: Column | None = None
) -> DataFrame:
    """The same number of rows from both classes: ``n``, or all positives where there are fewer."""
    label = F.col("outage_label")
    # The counts have at most two classes by the digits.
    positives = F.sum(F.when(label == 1, F.col("_n"))).over(Window.partitionBy())
    wanted = F.least(F.lit(n), F.coalesce(positives, F.lit(0)))
    return _first_rows(df, ["outage_label"], *_order(seed, order, digit), label.isNotNull(), wanted, F.lit(False))


def uniform_sample(
    df: DataFrame, n: int = 300_000, seed: int = 42, order: list[Column] | None = None, digit: Column | None = None
) -> DataFrame:
    return _first_rows(df, [], *_order(seed, order, digit), F.lit(True), F.lit(n), F.lit(False))


def county_sample(df: DataFrame, n: int, seed: int = 42, order: list[Column] | None = None) -> DataFrame:
    """All rows of ``n`` counties. The list of counties is bounded by ``n``."""
    order = order or hash_order(["fips"], seed)
    chosen = df.select("fips").distinct().orderBy(*order).limit(n)
    return df.join(chosen, "fips", "left_semi")
