"""Bucketed ranks, totals, quantiles and samples against plain windows, with a third of all rows in one group."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from outagegrid.operators import ordering, sampling


@pytest.fixture(scope="module")
def skewed(spark):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)
    value = F.when(F.col("id") % 3 == 1, F.lit(2.5)).otherwise((F.col("id") * 7919 % 1009) / 100)
    return spark.range(6000).select(hot.alias("k"), value.alias("v"), "id").persist()


def test_rank_matches_row_number(skewed):
    ranked = ordering.rank_within(skewed, ["k"], [-F.col("v"), F.col("id")])
    plain = Window.partitionBy("k").orderBy(F.desc("v"), "id")
    wrong = ranked.join(skewed.select("id", F.row_number().over(plain).alias("want")), "id").where("rank <> want")
    assert ranked.count() == 6000 and wrong.count() == 0


def test_rank_upto_keeps_only_the_first(skewed):
    top = ordering.rank_within(skewed, [], [F.col("v"), F.col("id")], upto=F.lit(17))
    want = [r.id for r in skewed.orderBy("v", "id").limit(17).collect()]
    assert [r.id for r in top.orderBy("rank").collect()] == want


def test_running_totals(skewed):
    counts = skewed.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    got = ordering.running_totals(counts, ["k"], [F.col("v")], ["n"])
    plain = Window.partitionBy("k").orderBy("v")
    want = counts.select("k", "v", F.sum("n").over(plain).alias("w"))
    assert got.join(want, ["k", "v"]).where("cum_n <> w").count() == 0
    assert got.count() == counts.count()


@pytest.mark.parametrize("q", [0.0, 0.25, 0.9, 1.0])
def test_quantiles_equal_percentile(skewed, q):
    got = {r.k: (r.x, r.m) for r in ordering.exact_quantiles(skewed, ["k"], "v", {"x": q}, mean="m").collect()}
    want = skewed.groupBy("k").agg(F.percentile("v", F.lit(q)).alias("x"), F.avg("v").alias("m")).collect()
    assert len(got) == len(want)
    for r in want:
        assert got[r.k] == (pytest.approx(r.x), pytest.approx(r.m))


def test_quantile_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([("a", 3.0), ("b", None)], "k string, v double")
    assert ordering.exact_quantiles(one, ["k"], "v", {"x": 0.9}).collect() == [("a", 3.0)]


def test_bucketed_results_do_not_depend_on_partitions(spark, skewed):
    def run():
        return sorted(map(tuple, ordering.exact_quantiles(skewed, ["k"], "v", {"x": 0.9}).collect()))

    many = run()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert run() == many
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture(scope="module")
def hours(spark):
    return spark.range(4000).select(
        (F.col("id") % 5).cast("string").alias("fips"), F.col("id").alias("hour"),
        F.when(F.col("id") < 3500, 2015).otherwise(2016).alias("year"),
        F.when(F.col("id") % 10 == 0, 1).when(F.col("id") > 3800, 1).otherwise(0).alias("outage_label"),
    )


def test_negative_downsample_sizes(hours):
    kept = sampling.negative_downsample(hours, ratio=4)
    got = {(r.year, r.outage_label): r["count"] for r in kept.groupBy("year", "outage_label").count().collect()}
    have = {(r.year, r.outage_label): r["count"] for r in hours.groupBy("year", "outage_label").count().collect()}
    for year in (2015, 2016):
        assert got[(year, 1)] == have[(year, 1)]
        assert got[(year, 0)] == min(4 * have[(year, 1)], have[(year, 0)])
    assert kept.select("fips", "hour").distinct().count() == kept.count()


def test_samples_repeat_and_differ_by_seed(hours):
    def ids(seed):
        return sorted(r.hour for r in sampling.uniform_sample(hours, 100, seed).collect())

    assert len(ids(1)) == 100 and ids(1) == ids(1) and ids(1) != ids(2)


def test_balanced_and_county_samples(hours):
    sizes = {r.outage_label: r["count"] for r in sampling.balanced_sample(hours, 50).groupBy("outage_label").count().collect()}
    assert sizes == {0: 50, 1: 50}
    assert sampling.county_sample(hours, 2).select("fips").distinct().count() == 2


@pytest.mark.parametrize("ratio", [0, 1, 3, 100])
def test_radix_selection_takes_the_first_rows(spark, ratio):
    """Against a sort: years without positives, without negatives, ties in the leading digit, labels that are null."""
    rows = [(y, h, 1 if (h * 7 + y) % 5 == 0 and y != 2 else None if h % 11 == 0 else 0 if y != 3 else 1) for y in (1, 2, 3, 4) for h in range(60)]
    df = spark.createDataFrame(rows, "year int, hour int, outage_label int").repartition(3)
    order = [(F.col("hour") * 31) % 7, F.col("hour")]
    got = {tuple(r) for r in sampling.negative_downsample(df, ratio, order=order).collect()}
    want = set()
    for y in (1, 2, 3, 4):
        mine = [r for r in rows if r[0] == y]
        positives = [r for r in mine if r[2] == 1]
        negatives = sorted((r for r in mine if r[2] == 0), key=lambda r: (r[1] * 31 % 7, r[1]))
        want |= {*positives, *negatives[: ratio * len(positives)]}
    assert got == want
    assert sampling.negative_downsample(df.where("false"), ratio, order=order).count() == 0
    some = sampling.uniform_sample(df, 17 * ratio, order=order).select("hour").collect()
    assert sorted(r.hour for r in some) == sorted(sorted((r[1] for r in rows), key=lambda h: (h * 31 % 7, h))[: 17 * ratio])
