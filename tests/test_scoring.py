"""Metrics, priorities and scenarios against hand-computed values."""

import datetime
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from outagegrid.functions import codes
from outagegrid.operators import metrics, model_tables, models, priority

SCORES = [(1, 0.9), (1, 0.8), (0, 0.8), (1, 0.6), (0, 0.4), (0, 0.4), (1, 0.2), (0, 0.1)]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, y, p, 10.0 * (i + 1)) for i, (y, p) in enumerate(SCORES)]
    return spark.createDataFrame(rows, "id int, label int, proba double, customers double")


def test_curves(scored):
    got = metrics.curve_metrics(metrics.threshold_table(scored)).first()
    pairs = [(p, n) for yp, p in SCORES for yn, n in SCORES if yp == 1 and yn == 0]
    auc = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    ap, last = 0.0, 0.0
    for t in sorted({p for _, p in SCORES}, reverse=True):
        tp = sum(y for y, p in SCORES if p >= t)
        ap += (tp / 4 - last) * tp / sum(p >= t for _, p in SCORES)
        last = tp / 4
    assert got.roc_auc == pytest.approx(auc) and got.pr_auc == pytest.approx(ap)
    assert got.best_threshold == 0.6 and got.best_f1 == pytest.approx(0.75)


def test_metrics_do_not_depend_on_row_order(scored):
    shuffled = scored.orderBy(F.xxhash64("id")).repartition(3)
    a, b = (metrics.curve_metrics(metrics.threshold_table(x)).first() for x in (scored, shuffled))
    assert tuple(a) == pytest.approx(tuple(b))


def test_best_threshold_takes_the_lowest_of_equals(spark):
    rows = [(1, 0.9), (0, 0.8), (0, 0.7), (1, 0.6), (1, 0.5), (1, 0.4)]
    df = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.1)], "label int, proba double")
    assert metrics.curve_metrics(metrics.threshold_table(df)).first().best_threshold == 0.1
    got = metrics.curve_metrics(metrics.threshold_table(spark.createDataFrame(rows, "label int, proba double"))).first()
    assert got.best_threshold == 0.4 and got.best_f1 == pytest.approx(0.8)


def test_points_start_and_end(scored):
    table = metrics.threshold_table(scored)
    roc = sorted((r.fpr, r.tpr) for r in metrics.roc_points(table).collect())
    assert roc[0] == (0.0, 0.0) and roc[-1] == (1.0, 1.0) and len(roc) == 7
    assert (1.0, 0.0) in [(r.precision, r.recall) for r in metrics.pr_points(table).collect()]


def test_bins_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 1 / 15), (1, 1.0), (0, 0.07)], "label int, proba double")
    got = {r.bin: r.n for r in metrics.calibration(df).collect()}
    assert got == {0: 2, 1: 1, 14: 1}
    widths = {r.bucket: r.n for r in metrics.equal_width_rate(df).collect()}
    assert widths == {1: 3, 10: 1}
    flat = spark.createDataFrame([(0, 0.5), (1, 0.5)], "label int, proba double")
    assert [tuple(r) for r in metrics.equal_width_rate(flat).collect()] == [(1, 0.5, 2)]


def test_density_integrates_to_one(scored):
    rows = metrics.class_density(scored, bins=5).collect()
    for label in (0, 1):
        own = [p for y, p in SCORES if y == label]
        width = (max(own) - min(own)) / 5
        assert sum(r.density for r in rows if r["class"] == label) * width == pytest.approx(1.0)


def test_losses(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 1.0), (0, -800.0, 1.0, 4.0)], "label int, z double, t double, q double")
    p = 1 / (1 + math.exp(-2))
    focal = metrics.focal_loss(df, "z")
    assert focal.first()[0] == pytest.approx((0.75 * (1 - p) ** 2 * -math.log(p)) / 2)
    pinball = metrics.pinball_loss(df, "t", {"q": 0.9})
    assert pinball.first()[0] == pytest.approx((0.9 * 2 + 0.1 * 3) / 2)
    assert metrics.combined_loss(focal, pinball).first().combined_loss == pytest.approx(
        0.6 * focal.first()[0] + 0.4 * pinball.first()[0]
    )


def test_top_k_recall(scored):
    got = {r.k: r.recall for r in metrics.top_k_recall(scored, [1, 2, 8], ["id"]).collect()}
    total = 10 + 20 + 40 + 70
    assert got == {1: pytest.approx(10 / total), 2: pytest.approx(30 / total), 8: pytest.approx(1.0)}


def test_model_table_and_leaders(scored):
    table = metrics.model_metrics(scored.withColumn("flat", F.lit(0.5)), {"good": "proba", "flat": "flat"})
    rows = {r.model: r for r in table.collect()}
    assert rows["flat"].roc_auc == 0.5 and rows["flat"].pr_auc == 0.5 and rows["flat"].brier == 0.25
    assert metrics.best_models(table).first().best_roc_auc == "good"


@pytest.mark.parametrize("labels, precision, f1", [([1, 1, 1], 1.0, 1.0), ([0, 0, 0], math.nan, 0.0)])
def test_metrics_of_a_single_class(spark, labels, precision, f1):
    df = spark.createDataFrame([*zip(labels, [0.9, 0.4, 0.1])], "label int, proba double")
    got = metrics.model_metrics(df, {"only": "proba"}).first()
    assert math.isnan(got.roc_auc) and got.pr_auc == pytest.approx(precision, nan_ok=True) and got.f1 == f1
    assert metrics.curve_metrics(metrics.threshold_table(df)).first().best_threshold == 0.1


def test_scores_without_labels_add_nothing(spark):
    rows = [(None, 0.95), *SCORES, (None, 0.05)]
    df = spark.createDataFrame(rows, "label int, proba double")
    a, b = (metrics.curve_metrics(metrics.threshold_table(x)).first() for x in (df, df.where("label IS NOT NULL")))
    assert tuple(a) == pytest.approx(tuple(b))


def test_metrics_are_rounded_once(spark):
    df = spark.range(276).select((F.col("id") == 106).cast("int").alias("label"), F.col("id").cast("double").alias("proba"))
    fine, coarse = (metrics.model_metrics(df, {"only": "proba"}, digits=n).first().roc_auc for n in (4, 3))
    assert (fine, coarse) == (0.3855, 0.385)  # 106 / 275


def test_trained_models_are_compared_where_every_test_hour_has_an_outage(spark, tmp_path):
    rows = []
    for day in (2, 3, 12, 13, 27):
        for hour in range(24):
            for county in range(3):
                for n in range(4):
                    mixed = (day * 7919 + hour * 104729 + county * 31 + n * 17) % 97 + 15.0
                    at = datetime.datetime(2024, 1, day, hour, 10 + n)
                    rows.append((len(rows), at, county, "view", mixed + (1000 if day > 25 else 0)))
    columns = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    path = f"{tmp_path}/events.parquet"
    spark.createDataFrame(rows, columns).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/*.parquet'")
    want = sorted(con.execute(entry.oracle_sql()["trained_comparison"]).fetchall())
    got = sorted(tuple(r) for r in entry.queries()["trained_comparison"](spark, str(tmp_path)).collect())
    assert [r[0] for r in got] == ["Gradient Boosting", "Logistic Regression"]
    assert all(math.isnan(r[1]) for r in got + want) and [r[2] for r in got] == [r[2] for r in want]


@pytest.fixture(scope="module")
def counties(spark):
    rows = [
        ("1001", 0.5, 100.0, 0.2), ("6001", 0.9, 50.0, 0.4), ("43001", 0.7, 10.0, 0.1), ("36103", 0.8, 200.0, 0.3),
    ]
    return spark.createDataFrame(rows, "fips string, max_outage_proba double, peak_customers_out double, outage_rate double")


def test_scenario_uses_the_maximum_of_all_counties(counties):
    scen = priority.scenario(counties, "High Wind Event", 6)
    got = {r.fips: r for r in scen.collect()}
    assert got["1001"].scenario_proba == pytest.approx(0.5 * 1.6 * 0.7) and got["6001"].scenario_proba == 0.999
    assert got["1001"].priority_score == pytest.approx(0.5 * 0.56 + 0.4 * 100 / (200 + 1e-8) + 0.1 * 0.2)
    assert got["43001"].state_abbr == "?" and got["1001"].risk_label == "MEDIUM"
    only = priority.priority_queue(scen, ["AL"], 10).collect()
    assert [r.fips for r in only] == ["1001"] and only[0].priority_score == got["1001"].priority_score
    assert priority.kpi_row(scen).first()[:2] == (2, 1)
    assert [r.state_abbr for r in priority.state_mean_risk(scen).collect()] == ["CA", "NY", "AL"]


def test_tables_of_a_scenario(counties):
    scen = priority.scenario(counties)
    table = priority.queue_table(priority.priority_queue(scen, k=2)).collect()
    assert [r["index"] for r in table] == [1, 2] and table[0]["FIPS"] == "36103"
    assert priority.county_lookup(scen, ["99999"]).count() == 0
    label = priority.top_by_probability(scen, 1).first().label
    assert label == "06001 — CA (P=0.900)"
    assert sum(r.counties for r in priority.score_histogram(scen).collect()) == 4
    assert max(r.bin for r in priority.score_histogram(scen).collect()) == 19
    assert priority.dispatch_total(scen, 1).first()[0] == 200.0


def test_hourly_profile(counties):
    rows = priority.risk_profile(priority.scenario(counties).where("fips = '1001'")).orderBy("hour_ahead").collect()
    decay = [0.55] * 4 + [0.7] * 5 + [0.85] * 9 + [1.0] * 6
    want = [min(0.999, 0.5 * (1 + 0.1 * math.sin(h / 4)) * decay[h - 1]) for h in range(1, 25)]
    assert [r.risk for r in rows] == pytest.approx(want)


def test_county_priority_rows(spark):
    rows = [("a", 2, "X", 0, 0.5, 10.0, 100.0), ("a", 1, "W", 1, 0.7, 20.0, 100.0), ("b", 1, None, 1, 0.9, 5.0, 50.0)]
    df = spark.createDataFrame(
        rows, "fips string, hour int, state string, outage_label int, outage_proba double, peak_customers_out double, county_p90 double"
    )
    got = {r.fips: r for r in priority.county_priority(priority.row_priority(df)).collect()}
    assert got["a"].rank == 1 and got["b"].rank == 2 and got["a"].state == "W" and got["b"].state is None
    assert got["a"].max_priority_score == pytest.approx(0.7 * 20 * (1 + 100 / (100 + 1e-8)))
    assert got["a"].outage_rate == 0.5 and got["a"].total_hours == 2


def test_models_learn_save_and_load(spark, tmp_path):
    data = spark.range(400).select(
        (F.col("id") % 4).cast("string").alias("fips"), F.col("id").alias("hour"),
        (F.col("id") % 10 < 3).cast("int").alias("outage_label"),
        F.when(F.col("id") % 10 < 3, 5.0).otherwise(1.0).alias("wind"), (F.col("id") % 7).cast("double").alias("noise"),
    )
    names = ["wind", "noise"]
    logistic = models.fit_logistic(data, names, max_iter=20)
    boosted = models.fit_gbt(data, names, trees=2, depth=2)
    models.save_model(logistic, str(tmp_path / "model"))
    again = models.load_model(str(tmp_path / "model"))
    scored = models.score(again, models.score(boosted, data, names, "boosted"), names)
    table = metrics.model_metrics(scored, {"l": "outage_proba", "b": "boosted"}, "outage_label")
    assert {(r.model, r.roc_auc) for r in table.collect()} == {("l", 1.0), ("b", 1.0)}
    top = models.feature_importance(spark, boosted, names).collect()
    assert top[0].feature == "wind" and top[0].feature_group == "storm" and top[1].feature_group == "temporal"


def test_model_tables_score_like_the_models(spark):
    data = spark.range(500).select(
        (F.col("id") % 4).cast("string").alias("fips"), F.col("id").alias("hour"),
        ((F.col("id") * 7919 % 100) + (F.col("id") % 5) * 9 > 70).cast("int").alias("outage_label"),
        (F.col("id") * 7919 % 100).cast("double").alias("wind"), F.when(F.col("id") % 9 > 0, (F.col("id") % 5).cast("double")).alias("noise"),
        F.lit(1.0).alias("level"),
    )
    names = ["wind", "noise", "level"]
    for fitted, table, score in (
        (models.fit_logistic(data, names, max_iter=30), model_tables.linear_table, model_tables.score_linear),
        (models.fit_gbt(data, names, trees=4, depth=3), model_tables.tree_table, model_tables.score_trees),
    ):
        both = score(models.score(fitted, data, names, "own"), table(spark, fitted, names), names)
        assert both.where(F.abs(F.col("own") - F.col("outage_proba")) > 1e-9).count() == 0 and both.count() == 500
    shares = {r.feature: r.importance for r in model_tables.importance(model_tables.tree_table(spark, fitted, names)).collect()}
    assert shares == pytest.approx({n: v for n, v in zip(names, fitted.stages[-1].featureImportances.toArray()) if v})


def test_unseen_forecast_combination_is_zero(spark):
    train = spark.createDataFrame([("a", 0, 1.0), ("a", 0, 3.0)], "fips string, any_storm int, log_peak_customers double")
    forecast = models.quantile_forecast(train)
    asked = spark.createDataFrame([("a", 0), ("a", 1)], "fips string, any_storm int")
    got = {r.any_storm: (r.q50_log, r.q90_log) for r in models.with_forecast(asked, forecast).collect()}
    assert got == {0: (2.0, pytest.approx(2.8)), 1: (0.0, 0.0)}


def test_label_round_trip(spark):
    row = spark.range(1).select(codes.fips_of_label(codes.county_label(F.lit("01001"), F.lit("AL"), F.lit(0.5))).alias("x"))
    assert row.first().x == "01001"


def test_a_boosting_sample_takes_as_few_tasks_as_its_rows_need(spark, monkeypatch):
    """Its parts, and with them the rows every tree draws, do not depend on the session's shuffle partitions."""
    rows = spark.range(400).select(
        F.lit("01001").alias("fips"), F.timestamp_seconds(F.col("id") * 3600).alias("hour"), "id"
    ).repartition(16, "id")
    assert models.packed(rows).rdd.getNumPartitions() == 1
    monkeypatch.setattr(models, "ROWS_PER_TASK", 100)
    packed = models.packed(rows)
    assert packed.rdd.getNumPartitions() == 4 and sorted(r.id for r in packed.collect()) == list(range(400))
