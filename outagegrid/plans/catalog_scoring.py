"""Queries over scored rows: metrics, county priority, scenarios and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from outagegrid import fixed
from outagegrid.functions import codes
from outagegrid.operators import features, metrics, model_tables, models, priority, sampling
from outagegrid.plans.catalog import CTES, query, rounded
from outagegrid.plans.catalog_outages import MIXED_SQL, SPLIT, _flagship, _mixed_order
from outagegrid.plans.scoring import ranked_counties
from outagegrid.plans.views import frame
from outagegrid.session import keep, scratch_path
from outagegrid.sources import files

SCENARIO, HORIZON = "Thunderstorm", 12

STATES_SQL = ", ".join(f"('{k}', '{v}')" for k, v in fixed.STATE_CODES.items())
CTES["p_states"] = f"SELECT * FROM (VALUES {STATES_SQL}) AS t(code, abbr)"
CTES["p_scored"] = """
SELECT CAST(fips AS VARCHAR) AS fips, hour, state, label AS outage_label, l_orderkey, l_linenumber,
       proba * (1 + fips % 10) / 1e1 AS outage_proba, customers AS peak_customers_out, county_p90 FROM v_scored"""
CTES["p_rows"] = """
SELECT *, outage_proba * (exp(least(20e0, ln(1 + peak_customers_out))) - 1)
          * (1 + county_p90 / ((SELECT max(county_p90) FROM p_scored) + 1e-8)) AS priority_score FROM p_scored"""
CTES["p_counties"] = """
SELECT *, outage_events / total_hours AS outage_rate,
       row_number() OVER (ORDER BY max_priority_score DESC, fips) AS rank
FROM (SELECT fips, avg(outage_proba) AS mean_outage_proba, max(outage_proba) AS max_outage_proba,
             avg(priority_score) AS mean_priority_score, max(priority_score) AS max_priority_score,
             max(peak_customers_out) AS peak_customers_out, CAST(sum(outage_label) AS BIGINT) AS outage_events,
             count(outage_label) AS total_hours, arg_min(state, hour) FILTER (state IS NOT NULL) AS state
      FROM p_rows GROUP BY fips)"""
CTES["p_scenario"] = """
SELECT *, CASE WHEN scenario_proba >= 0.85e0 THEN 'CRITICAL' WHEN scenario_proba >= 0.65e0 THEN 'HIGH'
               WHEN scenario_proba >= 0.4e0 THEN 'MEDIUM' ELSE 'LOW' END AS risk_label,
       CASE WHEN scenario_proba >= 0.85e0 THEN '#ef4444' WHEN scenario_proba >= 0.65e0 THEN '#f59e0b'
            WHEN scenario_proba >= 0.4e0 THEN '#3b82f6' ELSE '#10b981' END AS risk_colour,
       greatest(0e0, least(1e0, 0.5e0 * scenario_proba
         + 0.4e0 * (peak_customers_out / ((SELECT max(peak_customers_out) FROM p_counties) + 1e-8)) + 0.1e0 * outage_rate)) AS priority_score
FROM (SELECT c.*, lpad(c.fips, 5, '0') AS fips_str, substr(lpad(c.fips, 5, '0'), 1, 2) AS state_fips,
             coalesce(s.abbr, '?') AS state_abbr, least(0.999e0, max_outage_proba * 1.4e0 * 0.85e0) AS scenario_proba
      FROM p_counties c LEFT JOIN p_states s ON s.code = substr(lpad(c.fips, 5, '0'), 1, 2))"""
CTES["p_queue"] = "SELECT * FROM p_scenario ORDER BY priority_score DESC, fips LIMIT 50"
CTES["m_counts"] = """
SELECT proba AS score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM v_scored GROUP BY proba"""
CTES["m_table"] = """
SELECT score, pos AS pos_here, neg AS neg_here, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
       CAST(sum(pos) OVER () - sum(pos) OVER w AS BIGINT) AS fn, CAST(sum(neg) OVER () - sum(neg) OVER w AS BIGINT) AS tn
FROM m_counts WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"""
CTES["m_f1"] = """
SELECT score, 2e0 * tp / (2 * tp + fp + fn) AS f1,
       CASE WHEN tp = 0 THEN 0e0
            ELSE 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn) + 1e-8) END AS eased
FROM m_table"""
CTES["m_loss_rows"] = """
SELECT label, ln(greatest(0.001e0, least(0.999e0, proba)) / (1 - greatest(0.001e0, least(0.999e0, proba)))) AS z,
       ln(1 + customers) AS target, ln(1 + county_p90) * 0.8e0 AS q50, ln(1 + county_p90) * 1.1e0 AS q90 FROM v_scored"""
CTES["m_focal"] = """
SELECT avg(CASE WHEN label = 1 THEN 0.75e0 ELSE 0.25e0 END
           * pow(CASE WHEN label = 1 THEN 1 - 1 / (1 + exp(-z)) ELSE 1 / (1 + exp(-z)) END, 2)
           * (greatest(z, 0e0) - z * label + ln(1 + exp(-abs(z))))) AS focal_loss FROM m_loss_rows"""
CTES["m_pinball"] = """
SELECT avg((greatest(0.5e0 * (target - q50), -0.5e0 * (target - q50))
            + greatest(0.9e0 * (target - q90), -0.1e0 * (target - q90))) / 2) AS pinball_loss FROM m_loss_rows"""


def _scored(spark, folder):
    return frame(spark, folder, "v_scored")


def _priority_rows(spark, folder):
    return _scored(spark, folder).select(
        F.col("fips").cast("string").alias("fips"), "hour", "state", F.col("label").alias("outage_label"),
        "l_orderkey", "l_linenumber", (F.col("proba") * (1 + F.col("fips") % 10) / 10).alias("outage_proba"),
        F.col("customers").alias("peak_customers_out"), "county_p90",
    )


def _counties(spark, folder):
    return ranked_counties(_priority_rows(spark, folder))


def _scenario(spark, folder):
    return priority.scenario(_counties(spark, folder), SCENARIO, HORIZON)


def _queue(spark, folder):
    return priority.priority_queue(_scenario(spark, folder))


COUNTY_ROUNDS = dict(
    mean_outage_proba=8, max_outage_proba=9, mean_priority_score=4, max_priority_score=4, outage_rate=9
)


def _rounds(digits):
    return ", ".join(f"round({c}, {d}) AS {c}" for c, d in digits.items())


@query("SELECT l_orderkey, l_linenumber, round(priority_score, 4) AS priority_score FROM p_rows")
def row_priority(spark, folder):
    rows = priority.row_priority(_priority_rows(spark, folder))
    return rounded(rows.select("l_orderkey", "l_linenumber", "priority_score"), priority_score=4)


@query(
    f"SELECT fips, state, peak_customers_out, outage_events, total_hours, rank, {_rounds(COUNTY_ROUNDS)} FROM p_counties"
)
def county_priority(spark, folder):
    return rounded(_counties(spark, folder), **COUNTY_ROUNDS)


@query(
    "SELECT rank, fips, state, round(max_outage_proba, 9) AS max_outage_proba, peak_customers_out, "
    "round(max_priority_score, 4) AS max_priority_score FROM p_counties WHERE rank <= 10"
)
def priority_rank(spark, folder):
    return rounded(priority.top_counties(_counties(spark, folder)), max_outage_proba=9, max_priority_score=4)


SCENARIO_COLUMNS = ["fips_str", "state_fips", "state_abbr", "risk_label", "risk_colour"]
SCENARIO_ROUNDS = dict(scenario_proba=9, priority_score=6)


@query(f"SELECT fips, {', '.join(SCENARIO_COLUMNS)}, {_rounds(SCENARIO_ROUNDS)} FROM p_scenario")
def scenario_scores(spark, folder):
    df = _scenario(spark, folder).select("fips", *SCENARIO_COLUMNS, *SCENARIO_ROUNDS)
    return rounded(df, **SCENARIO_ROUNDS)


@query(
    f"SELECT fips, {', '.join(SCENARIO_COLUMNS)}, {_rounds(SCENARIO_ROUNDS)} FROM p_scenario "
    "WHERE state_abbr IN ('CA', 'NY', 'TX') ORDER BY p_scenario.priority_score DESC, fips LIMIT 20"
)
def priority_queue(spark, folder):
    queue = priority.priority_queue(_scenario(spark, folder), ["CA", "NY", "TX"], 20)
    return rounded(queue.select("fips", *SCENARIO_COLUMNS, *SCENARIO_ROUNDS), **SCENARIO_ROUNDS)


@query(
    """SELECT CAST(row_number() OVER (ORDER BY priority_score DESC, fips) AS INT) AS "index", fips_str AS "FIPS", state_abbr AS "State",
       round(scenario_proba, 6) AS "P(Outage)", peak_customers_out AS "Peak Customers", round(outage_rate, 6) AS "Outage Rate",
       round(priority_score, 6) AS "Priority Score", risk_label AS "Risk" FROM p_queue"""
)
def queue_table(spark, folder):
    table = priority.queue_table(_queue(spark, folder))
    return rounded(table, **{"P(Outage)": 6, "Outage Rate": 6, "Priority Score": 6})


@query(
    """SELECT fips_str, printf('%.3f', scenario_proba) AS p_text, format('{:,}', CAST(round(peak_customers_out) AS BIGINT)) AS customers_text,
       printf('%.4f', priority_score) AS score_text FROM p_queue"""
)
def queue_texts(spark, folder):
    return _queue(spark, folder).select(
        "fips_str", F.format_string("%.3f", "scenario_proba").alias("p_text"),
        codes.grouped_number(F.round("peak_customers_out"), 0).alias("customers_text"),
        F.format_string("%.4f", "priority_score").alias("score_text"),
    )


@query(
    """SELECT fips_str, label, trim(split_part(label, ' — ', 1)) AS fips_of_label
FROM (SELECT *, printf('%s — %s (P=%.3f)', fips_str, state_abbr, scenario_proba) AS label FROM p_scenario
      ORDER BY max_outage_proba DESC, fips LIMIT 200)"""
)
def county_labels(spark, folder):
    top = priority.top_by_probability(_scenario(spark, folder))
    return top.select("fips_str", "label", codes.fips_of_label(F.col("label")).alias("fips_of_label"))


@query("SELECT risk_label, count(*) AS counties FROM p_scenario GROUP BY risk_label")
def risk_mix(spark, folder):
    return priority.risk_mix(_scenario(spark, folder))


@query("SELECT state_abbr, count(*) AS counties FROM p_queue GROUP BY state_abbr ORDER BY counties DESC, state_abbr LIMIT 10")
def state_mix(spark, folder):
    return priority.state_mix(_queue(spark, folder))


@query(
    """SELECT state_abbr, round(avg(scenario_proba), 9) AS mean_proba FROM p_scenario WHERE state_abbr <> '?'
GROUP BY state_abbr ORDER BY avg(scenario_proba) DESC, state_abbr LIMIT 8"""
)
def state_mean_risk(spark, folder):
    return rounded(priority.state_mean_risk(_scenario(spark, folder)), mean_proba=9)


@query(
    """SELECT count(*) FILTER (scenario_proba >= 0.85e0) AS critical_counties,
       count(*) FILTER (scenario_proba >= 0.65e0 AND scenario_proba < 0.85e0) AS high_counties,
       round(sum(peak_customers_out), 2) AS customers_at_risk FROM p_scenario"""
)
def kpi_row(spark, folder):
    return rounded(priority.kpi_row(_scenario(spark, folder)), customers_at_risk=2)


@query(
    """SELECT round(sum(peak_customers_out), 2) AS dispatch_customers
FROM (SELECT * FROM p_queue ORDER BY priority_score DESC, fips LIMIT 10)"""
)
def dispatch_total(spark, folder):
    return rounded(priority.dispatch_total(_queue(spark, folder)), dispatch_customers=2)


@query("SELECT round(quantile_cont(priority_score, 0.97), 6) AS score_quantile FROM p_scenario")
def score_quantile(spark, folder):
    return rounded(priority.score_quantile(_scenario(spark, folder)), score_quantile=6)


@query(
    """SELECT bin, count(*) AS counties, round(max(lo + bin * width), 6) AS from_score
FROM (SELECT *, CAST(least(19, coalesce(floor((x - lo) / nullif(width, 0e0)), 0)) AS INT) AS bin
      FROM (SELECT priority_score AS x, min(priority_score) OVER () AS lo,
                   (max(priority_score) OVER () - min(priority_score) OVER ()) / 20 AS width FROM p_queue))
GROUP BY bin"""
)
def score_histogram(spark, folder):
    return rounded(priority.score_histogram(_queue(spark, folder)), from_score=6)


@query(
    """SELECT fips, CAST(h AS INT) AS hour_ahead,
       round(least(0.999e0, scenario_proba * (1 + 0.1e0 * sin(h / 4e0))
         * CASE WHEN h <= 4 THEN 0.55e0 WHEN h <= 9 THEN 0.7e0 WHEN h <= 18 THEN 0.85e0 ELSE 1e0 END), 6) AS risk
FROM p_scenario, unnest(range(1, 25)) AS r(h)"""
)
def risk_profile_24h(spark, folder):
    return rounded(priority.risk_profile(_scenario(spark, folder)), risk=6)


@query(
    """SELECT fips_str, state_abbr, round(scenario_proba, 6) AS scenario_proba, risk_label FROM p_scenario
WHERE fips_str IN (SELECT min(fips_str) FROM p_scenario UNION ALL SELECT max(fips_str) FROM p_scenario)"""
)
def county_compare(spark, folder):
    """Two counties side by side: the lowest and the highest code of the table."""
    scen = _scenario(spark, folder)
    ends = scen.agg(F.min("fips_str"), F.max("fips_str")).first()
    shown = priority.county_lookup(scen, list(ends))
    return rounded(shown.select("fips_str", "state_abbr", "scenario_proba", "risk_label"), scenario_proba=6)


@query(
    """SELECT CAST(row_number() OVER (ORDER BY priority_score DESC, fips) AS INT) AS rank, fips_str AS "FIPS", state_abbr AS "State",
       round(scenario_proba, 6) AS "P(Outage)", peak_customers_out AS "Peak Customers", round(priority_score, 6) AS "Priority Score"
FROM (SELECT * FROM p_scenario ORDER BY priority_score DESC, fips LIMIT 5)"""
)
def retrospective_top_counties(spark, folder):
    top = priority.retrospective(_scenario(spark, folder))
    return rounded(top, **{"P(Outage)": 6, "Priority Score": 6})


@query(
    """SELECT round(coalesce(avg(mean_outage_proba), 0.45e0), 9) AS avg_risk, round(coalesce(max(max_outage_proba), 0.75e0), 9) AS max_risk
FROM p_counties WHERE substr(fips, 1, 5) IN ('36059', '36103', '37036', '42041')"""
)
def region_risk(spark, folder):
    from outagegrid.operators.graph import region_risk as risk

    region = risk(_counties(spark, folder), [*fixed.RISK_COUNTIES, "37036", "42041"])
    return rounded(region, avg_risk=9, max_risk=9)


# --- metrics --------------------------------------------------------------------------------------


@query("SELECT score, tp, fp, fn, tn, pos_here, neg_here FROM m_table")
def threshold_table(spark, folder):
    return metrics.threshold_table(_scored(spark, folder))


def _curves(spark, folder):
    return metrics.curve_metrics(metrics.threshold_table(_scored(spark, folder)))


@query("SELECT round(sum(neg_here * (tp + tp - pos_here) / 2e0 / (tp + fn) / (fp + tn)), 9) AS roc_auc FROM m_table")
def roc_auc(spark, folder):
    return _curves(spark, folder).select(F.round("roc_auc", 9).alias("roc_auc"))


@query("SELECT round(sum(pos_here / (tp + fn) * (tp / (tp + fp))), 9) AS pr_auc FROM m_table")
def average_precision(spark, folder):
    return _curves(spark, folder).select(F.round("pr_auc", 9).alias("pr_auc"))


@query("SELECT score AS best_threshold, round(f1, 9) AS best_f1 FROM m_f1 ORDER BY eased DESC, score LIMIT 1")
def best_f1(spark, folder):
    return _curves(spark, folder).select("best_threshold", F.round("best_f1", 9).alias("best_f1"))


@query(
    """SELECT round(2e0 * count(*) FILTER (proba >= 0.5e0 AND label = 1)
       / (count(*) FILTER (proba >= 0.5e0) + count(*) FILTER (label = 1)), 9) AS f1 FROM v_scored"""
)
def f1_at_half(spark, folder):
    return rounded(metrics.f1_at(_scored(spark, folder), 0.5), f1=9)


@query(
    """SELECT score AS threshold, round(fp / (fp + tn), 9) AS fpr, round(tp / (tp + fn), 9) AS tpr FROM m_table
UNION ALL SELECT CAST(NULL AS DOUBLE), 0e0, 0e0"""
)
def roc_points(spark, folder):
    return rounded(metrics.roc_points(metrics.threshold_table(_scored(spark, folder))), fpr=9, tpr=9)


@query(
    """SELECT score AS threshold, round(tp / (tp + fp), 9) AS "precision", round(tp / (tp + fn), 9) AS recall FROM m_table
UNION ALL SELECT CAST(NULL AS DOUBLE), 1e0, 0e0"""
)
def pr_points(spark, folder):
    return rounded(metrics.pr_points(metrics.threshold_table(_scored(spark, folder))), precision=9, recall=9)


@query(
    """SELECT round(avg((proba - label) * (proba - label)), 9) AS brier,
       (SELECT round(avg(abs(target - q50)), 9) FROM m_loss_rows) AS mae FROM v_scored"""
)
def brier_mae(spark, folder):
    mae = metrics.mean_absolute_error(_loss_rows(spark, folder), "target", "q50")
    both = metrics.brier(_scored(spark, folder)).withColumn("mae", mae.scalar())
    return rounded(both, brier=9, mae=9)


@query(
    """SELECT CAST(greatest(0, ceil(proba * 15) - 1) AS INT) AS bin, round(avg(proba), 9) AS mean_predicted,
       round(avg(label), 9) AS fraction_positive, count(*) AS n FROM v_scored GROUP BY 1"""
)
def calibration(spark, folder):
    return rounded(metrics.calibration(_scored(spark, folder)), mean_predicted=9, fraction_positive=9)


@query(
    """SELECT CAST(greatest(1, ceil((proba - lo) / (hi - lo) * 10)) AS INT) AS bucket, round(avg(label), 9) AS outage_rate, count(*) AS n
FROM v_scored, (SELECT min(proba) AS lo, max(proba) AS hi FROM v_scored) GROUP BY 1"""
)
def decile_rate(spark, folder):
    return rounded(metrics.equal_width_rate(_scored(spark, folder)), outage_rate=9)


@query(
    """SELECT label AS "class", CAST(least(49, floor((proba - lo) / ((hi - lo) / 50))) AS INT) AS bin, count(*) AS n,
       round(count(*) / max(total) / max((hi - lo) / 50), 6) AS density
FROM v_scored JOIN (SELECT label, min(proba) AS lo, max(proba) AS hi, count(*) AS total FROM v_scored GROUP BY label) USING (label)
GROUP BY 1, 2"""
)
def class_density(spark, folder):
    return rounded(metrics.class_density(_scored(spark, folder)), density=6)


def _loss_rows(spark, folder):
    p = F.greatest(F.lit(0.001), F.least(F.lit(0.999), F.col("proba")))
    level = F.log1p("county_p90")
    return _scored(spark, folder).select(
        "label", F.log(p / (1 - p)).alias("z"), F.log1p("customers").alias("target"),
        (level * 0.8).alias("q50"), (level * 1.1).alias("q90"),
    )


@query("SELECT round(focal_loss, 9) AS focal_loss FROM m_focal")
def focal_loss(spark, folder):
    return rounded(metrics.focal_loss(_loss_rows(spark, folder), "z"), focal_loss=9)


@query("SELECT round(pinball_loss, 9) AS pinball_loss FROM m_pinball")
def pinball_loss(spark, folder):
    loss = metrics.pinball_loss(_loss_rows(spark, folder), "target", {"q50": 0.5, "q90": 0.9})
    return rounded(loss, pinball_loss=9)


@query(
    """SELECT round(focal_loss, 9) AS focal_loss, round(pinball_loss, 9) AS pinball_loss,
       round(0.6e0 * focal_loss + 0.4e0 * pinball_loss, 9) AS combined_loss FROM m_focal, m_pinball"""
)
def combined_loss(spark, folder):
    rows = _loss_rows(spark, folder)
    pinball = metrics.pinball_loss(rows, "target", {"q50": 0.5, "q90": 0.9})
    both = metrics.combined_loss(metrics.focal_loss(rows, "z"), pinball)
    return rounded(both, focal_loss=9, pinball_loss=9, combined_loss=9)


@query(
    """SELECT CAST(k AS INT) AS k, round(found / (total + 1e-8), 9) AS recall
FROM (SELECT row_number() OVER w AS k, sum(CASE WHEN label = 1 THEN customers ELSE 0 END) OVER w AS found,
             sum(CASE WHEN label = 1 THEN customers ELSE 0 END) OVER () AS total
      FROM v_scored WINDOW w AS (ORDER BY proba DESC, customers, l_orderkey, l_linenumber ROWS UNBOUNDED PRECEDING))
WHERE k <= 500 AND k % 10 = 0"""
)
def top_k_recall(spark, folder):
    recall = metrics.top_k_recall(_scored(spark, folder), list(range(10, 501, 10)), ["customers", "l_orderkey", "l_linenumber"])
    return rounded(recall, recall=9)


def _two_models(spark, folder):
    scored = _scored(spark, folder).withColumn("softened", 0.5 * F.col("proba") + 0.25)
    return metrics.model_metrics(scored, {"plain": "proba", "softened": "softened"})


COMPARISON = """
SELECT 'plain' AS model, round((SELECT sum(neg_here * (tp + tp - pos_here) / 2e0 / (tp + fn) / (fp + tn)) FROM m_table), 4) AS roc_auc,
       round((SELECT sum(pos_here / (tp + fn) * (tp / (tp + fp))) FROM m_table), 4) AS pr_auc,
       round((SELECT f1 FROM m_f1 ORDER BY eased DESC, score LIMIT 1), 4) AS f1,
       round((SELECT avg((proba - label) * (proba - label)) FROM v_scored), 4) AS brier
UNION ALL
SELECT 'softened', round((SELECT sum(neg_here * (tp + tp - pos_here) / 2e0 / (tp + fn) / (fp + tn)) FROM m_table), 4),
       round((SELECT sum(pos_here / (tp + fn) * (tp / (tp + fp))) FROM m_table), 4),
       round((SELECT f1 FROM m_f1 ORDER BY eased DESC, score LIMIT 1), 4),
       round((SELECT avg((0.5e0 * proba + 0.25e0 - label) * (0.5e0 * proba + 0.25e0 - label)) FROM v_scored), 4)"""


@query(COMPARISON)
def model_comparison(spark, folder):
    """The softened score orders rows as the plain one does, so only its Brier score differs."""
    return _two_models(spark, folder)


@query(
    f"""SELECT arg_max(model, roc_auc + brier * 0) AS best_roc_auc, arg_max(model, pr_auc) AS best_pr_auc,
       arg_max(model, f1) AS best_f1, arg_min(model, brier) AS best_brier
FROM (SELECT * REPLACE (roc_auc - CASE WHEN model = 'softened' THEN 0.1e0 ELSE 0e0 END AS roc_auc,
                        pr_auc - CASE WHEN model = 'softened' THEN 0.1e0 ELSE 0e0 END AS pr_auc,
                        f1 - CASE WHEN model = 'softened' THEN 0.1e0 ELSE 0e0 END AS f1) FROM ({COMPARISON}))"""
)
def best_models(spark, folder):
    """Leaders per metric, after a handicap on one model so that no leader depends on a tie."""
    handicap = F.when(F.col("model") == "softened", 0.1).otherwise(0.0)
    table = _two_models(spark, folder)
    return metrics.best_models(table.withColumns({c: F.col(c) - handicap for c in ("roc_auc", "pr_auc", "f1")}))


# --- models ---------------------------------------------------------------------------------------


def _split_features(spark, folder):
    """The feature store, stored once as the training jobs expect it, with its splits."""
    return sampling.assign_split(keep(_flagship(spark, folder)), **SPLIT)


@query(
    """SELECT fips, CAST(any_storm AS INT) AS any_storm, round(quantile_cont(log_peak_customers, 0.5), 6) AS q50_log,
       round(quantile_cont(log_peak_customers, 0.9), 6) AS q90_log FROM c_features WHERE year IN (1, 2) GROUP BY fips, any_storm"""
)
def quantile_forecast(spark, folder):
    train = _split_features(spark, folder).where(F.col("split") == "train")
    return rounded(models.quantile_forecast(train), q50_log=6, q90_log=6)


CTES["f_forecast"] = """
SELECT fips, any_storm, quantile_cont(log_peak_customers, 0.9) AS q90_log FROM c_features WHERE year IN (1, 2) GROUP BY fips, any_storm"""
CTES["f_test"] = """
SELECT c.*, (hour_of_day + 1) / 25e0 AS outage_proba, coalesce(f.q90_log, 0e0) AS q90_log
FROM c_features c LEFT JOIN f_forecast f USING (fips, any_storm) WHERE year = 4"""
CTES["f_rows"] = """
SELECT *, outage_proba * (exp(greatest(0e0, least(20e0, q90_log))) - 1) * (1 + county_p90 / ((SELECT max(county_p90) FROM f_test) + 1e-8)) AS s FROM f_test"""


@query(
    """SELECT fips, round(max(s), 6) AS max_priority_score, round(avg(s), 6) AS mean_priority_score,
       row_number() OVER (ORDER BY max(s) DESC, fips) AS rank FROM f_rows GROUP BY fips"""
)
def priority_from_forecast(spark, folder):
    """County ranking from the quantile forecast instead of the observed peak; the probability follows the clock."""
    parts = _split_features(spark, folder)
    forecast = models.quantile_forecast(parts.where(F.col("split") == "train"))
    test = parts.where(F.col("split") == "test").withColumn("outage_proba", (F.hour("hour") + 1) / 25)
    ranked = ranked_counties(test, forecast)
    return rounded(
        ranked.select("fips", "max_priority_score", "mean_priority_score", "rank"),
        max_priority_score=6, mean_priority_score=6,
    )


@query(
    """SELECT fips, hour, round((lag_1h_peak - m) / d, 6) AS scaled_lag, round((wind - wm) / wd, 6) AS scaled_wind
FROM c_features, (SELECT avg(lag_1h_peak) AS m, stddev_samp(lag_1h_peak) AS d, avg(wind) AS wm, stddev_samp(wind) AS wd
                  FROM c_features WHERE year IN (1, 2)) WHERE year = 4"""
)
def standardize(spark, folder):
    from pyspark.ml.functions import vector_to_array

    parts = _split_features(spark, folder)
    names = ["lag_1h_peak", "wind"]
    scaler = models.standardizer(names).fit(parts.where(F.col("split") == "train"))
    scaled = vector_to_array("scaled")
    return scaler.transform(parts.where(F.col("split") == "test")).select(
        "fips", "hour", F.round(scaled[0], 6).alias("scaled_lag"), F.round(scaled[1], 6).alias("scaled_wind")
    )


def _fit_and_score(spark, folder, fit):
    parts = _split_features(spark, folder)
    model = fit(parts.where(F.col("split") == "train"))
    scored = models.score(model, parts.where(F.col("split") == "test"))
    return scored.select("fips", "hour", "outage_label", "outage_proba")


@query()
def logistic_scores(spark, folder):
    return _fit_and_score(spark, folder, models.fit_logistic)


@query()
def gbt_scores(spark, folder):
    return _fit_and_score(spark, folder, models.fit_gbt)


@query()
def feature_importance(spark, folder):
    train = _split_features(spark, folder).where(F.col("split") == "train")
    return models.feature_importance(spark, models.fit_gbt(train))


# Two learners whose results SQL can state: a logistic model of two features by Newton's steps, and two boosted stumps over
# features of few values. Both are turned into tables, written, read back and scored from there.
LINEAR_FEATURES, STUMP_FEATURES = ["lagged_labels", "wind"], ["any_storm", "hour_of_day"]


def _newton_sql(rounds: int, penalty: float = 10.0) -> dict[str, str]:
    """Steps l_0, l_1, ... of the weighted logistic fit with a ridge on both coefficients; each solves a 3 x 3 system."""
    out = {"l_0": "SELECT 0e0 AS b0, 0e0 AS b1, 0e0 AS b2"}
    for k in range(1, rounds + 1):
        out[f"l_{k}"] = f"""
SELECT b0 - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det AS b0,
       b1 - (h00 * (g1 * h22 - g2 * h12) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det AS b1,
       b2 - (h00 * (h11 * g2 - h12 * g1) - h01 * (h01 * g2 - h02 * g1) + g0 * (h01 * h12 - h11 * h02)) / det AS b2
FROM (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det FROM (
  SELECT any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2,
         sum(r) AS g0, sum(r * x1) + {penalty}e0 * any_value(b1) AS g1, sum(r * x2) + {penalty}e0 * any_value(b2) AS g2,
         sum(h) AS h00, sum(h * x1) AS h01, sum(h * x2) AS h02, sum(h * x1 * x1) + {penalty}e0 AS h11,
         sum(h * x1 * x2) AS h12, sum(h * x2 * x2) + {penalty}e0 AS h22
  FROM (SELECT *, w * (p - y) AS r, w * p * (1 - p) AS h FROM (
    SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM l_rows CROSS JOIN l_{k - 1}))))"""
    return out


NEWTON_ROUNDS = 12
CTES["l_all"] = "SELECT *, lag_24h_label + lag_168h_label AS lagged_labels FROM c_features"
CTES["l_scale"] = """
SELECT avg(lagged_labels) AS m1, stddev_samp(lagged_labels) AS d1, avg(wind) AS m2, stddev_samp(wind) AS d2
FROM l_all WHERE year IN (1, 2)"""
CTES["l_rows"] = """
SELECT outage_label AS y, (lagged_labels - m1) / d1 AS x1, (wind - m2) / d2 AS x2,
       count(*) OVER () / (2e0 * count(*) OVER (PARTITION BY outage_label)) AS w
FROM l_all CROSS JOIN l_scale WHERE year IN (1, 2)"""
CTES |= _newton_sql(NEWTON_ROUNDS)


def _learning(spark, folder):
    rows = _flagship(spark, folder).withColumns({
        "lagged_labels": F.col("lag_24h_label") + F.col("lag_168h_label"), "hour_of_day": F.hour("hour"),
    })
    parts = sampling.assign_split(keep(rows), **SPLIT)
    return parts.where(F.col("split") == "train"), parts.where(F.col("split") == "test")


def _read_back(spark, rows, label):
    path = scratch_path(spark, label)
    files.write_table(rows, path)
    return spark.read.parquet(path)


def _linear(spark, train):
    model = models.fit_logistic(train, LINEAR_FEATURES, n=1 << 40, tol=1e-12)
    return _read_back(spark, model_tables.linear_table(spark, model, LINEAR_FEATURES), "linear")


@query(f"""
SELECT feature, round(mean, 6) AS mean, round(deviation, 6) AS deviation, round(coefficient, 3) AS coefficient FROM (
  SELECT '{LINEAR_FEATURES[0]}' AS feature, m1 AS mean, d1 AS deviation, b1 AS coefficient FROM l_scale, l_{NEWTON_ROUNDS}
  UNION ALL SELECT '{LINEAR_FEATURES[1]}', m2, d2, b2 FROM l_scale, l_{NEWTON_ROUNDS}
  UNION ALL SELECT NULL, NULL, NULL, b0 FROM l_{NEWTON_ROUNDS})""")
def logistic_table(spark, folder):
    """The fitted model as rows, written and read back."""
    return rounded(_linear(spark, _learning(spark, folder)[0]), mean=6, deviation=6, coefficient=3)


@query(f"""
SELECT fips, hour, outage_label,
       round(1 / (1 + exp(-(b0 + b1 * (lagged_labels - m1) / d1 + b2 * (wind - m2) / d2))), 3) AS outage_proba
FROM l_all, l_scale, l_{NEWTON_ROUNDS} WHERE year = 4""")
def logistic_table_scores(spark, folder):
    train, test = _learning(spark, folder)
    scored = model_tables.score_linear(test, _linear(spark, train), LINEAR_FEATURES)
    return rounded(scored.select("fips", "hour", "outage_label", "outage_proba"), outage_proba=3)


STUMP_RATE = 0.5
CTES["t_sample"] = f"""
SELECT CAST(any_storm AS DOUBLE) AS x0, CAST(hour_of_day AS DOUBLE) AS x1, 2e0 * outage_label - 1 AS y FROM (
  SELECT *, row_number() OVER (PARTITION BY outage_label ORDER BY {MIXED_SQL}, fips, hour) AS rn,
         count(*) FILTER (outage_label = 1) OVER () AS positives FROM c_features WHERE year IN (1, 2))
WHERE rn <= least(150000, positives)"""


def _stump_sql(tree: int, target: str, rows: str) -> dict[str, str]:
    """The split of largest gain in variance over both features and the means on its two sides."""
    return {
        f"t_{tree}_long": f"SELECT 0 AS f, x0 AS x, {target} AS t FROM {rows} UNION ALL SELECT 1, x1, {target} FROM {rows}",
        f"t_{tree}_cuts": f"""
SELECT f, (x + next) / 2 AS threshold FROM (
  SELECT f, x, lead(x) OVER (PARTITION BY f ORDER BY x) AS next FROM (SELECT DISTINCT f, x FROM t_{tree}_long)) WHERE next IS NOT NULL""",
        f"t_{tree}": f"""
SELECT f, threshold, below / nb AS low, above / na AS high,
       (bb + aa) / (nb + na) - ((below + above) / (nb + na)) ** 2
       - nb / (nb + na) * (bb / nb - (below / nb) ** 2) - na / (nb + na) * (aa / na - (above / na) ** 2) AS gain, nb + na AS n
FROM (SELECT c.f, threshold, CAST(count(*) FILTER (x <= threshold) AS DOUBLE) AS nb, CAST(count(*) FILTER (x > threshold) AS DOUBLE) AS na,
             sum(t) FILTER (x <= threshold) AS below, sum(t) FILTER (x > threshold) AS above,
             sum(t * t) FILTER (x <= threshold) AS bb, sum(t * t) FILTER (x > threshold) AS aa
      FROM t_{tree}_cuts c JOIN t_{tree}_long l ON l.f = c.f GROUP BY c.f, threshold)
ORDER BY gain DESC, f, threshold LIMIT 1""",
    }


CTES |= _stump_sql(0, "y", "t_sample")
CTES["t_left"] = """
SELECT x0, x1, 4 * y / (1 + exp(2 * y * CASE WHEN CASE f WHEN 0 THEN x0 ELSE x1 END <= threshold THEN low ELSE high END)) AS y
FROM t_sample CROSS JOIN t_0"""
CTES |= _stump_sql(1, "y", "t_left")
NAMES = "CASE f WHEN 0 THEN '{}' ELSE '{}' END".format(*STUMP_FEATURES)


def _stumps(spark, train):
    model = models.fit_gbt(train, STUMP_FEATURES, trees=2, depth=1, rate=STUMP_RATE, subsample=1.0, order=_mixed_order())
    return _read_back(spark, model_tables.tree_table(spark, model, STUMP_FEATURES), "stumps")


@query(f"""
SELECT tree, node, feature, threshold, round(value, 4) AS value FROM (
  SELECT 0 AS tree, 0 AS node, {NAMES} AS feature, threshold, NULL AS value FROM t_0
  UNION ALL SELECT 0, 1, NULL, NULL, low FROM t_0 UNION ALL SELECT 0, 2, NULL, NULL, high FROM t_0
  UNION ALL SELECT 1, 0, {NAMES}, threshold, NULL FROM t_1
  UNION ALL SELECT 1, 1, NULL, NULL, low FROM t_1 UNION ALL SELECT 1, 2, NULL, NULL, high FROM t_1)""")
def boosted_table(spark, folder):
    """The nodes of the fitted trees, written and read back."""
    rows = _stumps(spark, _learning(spark, folder)[0])
    value = F.when(F.col("feature").isNull(), F.round("value", 4)).alias("value")
    return rows.select("tree", "node", "feature", "threshold", value)


@query(f"""
SELECT fips, hour, outage_label, round(1 / (1 + exp(-2 * (
         CASE WHEN CASE a.f WHEN 0 THEN any_storm ELSE hour_of_day END <= a.threshold THEN a.low ELSE a.high END
         + {STUMP_RATE}e0 * CASE WHEN CASE b.f WHEN 0 THEN any_storm ELSE hour_of_day END <= b.threshold THEN b.low ELSE b.high END))), 6) AS outage_proba
FROM c_features, t_0 a, t_1 b WHERE year = 4""")
def boosted_table_scores(spark, folder):
    train, test = _learning(spark, folder)
    scored = model_tables.score_trees(test, _stumps(spark, train), STUMP_FEATURES)
    return rounded(scored.select("fips", "hour", "outage_label", "outage_proba"), outage_proba=6)


@query(f"""
SELECT feature, round(sum(g) / (SELECT sum(gain * n) FROM (SELECT gain, n FROM t_0 UNION ALL SELECT gain, n FROM t_1)), 6) AS importance,
       CASE feature WHEN 'any_storm' THEN 'storm' ELSE 'temporal' END AS feature_group
FROM (SELECT {NAMES} AS feature, gain * n AS g FROM t_0 UNION ALL SELECT {NAMES}, gain * n FROM t_1) GROUP BY feature""")
def boosted_importance(spark, folder):
    found = model_tables.importance(_stumps(spark, _learning(spark, folder)[0]))
    return rounded(found.select("feature", "importance", "feature_group"), importance=6)


@query("""
SELECT fips, hour, CASE WHEN hour_of_day % 3 = 0 THEN 0 ELSE lag_1h_peak END AS lag_1h_peak, CAST(any_storm AS INT) AS any_storm
FROM c_features""")
def filled_features(spark, folder):
    """Features that are missing in a third of the hours count as zero."""
    rows = _flagship(spark, folder).withColumn("lag_1h_peak", F.when(F.hour("hour") % 3 != 0, F.col("lag_1h_peak")))
    return features.fill_features(rows).select("fips", "hour", "lag_1h_peak", F.col("any_storm").cast("int").alias("any_storm"))


@query(f"""
SELECT fips, hour, outage_label,
       round(1 / (1 + exp(-(b0 + b1 * (lagged_labels - m1) / d1 + b2 * (wind - m2) / d2))), 3) AS outage_proba
FROM l_all, l_scale, l_{NEWTON_ROUNDS} WHERE year = 4""")
def model_round_trip(spark, folder):
    """The fitted pipeline saved, loaded and applied; the scores stay on the rows they are of."""
    train, test = _learning(spark, folder)
    path = scratch_path(spark, "model")
    models.save_model(models.fit_logistic(train, LINEAR_FEATURES, n=1 << 40, tol=1e-12), path)
    scored = models.score(models.load_model(path), test, LINEAR_FEATURES)
    return rounded(scored.select("fips", "hour", "outage_label", "outage_proba"), outage_proba=3)


CTES["k_scores"] = f"""
SELECT 'Logistic Regression' AS model, outage_label AS y,
       1 / (1 + exp(-(b0 + b1 * (lagged_labels - m1) / d1 + b2 * (wind - m2) / d2))) AS p
FROM l_all, l_scale, l_{NEWTON_ROUNDS} WHERE year = 4
UNION ALL
SELECT 'Gradient Boosting', outage_label, 1 / (1 + exp(-2 * (
         CASE WHEN CASE a.f WHEN 0 THEN any_storm ELSE hour_of_day END <= a.threshold THEN a.low ELSE a.high END
         + {STUMP_RATE}e0 * CASE WHEN CASE b.f WHEN 0 THEN any_storm ELSE hour_of_day END <= b.threshold THEN b.low ELSE b.high END)))
FROM c_features, t_0 a, t_1 b WHERE year = 4"""


@query("""
SELECT model, round((sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2e0)
                    / (count(*) FILTER (y = 1) * CAST(count(*) FILTER (y = 0) AS DOUBLE)), 3) AS roc_auc,
       round(avg((p - y) * (p - y)), 3) AS brier
FROM (SELECT *, rank() OVER (PARTITION BY model ORDER BY round(p, 9))
                + (count(*) OVER (PARTITION BY model, round(p, 9)) - 1) / 2e0 AS r FROM k_scores) GROUP BY model""")
def trained_comparison(spark, folder):
    """Two trained models scored on the test year and compared."""
    train, test = _learning(spark, folder)
    scored = model_tables.score_linear(test, _linear(spark, train), LINEAR_FEATURES, "linear")
    scored = model_tables.score_trees(scored, _stumps(spark, train), STUMP_FEATURES, "boosted")
    columns = {"Logistic Regression": "linear", "Gradient Boosting": "boosted"}
    return metrics.model_metrics(scored, columns, "outage_label", digits=3).select("model", "roc_auc", "brier")
