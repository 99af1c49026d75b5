"""Queries over stored outcomes, drift against the Production model, listings and look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.functions.scalars import DAY_US
from tickflow.operators import attribution, baselines, dataset, drift, model, panels, scans
from tickflow.plans import model_queries as M
from tickflow.plans import monitor_queries as Q
from tickflow.plans.base import FEATURES_SQL, HORIZON_US, MIDDLE_US, NOW_US, START_US, THETA, TICKS_SQL, TOLERANCE_US, features, rounded
from tickflow.sources.ingest import ticks
from tickflow.sources.shared import materialize, shared_dir

LIVE_US = 5 * DAY_US
DRAWS = 1000


def _attributed(spark, sf_dir):
    """Predictions stored twice; attribution in the middle of the month and at its end, theta from the newer of two training runs. Gives
    (slices of the last run, path of the outcomes). A prediction is of one event, several of which may be of one time."""
    root = shared_dir(spark)
    p, key = M._predictions(spark, sf_dir).drop("p"), (*attribution.KEY, "n")
    for rows in (p.where(F.col("t") < MIDDLE_US), p):
        attribution.store_predictions(rows, f"{root}/predictions", key=key)
    runs = spark.createDataFrame([(9.0, 1), (THETA, 2)], "theta double, finished long")
    for now in (MIDDLE_US, NOW_US):
        stored = spark.read.parquet(f"{root}/predictions")
        out = attribution.attribution_run(stored, f"{root}/outcomes", ticks(spark, sf_dir), now_us=now, horizon_us=HORIZON_US, tolerance_us=TOLERANCE_US, start_us=START_US, runs=runs, key=key)
    return out, f"{root}/outcomes"


def outcomes_stored(spark, sf_dir):
    rows = spark.read.parquet(_attributed(spark, sf_dir)[1]).where("status = 'resolved'")
    return rounded(rows.select("symbol", "t", "model_version", "predicted", "actual", "realised_return", "is_correct"))


def attribution_run(spark, sf_dir):
    return rounded(_attributed(spark, sf_dir)[0])


def drift_against_production(spark, sf_dir):
    """A version of which the statistics of the first half were stored, made Production; the last five days against it."""
    root = shared_dir(spark)
    f = materialize(features(spark, sf_dir))
    model.save_stats(dataset.feature_stats(f.where((F.col("t") < MIDDLE_US) & ~F.col("insufficient_history"))), root, "1")
    model.transition(spark, root, "1", "Staging", 1)
    model.transition(spark, root, "1", "Production", 2)
    rows = drift.drift_run(f, model.production_stats(spark, root), NOW_US, LIVE_US, draws=DRAWS)
    return rounded(rows.where("metric = 'psi'").select("feature", "value", "severity", "sample_size", "model_version"))


def stats_narrowed(spark, sf_dir):
    """Maps of statistics as JSON text, with entries that are not numbers, per symbol."""
    rows = ticks(spark, sf_dir).groupBy(F.col("symbol").alias("feature")).agg(F.avg("price").alias("mean"), F.min("price").alias("min"), F.max("price").alias("max"))
    text = F.to_json(F.struct("mean", "min", F.lit("n/a").alias("std"), F.when(F.col("feature") != "view", F.col("max")).alias("max"), F.lit("NaN").alias("p50"), F.array(F.lit(1)).alias("histogram")))
    odd = rows.select(F.concat("feature", F.lit("?")).alias("feature"), F.lit("[]").alias("stats"))
    return rounded(drift.numeric_stats(rows.select("feature", text.alias("stats")).unionByName(odd)))


def _versions(spark, sf_dir):
    """A version per symbol, created at its first tick, with a stage for each of its days."""
    t = ticks(spark, sf_dir)
    day = F.floor(F.col("t") / DAY_US)
    events = t.groupBy(F.col("symbol").alias("model_version"), day.alias("day")).agg(F.max("t").alias("at"))
    stage = F.element_at(F.array(F.lit("Staging"), F.lit("Production"), F.lit("Archived")), (F.col("day") % 3 + 1).cast("int"))
    return t.groupBy(F.col("symbol").alias("model_version")).agg(F.min("t").alias("created")), events.select("model_version", stage.alias("stage"), "at")


def version_history(spark, sf_dir):
    return scans.version_history(*_versions(spark, sf_dir))


def version_lookup(spark, sf_dir):
    return scans.lookup(_versions(spark, sf_dir)[0], model_version="error")


def promotion_events(spark, sf_dir):
    history = scans.version_history(*_versions(spark, sf_dir))
    return panels.promotion_events(history)


def prediction_page(spark, sf_dir):
    rows = M._predictions(spark, sf_dir).select("symbol", "t", "model_version", "predicted")
    return scans.recent_page(rows, ["t", "symbol"], now_us=NOW_US, days=30, limit=500, offset=50, equal={"model_version": "1"})


def drift_listing(spark, sf_dir):
    """All PSI rows of windows that ended since the second one, by feature within the newest window first."""
    rows = Q._drift_runs(spark, sf_dir).withColumn("computed_at", F.col("window_end"))
    return rounded(scans.listing(rows, Q.WINDOWS[1], "computed_at", newest_first=["window_end"], then=["feature"], equal={"metric": "psi", "feature": None}).select("feature", "window_end", "value", "severity"))


def drift_summary(spark, sf_dir):
    return panels.drift_summary(Q._drift_runs(spark, sf_dir))


def model_performance(spark, sf_dir):
    """Slices with promotions, what is pending, and the majority baseline's accuracy."""
    p = M._predictions(spark, sf_dir)
    versions = spark.createDataFrame([("1", 5), ("3", 6)], "model_version string, promoted_at long")
    split = M._split(spark, sf_dir)
    base = baselines.majority(split.where("split = 'train'"), split.where("split = 'test'")).agg(F.avg((F.col("actual") == F.col("predicted")).cast("double")).alias("baseline_accuracy"))
    out = panels.model_performance(attribution.slices(M._resolved(spark, sf_dir), START_US, NOW_US), versions, attribution.pending(p, M._outcomes(p), NOW_US - DAY_US, HORIZON_US), base)
    return rounded(out.select("model_version", "n", "accuracy", "promoted_at", "pending", "baseline_accuracy"))


QUERIES = {f.__name__: f for f in (outcomes_stored, attribution_run, drift_against_production, stats_narrowed, version_history, version_lookup, promotion_events, prediction_page, drift_listing, drift_summary, model_performance)}

_DONE = f"""{M.PRED_SQL}, every AS (
  SELECT pred.symbol, pred.t, model_version, predicted, (future - price) / price AS ret FROM pred JOIN fwd USING (symbol, t) WHERE future IS NOT NULL AND pred.t <= {NOW_US - HORIZON_US}
), told AS (SELECT *, {M.LABEL_SQL} AS actual FROM every)"""
_U = "(('0x' || substr(md5(feature || '|' || k || '|{0}'), 1, 13))::BIGINT + 1) / ((1::BIGINT << 52) + 1)::DOUBLE"
_NOW = f"t >= {NOW_US - LIVE_US} AND t < {NOW_US}"
_LIVE_ROWS = " UNION ALL ".join(f"SELECT '{n}' AS feature, {n} AS value FROM f WHERE {_NOW} AND NOT insufficient_history" for n in M.FEATURE_NAMES)
_STATS_CTE = "st AS (SELECT feature, avg(value) AS mean, stddev_pop(value) AS std, min(value) AS lo, max(value) AS hi FROM l WHERE value IS NOT NULL GROUP BY feature)"
_DRAWN = f"drawn AS (SELECT feature, CASE WHEN std > 0 THEN least(greatest(mean + std * sqrt(-2 * ln({_U.format(42)})) * cos(2 * pi() * {_U.format(43)}), lo), hi) ELSE mean END AS value, true AS is_draw FROM st, (SELECT unnest(range(1, {DRAWS + 1})) AS k))"
_VERSIONS = f"""WITH {TICKS_SQL}, v AS (SELECT symbol AS model_version, min(t) AS created FROM ticks GROUP BY symbol), ev AS (
  SELECT symbol AS model_version, (['Staging', 'Production', 'Archived'])[t // {DAY_US} % 3 + 1] AS stage, max(t) AS ts FROM ticks GROUP BY symbol, t // {DAY_US}
), hist AS (
  SELECT v.model_version, created, arg_max(stage, ts) AS stage, min(ts) FILTER (stage = 'Production') AS promoted_at FROM v LEFT JOIN ev USING (model_version) GROUP BY ALL
)"""
_MAJORITY = "(SELECT avg((label = (SELECT label FROM split WHERE split = 'train' GROUP BY label ORDER BY count(*) DESC, label LIMIT 1))::INT::DOUBLE) FROM split WHERE split = 'test')"
SQL = {
    "outcomes_stored": f"WITH {_DONE} SELECT symbol, t, model_version, predicted, actual, round(ret, 6) + 0.0 AS realised_return, actual = predicted AS is_correct FROM told",
    "attribution_run": f"WITH {_DONE} SELECT model_version, count(*) AS n, round(avg((actual = predicted)::INT::DOUBLE), 6) + 0.0 AS accuracy, round({M._MACRO}, 6) + 0.0 AS macro_f1, {M._CELLS}, {M._SHARES} FROM told WHERE t < {NOW_US} GROUP BY model_version",
    "drift_against_production": f"WITH {FEATURES_SQL}, l AS ({M._STATS}), {_STATS_CTE}, {_DRAWN}, lv AS ({_LIVE_ROWS}), src AS (SELECT * FROM drawn UNION ALL SELECT feature, value, false FROM lv WHERE feature IN (SELECT feature FROM st)), {Q._psi_sql('src', 'is_draw', 'NOT is_draw')} SELECT feature, round(psi, 6) + 0.0 AS value, {Q._BAND} AS severity, n_live AS sample_size, '1' AS model_version FROM psi",
    "stats_narrowed": f"WITH {TICKS_SQL} SELECT symbol AS feature, round(avg(price), 6) + 0.0 AS mean, NULL::DOUBLE AS std, round(min(price), 6) + 0.0 AS min, CASE WHEN symbol <> 'view' THEN round(max(price), 6) + 0.0 END AS max, NULL::DOUBLE AS p50 FROM ticks GROUP BY symbol",
    "version_history": f"{_VERSIONS} SELECT * FROM hist",
    "version_lookup": f"{_VERSIONS} SELECT * FROM v WHERE model_version = 'error'",
    "promotion_events": f"{_VERSIONS} SELECT model_version, promoted_at FROM hist WHERE promoted_at IS NOT NULL",
    "prediction_page": f"WITH {M.PRED_SQL}, p AS (SELECT symbol, t, model_version, predicted, row_number() OVER (ORDER BY t DESC, symbol DESC) - 50 AS place, count(*) OVER () AS n FROM pred WHERE model_version = '1' AND t >= {NOW_US - 30 * DAY_US} AND t <= {NOW_US}) SELECT symbol, t, model_version, predicted, place, n > 550 AS has_more FROM p WHERE place BETWEEN 1 AND 500",
    "drift_listing": f"{Q._RUNS} SELECT feature, window_end, round(psi, 6) + 0.0 AS value, severity FROM run WHERE window_end >= {Q.WINDOWS[1]}",
    "drift_summary": f"{Q._RUNS}, last AS (SELECT * FROM run WHERE window_end = (SELECT max(window_end) FROM run)) SELECT CASE WHEN bool_or(severity = 'significant') THEN 'significant' WHEN bool_or(severity = 'moderate') THEN 'moderate' ELSE 'stable' END AS status, count(DISTINCT feature) FILTER (severity <> 'stable') AS features, max(window_end) AS window_end FROM last",
    "model_performance": f"WITH {M.SPLIT_SQL}, {M.PRED_SQL[len(M.FORWARD_SQL) + 2:]} SELECT model_version, count(*) AS n, round(avg((actual = predicted)::INT::DOUBLE), 6) + 0.0 AS accuracy, CASE WHEN model_version = '1' THEN 5::BIGINT END AS promoted_at, (SELECT count(*) FROM pred WHERE n % 7 <> 0 AND t > {NOW_US - DAY_US - HORIZON_US}) AS pending, round({_MAJORITY}, 6) + 0.0 AS baseline_accuracy FROM done GROUP BY model_version",
}
