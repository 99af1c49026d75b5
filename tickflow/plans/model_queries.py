"""Queries over labels, splits, metrics, baselines and outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.functions.registry import FEATURE_NAMES
from tickflow.functions.scalars import DAY_US, LABELS, label_of, one_hot
from tickflow.operators import attribution, baselines, dataset, metrics
from tickflow.plans.base import FEATURES_SQL, HORIZON_US, MIDDLE_US, NOW_US, START_US, THETA, TICKS_SQL, TOLERANCE_US, features, rounded
from tickflow.sources.ingest import ticks

CONFIG = dataset.SplitConfig(min_rows=1, min_class_share=0.0)


def _labelled(spark, sf_dir):
    """Ticks with forward prices, returns and labels; those without a forward price are left out."""
    rows = dataset.with_forward_return(ticks(spark, sf_dir).select("symbol", "t", "price"), HORIZON_US, TOLERANCE_US).where("future is not null")
    return rows.withColumn("label", label_of(F.col("ret"), THETA))


def _split(spark, sf_dir):
    return dataset.split(_labelled(spark, sf_dir), HORIZON_US, CONFIG)


def forward_price(spark, sf_dir):
    rows = dataset.with_forward_return(ticks(spark, sf_dir).select("symbol", "t", "price"), HORIZON_US, TOLERANCE_US)
    return rounded(rows.select("symbol", "t", "future", "future_t", "ret"))


def theta(spark, sf_dir):
    return rounded(spark.createDataFrame([(dataset.derive_theta(_labelled(spark, sf_dir), 0.4),)], "theta double"))


def labels(spark, sf_dir):
    return _labelled(spark, sf_dir).select("symbol", "t", "label")


def dataset_split(spark, sf_dir):
    return _split(spark, sf_dir).select("symbol", "t", "label", "split")


def split_class_balance(spark, sf_dir):
    return dataset.class_counts(_split(spark, sf_dir))


def class_weights(spark, sf_dir):
    return rounded(dataset.class_weights(_split(spark, sf_dir).where("split = 'train'")))


def reference_feature_stats(spark, sf_dir):
    return rounded(dataset.feature_stats(features(spark, sf_dir).where((F.col("t") < MIDDLE_US) & ~F.col("insufficient_history"))))


def _predictions(spark, sf_dir):
    """Predictions as FIXTURES has them: model, label and probabilities by the event's number, at the tick's time."""
    n = F.col("message_id").cast("long")
    label = F.element_at(F.array(*[F.lit(x) for x in LABELS]), (n % 3 + 1).cast("int"))
    rows = ticks(spark, sf_dir).select("symbol", "t", n.alias("n"), F.when(n % 2 == 0, "1").otherwise("2").alias("model_version"), label.alias("predicted"))
    return rows.withColumn("predicted_t", F.col("t")).withColumn("p", F.transform(one_hot(F.col("predicted")), lambda x: 0.2 + 0.4 * x))


def _outcomes(predictions):
    return predictions.where("n % 7 = 0").select("symbol", "t", "model_version")


def _resolved(spark, sf_dir):
    p = _predictions(spark, sf_dir)
    return attribution.resolve(p.drop("p"), _outcomes(p), ticks(spark, sf_dir), now_us=NOW_US, horizon_us=HORIZON_US, tolerance_us=TOLERANCE_US, theta=THETA)


def _models(spark, sf_dir):
    """The predictions of both models against the labels that came true."""
    truth = _labelled(spark, sf_dir).select("symbol", "t", F.col("label").alias("actual"))
    return _predictions(spark, sf_dir).join(truth, ["symbol", "t"]).withColumnRenamed("model_version", "model")


def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_models(spark, sf_dir))


def class_metrics(spark, sf_dir):
    return rounded(metrics.class_metrics(_models(spark, sf_dir)))


def macro_f1(spark, sf_dir):
    return rounded(_models(spark, sf_dir).groupBy("model").agg(metrics.accuracy().alias("accuracy"), metrics.macro_f1().alias("macro_f1")))


def logloss_brier(spark, sf_dir):
    return rounded(_models(spark, sf_dir).groupBy("model").agg(metrics.log_loss().alias("logloss"), metrics.brier().alias("brier")))


def bucket_accuracy(spark, sf_dir):
    return rounded(metrics.bucket_accuracy(_models(spark, sf_dir), 5))


def baseline_majority(spark, sf_dir):
    rows = _split(spark, sf_dir)
    return baselines.majority(rows.where("split = 'train'"), rows.where("split = 'test'")).select("symbol", "t", "actual", "predicted")


def baseline_persistence(spark, sf_dir):
    rows = _split(spark, sf_dir)
    out = baselines.persistence(rows.where("split <> 'test'"), rows.where("split = 'test'"), HORIZON_US, "STABLE")
    return out.select("symbol", "t", "actual", "predicted")


def baseline_random(spark, sf_dir):
    rows = _split(spark, sf_dir)
    return baselines.random_stratified(rows.where("split = 'train'"), rows.where("split = 'test'")).select("symbol", "t", "actual", "predicted")


def promotion_gate(spark, sf_dir):
    """Model 1 as the candidate, model 2 as the incumbent, and a constant baseline."""
    rows = _models(spark, sf_dir).select("actual", "predicted", "p", F.when(F.col("model") == "1", "candidate").otherwise("incumbent").alias("model"))
    constant = rows.where("model = 'candidate'").select("actual", F.lit("STABLE").alias("predicted"), one_hot(F.lit("STABLE")).alias("p"), F.lit("majority").alias("model"))
    rows = rows.unionByName(constant)
    return baselines.promotion(metrics.summary(rows), metrics.class_metrics(rows))


def unresolved_predictions(spark, sf_dir):
    p = _predictions(spark, sf_dir)
    return attribution.unresolved(p, _outcomes(p), NOW_US, HORIZON_US).select("symbol", "t", "model_version", "predicted")


def pending_count(spark, sf_dir):
    p = _predictions(spark, sf_dir)
    return attribution.pending(p, _outcomes(p), NOW_US - DAY_US, HORIZON_US)


def resolved_outcomes(spark, sf_dir):
    return rounded(_resolved(spark, sf_dir).select("symbol", "t", "model_version", "predicted", "base_price", "future_price", "future_t", "realised_return", "actual", "is_correct", "status"))


def performance_slices(spark, sf_dir):
    return rounded(attribution.slices(_resolved(spark, sf_dir), START_US, NOW_US))


def prediction_mix_shift(spark, sf_dir):
    prior = {"DOWN": 0.3, "STABLE": 0.4, "UP": 0.3}
    return rounded(metrics.distribution_shift(attribution.slices(_resolved(spark, sf_dir), START_US, NOW_US), prior).select("model_version", *[f"share_{x}" for x in LABELS], "shift"))


QUERIES = {
    f.__name__: f
    for f in (forward_price, theta, labels, dataset_split, split_class_balance, class_weights, reference_feature_stats, confusion_matrix, class_metrics, macro_f1, logloss_brier, bucket_accuracy, baseline_majority, baseline_persistence, baseline_random, promotion_gate, unresolved_predictions, pending_count, resolved_outcomes, performance_slices, prediction_mix_shift)
}

_R = lambda *names: ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in names)
LABEL_SQL = f"CASE WHEN ret > {THETA} THEN 'UP' WHEN ret < -{THETA} THEN 'DOWN' ELSE 'STABLE' END"
FORWARD_SQL = f"""{TICKS_SQL}, fwd AS (
  SELECT a.symbol, a.t, a.price, a.event_id, CASE WHEN b.t <= a.t + {HORIZON_US + TOLERANCE_US} THEN b.price END AS future, CASE WHEN b.t <= a.t + {HORIZON_US + TOLERANCE_US} THEN b.t END AS future_t
  FROM (SELECT *, t + {HORIZON_US} AS target FROM ticks) a ASOF LEFT JOIN ticks b ON a.symbol = b.symbol AND a.target <= b.t
), lab AS (
  SELECT *, (future - price) / price AS ret FROM fwd WHERE future IS NOT NULL
), labelled AS (
  SELECT *, {LABEL_SQL} AS label FROM lab
)"""
SPLIT_SQL = f"""{FORWARD_SQL}, o AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY t) AS rn, count(*) OVER (PARTITION BY symbol) AS n FROM labelled
), k AS (
  SELECT *, greatest(1, floor(n * 0.70::DOUBLE)) AS ti, least(greatest(greatest(1, floor(n * 0.70::DOUBLE)) + 1, floor(n * (0.70::DOUBLE + 0.15::DOUBLE))), n - 1) AS vi FROM o WHERE n >= 3
), e AS (
  SELECT symbol, max(t) FILTER (rn = ti) AS tt, max(t) FILTER (rn = vi) AS vv FROM k GROUP BY symbol
), split AS (
  SELECT * FROM (SELECT labelled.*, CASE WHEN t <= tt - {HORIZON_US} THEN 'train' WHEN t > tt AND t <= vv - {HORIZON_US} THEN 'validation' WHEN t > vv THEN 'test' END AS split FROM labelled JOIN e USING (symbol)) WHERE split IS NOT NULL
)"""
PRED_SQL = f"""{FORWARD_SQL}, pred AS (
  SELECT symbol, t, event_id AS n, CASE WHEN event_id % 2 = 0 THEN '1' ELSE '2' END AS model_version, (['DOWN', 'STABLE', 'UP'])[event_id % 3 + 1] AS predicted FROM ticks
), models AS (
  SELECT model_version AS model, predicted, label AS actual, symbol, t FROM pred JOIN labelled USING (symbol, t)
), resolved AS (
  SELECT pred.symbol, pred.t, model_version, predicted, fwd.price AS base_price, future AS future_price, future_t, (future - price) / price AS ret FROM pred JOIN fwd USING (symbol, t) WHERE n % 7 <> 0 AND pred.t <= {NOW_US - HORIZON_US}
), done AS (
  SELECT *, {LABEL_SQL} AS actual FROM resolved WHERE future_price IS NOT NULL AND t < {NOW_US}
)"""
_GRID = "(SELECT unnest(['DOWN', 'STABLE', 'UP']) AS label)"
_TP, _P, _A = "count(*) FILTER (actual = '{0}' AND predicted = '{0}')", "count(*) FILTER (predicted = '{0}')", "count(*) FILTER (actual = '{0}')"
_F1 = "coalesce(2 * " + _TP + "::DOUBLE / nullif(" + _P + " + " + _A + ", 0), 0)"
_MACRO = "(" + " + ".join(_F1.format(x) for x in LABELS) + ") / 3"
_CELLS = ", ".join(f"count(*) FILTER (actual = '{a}' AND predicted = '{p}') AS n_{a}_{p}" for a in LABELS for p in LABELS)
_SHARES = ", ".join(f"round(avg((predicted = '{x}')::INT::DOUBLE), 6) + 0.0 AS share_{x}" for x in LABELS)
_STATS = " UNION ALL ".join(f"SELECT '{n}' AS feature, {n} AS value FROM f WHERE t < {MIDDLE_US} AND NOT insufficient_history" for n in FEATURE_NAMES)
_F1S = {m: f"(SELECT {_MACRO} FROM models WHERE model = '{m}')" for m in "12"}
SQL = {
    "forward_price": f"WITH {FORWARD_SQL} SELECT symbol, t, {_R('future')}, future_t, round((future - price) / price, 6) + 0.0 AS ret FROM fwd",
    "theta": f"WITH {FORWARD_SQL} SELECT round(quantile_cont(abs(ret), 0.4), 6) + 0.0 AS theta FROM lab",
    "labels": f"WITH {FORWARD_SQL} SELECT symbol, t, label FROM labelled",
    "dataset_split": f"WITH {SPLIT_SQL} SELECT symbol, t, label, split FROM split",
    "split_class_balance": f"WITH {SPLIT_SQL} SELECT s.split, g.label, count(x.label) AS n FROM (SELECT DISTINCT split FROM split) s CROSS JOIN {_GRID} g LEFT JOIN split x ON x.split = s.split AND x.label = g.label GROUP BY ALL",
    "class_weights": f"WITH {SPLIT_SQL}, c AS (SELECT g.label, count(x.label) AS n FROM {_GRID} g LEFT JOIN split x ON x.label = g.label AND x.split = 'train' GROUP BY g.label) SELECT label, n, round(CASE WHEN n > 0 THEN sum(n) OVER () / (3.0 * n) ELSE 1 END, 6) + 0.0 AS weight FROM c",
    "reference_feature_stats": f"WITH {FEATURES_SQL}, l AS ({_STATS}) SELECT feature, round(avg(value), 6) + 0.0 AS mean, round(stddev_pop(value), 6) + 0.0 AS std, round(min(value), 6) + 0.0 AS min, round(max(value), 6) + 0.0 AS max, round(quantile_cont(value, 0.5), 6) + 0.0 AS p50 FROM l WHERE value IS NOT NULL GROUP BY feature",
    "confusion_matrix": f"WITH {PRED_SQL} SELECT m.model, a.label AS actual, p.label AS predicted, count(x.model) AS n FROM (SELECT DISTINCT model FROM models) m CROSS JOIN {_GRID} a CROSS JOIN {_GRID} p LEFT JOIN models x ON x.model = m.model AND x.actual = a.label AND x.predicted = p.label GROUP BY ALL",
    "class_metrics": f"WITH {PRED_SQL}, c AS (SELECT m.model, g.label, count(*) FILTER (x.actual = g.label AND x.predicted = g.label) AS tp, count(*) FILTER (x.predicted = g.label) AS p, count(*) FILTER (x.actual = g.label) AS a FROM (SELECT DISTINCT model FROM models) m CROSS JOIN {_GRID} g JOIN models x ON x.model = m.model GROUP BY ALL) SELECT model, label, round(coalesce(tp / nullif(p, 0)::DOUBLE, 0), 6) + 0.0 AS precision, round(coalesce(tp / nullif(a, 0)::DOUBLE, 0), 6) + 0.0 AS recall, round(coalesce(2 * tp / nullif(p + a, 0)::DOUBLE, 0), 6) + 0.0 AS f1, a AS support FROM c",
    "macro_f1": f"WITH {PRED_SQL} SELECT model, round(avg((actual = predicted)::INT::DOUBLE), 6) + 0.0 AS accuracy, round({_MACRO}, 6) + 0.0 AS macro_f1 FROM models GROUP BY model",
    "logloss_brier": f"WITH {PRED_SQL} SELECT model, round(-avg(ln(CASE WHEN actual = predicted THEN 0.6 ELSE 0.2 END)), 6) + 0.0 AS logloss, round(avg(CASE WHEN actual = predicted THEN 0.4 * 0.4 + 2 * 0.04 ELSE 0.36 + 0.64 + 0.04 END), 6) + 0.0 AS brier FROM models GROUP BY model",
    "bucket_accuracy": f"WITH {PRED_SQL} SELECT model, bucket - 1 AS bucket, count(*) AS n, round(avg((actual = predicted)::INT::DOUBLE), 6) + 0.0 AS accuracy FROM (SELECT *, ntile(5) OVER (PARTITION BY model ORDER BY t, symbol) AS bucket FROM models) GROUP BY ALL",
    "baseline_majority": f"WITH {SPLIT_SQL} SELECT symbol, t, label AS actual, (SELECT label FROM split WHERE split = 'train' GROUP BY label ORDER BY count(*) DESC, label LIMIT 1) AS predicted FROM split WHERE split = 'test'",
    "baseline_persistence": f"WITH {SPLIT_SQL}, h AS (SELECT t + {HORIZON_US} AS t, label, symbol FROM split WHERE split <> 'test' QUALIFY row_number() OVER (PARTITION BY t ORDER BY symbol DESC) = 1), q AS (SELECT * FROM split WHERE split = 'test') SELECT q.symbol, q.t, q.label AS actual, coalesce(h.label, 'STABLE') AS predicted FROM q ASOF LEFT JOIN h ON q.t >= h.t",
    "promotion_gate": f"WITH {PRED_SQL}, s AS (SELECT {_F1S['1']} AS own, {_F1S['2']} AS other, (SELECT coalesce(2 * n::DOUBLE / (n + t), 0) / 3 FROM (SELECT count(*) FILTER (actual = 'STABLE') AS n, count(*) AS t FROM models WHERE model = '1')) AS majority, (SELECT avg(CASE WHEN actual = predicted THEN 0.24 ELSE 1.04 END) FROM models WHERE model = '1') AS brier), w AS (SELECT list('recall too low for ' || label ORDER BY label) AS weak FROM (SELECT g.label, count(*) FILTER (x.actual = g.label AND x.predicted = g.label) AS tp, count(*) FILTER (x.actual = g.label) AS a FROM {_GRID} g CROSS JOIN models x WHERE x.model = '1' GROUP BY g.label) WHERE coalesce(tp / nullif(a, 0)::DOUBLE, 0) < 0.05), r AS (SELECT list_concat(CASE WHEN own <= majority THEN ['macro F1 not above majority'] ELSE []::VARCHAR[] END, CASE WHEN own < other THEN ['macro F1 below the incumbent'] ELSE []::VARCHAR[] END, coalesce(weak, []::VARCHAR[]), CASE WHEN brier >= 2.0 / 3 THEN ['Brier score no better than equal probabilities'] ELSE []::VARCHAR[] END) AS reasons FROM s, w) SELECT len(reasons) = 0 AS promoted, array_to_string(reasons, '; ') AS reason FROM r",
    "unresolved_predictions": f"WITH {PRED_SQL} SELECT symbol, t, model_version, predicted FROM pred WHERE n % 7 <> 0 AND t <= {NOW_US - HORIZON_US}",
    "pending_count": f"WITH {PRED_SQL} SELECT count(*) AS pending FROM pred WHERE n % 7 <> 0 AND t > {NOW_US - DAY_US - HORIZON_US}",
    "resolved_outcomes": f"WITH {PRED_SQL} SELECT symbol, t, model_version, predicted, {_R('base_price', 'future_price')}, future_t, round(ret, 6) + 0.0 AS realised_return, CASE WHEN ret IS NULL THEN NULL ELSE {LABEL_SQL} END AS actual, CASE WHEN ret IS NULL THEN NULL ELSE {LABEL_SQL} = predicted END AS is_correct, CASE WHEN future_price IS NULL THEN 'no_future' ELSE 'resolved' END AS status FROM resolved",
    "performance_slices": f"WITH {PRED_SQL} SELECT model_version, count(*) AS n, round(avg((actual = predicted)::INT::DOUBLE), 6) + 0.0 AS accuracy, round({_MACRO}, 6) + 0.0 AS macro_f1, {_CELLS}, {_SHARES} FROM done GROUP BY model_version",
    "prediction_mix_shift": f"WITH {PRED_SQL} SELECT model_version, {_SHARES}, round(0.5 * (abs(avg((predicted = 'DOWN')::INT) - 0.3) + abs(avg((predicted = 'STABLE')::INT) - 0.4) + abs(avg((predicted = 'UP')::INT) - 0.3)), 6) + 0.0 AS shift FROM done GROUP BY model_version",
}
