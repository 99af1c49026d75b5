"""Queries over data quality, drift, alerts and panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.functions.registry import FEATURE_NAMES
from tickflow.functions.scalars import DAY_US, HOUR_US, MINUTE_US, floor_to
from tickflow.operators import alerts, attribution, drift, panels, quality, scans
from tickflow.plans import model_queries as M
from tickflow.plans.base import FEATURES_SQL, MIDDLE_US, NOW_US, START_US, TICKS_SQL, features, rounded
from tickflow.sources.ingest import ticks
from tickflow.sources.shared import materialize, shared_dir

INTERVAL_US = 30 * MINUTE_US
WEEK = 5 * DAY_US
WINDOWS = tuple(MIDDLE_US + k * WEEK for k in (1, 2, 3))
SUSTAINED, SUPPRESSION_US = 3, 4 * HOUR_US


def _symbols(spark, sf_dir):
    return ticks(spark, sf_dir).select("symbol").distinct()


def check_freshness(spark, sf_dir):
    rows = ticks(spark, sf_dir)
    return rounded(quality.freshness(_symbols(spark, sf_dir), rows.where((F.col("t") < NOW_US) & ((F.col("symbol") != "error") | (F.col("t") < NOW_US - DAY_US))), NOW_US, 30 * MINUTE_US))


def check_completeness(spark, sf_dir):
    return rounded(quality.completeness(_symbols(spark, sf_dir), ticks(spark, sf_dir), NOW_US, DAY_US, INTERVAL_US))


def check_validity(spark, sf_dir):
    """Ticks arrive in the order of their message ids, prices are lowered by 5."""
    raw = ticks(spark, sf_dir).select("symbol", "t", (F.col("price") - 5).alias("price"), (F.col("message_id").cast("long") * 60_000_000 + F.pmod(F.col("message_id").cast("long") * 7919, F.lit(11)) * 600_000_000).alias("arrival"))
    return quality.validity(_symbols(spark, sf_dir), raw, features(spark, sf_dir))


def check_distribution(spark, sf_dir):
    return quality.distribution(_symbols(spark, sf_dir), features(spark, sf_dir), NOW_US, DAY_US, WEEK)


def _audit(spark, sf_dir):
    checks = {"freshness": check_freshness(spark, sf_dir), "completeness": check_completeness(spark, sf_dir), "distribution": check_distribution(spark, sf_dir)}
    return quality.audit_rows(checks, NOW_US, NOW_US - DAY_US)


def quality_gate(spark, sf_dir):
    """Validity did not run, so the gate stays shut."""
    path = f"{shared_dir(spark)}/audit"
    for _ in range(2):
        quality.store_audit(_audit(spark, sf_dir), path)
    return quality.stored_gate(spark, path, NOW_US - HOUR_US, NOW_US)


def quality_latest_status(spark, sf_dir):
    return quality.latest_status(_audit(spark, sf_dir))


VALUES = ("price", "volume", *FEATURE_NAMES)


def _values(spark, sf_dir):
    """The features, computed once for all that reads them."""
    return materialize(features(spark, sf_dir).where(~F.col("insufficient_history")).select("t", *VALUES))


def _halves(spark, sf_dir):
    return drift.counted(_values(spark, sf_dir).withColumn("feature", F.lit("")), F.col("t") < MIDDLE_US, F.col("t") >= MIDDLE_US, names=VALUES)


def psi_by_feature(spark, sf_dir):
    return rounded(drift.psi_of(_halves(spark, sf_dir)))


def ks_by_feature(spark, sf_dir):
    return rounded(drift.ks_of(_halves(spark, sf_dir)).select("feature", "ks", "n_ref", "n_live"))


def _flags(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_returnflag", "l_quantity", "l_extendedprice", "l_discount").unpivot(["l_returnflag"], ["l_quantity", "l_extendedprice", "l_discount"], "feature", "value")
    return drift.counted(rows, F.col("l_returnflag") == "R", F.col("l_returnflag") == "N")


def psi_lineitem(spark, sf_dir):
    """Drift of prices, quantities and discounts between two return flags, at the scale of lineitem."""
    return rounded(drift.psi_of(_flags(spark, sf_dir)))


def ks_lineitem(spark, sf_dir):
    return rounded(drift.ks_of(_flags(spark, sf_dir)).select("feature", "ks", "n_ref", "n_live"))


def chi2_class_mix(spark, sf_dir):
    rows = M._labelled(spark, sf_dir)
    count = lambda df: df.groupBy(F.col("label").alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return rounded(drift.chi_square(count(rows.where(F.col("t") < MIDDLE_US)), count(rows.where(F.col("t") >= MIDDLE_US))))


def _drift_runs(spark, sf_dir):
    """PSI and KS rows of three live windows of five days against the first fifteen days, in one job: the window joins the feature's name."""
    rows = _values(spark, sf_dir)
    end = F.floor((F.col("t") - MIDDLE_US) / WEEK) * WEEK + MIDDLE_US + WEEK
    named = F.concat(F.lit("@"), F.col("window_end").cast("string")).alias("feature")
    ref = rows.where(F.col("t") < MIDDLE_US).withColumn("window_end", F.explode(F.array(*[F.lit(w) for w in WINDOWS])))
    live = scans.in_range(rows, MIDDLE_US, WINDOWS[-1]).withColumn("window_end", end)
    both = ref.select(named, *VALUES, F.lit(True).alias("ref")).unionByName(live.select(named, *VALUES, F.lit(False).alias("ref")))
    values = drift.counted(both, F.col("ref"), ~F.col("ref"), names=VALUES)
    rows = drift.metric_rows(drift.psi_of(values), drift.ks_of(values), 0, 0, NOW_US, "1")
    w = F.split_part("feature", F.lit("@"), F.lit(2)).cast("long")
    return rows.withColumns({"window_start": w - WEEK, "window_end": w, "feature": F.split_part("feature", F.lit("@"), F.lit(1))})


def drift_severity_timeline(spark, sf_dir):
    return panels.severity_timeline(_drift_runs(spark, sf_dir))


def psi_heatmap(spark, sf_dir):
    return rounded(drift.psi_heatmap(_drift_runs(spark, sf_dir), WINDOWS))


def correlated_breach(spark, sf_dir):
    return drift.correlated_breach(_drift_runs(spark, sf_dir), 3)


def drift_latest_window(spark, sf_dir):
    return rounded(scans.newest_window(_drift_runs(spark, sf_dir).where("metric = 'psi'")).select("feature", "value", "severity", "sample_size", "window_end"))


def _evaluations(spark, sf_dir):
    rows = ticks(spark, sf_dir)
    hourly = rows.groupBy("symbol", floor_to(F.col("t"), HOUR_US).alias("t")).agg(F.avg("price").alias("m"))
    whole = rows.groupBy("symbol").agg(F.avg("price").alias("w"))
    return hourly.join(whole, "symbol").select(F.col("symbol").alias("dedup_key"), "t", (F.col("m") > F.col("w")).alias("breached"))


def alert_decisions(spark, sf_dir):
    return alerts.decisions(_evaluations(spark, sf_dir), SUSTAINED, SUPPRESSION_US).select("dedup_key", "t", "breached", "action", "consecutive")


def alert_open_state(spark, sf_dir):
    return alerts.open_state(alerts.decisions(_evaluations(spark, sf_dir), SUSTAINED, SUPPRESSION_US))


def alert_record(spark, sf_dir):
    """The state after one more run, in which the keys of an even number of letters breach and one has no evidence."""
    rows = _evaluations(spark, sf_dir)
    opened = alerts.open_state(alerts.decisions(rows, SUSTAINED, SUPPRESSION_US)).select("dedup_key", F.col("consecutive_breaches").alias("consecutive"), "first_breached", "fired")
    keys = rows.select("dedup_key").distinct()
    return alerts.record(opened, keys.where(F.length("dedup_key") % 2 == 0), keys.where("dedup_key <> 'error'"), NOW_US, sustained=SUSTAINED, suppression_us=SUPPRESSION_US)


def rule_drift(spark, sf_dir):
    return alerts.drift_rule(correlated_breach(spark, sf_dir).where(F.col("window_end") == WINDOWS[-1]))


def _slices(spark, sf_dir):
    return attribution.slices(M._resolved(spark, sf_dir), START_US, NOW_US)


def rule_accuracy(spark, sf_dir):
    return alerts.accuracy_rule(_slices(spark, sf_dir), least=0.9)


def rule_prediction_mix(spark, sf_dir):
    return alerts.mix_rule(_slices(spark, sf_dir), {"DOWN": 0.8, "STABLE": 0.1, "UP": 0.1})


def panel_system_health(spark, sf_dir):
    f = features(spark, sf_dir).where((F.col("t") < NOW_US) & (F.col("symbol") != "view"))
    return rounded(panels.system_health(ticks(spark, sf_dir).where(F.col("t") < NOW_US), f, NOW_US, 1200.0))


def panel_ingestion_rate(spark, sf_dir):
    return panels.ingestion_rate(ticks(spark, sf_dir))


def panel_completeness(spark, sf_dir):
    return rounded(panels.completeness(ticks(spark, sf_dir), NOW_US, DAY_US, INTERVAL_US))


def panel_null_rate(spark, sf_dir):
    return rounded(panels.null_rate(features(spark, sf_dir)))


def symbols_summary(spark, sf_dir):
    return rounded(panels.symbols_summary(ticks(spark, sf_dir).where(F.col("t") < NOW_US), NOW_US, 1200.0))


def pipeline_summary(spark, sf_dir):
    """Newest runs derived from the ticks: trainings at each tick of one type, promotions at another, checks and drift runs by the hour."""
    t = ticks(spark, sf_dir)
    runs = t.where("symbol = 'click'").select(F.col("t").alias("finished"))
    versions = t.where("symbol = 'view'").select(F.when(F.col("volume") < 50, F.col("t")).alias("promoted_at"))
    audit = t.select(floor_to(F.col("t"), HOUR_US).alias("checked_at"))
    runs_of_drift = t.select(floor_to(F.col("t"), 6 * HOUR_US).alias("computed_at"))
    opened = alert_open_state(spark, sf_dir).select("status", F.lit("warning").alias("severity"))
    return panels.pipeline_summary(runs, versions, audit, runs_of_drift, opened)


QUERIES = {
    f.__name__: f
    for f in (check_freshness, check_completeness, check_validity, check_distribution, quality_gate, quality_latest_status, psi_by_feature, ks_by_feature, psi_lineitem, ks_lineitem, chi2_class_mix, drift_severity_timeline, psi_heatmap, correlated_breach, drift_latest_window, alert_decisions, alert_open_state, alert_record, rule_drift, rule_accuracy, rule_prediction_mix, panel_system_health, panel_ingestion_rate, panel_completeness, panel_null_rate, symbols_summary, pipeline_summary)
}

_SYM = "sym AS (SELECT DISTINCT symbol FROM ticks)"
FRESH_SQL = f"fresh AS (SELECT sym.symbol, max(x.t) AS last FROM sym LEFT JOIN ticks x ON x.symbol = sym.symbol AND x.t < {NOW_US} AND (x.symbol <> 'error' OR x.t < {NOW_US - DAY_US}) GROUP BY sym.symbol)"
COMPLETE_SQL = f"complete AS (SELECT sym.symbol, count(x.t) AS actual FROM sym LEFT JOIN ticks x ON x.symbol = sym.symbol AND x.t >= {NOW_US - DAY_US} AND x.t < {NOW_US} GROUP BY sym.symbol)"
_LONG = " UNION ALL ".join(f"SELECT symbol, t, '{n}' AS feature, {n} AS value FROM f WHERE NOT insufficient_history" for n in FEATURE_NAMES)
_LONG2 = _LONG + "".join(f" UNION ALL SELECT symbol, t, '{n}', {n} FROM f WHERE NOT insufficient_history" for n in ("price", "volume"))
DIST_SQL = f"""long AS ({_LONG}), moved AS (
  SELECT symbol, feature FROM (
    SELECT symbol, feature, avg(value) FILTER (t >= {NOW_US - DAY_US} AND t < {NOW_US}) AS live, avg(value) FILTER (t >= {NOW_US - DAY_US - WEEK} AND t < {NOW_US - DAY_US}) AS past FROM long GROUP BY ALL
  ) WHERE past <> 0 AND live IS NOT NULL AND abs((live - past) / past) > 0.5
), dist AS (SELECT sym.symbol, count(feature) AS shifted, coalesce(string_agg(feature, ',' ORDER BY feature), '') AS features FROM sym LEFT JOIN moved USING (symbol) GROUP BY sym.symbol)"""
_GATE = f"WITH {FEATURES_SQL}, {_SYM}, {FRESH_SQL}, {COMPLETE_SQL}, {DIST_SQL}, st AS (SELECT 'freshness' AS check_name, bool_and(coalesce(last >= {NOW_US - 30 * MINUTE_US}, false)) AS passed FROM fresh UNION ALL SELECT 'completeness', bool_and(actual >= 0.95 * 48) FROM complete UNION ALL SELECT 'distribution', bool_and(shifted = 0) FROM dist UNION ALL SELECT 'validity', NULL)"


def _psi_sql(source: str, ref: str, live: str) -> str:
    """PSI of `source` rows (feature, value), by quantiles and explicit bins."""
    return f"""cuts AS (
  SELECT feature, unnest(list_distinct(quantile_cont(value, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]))) AS e FROM {source} WHERE {ref} AND value IS NOT NULL GROUP BY feature
), edges AS (
  SELECT feature, list(e ORDER BY e) AS es FROM cuts GROUP BY feature
), bins AS (
  SELECT feature, es[2:len(es) - 1] AS inn, unnest(range(greatest(len(es) - 1, 1))) AS bin, len(es) AS k FROM edges
), placed AS (
  SELECT s.feature, len(list_filter(e.es[2:len(e.es) - 1], lambda x: x <= s.value)) AS bin, ({ref}) AS is_ref, ({live}) AS is_live FROM {source} s JOIN edges e USING (feature) WHERE value IS NOT NULL
), shares AS (
  SELECT b.feature, b.bin, any_value(k) AS k, greatest(count(*) FILTER (is_ref) / any_value(nr)::DOUBLE, 1e-6) AS r, greatest(count(*) FILTER (is_live) / any_value(nl)::DOUBLE, 1e-6) AS o, any_value(nl) AS nl
  FROM bins b LEFT JOIN placed p ON b.feature = p.feature AND b.bin = p.bin JOIN (SELECT feature, count(*) FILTER (is_ref) AS nr, count(*) FILTER (is_live) AS nl FROM placed GROUP BY feature) n ON n.feature = b.feature GROUP BY ALL
), psi AS (
  SELECT feature, CASE WHEN bool_and(k >= 2 AND nl > 0) THEN sum((o - r) * ln(o / r)) ELSE 0 END AS psi, any_value(nl) AS n_live, bool_and(k >= 2 AND nl > 0) AS evaluable FROM shares GROUP BY feature
)"""


def _ks_sql(source: str, ref: str, live: str) -> str:
    return f"""v AS (
  SELECT feature, value, count(*) FILTER ({ref}) AS r, count(*) FILTER ({live}) AS o FROM {source} WHERE value IS NOT NULL AND ({ref} OR {live}) GROUP BY ALL
), c AS (
  SELECT feature, sum(r) OVER w AS sr, sum(o) OVER w AS so, sum(r) OVER p AS nr, sum(o) OVER p AS nl FROM v WINDOW w AS (PARTITION BY feature ORDER BY value), p AS (PARTITION BY feature)
)
SELECT feature, round(coalesce(max(abs(sr / nullif(nr, 0) - so / nullif(nl, 0))), 0), 6) + 0.0 AS ks, max(nr)::BIGINT AS n_ref, max(nl)::BIGINT AS n_live FROM c GROUP BY feature"""


_BAND = "CASE WHEN psi > 0.25 THEN 'significant' WHEN psi > 0.10 THEN 'moderate' ELSE 'stable' END"
_PSI_OUT = f"SELECT feature, round(psi, 6) + 0.0 AS psi, {_BAND} AS severity, n_live, evaluable FROM psi"
_LINE = "line AS (SELECT l_returnflag, unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS feature, unnest([l_quantity, l_extendedprice, l_discount]) AS value FROM lineitem)"
_FLAG = "l_returnflag = '{}'"
_REF, _LIVE = f"t < {MIDDLE_US}", f"t >= {MIDDLE_US}"
# one PSI per live window: the window is part of the feature's name
_RUNS = f"WITH {FEATURES_SQL}, long AS ({_LONG2}), runs AS (" + " UNION ALL ".join(f"SELECT feature || '@{w}' AS feature, value, t, {w} AS w FROM long WHERE t < {MIDDLE_US} OR (t >= {w - WEEK} AND t < {w})" for w in WINDOWS) + f"), {_psi_sql('runs', _REF, _LIVE)}, run AS (SELECT split_part(feature, '@', 1) AS feature, split_part(feature, '@', 2)::BIGINT AS window_end, psi, n_live, {_BAND} AS severity FROM psi)"
_BREACH = "breach AS (SELECT window_end, count(DISTINCT feature) AS n, string_agg(DISTINCT feature, ',' ORDER BY feature) AS features FROM run WHERE severity <> 'stable' GROUP BY window_end HAVING count(DISTINCT feature) >= 3)"
EVAL_SQL = f"""ev AS (
  SELECT h.symbol AS dedup_key, h.t, m > w AS breached, row_number() OVER (PARTITION BY h.symbol ORDER BY h.t) AS i
  FROM (SELECT symbol, t - t % {HOUR_US} AS t, avg(price) AS m FROM ticks GROUP BY ALL) h JOIN (SELECT symbol, avg(price) AS w FROM ticks GROUP BY symbol) s USING (symbol)
), st AS (
  SELECT dedup_key, t, i, breached, CASE WHEN breached THEN 1 ELSE 0 END AS k, NULL::BIGINT AS fired, CASE WHEN breached THEN t END AS since, CASE WHEN NOT breached THEN 'none' ELSE 'accumulate' END AS action FROM ev WHERE i = 1
  UNION ALL
  SELECT e.dedup_key, e.t, e.i, e.breached, CASE WHEN e.breached THEN s.k + 1 ELSE 0 END,
         CASE WHEN NOT e.breached THEN NULL WHEN s.fired IS NOT NULL THEN s.fired WHEN s.k + 1 >= {SUSTAINED} THEN e.t END, CASE WHEN NOT e.breached THEN NULL WHEN s.k > 0 THEN s.since ELSE e.t END,
         CASE WHEN NOT e.breached THEN CASE WHEN s.k > 0 THEN 'resolve' ELSE 'none' END WHEN s.k + 1 < {SUSTAINED} THEN 'accumulate' WHEN s.fired IS NOT NULL AND e.t - s.fired < {SUPPRESSION_US} THEN 'suppress' ELSE 'fire' END
  FROM st s JOIN ev e ON e.dedup_key = s.dedup_key AND e.i = s.i + 1
)"""
_STATE = f"WITH RECURSIVE {TICKS_SQL}, {EVAL_SQL}, opened AS (SELECT dedup_key, CASE WHEN fired IS NOT NULL THEN 'firing' ELSE 'pending' END AS status, k::BIGINT AS consecutive_breaches, since AS first_breached, fired, t AS updated, breached FROM st QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY t DESC) = 1)"
_ARRIVAL = "(event_id * 60000000 + (event_id * 7919) % 11 * 600000000)"
SQL = {
    "check_freshness": f"WITH {TICKS_SQL}, {_SYM}, {FRESH_SQL} SELECT symbol, coalesce(last >= {NOW_US - 30 * MINUTE_US}, false) AS passed, round(({NOW_US} - last) / 1e6, 6) + 0.0 AS lag_seconds, CASE WHEN last IS NULL THEN 'no_ticks_observed' WHEN last < {NOW_US - 30 * MINUTE_US} THEN 'stale' END AS issue FROM fresh",
    "check_completeness": f"WITH {TICKS_SQL}, {_SYM}, {COMPLETE_SQL} SELECT symbol, actual >= 0.95 * 48 AS passed, actual, 48::BIGINT AS expected, round(actual / 48.0, 6) + 0.0 AS ratio FROM complete",
    "check_validity": f"WITH {FEATURES_SQL}, {_SYM}, seen AS (SELECT symbol, count(*) FILTER (price - 5 <= 0) AS non_positive, count(*) FILTER (t < last AND arrival - before <= {DAY_US}) AS non_monotonic FROM (SELECT symbol, price, t, {_ARRIVAL} AS arrival, lag(t) OVER (PARTITION BY symbol ORDER BY {_ARRIVAL}) AS last, lag({_ARRIVAL}) OVER (PARTITION BY symbol ORDER BY {_ARRIVAL}) AS before FROM ticks) GROUP BY symbol), n AS (SELECT symbol, count(*) AS null_features FROM f WHERE NOT insufficient_history AND ({' OR '.join(f'{x} IS NULL' for x in FEATURE_NAMES)}) GROUP BY symbol) SELECT symbol, non_positive + non_monotonic + coalesce(null_features, 0) = 0 AS passed, non_positive, non_monotonic, coalesce(null_features, 0) AS null_features, concat_ws(',', CASE WHEN non_positive > 0 THEN 'non_positive:' || non_positive END, CASE WHEN non_monotonic > 0 THEN 'non_monotonic:' || non_monotonic END, CASE WHEN null_features > 0 THEN 'null_features:' || null_features END) AS issues FROM sym LEFT JOIN seen USING (symbol) LEFT JOIN n USING (symbol)",
    "check_distribution": f"WITH {FEATURES_SQL}, {_SYM}, {DIST_SQL} SELECT symbol, shifted = 0 AS passed, shifted, features FROM dist",
    "quality_gate": f"{_GATE} SELECT bool_and(coalesce(passed, false)) AS open, count(*) FILTER (passed IS NULL) AS missing, count(*) FILTER (NOT passed) AS failed FROM st",
    "quality_latest_status": f"{_GATE} SELECT check_name, passed, CASE WHEN passed IS NOT NULL THEN {NOW_US} END AS checked_at FROM st",
    "psi_by_feature": f"WITH {FEATURES_SQL}, long AS ({_LONG2}), {_psi_sql('long', _REF, _LIVE)} {_PSI_OUT}",
    "ks_by_feature": f"WITH {FEATURES_SQL}, long AS ({_LONG2}), {_ks_sql('long', _REF, _LIVE)}",
    "psi_lineitem": f"WITH {_LINE}, {_psi_sql('line', _FLAG.format('R'), _FLAG.format('N'))} {_PSI_OUT}",
    "ks_lineitem": f"WITH {_LINE}, {_ks_sql('line', _FLAG.format("R"), _FLAG.format("N"))}",
    "chi2_class_mix": f"WITH {M.FORWARD_SQL}, c AS (SELECT label, count(*) FILTER ({_REF}) AS r, count(*) FILTER ({_LIVE}) AS o FROM labelled GROUP BY label), e AS (SELECT o, r * sum(o) OVER () / sum(r) OVER () AS x, sum(o) OVER () AS n FROM c), s AS (SELECT sum((o - x) * (o - x) / x) AS x2, max(n)::BIGINT AS n FROM e) SELECT round(x2, 6) + 0.0 AS statistic, round(exp(-x2 / 2), 6) + 0.0 AS p_value, n AS n_live FROM s",
    "drift_severity_timeline": f"{_RUNS} SELECT window_end, arg_max(severity, CASE severity WHEN 'significant' THEN 2 WHEN 'moderate' THEN 1 ELSE 0 END) AS severity FROM run GROUP BY window_end",
    "psi_heatmap": f"{_RUNS} SELECT feature, " + ", ".join(f"round(max(psi) FILTER (window_end = {w}), 6) + 0.0 AS w_{w}" for w in WINDOWS) + " FROM run GROUP BY feature",
    "correlated_breach": f"{_RUNS}, {_BREACH} SELECT window_end, n, features FROM breach",
    "drift_latest_window": f"{_RUNS} SELECT feature, round(psi, 6) + 0.0 AS value, severity, n_live AS sample_size, window_end FROM run WHERE window_end = {WINDOWS[-1]}",
    "alert_decisions": f"WITH RECURSIVE {TICKS_SQL}, {EVAL_SQL} SELECT dedup_key, t, breached, action, k::BIGINT AS consecutive FROM st",
    "alert_record": f"""{_STATE}, x AS (
  SELECT k.dedup_key, o.dedup_key IS NOT NULL AS is_open, len(k.dedup_key) % 2 = 0 AS b, o.consecutive_breaches AS c, o.first_breached AS since, o.fired AS f
  FROM (SELECT DISTINCT dedup_key FROM st) k LEFT JOIN (SELECT * FROM opened WHERE breached) o ON k.dedup_key = o.dedup_key WHERE k.dedup_key <> 'error'
), y AS (SELECT *, CASE WHEN b THEN coalesce(c, 0) + 1 ELSE 0 END AS n FROM x), z AS (
  SELECT *, CASE WHEN NOT b THEN CASE WHEN is_open THEN 'resolve' ELSE 'none' END WHEN n < {SUSTAINED} THEN 'accumulate' WHEN f IS NULL OR {NOW_US} - f >= {SUPPRESSION_US} THEN 'fire' ELSE 'suppress' END AS action FROM y
) SELECT dedup_key, action, CASE WHEN action = 'resolve' THEN 'resolved' WHEN f IS NOT NULL OR action = 'fire' THEN 'firing' WHEN b THEN 'pending' END AS status, n::BIGINT AS consecutive,
  CASE WHEN b THEN coalesce(since, {NOW_US}) ELSE since END AS first_breached, CASE WHEN f IS NOT NULL THEN f WHEN action = 'fire' THEN {NOW_US} END AS fired, CASE WHEN action = 'resolve' THEN {NOW_US} END AS resolved FROM z""",
    "alert_open_state": f"{_STATE} SELECT dedup_key, status, consecutive_breaches, first_breached, fired, updated FROM opened WHERE breached",
    "rule_drift": f"{_RUNS}, {_BREACH} SELECT 'feature_drift' AS alert_name, 'feature_drift' AS dedup_key, features AS details FROM breach WHERE window_end = {WINDOWS[-1]}",
    "rule_accuracy": f"WITH {M.PRED_SQL}, s AS (SELECT model_version, count(*) AS n, avg((actual = predicted)::INT::DOUBLE) AS a FROM done GROUP BY model_version) SELECT 'model_accuracy_degraded' AS alert_name, 'model_accuracy_degraded:' || model_version AS dedup_key, format('{{:.4f}}', a) AS details FROM s WHERE n >= 50 AND a < 0.9 ORDER BY a, model_version LIMIT 1",
    "rule_prediction_mix": f"WITH {M.PRED_SQL}, s AS (SELECT model_version, 0.5 * (abs(avg((predicted = 'DOWN')::INT) - 0.8) + abs(avg((predicted = 'STABLE')::INT) - 0.1) + abs(avg((predicted = 'UP')::INT) - 0.1)) AS d FROM done GROUP BY model_version) SELECT 'prediction_distribution_shift' AS alert_name, 'prediction_distribution_shift:' || model_version AS dedup_key, format('{{:.4f}}', d) AS details FROM s WHERE d > 0.30 ORDER BY d DESC, model_version DESC LIMIT 1",
    "panel_system_health": f"WITH {TICKS_SQL}, a AS (SELECT symbol, max(t) AS last_tick FROM ticks WHERE t < {NOW_US} GROUP BY symbol), b AS (SELECT symbol, max(t) AS last_feature FROM ticks WHERE t < {NOW_US} AND symbol <> 'view' GROUP BY symbol) SELECT symbol, last_tick, last_feature, round(({NOW_US} - last_tick) / 1e6, 6) + 0.0 AS tick_age, round(({NOW_US} - last_feature) / 1e6, 6) + 0.0 AS feature_age, coalesce(({NOW_US} - last_feature) / 1e6 > 1200, true) AS stale FROM a FULL JOIN b USING (symbol)",
    "panel_ingestion_rate": f"WITH {TICKS_SQL} SELECT symbol, t - t % {HOUR_US} AS bucket, count(*) AS n FROM ticks GROUP BY ALL",
    "panel_completeness": f"WITH {TICKS_SQL} SELECT symbol, count(*) AS n, round(least(count(*) / 48.0, 1.0), 6) + 0.0 AS completeness FROM ticks WHERE t >= {NOW_US - DAY_US} AND t < {NOW_US} GROUP BY symbol",
    "panel_null_rate": f"WITH {FEATURES_SQL} " + " UNION ALL ".join(f"SELECT '{n}' AS feature, round(avg(({n} IS NULL)::INT::DOUBLE), 6) + 0.0 AS null_rate FROM f" for n in FEATURE_NAMES),
    "symbols_summary": f"WITH {TICKS_SQL}, l AS (SELECT symbol, max(t) AS last_t FROM ticks WHERE t < {NOW_US} GROUP BY symbol) SELECT symbol, last_t, round(({NOW_US} - last_t) / 1e6, 6) + 0.0 AS age, min(({NOW_US} - last_t) / 1e6) OVER () <= 1200 AS ready FROM l",
    "pipeline_summary": f"{_STATE} SELECT (SELECT max(t) FROM ticks WHERE symbol = 'click') AS last_training, (SELECT max(t) FROM ticks WHERE symbol = 'view' AND volume < 50) AS last_promotion, (SELECT max(t - t % {HOUR_US}) FROM ticks) AS last_quality, (SELECT max(t - t % {6 * HOUR_US}) FROM ticks) AS last_drift, (SELECT count(*) FROM opened WHERE breached) AS open_alerts",
}
