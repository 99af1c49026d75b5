"""Dashboard aggregates and summaries: small result tables over the stored ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.functions.registry import FEATURE_NAMES
from tickflow.functions.scalars import HOUR_US, age_seconds, floor_to


def system_health(ticks: DataFrame, features: DataFrame, now_us: int, limit_seconds: float) -> DataFrame:
    """(symbol, last_tick, last_feature, tick_age, feature_age, stale) of every symbol with ticks or features."""
    last = lambda df, c: df.groupBy("symbol").agg(F.max("t").alias(c))
    rows = last(ticks, "last_tick").join(last(features, "last_feature"), "symbol", "full_outer")
    age = age_seconds(now_us, F.col("last_feature"))
    return rows.select("symbol", "last_tick", "last_feature", F.when(F.col("last_tick").isNotNull(), age_seconds(now_us, F.col("last_tick"))).alias("tick_age"), F.when(F.col("last_feature").isNotNull(), age).alias("feature_age"), (F.col("last_feature").isNull() | (age > limit_seconds)).alias("stale"))


def ingestion_rate(ticks: DataFrame, step_us: int = HOUR_US) -> DataFrame:
    return ticks.groupBy("symbol", floor_to(F.col("t"), step_us).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def completeness(ticks: DataFrame, now_us: int, window_us: int, interval_us: int) -> DataFrame:
    expected = float(max(window_us // interval_us, 1))
    rows = ticks.where((F.col("t") >= now_us - window_us) & (F.col("t") < now_us))
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).select("symbol", "n", F.least(F.col("n") / expected, F.lit(1.0)).alias("completeness"))


def null_rate(features: DataFrame) -> DataFrame:
    """(feature, null_rate); no rows for an empty window."""
    wide = features.agg(F.count(F.lit(1)).alias("_n"), *[F.avg(F.col(n).isNull().cast("double")).alias(n) for n in FEATURE_NAMES]).where("_n > 0").drop("_n")
    return wide.unpivot([], list(FEATURE_NAMES), "feature", "null_rate")


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count_if(F.col("status") != "resolved").alias("open"), F.count_if((F.col("status") != "resolved") & (F.col("severity") == "critical")).alias("critical"))


def promotion_events(versions: DataFrame) -> DataFrame:
    return versions.where("promoted_at is not null").select("model_version", "promoted_at").orderBy("promoted_at")


def severity_timeline(drift: DataFrame) -> DataFrame:
    from tickflow.operators.drift import worst_severity

    return worst_severity(drift, ["window_end"])


def pipeline_summary(runs: DataFrame, versions: DataFrame, audit: DataFrame, drift: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row: the newest training, promotion, quality check and drift run, and how many alerts are open; null is never."""
    newest = lambda df, c, name: df.agg(F.max(c).alias(name))
    out = newest(runs, "finished", "last_training")
    for one in (newest(versions, "promoted_at", "last_promotion"), newest(audit, "checked_at", "last_quality"), newest(drift, "computed_at", "last_drift"), alert_counts(alerts).select(F.col("open").alias("open_alerts"))):
        out = out.join(F.broadcast(one))  # one row each
    return out


def symbols_summary(ticks: DataFrame, now_us: int, limit_seconds: float) -> DataFrame:
    """(symbol, last_t, age, ready): ready, on each row, iff the freshest symbol is no older than the limit."""
    last = ticks.groupBy("symbol").agg(F.max("t").alias("last_t"))
    freshest = last.agg(F.min(age_seconds(now_us, F.col("last_t"))).alias("_least"))
    return last.join(F.broadcast(freshest)).select("symbol", "last_t", age_seconds(now_us, F.col("last_t")).alias("age"), (F.col("_least") <= limit_seconds).alias("ready"))


def quality_summary(audit: DataFrame) -> DataFrame:
    """One row (checks, all_passed); passing needs at least one row."""
    return audit.agg(F.count(F.lit(1)).alias("checks"), (F.coalesce(F.bool_and("passed"), F.lit(False)) & (F.count(F.lit(1)) > 0)).alias("all_passed"))


def drift_summary(drift: DataFrame) -> DataFrame:
    """One row (status, features, window_end): the worst severity of the newest window and how many features are not stable in it;
    never_ran without rows."""
    from tickflow.operators.drift import worst_severity
    from tickflow.operators.scans import newest_window

    rows = newest_window(drift)
    told = rows.agg(F.count_distinct(F.when(F.col("severity") != "stable", F.col("feature"))).alias("features"), F.max("window_end").alias("window_end"))
    status = F.when(F.col("window_end").isNull(), "never_ran").otherwise(F.col("severity"))
    return told.join(F.broadcast(worst_severity(rows))).select(status.alias("status"), "features", "window_end")  # one row each


def model_performance(slices: DataFrame, versions: DataFrame, pending: DataFrame, baseline: DataFrame) -> DataFrame:
    """A row per model version of the slices, with when it was promoted (null: never), how many predictions wait for their horizon, and the
    baseline's accuracy on every row. pending: one row (pending); baseline: one row (baseline_accuracy) or none."""
    rows = slices.join(versions.select("model_version", "promoted_at"), "model_version", "left")
    both = pending.join(baseline.agg(F.max("baseline_accuracy").alias("baseline_accuracy")))  # one row each
    return rows.join(F.broadcast(both))
