"""Sustained-breach alerts: decisions in closed form over evaluations, rules over slices, and the state that a run leaves."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickflow.operators.metrics import distribution_shift, latest_prior


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    runbook: str


#: Names and severities are fixed values; the runbooks are topics, which whoever runs the engine describes.
RULES = (
    Rule("feature_drift", "warning", "model rollback"),
    Rule("model_accuracy_degraded", "critical", "model rollback"),
    Rule("prediction_distribution_shift", "warning", "consumer lag"),
    Rule("data_quality_failed", "warning", "dead letters"),
)


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(r.name, r.severity, r.runbook) for r in RULES], "alert_name string, severity string, runbook string")


def decisions(evaluations: DataFrame, sustained: int, suppression_us: int) -> DataFrame:
    """(dedup_key, t, breached, action, consecutive, first_fire) of (dedup_key, t, breached).

    A breach counts in its run of breaches; below `sustained` it accumulates, at `sustained` it fires, after that it is suppressed until
    the suppression has passed since the alert fired, and then fires again (the boundary fires). What ends a run resolves it; else none.
    The time of the first fire stays, so once the suppression has passed each later evaluation of a long run fires."""
    w = Window.partitionBy("dedup_key").orderBy("t")
    rows = evaluations.withColumn("_clear", F.sum(F.when(F.col("breached"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_before", F.lag("breached").over(w))
    run = Window.partitionBy("dedup_key", "_clear").orderBy("t")
    rows = rows.withColumn("consecutive", F.when(F.col("breached"), F.sum(F.col("breached").cast("long")).over(run)).otherwise(F.lit(0).cast("long")))
    rows = rows.withColumn("first_fire", F.max(F.when(F.col("breached") & (F.col("consecutive") == sustained), F.col("t"))).over(run))
    age = F.col("t") - F.col("first_fire")
    again = age >= suppression_us
    action = F.when(~F.col("breached") & F.coalesce("_before", F.lit(False)), "resolve").when(~F.col("breached"), "none").when(F.col("consecutive") < sustained, "accumulate").when(F.col("consecutive") == sustained, "fire").when(again, "fire").otherwise("suppress")
    return rows.select("dedup_key", "t", "breached", action.alias("action"), "consecutive", F.when(F.col("breached"), F.col("first_fire")).alias("first_fire"))


def open_state(decided: DataFrame) -> DataFrame:
    """One row per key whose newest evaluation breaches: since when, how often, when it fired."""
    last = decided.groupBy("dedup_key").agg(F.max_by(F.struct("t", "breached", "consecutive", "first_fire", "action"), "t").alias("x")).select("dedup_key", "x.*").where("breached")
    w = decided.where("breached").join(last.select("dedup_key", F.col("t").alias("_last"), F.col("consecutive").alias("_k")), "dedup_key")
    first = w.where(F.col("t") <= F.col("_last")).withColumn("_r", F.row_number().over(Window.partitionBy("dedup_key").orderBy(F.desc("t")))).where("_r = _k").select("dedup_key", F.col("t").alias("first_breached"))
    return last.join(first, "dedup_key").select("dedup_key", F.when(F.col("first_fire").isNotNull(), "firing").otherwise("pending").alias("status"), F.col("consecutive").alias("consecutive_breaches"), "first_breached", F.col("first_fire").alias("fired"), F.col("t").alias("updated"))


def open_alerts(alerts: DataFrame, dedup_key: str | None = None) -> DataFrame:
    """Alerts that are not resolved, the newest first; with a key, the newest one of it at most."""
    rows = alerts.where("status <> 'resolved'")
    if dedup_key is None:
        return rows.orderBy(F.desc("updated"), "dedup_key")
    return rows.where(F.col("dedup_key") == dedup_key).orderBy(F.desc("updated")).limit(1)


def drift_rule(breaches: DataFrame) -> DataFrame:
    """Breaches (alert_name, dedup_key, details) of correlated_breach() rows."""
    return breaches.select(F.lit("feature_drift").alias("alert_name"), F.lit("feature_drift").alias("dedup_key"), F.col("features").alias("details"))


def accuracy_rule(slices: DataFrame, *, least: float = 0.34, resolved: int = 50, all_degraded: bool = False) -> DataFrame:
    """The worst (or each) version of enough resolved predictions whose accuracy is below `least`; the key names the version."""
    bad = slices.where((F.col("n") >= resolved) & (F.col("accuracy") < least))
    if not all_degraded:
        bad = bad.groupBy().agg(F.min_by(F.struct("model_version", "accuracy"), F.struct("accuracy", "model_version")).alias("x")).where("x is not null").select("x.*")
    return bad.select(F.lit("model_accuracy_degraded").alias("alert_name"), F.concat(F.lit("model_accuracy_degraded:"), F.col("model_version").cast("string")).alias("dedup_key"), F.format_number("accuracy", 4).alias("details"))


def stored_prior(runs: DataFrame) -> dict[str, float] | None:
    """The training prior of mix_rule(): the shares of the newest stored run's training labels; None where no run has any."""
    counts = F.from_json("counts", "map<string, bigint>")
    own = F.transform_keys(F.map_filter(counts, lambda k, _: k.startswith("train_")), lambda k, _: F.substring_index(k, "_", -1))
    row = latest_prior(runs.select(own.alias("counts"), "finished")).first()  # one row
    return dict(row["prior"]) if row else None


def mix_rule(slices: DataFrame, prior: dict[str, float] | None, *, most: float = 0.30) -> DataFrame:
    """The version whose predicted mix lies furthest from the training prior, if by over `most`; without a prior there is no evidence."""
    rows = distribution_shift(slices, prior or {}).where(F.lit(prior is not None and bool(prior)) & (F.col("shift") > most))
    worst = rows.groupBy().agg(F.max_by(F.struct("model_version", "shift"), F.struct("shift", "model_version")).alias("x")).where("x is not null").select("x.*")
    return worst.select(F.lit("prediction_distribution_shift").alias("alert_name"), F.concat(F.lit("prediction_distribution_shift:"), F.col("model_version").cast("string")).alias("dedup_key"), F.format_number("shift", 4).alias("details"))


def record(open_alerts: DataFrame, breaches: DataFrame, evaluated: DataFrame, now_us: int, *, sustained: int, suppression_us: int) -> DataFrame:
    """The state after one run: (dedup_key, action, status, consecutive, first_breached, fired, resolved).

    open_alerts: (dedup_key, consecutive, first_breached, fired); evaluated: (dedup_key) of the keys that had evidence. Keys without
    evidence are left as they are and give no row."""
    keys = evaluated.select("dedup_key").distinct()
    rows = keys.join(open_alerts.withColumn("_open", F.lit(True)), "dedup_key", "left").join(breaches.select("dedup_key").distinct().withColumn("_now", F.lit(True)), "dedup_key", "left")
    is_open, breach = F.coalesce("_open", F.lit(False)), F.coalesce("_now", F.lit(False))
    count = F.when(breach, F.coalesce("consecutive", F.lit(0).cast("long")) + 1).otherwise(F.lit(0).cast("long"))
    fires = (count >= sustained) & (F.col("fired").isNull() | (now_us - F.col("fired") >= suppression_us))
    action = F.when(~breach & is_open, "resolve").when(~breach, "none").when(count < sustained, "accumulate").when(fires, "fire").otherwise("suppress")
    rows = rows.withColumn("action", action).withColumn("_count", count)
    fired = F.when(F.col("fired").isNotNull(), F.col("fired")).when(F.col("action") == "fire", F.lit(now_us))
    return rows.select("dedup_key", "action", F.when(F.col("action") == "resolve", "resolved").when(fired.isNotNull(), "firing").when(breach, "pending").alias("status"), F.col("_count").alias("consecutive"), F.when(breach, F.coalesce("first_breached", F.lit(now_us))).otherwise(F.col("first_breached")).alias("first_breached"), fired.alias("fired"), F.when(F.col("action") == "resolve", F.lit(now_us)).alias("resolved"))
