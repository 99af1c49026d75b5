"""Data quality: freshness, completeness, validity and distribution of each symbol, and the gate over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickflow.functions.registry import FEATURE_NAMES, finite, unpivoted
from tickflow.functions.scalars import DAY_US
from tickflow.operators.halo import by_chunk
from tickflow.sources.sinks import insert_if_absent, months_between, stored, with_month

CHECKS = ("freshness", "completeness", "validity", "distribution")


def freshness(symbols: DataFrame, ticks: DataFrame, now_us: int, limit_us: int) -> DataFrame:
    """(symbol, passed, lag_seconds, issue): whether the newest tick is at most limit old; a symbol without ticks fails."""
    last = ticks.groupBy("symbol").agg(F.max("t").alias("last"))
    return symbols.join(last, "symbol", "left").select("symbol", F.coalesce(F.col("last") >= now_us - limit_us, F.lit(False)).alias("passed"), ((now_us - F.col("last")) / 1e6).alias("lag_seconds"), F.when(F.col("last").isNull(), "no_ticks_observed").when(F.col("last") < now_us - limit_us, "stale").alias("issue"))


def completeness(symbols: DataFrame, ticks: DataFrame, now_us: int, window_us: int, interval_us: int, least: float = 0.95) -> DataFrame:
    """(symbol, passed, actual, expected, ratio) over [now - window, now); the ratio may exceed 1."""
    got = ticks.where((F.col("t") >= now_us - window_us) & (F.col("t") < now_us)).groupBy("symbol").agg(F.count(F.lit(1)).alias("actual"))
    expected = max(window_us // interval_us, 1)
    rows = symbols.join(got, "symbol", "left").withColumn("actual", F.coalesce("actual", F.lit(0).cast("long"))).withColumn("expected", F.lit(expected).cast("long"))
    ratio = F.col("actual") / F.lit(float(expected))
    return rows.select("symbol", (ratio >= least).alias("passed"), "actual", "expected", ratio.alias("ratio"))


def validity(symbols: DataFrame, raw: DataFrame, features: DataFrame, *, order: str = "arrival", chunk_us: int = DAY_US) -> DataFrame:
    """(symbol, passed, non_positive, non_monotonic, null_features, issues): prices not above 0, ticks that arrive after a later one of
    their symbol, and rows of sufficient history that hold a null. raw has `order`, the order of arrival, in the unit of time. However long
    a symbol pauses, a tick is compared with the one before: the last of each chunk is carried into the next that has any."""
    rows = raw.withColumn("chunk", F.floor(F.col(order) / chunk_us))
    ends = rows.groupBy("symbol", "chunk").agg(F.max_by("t", order).alias("_end"))
    ends = ends.select("symbol", "chunk", F.lag("_end").over(Window.partitionBy("symbol").orderBy("chunk")).alias("_before"))
    back = by_chunk("symbol", time=order)
    rows = rows.select("*", F.lag("t").over(back).alias("_in"), F.lag(F.lit(True)).over(back).alias("_has")).join(ends, ["symbol", "chunk"], "left")
    seen = rows.withColumn("_last", F.when(F.col("_has"), F.col("_in")).otherwise(F.col("_before"))).groupBy("symbol").agg(F.count_if(F.col("price") <= 0).alias("non_positive"), F.count_if(F.col("t") < F.col("_last")).alias("non_monotonic"))
    nulls = features.where("not insufficient_history").groupBy("symbol").agg(F.count_if(F.exists(F.array(*FEATURE_NAMES), lambda v: v.isNull())).alias("null_features"))
    rows = symbols.join(seen, "symbol", "left").join(nulls, "symbol", "left").na.fill(0, ["non_positive", "non_monotonic", "null_features"])
    told = [F.when(F.col(c) > 0, F.concat(F.lit(f"{c}:"), F.col(c).cast("string"))) for c in ("non_positive", "non_monotonic", "null_features")]
    return rows.select("symbol", (F.col("non_positive") + F.col("non_monotonic") + F.col("null_features") == 0).alias("passed"), "non_positive", "non_monotonic", "null_features", F.concat_ws(",", *told).alias("issues"))


def distribution(symbols: DataFrame, features: DataFrame, now_us: int, window_us: int, reference_us: int, most: float = 0.5) -> DataFrame:
    """(symbol, passed, shifted, features): features whose mean moved by over `most` of the reference mean; zero or missing ones do not."""
    start = now_us - window_us
    rows = features.where((F.col("t") >= start - reference_us) & (F.col("t") < now_us) & ~F.col("insufficient_history"))
    long = unpivoted(rows.select("symbol", (F.col("t") >= start).alias("live"), *FEATURE_NAMES), ["symbol", "live"]).where(finite(F.col("value")))
    means = long.groupBy("symbol", "feature").agg(F.avg(F.when(F.col("live"), F.col("value"))).alias("mean"), F.avg(F.when(~F.col("live"), F.col("value"))).alias("reference"))  # both of one pass over the features
    moved = means.where("reference <> 0").where(F.abs((F.col("mean") - F.col("reference")) / F.nullif(F.col("reference"), F.lit(0.0))) > most)
    moved = moved.groupBy("symbol").agg(F.count(F.lit(1)).alias("shifted"), F.concat_ws(",", F.array_sort(F.collect_list("feature"))).alias("features"))
    return symbols.join(moved, "symbol", "left").select("symbol", F.col("shifted").isNull().alias("passed"), F.coalesce("shifted", F.lit(0).cast("long")).alias("shifted"), F.coalesce("features", F.lit("")).alias("features"))


def audit_rows(checks: dict[str, DataFrame], now_us: int, start_us: int) -> DataFrame:
    """The rows that a run appends: check_name, symbol, passed, details (JSON), window bounds and time of the check."""
    out = None
    for name, df in checks.items():
        rows = df.select(F.lit(name).alias("check_name"), "symbol", "passed", F.to_json(F.struct(*[c for c in df.columns if c not in ("symbol", "passed")])).alias("details"), F.lit(start_us).alias("window_start"), F.lit(now_us).alias("window_end"), F.lit(now_us).alias("checked_at"))
        out = rows if out is None else out.unionByName(rows)
    return out


def latest_status(audit: DataFrame, since_us: int | None = None) -> DataFrame:
    """(check_name, passed, checked_at) of the newest run of each check: passed if all its rows are; a check that never ran has a null."""
    rows = audit if since_us is None else audit.where(F.col("checked_at") >= since_us)
    last = rows.groupBy("check_name").agg(F.max("checked_at").alias("checked_at"))
    state = rows.join(last, ["check_name", "checked_at"]).groupBy("check_name", "checked_at").agg(F.bool_and(F.coalesce("passed", F.lit(False))).alias("passed"))
    names = audit.sparkSession.createDataFrame([(c,) for c in CHECKS], "check_name string")
    return names.join(state, "check_name", "left").select("check_name", "passed", "checked_at")


def gate(audit: DataFrame, since_us: int) -> DataFrame:
    """One row (open, missing, failed): open only if every check ran since then and its newest run passed. Absence is no pass."""
    s = latest_status(audit, since_us)
    return s.agg(F.bool_and(F.coalesce("passed", F.lit(False))).alias("open"), F.count_if(F.col("passed").isNull()).alias("missing"), F.count_if(F.col("passed") == F.lit(False)).alias("failed"))


AUDIT_KEYS = (("check_name", "symbol", "window_end", "checked_at"),)


def store_audit(rows: DataFrame, path: str) -> None:
    """Append a run's audit rows, by the month of their time; a run that is stored again adds nothing."""
    insert_if_absent(with_month(rows, "checked_at"), path, AUDIT_KEYS, partition="month")


def stored_gate(spark: SparkSession, path: str, since_us: int, now_us: int) -> DataFrame:
    """gate() over the stored audit rows: only the months from since_us to now_us are read. Without a table the gate is shut."""
    like = spark.createDataFrame([], "check_name string, symbol string, passed boolean, details string, window_start long, window_end long, checked_at long, month string")
    rows = stored(spark, path, like)
    return gate(rows.where(F.col("month").isin(months_between(since_us, now_us + 1)) & (F.col("checked_at") <= now_us)), since_us)
