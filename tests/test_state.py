"""Keyed window state: the stream's features are the batch's, in any order of arrival, after restarts, and without stored history."""

import os
from datetime import UTC, datetime

from pyspark.sql import functions as F

from tickflow.functions.registry import FEATURE_NAMES
from tickflow.functions.scalars import DAY_US, HOUR_US, MINUTE_US
from tickflow.operators.features import compute_features
from tickflow.sources.ingest import encode
from tickflow.streaming import state

T0 = int(datetime(2024, 3, 1, tzinfo=UTC).timestamp()) * 1_000_000
COLUMNS = ["symbol", "t", "price", *FEATURE_NAMES, "insufficient_history", "has_gap"]


def made(spark, n, step=10 * MINUTE_US, symbols=("X", "Y")):
    rows = [(s, T0 + k * step, 100.0 + 5 * ((k % 7) - 3) + 0.1 * k + len(s), 10.0 + k % 4, f"{s}{k}") for s in symbols for k in range(n)]
    return spark.createDataFrame(rows, "symbol string, t long, price double, volume double, message_id string").persist()


def put(rows, root, name):
    stamped = rows.select("message_id", F.lit("c").alias("correlation_id"), F.lit(1).alias("schema_version"), F.timestamp_micros("t").alias("emitted_at"), "symbol", F.timestamp_micros("t").alias("observed_at"), "price", "volume")
    encode(stamped).coalesce(1).write.text(f"{root}/in/{name}")


def run(spark, root, **options):
    source = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).text(f"{root}/in")
    query = state.ingest_windowed(source, f"{root}/out", **options)
    query.awaitTermination()
    return query


def same_features(spark, root, *known):
    """known: what was known after each run; a tick's features are of what was known when it came."""
    want = {}
    for ticks in known:
        want = {tuple(r)[:2]: r for r in compute_features(ticks.select("symbol", "t", "price", "volume")).select(*COLUMNS).collect()} | want
    got = [r for r in spark.read.parquet(f"{root}/out/features").select(*COLUMNS).collect()]
    assert len(got) == len({tuple(r)[:2] for r in got})
    for r in got:
        for c, a, b in zip(COLUMNS, r, want[tuple(r)[:2]], strict=True):
            assert a == b or abs(a - b) < 1e-9, (r.symbol, (r.t - T0) // MINUTE_US, c)
    return {tuple(r)[:2] for r in got}, set(want)


def test_any_order_restart_and_no_history(spark, tmp_path):
    ticks = made(spark, 400)  # 66 hours
    n = F.substring("message_id", 2, 9).cast("int")
    put(ticks.where(n < 150).orderBy(F.rand(1)), tmp_path, "a")
    put(ticks.where((n >= 150) & (n < 260) & (n % 10 != 3)).orderBy(F.rand(2)), tmp_path, "b")
    run(spark, tmp_path)
    os.rename(tmp_path / "out/ticks", tmp_path / "away")  # no stored history from here on
    # ticks of an hour and less that come late, among new ones, and repeats of old ones
    put(ticks.where((n >= 256) & (n < 300) | (n == 253)).orderBy(F.rand(3)), tmp_path, "c")
    put(ticks.where(n >= 300).orderBy(F.rand(4)), tmp_path, "d")
    run(spark, tmp_path, lateness_us=HOUR_US + 10 * MINUTE_US)
    first = ticks.where((n < 150) | (n < 260) & (n % 10 != 3))
    known = ticks.where((n < 150) | (n >= 260) | (n % 10 != 3) | (n == 253))
    got, want = same_features(spark, tmp_path, first, known)
    assert got == want
    assert spark.read.parquet(f"{tmp_path}/out/features").where("not insufficient_history").count() > 100


def test_too_late_is_stored_without_features(spark, tmp_path):
    ticks = made(spark, 40)
    late = F.col("message_id") == "X5"
    put(ticks.where(~late), tmp_path, "a")
    run(spark, tmp_path)
    put(ticks.where(late), tmp_path, "b")
    run(spark, tmp_path)
    assert spark.read.parquet(f"{tmp_path}/out/ticks").count() == 80
    got, want = same_features(spark, tmp_path, ticks.where(~late))
    assert got == want and ("X", T0 + 5 * 10 * MINUTE_US) not in got


def test_a_lagging_symbol_loses_nothing(spark, tmp_path):
    """Y's ticks are two days behind X's: no watermark of all symbols drops them."""
    ticks = made(spark, 30)
    ticks = ticks.withColumn("t", F.when(F.col("symbol") == "X", F.col("t") + 2 * DAY_US).otherwise(F.col("t")))
    for k in range(3):
        put(ticks.where(F.substring("message_id", 2, 9).cast("int") % 3 == k) if k else ticks.where("symbol = 'X'"), tmp_path, f"{k}")
    run(spark, tmp_path, lateness_us=6 * HOUR_US)
    rest = ticks.where("symbol = 'X' or substring(message_id, 2, 9) % 3 > 0")
    stored = spark.read.parquet(f"{tmp_path}/out/features")
    assert stored.count() == rest.count() and stored.where("symbol = 'Y'").count() == 20


def test_initial_state(spark, tmp_path):
    ticks = made(spark, 400)
    cut = T0 + 250 * 10 * MINUTE_US
    ticks.where(F.col("t") < cut).withColumn("month", F.lit("2024-03")).write.partitionBy("month").parquet(f"{tmp_path}/past/ticks")
    put(ticks.where(F.col("t") >= cut), tmp_path, "a")
    run(spark, tmp_path, initial=state.recent(spark, f"{tmp_path}/past", cut))
    got, want = same_features(spark, tmp_path, ticks)
    assert got == {k for k in want if k[1] >= cut}
    assert spark.read.parquet(f"{tmp_path}/out/features").where("insufficient_history").count() == 0


def test_state_is_bounded_and_expires(spark, tmp_path):
    """The state's rows follow the kept time, not the stream's age, and a silent symbol goes."""
    ticks = made(spark, 2000)
    n = F.substring("message_id", 2, 9).cast("int")
    for k in range(2):
        put(ticks.where((n >= 1000 * k) & (n < 1000 * (k + 1)) & ((F.col("symbol") == "X") | F.lit(k == 0))), tmp_path, f"{k}")
    query = run(spark, tmp_path, history_us=HOUR_US * 27)
    held = spark.read.format("statestore").option("stateVarName", "ticks").load(f"{tmp_path}/out/checkpoint").groupBy("key.symbol").count().collect()
    counts = {r["symbol"]: r["count"] for r in held}
    assert counts["X"] < 3 * 6 * 28 and query.lastProgress is not None


def test_dead_letters(spark, tmp_path):
    put(made(spark, 3), tmp_path, "a")
    spark.createDataFrame([("not json",)], "value string").write.text(f"{tmp_path}/in/z")
    source = spark.readStream.schema("value string").option("recursiveFileLookup", True).text(f"{tmp_path}/in")
    for _ in range(2):
        state.dead_letters(source, f"{tmp_path}/out").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out/dead_letters").count() == 1
