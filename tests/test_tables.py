"""Sources, sinks, streams and archives."""

import pytest
from pyspark.sql import functions as F

from tickflow.functions.scalars import DAY_US, MINUTE_US
from tickflow.operators.features import compute_features
from tickflow.sources import ingest, sinks
from tickflow.streaming import ingest as stream

GOOD = '{"message_id":"1","correlation_id":"c","schema_version":1,"emitted_at":"2024-01-01T00:00:00Z","symbol":"X","payload":{"price":"1.5","volume":2,"provider_observed_at":"2024-01-01T01:00:00+01:00"}}'


def test_decode(spark):
    bad = [GOOD.replace('"1.5"', '"0"'), GOOD.replace('"X"', '" "'), GOOD.replace("+01:00", ""), GOOD.replace(":2,", ":-1,"), GOOD.replace('"1.5"', '"abc"'), "not json", GOOD.replace('"message_id":"1",', "")]
    rows = ingest.decode(spark.createDataFrame([(x,) for x in [GOOD, *bad]], "value string"))
    valid, dead = ingest.split_valid(rows)
    one = valid.select(F.unix_micros("observed_at").alias("t"), F.col("price").cast("double").alias("p")).collect()
    assert [(r.t, r.p) for r in one] == [(1704067200000000, 1.5)]
    assert sorted(r.fault for r in dead.collect()) == sorted(["price", "symbol", "observed_at", "volume", "price", "symbol", "message_id"])
    assert {r.reason for r in dead.collect()} == {"dead.validation"}


def test_sources(spark):
    h = spark.createDataFrame([("X", [[1000.0, 5.0], [2000.0, 6.0]], [[1000.0, 7.0]])], "symbol string, prices array<array<double>>, total_volumes array<array<double>>")
    assert [tuple(r) for r in ingest.history_rows(h).collect()] == [("X", 1_000_000, 5.0, 7.0)]
    s = spark.createDataFrame([('{"btc":{"usd":9.5},"eth":{"eur":1},"doge":{"usd":1}}',)], "value string")
    names = spark.createDataFrame([("btc", "BTC"), ("eth", "ETH")], "coin string, symbol string")
    assert [tuple(r) for r in ingest.spot_rows(s, names, 77).collect()] == [("BTC", 77, 9.5, 0.0)]
    assert ingest.envelopes(ingest.history_rows(h)).select("message_id").distinct().count() == 1


def test_insert_either_key(spark, tmp_path):
    path = f"{tmp_path}/ticks"
    frame = lambda rows: spark.createDataFrame(rows, "symbol string, t long, message_id string")
    sinks.insert_if_absent(frame([("X", 1, "a"), ("X", 1, "b"), ("Y", 1, "c")]), path, sinks.TICK_KEYS)
    sinks.insert_if_absent(frame([("X", 1, "z"), ("Z", 1, "c"), ("X", 2, "a")]), path, sinks.TICK_KEYS)
    got = {(r.symbol, r.t, r.message_id) for r in spark.read.parquet(path).collect()}
    assert got == {("X", 1, "a"), ("Y", 1, "c"), ("X", 2, "a")}


def test_archive_keeps_source_of_a_bad_copy(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/ticks"
    rows = sinks.with_month(spark.createDataFrame([("X", k * DAY_US) for k in range(40)], "symbol string, t long"))
    rows.write.partitionBy("month").parquet(path)
    real = sinks.fingerprint
    calls = []
    monkeypatch.setattr(sinks, "fingerprint", lambda df: (0, len(calls)) if calls.append(1) or len(calls) == 2 else real(df))
    with pytest.raises(OSError):
        sinks.archive_month(spark, path, f"{tmp_path}/a", f"{tmp_path}/audit", "1970-01")
    monkeypatch.setattr(sinks, "fingerprint", real)
    assert spark.read.parquet(path).count() == 40
    assert sinks.archive_month(spark, path, f"{tmp_path}/a", f"{tmp_path}/audit", "1970-01").first()["rows"] == 31
    assert spark.read.parquet(path).count() == 9
    assert sinks.archivable_months(rows, 200 * DAY_US, 5) == ["1970-01"]


def test_months():
    assert sinks.months_between(0, 31 * DAY_US) == ["1970-01"]
    assert sinks.months_between(0, 31 * DAY_US + 1) == ["1970-01", "1970-02"]


def _message(k, t, symbol="X"):
    return GOOD.replace('"message_id":"1"', f'"message_id":"{k}"').replace('"X"', f'"{symbol}"').replace("2024-01-01T01:00:00+01:00", t).replace('"1.5"', f'"{100 + k % 7}"')


def test_stream_restart_and_duplicates(spark, tmp_path):
    messages = [_message(k, f"2024-01-01T{k // 60:02d}:{k % 60:02d}:00Z") for k in range(120)]
    parts = [messages[:50] + ["junk"], messages[40:90], messages[90:] + messages[:5]]
    for k, part in enumerate(parts):  # a restart between the files
        spark.createDataFrame([(m,) for m in part], "value string").coalesce(1).write.mode("append").text(f"{tmp_path}/in")
        stream.ingest(spark.readStream.schema("value string").text(f"{tmp_path}/in"), f"{tmp_path}/out").awaitTermination()
    ticks = spark.read.parquet(f"{tmp_path}/out/ticks")
    assert ticks.count() == 120 and spark.read.parquet(f"{tmp_path}/out/dead_letters").count() == 1
    want = compute_features(ticks)
    got = spark.read.parquet(f"{tmp_path}/out/features").select(*want.columns)
    r = lambda df: df.select(*[F.round(c, 9).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])
    assert got.count() == 120 and r(got).exceptAll(r(want)).count() == 0


def test_replay_after_a_crash_between_sinks(spark, tmp_path):
    rows = ingest.decode(spark.createDataFrame([(_message(k, f"2024-01-01T00:{k:02d}:00Z"),) for k in range(20)], "value string"))
    valid, _ = ingest.split_valid(rows)
    sinks.insert_if_absent(stream._ticks(valid), f"{tmp_path}/ticks", sinks.TICK_KEYS, partition="month")  # the batch died here
    stream.process(rows, str(tmp_path))
    stream.process(rows, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/features").count() == 20 and spark.read.parquet(f"{tmp_path}/ticks").count() == 20


def test_backfill_converges(spark, tmp_path):
    rows = spark.createDataFrame([("X", 100 * DAY_US + k * MINUTE_US, 1.0 + k, 1.0, str(k)) for k in range(180)], "symbol string, t long, price double, volume double, message_id string")
    stream.seed(rows.where("t < " + str(100 * DAY_US + 60 * MINUTE_US)), str(tmp_path))
    sinks.insert_if_absent(sinks.with_month(rows), f"{tmp_path}/ticks", sinks.TICK_KEYS, partition="month")
    for _ in range(2):
        stream.backfill(spark, str(tmp_path), 100 * DAY_US + 60 * MINUTE_US, 101 * DAY_US)
    assert spark.read.parquet(f"{tmp_path}/features").count() == 180
    with pytest.raises(ValueError):
        stream.backfill(spark, str(tmp_path), 0, 1, version=2)


def test_backfill_by_days_goes_on_where_it_was_killed(spark, tmp_path):
    root, hours = str(tmp_path), 6
    rows = spark.createDataFrame([("X", 100 * DAY_US + k * DAY_US // hours, 1.0 + k, 1.0, str(k)) for k in range(5 * hours)], "symbol string, t long, price double, volume double, message_id string")
    put = lambda df: sinks.insert_if_absent(sinks.with_month(df), f"{root}/ticks", sinks.TICK_KEYS, partition="month")
    day = lambda k: (100 + k) * DAY_US
    put(rows)

    def killed(lo, hi):
        if lo == day(1):
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        stream.backfill_days(spark, root, day(0), day(5), after_chunk=killed)
    assert spark.read.parquet(f"{root}/features").count() == 2 * hours
    half = day(4) + DAY_US // 2
    assert stream.backfill_days(spark, root, day(0), half) == [(day(2), day(3)), (day(3), day(4)), (day(4), half)]
    assert spark.read.parquet(f"{root}/features").count() == 4 * hours + hours // 2
    # the day that was done in part is not noted, the others are
    assert stream.backfill_days(spark, root, day(0), day(5), days=3) == [(day(4), day(5))]
    assert stream.backfill_days(spark, root, day(0), day(5)) == []
    # ticks that come later open the days of their month again; what is stored stays
    put(rows.where("message_id = '7'").withColumns({"t": F.col("t") + MINUTE_US, "message_id": F.lit("late")}))
    assert stream.backfill_days(spark, root, day(0), day(5), days=3) == [(day(0), day(3)), (day(3), day(5))]
    whole = spark.read.parquet(f"{root}/features")
    assert whole.count() == 5 * hours + 1 and whole.select("symbol", "t").distinct().count() == 5 * hours + 1


def test_replay_of_a_batch_with_dead_letters(spark, tmp_path):
    rows = ingest.decode(spark.createDataFrame([(_message(k, f"2024-01-01T00:{k:02d}:00Z"),) for k in range(9)] + [("junk",)], "value string"))
    for _ in range(2):
        stream.process(rows, str(tmp_path), batch_id=3)
    stream.process(rows.where("reason is not null"), str(tmp_path), batch_id=4)
    assert spark.read.parquet(f"{tmp_path}/dead_letters").count() == 2 and spark.read.parquet(f"{tmp_path}/ticks").count() == 9


def test_late_ticks_and_months(spark, tmp_path):
    """A tick of an earlier month that comes late is stored and gets its features; what is stored already stays."""
    decoded = lambda times: ingest.decode(spark.createDataFrame([(_message(int(t[8:10]) * 10_000 + int(t[14:16]) * 100 + int(t[17:19]), t),) for t in times], "value string"))
    first = [f"2024-02-01T00:{k:02d}:00Z" for k in range(8)]
    stream.process(decoded(first), str(tmp_path), batch_id=0)
    stream.process(decoded(["2024-01-31T23:59:00Z", "2024-02-01T00:03:30Z", first[0]]), str(tmp_path), batch_id=1)
    ticks, features = spark.read.parquet(f"{tmp_path}/ticks"), spark.read.parquet(f"{tmp_path}/features")
    assert ticks.count() == features.count() == 10 and {r.month for r in ticks.select("month").distinct().collect()} == {"2024-01", "2024-02"}
    late = features.join(ticks.where("message_id in ('315900', '10330')"), ["symbol", "t"], "left_semi").select("symbol", "t", "volume_change")
    want = compute_features(ticks).select("symbol", "t", "volume_change")
    assert late.count() == 2 and late.exceptAll(want).count() == 0


def test_expiry(spark, tmp_path):
    """GOOD was emitted at 2024-01-01T00:00:00Z."""
    spark.createDataFrame([(_message(k, f"2024-01-01T00:{k:02d}:00Z"),) for k in range(3)], "value string").write.text(f"{tmp_path}/in")
    source = lambda: spark.readStream.schema("value string").text(f"{tmp_path}/in")
    at = 1_704_067_200_000_000
    stream.ingest(source(), f"{tmp_path}/kept", expire_us=60 * MINUTE_US, clock=lambda: at + 59 * MINUTE_US).awaitTermination()
    stream.ingest(source(), f"{tmp_path}/gone", expire_us=60 * MINUTE_US, clock=lambda: at + 61 * MINUTE_US).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/kept/ticks").count() == 3 and spark.read.parquet(f"{tmp_path}/kept/dead_letters").count() == 0
    assert {r.reason for r in spark.read.parquet(f"{tmp_path}/gone/dead_letters").collect()} == {"dead.expired"} or spark.read.parquet(f"{tmp_path}/gone/dead_letters").count() == 3


def test_only_the_rows_months_are_read(spark, tmp_path):
    rows = sinks.with_month(spark.createDataFrame([("X", k * 20 * DAY_US, str(k)) for k in range(6)], "symbol string, t long, message_id string"))
    sinks.insert_if_absent(rows, f"{tmp_path}/t", sinks.TICK_KEYS, partition="month")
    table = sinks.in_partitions(sinks.stored(spark, f"{tmp_path}/t", rows), "month", sinks.partitions_of(rows.where("t = 0"), "month"))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "1970-01" in plan
    sinks.insert_if_absent(rows, f"{tmp_path}/t", sinks.TICK_KEYS, partition="month")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 6


def test_stream_rates_and_duplicates(spark, tmp_path):
    messages = [_message(k, f"2024-01-01T0{k // 30}:{k % 30:02d}:00Z") for k in range(60)]
    spark.createDataFrame([(m,) for m in [*messages, *messages[:7], "junk"]], "value string").coalesce(1).write.text(f"{tmp_path}/in")
    decoded = ingest.decode(spark.readStream.schema("value string").text(f"{tmp_path}/in"))

    def ran(frame, name, mode):
        frame.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/{name}").start().awaitTermination()
        return spark.table(name)

    assert ran(stream.deduplicated_stream(decoded), "once", "append").count() == 60
    assert sorted(r.n for r in ran(stream.rate_stream(decoded), "rates", "complete").collect()) == [30, 37]


def test_outcomes_are_stored_once(spark, tmp_path):
    from tickflow.operators import attribution

    h = 15 * MINUTE_US
    ticks = spark.createDataFrame([("X", k * MINUTE_US, 1.0 + k) for k in range(60)], "symbol string, t long, price double")
    predictions = spark.createDataFrame([("X", k * MINUTE_US, "1", "UP", k * MINUTE_US) for k in (1, 2, 50)], "symbol string, t long, model_version string, predicted string, predicted_t long")
    run = lambda now, **more: attribution.attribution_run(predictions, f"{tmp_path}/o", ticks.where(F.col("t") <= now), now_us=now, horizon_us=h, tolerance_us=MINUTE_US, start_us=0, **more)
    runs = spark.createDataFrame([(0.5, 2), (9.0, 1)], "theta double, finished long")
    with pytest.raises(attribution.NoTheta):
        run(20 * MINUTE_US)
    with pytest.raises(attribution.NoTheta):
        run(20 * MINUTE_US, runs=runs.where("false"))
    assert run(20 * MINUTE_US, runs=runs).first()["n"] == 2
    assert run(20 * MINUTE_US, theta=0.5).first()["n"] == 2 and spark.read.parquet(f"{tmp_path}/o").count() == 2
    run(70 * MINUTE_US, theta=0.5)  # the tick a horizon after the last prediction never came: it is not stored
    assert spark.read.parquet(f"{tmp_path}/o").count() == 2


def test_stages_and_drift_without_production(spark, tmp_path):
    from tickflow.operators import drift, model

    root = str(tmp_path)
    live = spark.createDataFrame([(5, 1.0, False)], "t long, ma_5m double, insufficient_history boolean").withColumns({n: F.lit(1.0) for n in model.FEATURE_NAMES if n != "ma_5m"})
    assert model.production_version(spark, root) is None and drift.drift_run(live, model.production_stats(spark, root), 10, 10).count() == 0
    model.transition(spark, root, "1", "Staging", 1)
    assert model.production_version(spark, root) is None
    model.transition(spark, root, "1", "Production", 2)
    assert model.production_stats(spark, root) is None
    model.transition(spark, root, "2", "Production", 3)
    assert model.production_version(spark, root) == "2"
    stages = {r.model_version: r.stage for r in sinks.latest_stage(spark.read.parquet(f"{root}/stages")).collect()}
    assert stages == {"1": "Archived", "2": "Production"}
    model.save_stats(spark.createDataFrame([("ma_5m", 1.0, 0.0, 1.0, 1.0, 1.0), ("roc_1m", 2.0, 1.0, -9.0, 9.0, 2.0)], "feature string, mean double, std double, min double, max double, p50 double"), root, "2")
    rows = drift.drift_run(live, model.production_stats(spark, root), 10, 10).collect()
    assert {(r.feature, r.metric, r.model_version) for r in rows} == {(f, m, "2") for f in ("ma_5m", "roc_1m") for m in ("psi", "ks")}
    samples = drift.reference_samples(model.production_stats(spark, root)[1], 2000)
    told = {r.feature: (r.m, r.s) for r in samples.groupBy("feature").agg(F.avg("value").alias("m"), F.stddev("value").alias("s")).collect()}
    assert told["ma_5m"] == (1.0, 0.0) and abs(told["roc_1m"][0] - 2) < 0.1 and abs(told["roc_1m"][1] - 1) < 0.1


def test_listings(spark):
    from tickflow.operators import alerts, panels, scans

    rows = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", 2, "y")], "k string, t long, v string")
    assert [r.k for r in scans.listing(rows, 1, "t", newest_first=["t"], then=["k"]).collect()] == ["b", "c", "a"]
    assert [r.k for r in scans.listing(rows, 2, "t", newest_first=["t"], equal={"v": "y", "k": None}).collect()] == ["c"]
    assert scans.lookup(rows, k="b").first()["t"] == 2 and scans.lookup(rows, k="q").count() == 0
    for bad in ({}, {"k": None}):
        with pytest.raises(ValueError):
            scans.lookup(rows, **bad)
    with pytest.raises(ValueError):
        scans.recent_page(rows, ["t"], now_us=5, days=31)
    assert [r.k for r in scans.recent_page(rows, ["t", "k"], now_us=2, limit=1, equal={"v": "x"}).collect()] == ["b"]
    opened = spark.createDataFrame([("a", "firing", 1), ("a", "pending", 3), ("b", "resolved", 9), ("c", "firing", 2)], "dedup_key string, status string, updated long")
    assert [r.updated for r in alerts.open_alerts(opened).collect()] == [3, 2, 1]
    assert [r.updated for r in alerts.open_alerts(opened, "a").collect()] == [3] and alerts.open_alerts(opened, "b").count() == 0
    drift = spark.createDataFrame([("f", "stable", 1), ("g", "moderate", 1)], "feature string, severity string, window_end long")
    assert panels.drift_summary(drift).first() == ("moderate", 1, 1) and panels.drift_summary(drift.where("false")).first()["status"] == "never_ran"
    audit = spark.createDataFrame([(True,)], "passed boolean")
    assert panels.quality_summary(audit).first()["all_passed"] and not panels.quality_summary(audit.where("false")).first()["all_passed"]


def test_quantiles(spark):
    import numpy as np

    from tickflow.operators.quantiles import quantiles

    rng = np.random.default_rng(1)
    data = {"few": [3.0, 1.0], "one": [7.0], "ties": rng.integers(0, 4, 500).astype(float).tolist(), "many": rng.normal(size=3000).tolist()}
    rows = spark.createDataFrame([(f, v) for f, x in data.items() for v in x] + [("few", None), ("none", None)], "feature string, value double")
    at = [0.0, 0.1, 0.4, 0.5, 0.99, 1.0]
    got = {r.feature: list(r.q) for r in quantiles(rows, at).collect()}
    assert got.keys() == data.keys() and all(np.allclose(got[f], np.quantile(x, at)) for f, x in data.items())


def test_predictions_of_ticks_of_one_time_are_all_stored(spark, tmp_path):
    """Attribution with several ticks of a symbol and time gives what its SQL gives: a prediction for each, with the price of each."""
    import duckdb

    from tests.oracle import same
    from tickflow.plans import registry

    # every three hours one to three ticks of one time, and one tick 70 minutes later
    ticks = "SELECT k * 10 + j AS event_id, k * 180 AS m, 10.0 + (k * 5 + j * 4) % 9 AS value FROM range(60) a(k), range(3) b(j) WHERE j <= k % 3 UNION ALL SELECT 1000 + k, k * 180 + 70, 12.0 + k % 3 FROM range(60) a(k)"
    duckdb.sql(f"""COPY (SELECT event_id, TIMESTAMP '2024-01-12' + to_minutes(m) AS ts, 1::BIGINT AS user_id, 'view' AS event_type, value::DOUBLE AS value, '{{"k": 1}}' AS props FROM ({ticks})) TO '{tmp_path}/events.parquet' (FORMAT parquet)""")
    for name in ("outcomes_stored", "attribution_run"):
        same(registry.QUERIES[name](spark, str(tmp_path)), registry.SQL[name], str(tmp_path))


def test_a_batch_computes_its_features_once(spark, tmp_path, monkeypatch):
    """To store features, a batch computes them once, not once more to learn their months."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def told(price):
        seen.add(1)
        return price

    monkeypatch.setattr(stream, "compute_features", lambda ticks, **more: compute_features(ticks.withColumn("price", told("price")), **more))
    spark.createDataFrame([(_message(k, f"2024-01-01T00:{k:02d}:00Z"),) for k in range(30)], "value string").write.text(f"{tmp_path}/in")
    stream.process(ingest.decode(spark.read.text(f"{tmp_path}/in")), f"{tmp_path}/out")
    assert seen.value == spark.read.parquet(f"{tmp_path}/out/features").count() == 30
