"""Labels, splits, metrics, drift, alerts, quality and joins, against values by hand or step-by-step versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickflow.functions.registry import FEATURE_NAMES
from tickflow.functions.scalars import DAY_US, MINUTE_US, label_of, psi_severity
from tickflow.operators import alerts, attribution, baselines, dataset, drift, metrics, quality
from tickflow.operators.asof import backward_last, forward_join, forward_self


def test_labels(spark):
    rows = spark.createDataFrame([(0.05,), (-0.05,), (0.01,), (-0.01,), (None,)], "ret double").select(label_of(F.col("ret"), 0.01).alias("x"))
    assert [r.x for r in rows.collect()] == ["UP", "DOWN", "STABLE", "STABLE", None]
    with pytest.raises(ValueError):
        label_of(F.col("ret"), -1)


def test_asof_forward(spark):
    rng = random.Random(3)
    pts = sorted({("ab"[rng.randrange(2)], rng.randrange(100_000)) for _ in range(400)})
    right = spark.createDataFrame([(s, t, float(t)) for s, t in pts], "symbol string, t long, v double")
    left = spark.createDataFrame([("ab"[k % 2], rng.randrange(100_000), k) for k in range(300)], "symbol string, target long, k int")
    got = {r.k: r.future_t for r in forward_join(left, right, "target", "v", 200).collect()}
    for r in left.collect():
        want = min((t for s, t in pts if s == r.symbol and r.target <= t <= r.target + 200), default=None)
        assert got[r.k] == want
    own = {(r.symbol, r.t): r.future_t for r in forward_self(right, "v", 500, 100).collect()}
    for s, t in pts:
        assert own[s, t] == min((u for q, u in pts if q == s and t + 500 <= u <= t + 600), default=None)


def test_asof_tolerance_edge(spark):
    ticks = spark.createDataFrame([("X", -30, 1.0), ("X", 20, 2.0), ("X", 90, 3.0)], "symbol string, t long, v double")
    probe = spark.createDataFrame([("X", 0)], "symbol string, target long")
    assert forward_join(probe, ticks, "target", "v", 60).first()["future"] == 2.0
    assert forward_join(probe, ticks, "target", "v", 19).first()["future"] is None


def test_persistence(spark):
    m = MINUTE_US
    history = spark.createDataFrame([("X", 0, "UP"), ("X", 5 * m, "DOWN")], "symbol string, t long, label string")
    test = spark.createDataFrame([("X", 10 * m, "UP"), ("X", 16 * m, "UP"), ("X", 21 * m, "UP")], "symbol string, t long, label string")
    rows = baselines.persistence(history, test, 15 * m, "STABLE").orderBy("t").collect()
    assert [r.predicted for r in rows] == ["STABLE", "UP", "DOWN"]
    rows = baselines.persistence(history, test, 15 * m, "STABLE", by_symbol=True).orderBy("t").collect()
    assert [r.predicted for r in rows] == ["STABLE", "UP", "DOWN"]


def test_backward_over_buckets(spark):
    rng = random.Random(1)
    known = sorted({rng.randrange(10_000) for _ in range(60)})
    asked = [rng.randrange(10_000) for _ in range(80)]
    h = spark.createDataFrame([(t, str(t)) for t in known], "t long, v string")
    q = spark.createDataFrame([(t, k) for k, t in enumerate(asked)], "t long, k int")
    got = {r.k: r["last"] for r in backward_last(h, q, "v", bucket_us=97).collect()}
    assert got == {k: max((str(u) for u in known if u <= t), key=int, default=None) for k, t in enumerate(asked)}


@pytest.mark.parametrize("n", [2, 3, 4, 10, 301])
def test_split(spark, n):
    rows = spark.createDataFrame([("X", k * MINUTE_US) for k in range(n)], "symbol string, t long")
    got = {r.t // MINUTE_US: r.split for r in dataset.split(rows, 2 * MINUTE_US, bucket_us=17 * MINUTE_US).collect()}
    want = {}
    if n >= 3:
        ti = max(1, int(n * 0.70))
        vi = min(max(ti + 1, int(n * (0.70 + 0.15))), n - 1)
        T, V = ti - 1, vi - 1
        for k in range(n):
            part = "train" if k <= T - 2 else "validation" if T < k <= V - 2 else "test" if k > V else None
            if part:
                want[k] = part
    assert got == want


def test_sufficiency(spark):
    rows = spark.createDataFrame([("train", "UP")], "split string, label string")
    with pytest.raises(dataset.InsufficientData):
        dataset.check_sufficiency(rows.unionByName(rows.withColumn("split", F.lit("test"))))


def test_brier_and_f1(spark):
    rows = spark.createDataFrame([("m", "UP", "UP", [0.2, 0.3, 0.5]), ("m", "DOWN", "DOWN", [0.6, 0.3, 0.1])], "model string, actual string, predicted string, p array<double>")
    assert metrics.summary(rows).first()["brier"] == pytest.approx(0.32)
    down = spark.createDataFrame([("m", "DOWN", "DOWN", [1.0, 0.0, 0.0])] * 3, "model string, actual string, predicted string, p array<double>")
    one = metrics.summary(down).first()
    assert one["macro_f1"] == pytest.approx(1 / 3) and one["accuracy"] == 1 and one["logloss"] == pytest.approx(0)
    assert metrics.summary(down.where("false")).count() == 0


def test_bucket_accuracy(spark):
    rows = spark.createDataFrame([("m", "X", k, "UP", "UP" if k // 33 != 1 else "DOWN") for k in range(99)], "model string, symbol string, t long, actual string, predicted string")
    got = [r.accuracy for r in metrics.bucket_accuracy(rows, 3, chunk_us=10).orderBy("bucket").collect()]
    assert got[0] == 1 and got[1] < 0.5 and got[2] == 1
    sizes = metrics.bucket_accuracy(rows.limit(23), 5).orderBy("bucket").collect()
    assert [r.n for r in sizes] == [5, 5, 5, 4, 4]


def test_shift(spark):
    slices = spark.createDataFrame([("1", 0.1, 0.6, 0.3)], "model_version string, share_DOWN double, share_STABLE double, share_UP double")
    assert metrics.distribution_shift(slices, {"DOWN": 0.3, "STABLE": 0.4, "UP": 0.3}).first()["shift"] == pytest.approx(0.2)


@pytest.mark.parametrize(("f1", "brier", "recall", "inc", "want"), [(0.5, 0.5, 0.5, None, ""), (0.3, 0.5, 0.5, None, "macro F1 not above majority"), (0.5, 0.5, 0.0, None, "recall too low for UP"), (0.5, 0.7, 0.5, None, "Brier score no better than equal probabilities"), (0.5, 0.5, 0.5, 0.6, "macro F1 below the incumbent"), (0.5, 0.5, 0.5, 0.5, "")])
def test_promotion(spark, f1, brier, recall, inc, want):
    rows = [("candidate", f1, brier), ("majority", 0.3, 0.6)] + ([("incumbent", inc, 0.5)] if inc else [])
    s = spark.createDataFrame(rows, "model string, macro_f1 double, brier double")
    r = spark.createDataFrame([("candidate", "UP", recall), ("candidate", "DOWN", 0.9)], "model string, label string, recall double")
    got = baselines.promotion(s, r).first()
    assert got["reason"] == want and got["promoted"] is (want == "")


def test_no_candidate_is_no_promotion(spark):
    s = spark.createDataFrame([("majority", 0.3, 0.6)], "model string, macro_f1 double, brier double")
    r = spark.createDataFrame([], "model string, label string, recall double")
    assert baselines.promotion(s, r).first()["promoted"] is False


def _long(spark, values, feature="f"):
    return spark.createDataFrame([(feature, None if v is None else float(v)) for v in values], "feature string, value double")


def _psi(ref, live, bins=10):
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, bins + 1)))
    edges[0], edges[-1] = -np.inf, np.inf
    r, o = (np.maximum(np.histogram(x, edges)[0] / len(x), 1e-6) for x in (ref, live))
    return float(((o - r) * np.log(o / r)).sum())


@pytest.mark.parametrize("live", [range(0, 1000, 3), [5] * 90 + list(range(900)), [-50, 2000, 3]])
def test_psi(spark, live):
    ref = list(range(1000))
    assert drift.psi(_long(spark, ref), _long(spark, live)).first()["psi"] == pytest.approx(_psi(ref, list(live)))


def test_psi_without_values(spark):
    row = drift.psi(_long(spark, [1] * 10), _long(spark, [1, 2])).first()
    assert row["psi"] == 0 and not row["evaluable"]
    row = drift.psi(_long(spark, range(10)), _long(spark, [None, math.nan, math.inf])).first()
    assert row["psi"] == 0 and row["n_live"] == 0 and not row["evaluable"]


def test_bands(spark):
    rows = spark.createDataFrame([(0.10,), (0.11,), (0.25,), (0.26,)], "x double").select(psi_severity(F.col("x")).alias("s"))
    assert [r.s for r in rows.collect()] == ["stable", "moderate", "moderate", "significant"]


def test_ks(spark):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 50, 500).tolist(), rng.integers(5, 60, 300).tolist()
    grid = sorted(set(a) | set(b))
    want = max(abs(sum(x <= g for x in a) / 500 - sum(x <= g for x in b) / 300) for g in grid)
    row = drift.ks(_long(spark, a), _long(spark, b), parts=7).first()
    assert row["ks"] == pytest.approx(want) and row["p_value"] < 0.01
    empty = drift.ks(_long(spark, a), _long(spark, [None])).first()
    assert empty["ks"] == 0 and empty["p_value"] == 1
    same = drift.ks(_long(spark, a), _long(spark, a)).first()
    assert same["ks"] == 0 and same["p_value"] == 1


def test_chi_square(spark):
    frame = lambda counts: spark.createDataFrame(list(zip("abc", counts, strict=True)), "category string, n long")
    assert drift.chi_square(frame([300, 400, 300]), frame([30, 40, 30])).first()["statistic"] == pytest.approx(0, abs=1e-9)
    row = drift.chi_square(frame([300, 400, 300]), frame([0, 100, 0])).first()
    assert row["statistic"] > 100 and row["p_value"] == pytest.approx(math.exp(-row["statistic"] / 2))
    none = drift.chi_square(frame([0, 0, 0]), frame([1, 2, 3])).first()
    assert none["statistic"] == 0 and none["p_value"] == 1


def _machine(events, n, suppression):
    out, count, fired = [], 0, None
    for t, breached in events:
        if not breached:
            out.append("resolve" if count else "none")
            count, fired = 0, None
            continue
        count += 1
        if count < n:
            out.append("accumulate")
        elif fired is not None and t - fired < suppression:
            out.append("suppress")
        else:
            out.append("fire")
            fired = t if fired is None else fired
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_alert_decisions(spark, n):
    rng = random.Random(n)
    events = {k: [(t, rng.random() < 0.8) for t in range(0, 400, 10)] for k in "ab"}
    rows = spark.createDataFrame([(k, t, b) for k, e in events.items() for t, b in e], "dedup_key string, t long, breached boolean")
    got = {(r.dedup_key, r.t): r.action for r in alerts.decisions(rows, n, 40).collect()}
    for k, e in events.items():
        assert [got[k, t] for t, _ in e] == _machine(e, n, 40)


def test_alert_stream_equals_batch(spark, tmp_path):
    from tickflow.streaming.alerts import decide_stream

    rng = random.Random(9)
    rows = spark.createDataFrame([(k, t, rng.random() < 0.7) for k in "ab" for t in range(0, 300, 10)], "dedup_key string, t long, breached boolean")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    query = decide_stream(stream, 2, 40).writeStream.format("memory").queryName("decided").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start()
    query.awaitTermination()
    want = alerts.decisions(rows, 2, 40).select("dedup_key", "t", "action", "consecutive")
    got = spark.table("decided").select("dedup_key", "t", "action", "consecutive")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_record(spark):
    state = spark.createDataFrame([("a", 2, 1, None), ("b", 5, 1, 10), ("c", 4, 1, 10), ("d", 1, 1, None)], "dedup_key string, consecutive long, first_breached long, fired long")
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "dedup_key string")
    got = {r.dedup_key: r.action for r in alerts.record(state, frame("abe"), frame("abcef"), 100, sustained=3, suppression_us=90).collect()}
    assert got == {"a": "fire", "b": "fire", "c": "resolve", "e": "accumulate", "f": "none"}
    got = {r.dedup_key: r.action for r in alerts.record(state, frame("b"), frame("b"), 99, sustained=3, suppression_us=90).collect()}
    assert got == {"b": "suppress"}


def test_rules(spark):
    slices = spark.createDataFrame([("1", 60, 0.2, 0.9, 0.1, 0.0), ("2", 60, 0.1, 0.3, 0.4, 0.3), ("3", 10, 0.0, 0.3, 0.4, 0.3)], "model_version string, n long, accuracy double, share_DOWN double, share_STABLE double, share_UP double")
    assert alerts.accuracy_rule(slices).first()["dedup_key"] == "model_accuracy_degraded:2"
    assert alerts.accuracy_rule(slices, all_degraded=True).count() == 2
    assert alerts.mix_rule(slices, {"DOWN": 0.3, "STABLE": 0.4, "UP": 0.3}).first()["dedup_key"] == "prediction_distribution_shift:1"
    assert alerts.mix_rule(slices, None).count() == 0
    assert all(r.runbook for r in alerts.rules(spark).collect())


def test_freshness_and_gate(spark):
    now, limit = 10 * DAY_US, 10 * MINUTE_US
    symbols = spark.createDataFrame([("a",), ("b",), ("c",)], "symbol string")
    ticks = spark.createDataFrame([("a", now - 30 * MINUTE_US), ("b", now - limit)], "symbol string, t long")
    rows = {r.symbol: r for r in quality.freshness(symbols, ticks, now, limit).collect()}
    assert not rows["a"].passed and rows["a"].lag_seconds == 1800 and rows["b"].passed and rows["c"].issue == "no_ticks_observed"
    audit = quality.audit_rows({c: symbols.withColumn("passed", F.lit(True)) for c in quality.CHECKS}, now, now - 1)
    assert quality.gate(audit, now - 1).first()["open"]
    assert not quality.gate(audit, now + 1).first()["open"]
    worse = audit.unionByName(audit.where("check_name = 'validity' and symbol = 'b'").withColumn("passed", F.lit(False)))
    assert not quality.gate(worse, now - 1).first()["open"]
    assert not quality.gate(audit.where("check_name <> 'freshness'"), now - 1).first()["open"]


def test_validity_over_long_pauses(spark):
    symbols = spark.createDataFrame([("a",), ("b",)], "symbol string")
    raw = [("a", 5, 0), ("a", 4, 30 * DAY_US), ("a", 6, 31 * DAY_US + 1), ("a", 3, 34 * DAY_US), ("a", 2, 34 * DAY_US + 1), ("b", 1, 0), ("b", 2, 9 * DAY_US)]
    raw = spark.createDataFrame([(s, t, 1.0, a) for s, t, a in raw], "symbol string, t long, price double, arrival long")
    features = symbols.select("symbol", F.lit(True).alias("insufficient_history"), *[F.lit(None).cast("double").alias(c) for c in FEATURE_NAMES])
    rows = {r.symbol: (r.passed, r.non_monotonic) for r in quality.validity(symbols, raw, features).collect()}
    assert rows == {"a": (False, 3), "b": (True, 0)}


def test_resolution_boundary(spark):
    now, h = 10 * DAY_US, 15 * MINUTE_US
    p = spark.createDataFrame([("X", now - h, "1"), ("X", now - h + 1, "1")], "symbol string, t long, model_version string")
    none = p.where("false")
    assert [r.t for r in attribution.unresolved(p, none, now, h).collect()] == [now - h]
    assert attribution.pending(p, none, now, h).first()["pending"] == 1
    assert attribution.unresolved(p, p, now, h).count() == 0


def test_forward_look_ups_do_not_follow_density(spark):
    """Each row meets the next point only: as many entries are written as there are rows, whatever the points lie in a tolerance; rows of
    one time, keys that are null and several predictions of one time are kept."""
    n = 3000
    ticks = spark.range(n).select(F.lit("X").alias("symbol"), (F.col("id") * 10).alias("t"), F.col("id").cast("double").alias("price"))
    ticks = ticks.unionByName(spark.createDataFrame([("X", 10, 0.5), (None, 10, 7.0)], "symbol string, t long, price double"))
    out = forward_join(ticks.withColumn("at", F.col("t") + 5), ticks, "at", "price", 1_000_000)
    assert out.count() == n + 2
    assert {(r.symbol, r.t, r.price): r.future for r in out.where("t < 20").collect()} == {("X", 0, 0.0): 0.5, ("X", 10, 1.0): 2.0, ("X", 10, 0.5): 2.0, (None, 10, 7.0): None}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan  # an equi-join on buckets made 3,000 x 3,000 rows here
    own = {(r.symbol, r.t, r.price): r.future_t for r in forward_self(ticks, "price", 5, 1_000_000).collect()}
    assert len(own) == n + 2 and own["X", 0, 0.0] == 10 and own["X", (n - 1) * 10, n - 1.0] is None and own[None, 10, 7.0] is None
