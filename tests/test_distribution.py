"""The shift of features' means."""

from tickflow.functions.registry import FEATURE_NAMES
from tickflow.operators import quality


def test_distribution_reads_the_features_once(spark):
    row = lambda t, x, short=False: ("a", t, short, *[x] * len(FEATURE_NAMES))
    kind = "symbol string, t long, insufficient_history boolean, " + ", ".join(f"{n} double" for n in FEATURE_NAMES)
    features = spark.createDataFrame([row(5, 100.0), row(10, 1.0), row(12, 3.0), row(13, 99.0, True), row(20, 2.5), row(21, 3.7), row(22, None), row(30, 100.0)], kind)
    symbols = spark.createDataFrame([("a",), ("b",)], "symbol string")
    out = quality.distribution(symbols, features, 30, 10, 10, 0.5)
    assert {r["symbol"]: r["shifted"] for r in out.collect()} == {"a": len(FEATURE_NAMES), "b": 0}
    assert {r["shifted"] for r in quality.distribution(symbols, features, 30, 10, 10, 0.6).collect()} == {0}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
