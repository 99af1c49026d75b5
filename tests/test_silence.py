"""Alerts about what does not arrive: a silent symbol fires by the clock, is suppressed across a restart, and resolves."""

import inspect
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tickflow.functions.scalars import HOUR_US
from tickflow.sources.ingest import encode
from tickflow.streaming import alerts, state


def _put(spark, root, name, symbols):
    rows = spark.createDataFrame([(f"{name}-{s}", s) for s in symbols], "message_id string, symbol string")
    now = F.timestamp_micros(F.lit(time.time_ns() // 1000))
    encode(rows.select("message_id", F.lit("c").alias("correlation_id"), F.lit(1).alias("schema_version"), now.alias("emitted_at"), "symbol", now.alias("observed_at"), F.lit(1.0).alias("price"), F.lit(1.0).alias("volume"))).coalesce(1).write.text(f"{root}/in/{name}")


def _until(spark, root, query, found, seconds=120):
    """The decisions so far, once some of them are as wanted."""
    end = time.time() + seconds
    while time.time() < end:
        assert query.exception() is None
        try:
            rows = [tuple(r) for r in spark.read.schema(alerts._OUT).parquet(f"{root}/out/silence").orderBy("t").collect()]
        except Exception:  # nothing is written yet
            rows = []
        if found(rows):
            return rows
        time.sleep(0.5)
    raise AssertionError(rows)


def test_silence_fires_is_suppressed_after_a_restart_and_resolves(spark, tmp_path):
    def start(**more):
        source = spark.readStream.schema("value string").option("recursiveFileLookup", True).text(f"{tmp_path}/in")
        return alerts.watch_silence(source, f"{tmp_path}/out", silence_us=2_000_000, every_us=500_000, sustained=2, suppression_us=HOUR_US, trigger="500 milliseconds", **more)

    _put(spark, tmp_path, "a", ["X"])
    began = time.time_ns() // 1000
    query = start(known=spark.createDataFrame([("Z",), (None,)], "symbol string"))
    both = {("X", "fire"), ("Z", "fire")}  # nothing ever came of Z
    first = _until(spark, tmp_path, query, lambda rows: both <= {(r[0], r[3]) for r in rows})
    query.stop()
    for symbol in "XZ":
        own = [r for r in first if r[0] == symbol]
        assert [r[3] for r in own[:2]] == ["accumulate", "fire"] and {r[3] for r in own[2:]} <= {"suppress"}
        assert own[0][1] >= began + 2_000_000 and all(r[2] for r in own)
    stopped = time.time_ns() // 1000

    query = start(known=spark.createDataFrame([("Z",)], "symbol string"))
    rows = _until(spark, tmp_path, query, lambda rows: {r[0] for r in rows if r[1] > stopped} == {"X", "Z"})
    assert {r[3] for r in rows if r[1] > stopped} == {"suppress"}  # no second fire
    _put(spark, tmp_path, "b", ["X"])
    rows = _until(spark, tmp_path, query, lambda rows: "resolve" in {r[3] for r in rows})
    query.stop()
    assert [(r[0], r[2], r[4]) for r in rows if r[3] == "resolve"] == [("X", False, 0)]
    assert sum(r[3] == "fire" for r in rows) == 2


@pytest.mark.parametrize("made", [alerts.Silence, state.TickWindow])
def test_processors_are_called_by_these_names(made):
    """The engine calls them with keywords."""
    for method in ("handleInitialState", "handleInputRows", "handleExpiredTimer"):
        assert list(inspect.signature(getattr(made, method)).parameters) == list(inspect.signature(getattr(StatefulProcessor, method)).parameters)


@pytest.mark.parametrize("before, breached, want", [((0, -1), True, ("accumulate", 1, -1)), ((2, -1), True, ("fire", 3, 100)), ((3, 100), True, ("suppress", 4, 100)), ((3, 90), True, ("fire", 4, 90)), ((3, 90), False, ("resolve", 0, -1)), ((0, -1), False, ("none", 0, -1))])
def test_one_decision(before, breached, want):
    assert alerts._decide(100, breached, *before, sustained=3, suppression_us=10) == want
