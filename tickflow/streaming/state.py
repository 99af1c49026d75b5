"""Keyed window state: each symbol's recent ticks held by the stream itself, so that no micro-batch reads stored history.

The state of a symbol is the list of its ticks of the last HISTORY_US and the lateness before its newest one, by the ticks' own time. A
batch's new ticks are inserted, in whatever order they come, and leave the operator with those of the state that their windows reach; the batch function then computes the features, so the
stream cannot differ from it. The state is part of the query's checkpoint: a batch that runs again begins from the state before it, and a
restart continues with what was known.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tickflow.functions.scalars import DAY_US, HOUR_US, micros
from tickflow.operators.features import GAP_US, HISTORY_ROWS, HISTORY_US, compute_features, versioned
from tickflow.sources.ingest import decode
from tickflow.sources.sinks import FEATURE_KEYS, TICK_KEYS, insert_if_absent, months_between, with_month

#: What the operator reads its state with; set it for the session before a stream begins.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATENESS_US = HOUR_US
#: A symbol that is silent for so long, by the time of arrival, is forgotten.
IDLE_US = 30 * DAY_US
_TICK = "t long, price double, volume double"
_OUT = f"symbol string, {_TICK}, message_id string, fate string"


class TickWindow(StatefulProcessor):
    """Each symbol's recent ticks, the oldest first. Rows leave as `new` (in the state from now on), `known` (of the state, and within the
    reach of a new one), `again` (of a time that is known) or `late` (older than all that is kept: without features here)."""

    def __init__(self, history_us: int = HISTORY_US, lateness_us: int = LATENESS_US, idle_us: int = IDLE_US):
        self.history_us, self.lateness_us, self.keep_us, self.idle_us = history_us, lateness_us, history_us + lateness_us, idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ticks = handle.getListState("ticks", _TICK)
        self.newest = handle.getValueState("newest", "t long")
        self.handle = handle

    def _load(self) -> np.ndarray:
        rows = list(self.ticks.get()) if self.ticks.exists() else []
        held = np.array([tuple(r) for r in rows], dtype=[("t", "i8"), ("price", "f8"), ("volume", "f8")])
        return held[np.argsort(held["t"], kind="stable")]

    def _rearm(self, arrived_ms: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(arrived_ms + self.idle_us // 1000)

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        """Warm-up: the stored ticks of a symbol, before its first batch."""
        rows = initialState.dropna(subset=["t"]).drop_duplicates("t").sort_values("t")
        if not len(rows):
            return
        newest = int(rows["t"].iloc[-1])
        rows = rows[rows["t"] > newest - self.keep_us]
        self.ticks.appendList([(int(t), float(p), float(v)) for t, p, v in zip(rows["t"], rows["price"], rows["volume"], strict=True)])
        known = int(self.newest.get()[0]) if self.newest.exists() else newest
        self.newest.update((max(known, newest),))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows)).sort_values(["t", "message_id"], kind="stable")
        held = self._load()
        t = came["t"].to_numpy()
        before = int(self.newest.get()[0]) if self.newest.exists() else None
        # late by what was known before the batch: what it brings itself is history to its later ticks
        late = np.zeros(len(t), bool) if before is None else t <= before - self.lateness_us
        again = came["t"].duplicated().to_numpy() | np.isin(t, held["t"])
        fate = np.where(again, "again", np.where(late, "late", "new"))
        newest = max(int(t[-1]), int(t[-1]) if before is None else before)
        oldest = newest - self.keep_us
        new = came[fate == "new"]
        fresh = np.array(list(zip(new["t"], new["price"], new["volume"], strict=True)), dtype=held.dtype)
        live = held[held["t"] > oldest]
        kept = fresh[fresh["t"] > oldest]
        if 2 * len(live) < len(held):  # rewritten once half of it is out of reach, else only added to
            self.ticks.clear()
            kept = np.concatenate((live, kept))
        if len(kept):
            self.ticks.appendList([tuple(x.item() for x in r) for r in kept])
        self.newest.update((newest,))
        self._rearm(int(came["arrived"].max().timestamp() * 1000))
        out = came[["t", "price", "volume", "message_id"]].assign(fate=fate)
        if len(fresh):
            near = held[(held["t"] > fresh["t"].min() - self.history_us - 1) & (held["t"] < fresh["t"].max())]
            if len(near):
                out = pd.concat((out, pd.DataFrame(near).assign(message_id=None, fate="known")))
        yield out.assign(symbol=key[0])[["symbol", "t", "price", "volume", "message_id", "fate"]]

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.ticks.clear()
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def windowed(valid: DataFrame, *, initial: DataFrame | None = None, history_us: int = HISTORY_US, lateness_us: int = LATENESS_US, idle_us: int = IDLE_US) -> DataFrame:
    """(symbol, t, price, volume, message_id, fate) of a stream of valid ticks (symbol, observed_at, price, volume, message_id).

    initial: stored ticks (symbol, t, price, volume) that a new query's state begins with. Ticks may come in any order,
    up to lateness_us behind their symbol's newest of the batches before; the watermark is of the time of arrival, as one of the ticks' own time
    would drop the ticks of symbols that lag behind others. A stream that stood still for longer than idle_us has to begin anew, with initial ticks. A symbol's ticks of one batch
    and its state are in one task: both are bounded by the rate of ticks, not by the age of the stream."""
    rows = valid.withColumn("t", micros("observed_at")).withColumn("arrived", F.current_timestamp()).withWatermark("arrived", "1 day")
    rows = rows.select("symbol", "arrived", "t", F.col("price").cast("double").alias("price"), F.col("volume").cast("double").alias("volume"), "message_id")
    begin = None if initial is None else initial.select("symbol", "t", F.col("price").cast("double").alias("price"), F.col("volume").cast("double").alias("volume")).groupBy("symbol")
    return rows.groupBy("symbol").transformWithStateInPandas(TickWindow(history_us, lateness_us, idle_us), outputStructType=_OUT, outputMode="Append", timeMode="EventTime", initialState=begin)


def recent(spark: SparkSession, root: str, end_us: int, *, history_us: int = HISTORY_US, lateness_us: int = LATENESS_US) -> DataFrame:
    """The stored ticks before end_us that a new query's state begins with: read once, by their months."""
    lo = end_us - history_us - lateness_us
    return spark.read.parquet(f"{root}/ticks").where(F.col("month").isin(months_between(lo, end_us)) & (F.col("t") >= lo) & (F.col("t") < end_us)).select("symbol", "t", "price", "volume")


def ingest_windowed(messages: DataFrame, root: str, *, initial: DataFrame | None = None, gap_us: int = GAP_US, history_us: int = HISTORY_US, history_rows: int | None = HISTORY_ROWS, lateness_us: int = LATENESS_US, available_now: bool = True) -> StreamingQuery:
    """A query over JSON envelopes (value) that stores ticks, dead letters, and the features of each new tick below root.

    Features come from the batch and the keyed state alone: stored ticks are only compared with for their keys. A tick too late for the
    state is stored without features, which a backfill adds. The state needs the RocksDB store; it is set for the query's session."""
    spark = messages.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    rows = decode(messages)

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        if batch.isEmpty():  # a batch without data, in which only timers ran
            batch.unpersist()
            return
        fresh = batch.where("fate = 'new'")
        insert_if_absent(with_month(batch.where("fate in ('new', 'late')").select("symbol", "t", "price", "volume", "message_id")), f"{root}/ticks", TICK_KEYS, partition="month")
        seen = batch.where("fate in ('new', 'known')").select("symbol", "t", "price", "volume")
        made = compute_features(seen, gap_us=gap_us, history_us=history_us, history_rows=history_rows).join(fresh.select("symbol", "t"), ["symbol", "t"], "left_semi")
        insert_if_absent(with_month(versioned(made)), f"{root}/features", FEATURE_KEYS, partition="month")
        batch.unpersist()

    out = windowed(rows.where("reason is null"), initial=initial, history_us=history_us, lateness_us=lateness_us)
    writer = out.writeStream.outputMode("append").foreachBatch(run).option("checkpointLocation", f"{root}/checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def dead_letters(messages: DataFrame, root: str, *, available_now: bool = True) -> StreamingQuery:
    """The messages of the same stream that no tick comes of, with the reason, appended exactly once below root."""
    rows = decode(messages).where("reason is not null")
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", f"{root}/dead_letters").option("checkpointLocation", f"{root}/checkpoint-dead")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
