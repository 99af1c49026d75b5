"""Streaming ticks: decode, divert, store what is new, and compute features for it with the batch function."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickflow.functions.registry import FEATURE_SET_VERSION
from tickflow.functions.scalars import DAY_US, micros
from tickflow.operators.features import GAP_US, HISTORY_ROWS, HISTORY_US, compute_features, versioned
from tickflow.sources.ingest import decode, split_valid
from tickflow.sources.sinks import FEATURE_KEYS, TICK_KEYS, commit_of, folders, in_partitions, insert_if_absent, months_between, new_rows, partitions_of, stored, with_month


def _ticks(valid: DataFrame) -> DataFrame:
    return with_month(valid.select("symbol", micros("observed_at").alias("t"), F.col("price").cast("double").alias("price"), F.col("volume").cast("double").alias("volume"), "message_id"))


def features_of(keys: DataFrame, ticks: DataFrame, *, gap_us: int = GAP_US, history_rows: int | None = HISTORY_ROWS) -> DataFrame:
    """Feature rows of the ticks whose (symbol, t) are in keys, from stored ticks: the past that their windows need is read with them, so a
    restart needs no warm-up."""
    bounds = keys.agg(F.min("t"), F.max("t")).first()
    if bounds[0] is None:
        return compute_features(ticks.where("false"), gap_us=gap_us, history_rows=history_rows)
    lo, hi = bounds[0] - HISTORY_US, bounds[1] + 1
    near = ticks.where(F.col("month").isin(months_between(lo, hi)) & (F.col("t") >= lo) & (F.col("t") < hi)).join(keys.select("symbol").distinct(), "symbol", "left_semi")
    return compute_features(near, gap_us=gap_us, history_rows=history_rows).join(keys.select("symbol", "t"), ["symbol", "t"], "left_semi")


def process(batch: DataFrame, root: str, *, batch_id: int = 0, gap_us: int = GAP_US, history_rows: int | None = HISTORY_ROWS, expire_us: int | None = None, now_us: int | None = None) -> None:
    """One micro-batch of decoded messages: dead letters, ticks and features below root. Dead letters are written over those of the same
    batch_id, and the other sinks compare with what they hold, so a batch that is run again after a failure, between the sinks or
    elsewhere, ends in the same tables. Late ticks get their own features from what precedes them; features that are already stored stay.
    What was emitted over expire_us before now_us is a dead letter too."""
    spark = batch.sparkSession
    batch = batch.persist()
    before = F.timestamp_micros(F.lit(now_us - expire_us)) if expire_us is not None and now_us is not None else None
    valid, dead = split_valid(batch, expire_before=before)
    dead.write.mode("overwrite").parquet(f"{root}/dead_letters/batch={batch_id}")
    rows = _ticks(valid)
    months = partitions_of(rows, "month")
    insert_if_absent(rows, f"{root}/ticks", TICK_KEYS, partition="month", among=months)
    ticks = stored(spark, f"{root}/ticks", rows)
    # of the batch's ticks, those that are stored (not the duplicates that lost) and have no features yet
    kept = in_partitions(ticks, "month", months).join(rows.select("symbol", "t", "message_id").distinct(), ["symbol", "t", "message_id"], "left_semi").select("symbol", "t")
    table = in_partitions(stored(spark, f"{root}/features", with_month(versioned(compute_features(ticks.where("false"))))), "month", months)
    todo = kept.join(table.select("symbol", "t"), ["symbol", "t"], "left_anti").persist()
    fresh = with_month(versioned(features_of(todo, ticks, gap_us=gap_us, history_rows=history_rows)))
    insert_if_absent(fresh, f"{root}/features", FEATURE_KEYS, partition="month", among=months)
    todo.unpersist()
    batch.unpersist()


def clock_us() -> int:
    return time.time_ns() // 1000


def ingest(messages: DataFrame, root: str, *, gap_us: int = GAP_US, history_rows: int | None = HISTORY_ROWS, expire_us: int | None = None, available_now: bool = True, clock: Callable[[], int] = clock_us) -> StreamingQuery:
    """A query over a stream with a column `value` of JSON envelopes. With expire_us, messages that were emitted longer than that before
    their batch begins, by `clock` in microseconds, are dead letters."""

    def run(batch: DataFrame, batch_id: int) -> None:
        process(batch, root, batch_id=batch_id, gap_us=gap_us, history_rows=history_rows, expire_us=expire_us, now_us=clock())

    writer = decode(messages).writeStream.foreachBatch(run).option("checkpointLocation", f"{root}/checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def deduplicated_stream(decoded: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Valid ticks of a stream, once per (symbol, time) and once per message id, within the watermark. A tick whose message id came before
    may have shadowed another of its time; the stored tables' own comparison does not mend that."""
    rows = decoded.where("reason is null").withWatermark("observed_at", lateness)
    return rows.dropDuplicates(["symbol", "observed_at"]).dropDuplicates(["message_id", "observed_at"])


def rate_stream(decoded: DataFrame, step: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """(symbol, window, n) of a stream of valid ticks."""
    rows = decoded.where("reason is null").withWatermark("observed_at", lateness)
    return rows.groupBy("symbol", F.window("observed_at", step)).agg(F.count(F.lit(1)).alias("n"))


def backfill(spark: SparkSession, root: str, start_us: int, end_us: int, *, version: int | None = None, gap_us: int = GAP_US, history_rows: int | None = HISTORY_ROWS) -> None:
    """Features of the stored ticks of [start, end) that have none yet, each with the past it needs; running it again changes nothing."""
    if version not in (None, FEATURE_SET_VERSION):
        raise ValueError(f"features are computed as version {FEATURE_SET_VERSION}")
    lo = start_us - HISTORY_US
    ticks = spark.read.parquet(f"{root}/ticks").where(F.col("month").isin(months_between(lo, end_us)) & (F.col("t") >= lo) & (F.col("t") < end_us))
    rows = with_month(versioned(compute_features(ticks, gap_us=gap_us, history_rows=history_rows).where(F.col("t") >= start_us)))
    insert_if_absent(rows, f"{root}/features", FEATURE_KEYS, partition="month", among=months_between(start_us, end_us))


def _last_commit(spark: SparkSession, path: str, month: str) -> int:
    """The newest commit that brought ticks of the month; 0 where there is none."""
    return max((commit_of(f) for f in folders(spark, f"{path}/commit=*/month={month}")), default=0)


def backfill_days(spark: SparkSession, root: str, start_us: int, end_us: int, *, version: int | None = None, gap_us: int = GAP_US, history_rows: int | None = HISTORY_ROWS, days: int = 1, after_chunk: Callable[[int, int], None] | None = None) -> list[tuple[int, int]]:
    """backfill() in chunks of whole days (UTC), each of which is noted below root/backfilled once its features are stored; returns the
    chunks that were computed. A run that was killed is taken up where it ended: days that are noted are skipped, without reading their
    ticks or features. A day is noted with the newest commit of its month's ticks, so it is looked at again once ticks have been stored in
    that month since. Days that [start, end) holds in part are computed, but not noted. after_chunk(start, end) is called after each."""
    ledger = f"{root}/backfilled"
    like = spark.createDataFrame([], "day long, version int, ticks_commit long")
    which = FEATURE_SET_VERSION if version is None else version
    noted = {r["day"]: r["commit"] for r in stored(spark, ledger, like).where(F.col("version") == which).groupBy("day").agg(F.max("ticks_commit").alias("commit")).collect()}  # one number a day
    newest: dict[str, int] = {}
    todo: list[tuple[int, int]] = []
    for day in range(start_us // DAY_US, -(-end_us // DAY_US)):
        month = months_between(day * DAY_US, (day + 1) * DAY_US)[0]
        if month not in newest:
            newest[month] = _last_commit(spark, f"{root}/ticks", month)
        if noted.get(day, -1) < newest[month]:
            todo.append((day, newest[month]))
    done = []
    while todo:
        # days in a row, at most `days` of them
        chunk = [d for i, d in enumerate(todo[:days]) if d[0] == todo[0][0] + i]
        todo = todo[len(chunk) :]
        lo, hi = max(start_us, chunk[0][0] * DAY_US), min(end_us, (chunk[-1][0] + 1) * DAY_US)
        backfill(spark, root, lo, hi, version=version, gap_us=gap_us, history_rows=history_rows)
        whole = [(day, which, commit) for day, commit in chunk if start_us <= day * DAY_US and (day + 1) * DAY_US <= end_us]
        if whole:
            insert_if_absent(spark.createDataFrame(whole, like.schema), ledger, (("day", "version", "ticks_commit"),))
        done.append((lo, hi))
        if after_chunk:
            after_chunk(lo, hi)
    return done


def seed(rows: DataFrame, root: str, *, gap_us: int = GAP_US, history_rows: int | None = HISTORY_ROWS) -> None:
    """Historical rows (symbol, t, price, volume, message_id): stored if new, with features for those that are."""
    spark = rows.sparkSession
    rows = with_month(rows.select("symbol", "t", "price", "volume", "message_id"))
    months = partitions_of(rows, "month")
    fresh = new_rows(rows, in_partitions(stored(spark, f"{root}/ticks", rows), "month", months), TICK_KEYS).select("symbol", "t").persist()
    fresh.count()
    insert_if_absent(rows, f"{root}/ticks", TICK_KEYS, partition="month", among=months)
    table = spark.read.parquet(f"{root}/ticks")
    insert_if_absent(with_month(versioned(features_of(fresh, table, gap_us=gap_us, history_rows=history_rows))), f"{root}/features", FEATURE_KEYS, partition="month", among=months)
    fresh.unpersist()
