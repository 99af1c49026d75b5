"""Range scans, pages and newest rows over stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickflow.functions.scalars import DAY_US

MAX_PAGE, MAX_LOOKBACK_DAYS = 500, 30


def in_range(df: DataFrame, start: int | Column, end: int | Column, time: str = "t") -> DataFrame:
    """Rows of [start, end); both bounds reach the Parquet scan."""
    return df.where((F.col(time) >= start) & (F.col(time) < end))


def since(df: DataFrame, start: int | Column, time: str = "t") -> DataFrame:
    return df.where(F.col(time) >= start)


def page(df: DataFrame, by: Sequence[str], *, limit: int, offset: int = 0) -> DataFrame:
    """One page of rows, newest first by `by`, with its place (from 1) and whether there are more: one row beyond the page is read, and
    nothing is counted. Ties beyond `by` are in no set order."""
    if not 0 < limit <= MAX_PAGE:
        raise ValueError(f"a page has 1 to {MAX_PAGE} rows")
    order = [F.desc(c) for c in by]
    rows = df.orderBy(*order).offset(offset).limit(limit + 1).withColumn("_page", F.lit(0))
    w = Window.partitionBy("_page")
    return rows.select("*", F.row_number().over(w.orderBy(*order)).cast("long").alias("place"), (F.count(F.lit(1)).over(w) > limit).alias("has_more")).where(F.col("place") <= limit).drop("_page")


def recent_page(df: DataFrame, by: Sequence[str], *, now_us: int, days: int = 1, limit: int = MAX_PAGE, offset: int = 0, time: str = "t", equal: Mapping[str, object] | None = None) -> DataFrame:
    """A page of the rows of the last `days`, which may not be over MAX_LOOKBACK_DAYS, with the given column values, if any."""
    if not 0 < days <= MAX_LOOKBACK_DAYS:
        raise ValueError(f"looking back goes from 1 to {MAX_LOOKBACK_DAYS} days")
    return page(matching(in_range(df, now_us - days * DAY_US, now_us + 1, time), equal), by, limit=limit, offset=offset)


def matching(df: DataFrame, equal: Mapping[str, object] | None) -> DataFrame:
    """Rows whose columns have the given values; a value of None asks nothing."""
    for name, value in (equal or {}).items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def listing(df: DataFrame, since_us: int, time: str, *, newest_first: Sequence[str], then: Sequence[str] = (), equal: Mapping[str, object] | None = None) -> DataFrame:
    """Rows of `time` from since_us on with the given column values, newest first by newest_first, then ascending by `then`."""
    return matching(since(df, since_us, time), equal).orderBy(*[F.desc(c) for c in newest_first], *then)


def lookup(df: DataFrame, **key: object) -> DataFrame:
    """The rows of a key; empty if there are none. A key may not be null."""
    if not key or any(v is None for v in key.values()):
        raise ValueError("a look-up needs a key")
    return matching(df, key)


def version_history(versions: DataFrame, events: DataFrame) -> DataFrame:
    """(model_version, created, stage, promoted_at) of each version, newest first: its newest stage, None before any, and when it first
    became Production. events: (model_version, stage, at)."""
    told = events.groupBy("model_version").agg(F.max_by("stage", F.struct("at", "stage")).alias("stage"), F.min(F.when(F.col("stage") == "Production", F.col("at"))).alias("promoted_at"))
    return versions.select("model_version", "created").join(told, "model_version", "left").orderBy(F.desc("created"), F.desc("model_version"))


def newest(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key, or of all; partial aggregation, no sort."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), time).alias("_x")).where("_x is not null").select(*keys, "_x.*")


def newest_window(df: DataFrame, time: str = "window_end") -> DataFrame:
    """All rows of the greatest `time`."""
    top = df.agg(F.max(time).alias("_top"))
    return df.join(F.broadcast(top), F.col(time) == F.col("_top"), "left_semi")  # one row
