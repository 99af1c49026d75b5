"""Time chunks with a halo: windows over a hot key spread over many tasks, with the same results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tickflow.functions.scalars import DAY_US


def chunked(df: DataFrame, before_us: int, after_us: int = 0, *, time: str = "t", size_us: int = DAY_US) -> DataFrame:
    """df with `chunk` and `own`: a row goes to its own chunk of time, and to each chunk of which some row looks as far as it."""
    t = F.col(time)
    chunk = F.explode(F.sequence(F.floor((t - after_us) / size_us), F.floor((t + before_us) / size_us)))
    return df.withColumn("chunk", chunk).withColumn("own", F.col("chunk") == F.floor(t / size_us))


def by_chunk(*keys: str, time: str = "t") -> WindowSpec:
    return Window.partitionBy(*keys, "chunk").orderBy(time)


def running(df: DataFrame, keys: list[str], bucket: str, order: list[str], sums: dict[str, str]) -> DataFrame:
    """df with inclusive running sums {name: column} over `order` within keys. Buckets follow that order; sums of the buckets are summed
    first, so that no task orders a whole key."""
    totals = df.groupBy(*keys, bucket).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    upto = Window.partitionBy(*keys).orderBy(bucket)
    before = totals.select(*keys, bucket, *[(F.sum(f"_{n}").over(upto) - F.col(f"_{n}")).alias(f"_{n}") for n in sums])
    within = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.select("*", *[F.sum(c).over(within).alias(n) for n, c in sums.items()]).join(before, [*keys, bucket])
    return rows.select(*[c for c in df.columns], *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums])
