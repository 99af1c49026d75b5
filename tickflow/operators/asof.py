"""As-of joins without nested loops: running frames in chunks of time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType
from pyspark.sql.window import Window

from tickflow.functions.scalars import DAY_US


def _entries(df: DataFrame, *entries: Column) -> DataFrame:
    """(_k, chunk, _t, _p, _q) of each row's points and questions, so that rows that are both are read once."""
    return df.select(F.explode(F.concat(*entries)).alias("_e")).select("_e.*")


def _points(df: DataFrame, key: str, time: str, value: str, tolerance_us: int, size_us: int, question: DataType) -> Column:
    """A row's point, once for each chunk that may look as far as it; a row without a key or time has none."""
    t = F.col(time)
    entry = lambda c: F.struct(F.col(key).alias("_k"), c.alias("chunk"), t.alias("_t"), F.struct(t.alias("_t"), F.col(value).alias("_v")).alias("_p"), F.lit(None).cast(question).alias("_q"))
    chunks = F.when(F.col(key).isNotNull() & t.isNotNull(), F.sequence(F.floor((t - tolerance_us) / size_us), F.floor(t / size_us)))
    return F.transform(F.coalesce(chunks, F.array().cast("array<bigint>")), entry)


def _question(df: DataFrame, key: str, target: Column, size_us: int, point: DataType) -> Column:
    return F.array(F.struct(F.col(key).alias("_k"), F.floor(target / size_us).alias("chunk"), target.alias("_t"), F.lit(None).cast(point).alias("_p"), F.struct(*df.columns).alias("_q")))


def _next_points(rows: DataFrame, tolerance_us: int, time: str, name: str) -> DataFrame:
    """The questions' rows with their points. A key's entries are walked from the latest on, and each question takes the point that was
    passed last: no row meets more than the next one, however densely the points lie."""
    # of points at one time the least comes last, and all of them before the questions of that time
    w = Window.partitionBy("_k", "chunk").orderBy(F.desc("_t"), F.col("_q").isNotNull(), F.desc("_p")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_x", F.last("_p", ignorenulls=True).over(w)).where("_q is not null")
    found = lambda c: F.when(F.col("_k").isNotNull() & (F.col("_x._t") <= F.col("_t") + tolerance_us), F.col(f"_x.{c}"))
    return rows.select("_q.*", found("_v").alias(name), found("_t").alias(f"{name}_{time}"))


def _types(left: DataFrame, right: DataFrame, time: str, value: str) -> tuple[DataType, DataType]:
    return right.select(F.struct(F.col(time).alias("_t"), F.col(value).alias("_v")).alias("x")).schema["x"].dataType, left.select(F.struct(*left.columns).alias("x")).schema["x"].dataType


def forward_self(df: DataFrame, value: str, horizon_us: int, tolerance_us: int, *, key: str = "symbol", time: str = "t", name: str = "future") -> DataFrame:
    """df with the value and time of the key's first row in [time + horizon, time + horizon + tolerance], both ends included; else null.
    Of several rows at that time, the least value."""
    size, (point, question) = max(DAY_US, tolerance_us), _types(df, df, time, value)
    rows = _entries(df, _points(df, key, time, value, tolerance_us, size, question), _question(df, key, F.col(time) + horizon_us, size, point))
    return _next_points(rows, tolerance_us, time, name)


def forward_join(left: DataFrame, right: DataFrame, target: str, value: str, tolerance_us: int, *, key: str = "symbol", time: str = "t", name: str = "future") -> DataFrame:
    """left with the value and time of right's earliest row of the key in [target, target + tolerance], both ends included; else null. Of
    several rows at that time, the least value."""
    size, (point, question) = max(DAY_US, tolerance_us), _types(left, right, time, value)
    rows = _entries(right, _points(right, key, time, value, tolerance_us, size, question)).unionByName(_entries(left, _question(left, key, F.col(target), size, point)))
    return _next_points(rows, tolerance_us, time, name)


def backward_last(history: DataFrame, queries: DataFrame, value: str, *, time: str = "t", order: Sequence[str] = (), keys: Sequence[str] = (), bucket_us: int = DAY_US, name: str = "last") -> DataFrame:
    """queries with the value of history's last row at or before their time, within keys if given; else null. Rows of one time are taken in
    `order`. The last value of each bucket of time is carried into the next, so that no task orders all rows."""
    side = lambda df, kind, v: df.select(*keys, F.col(time).alias("_t"), F.lit(kind).alias("_kind"), v.alias("_v"), *[(F.col(c) if kind == 0 else F.lit(None)).alias(f"_o{i}") for i, c in enumerate(order)], (F.lit(None) if kind == 0 else F.struct(*queries.columns)).alias("_q"))
    asked = side(queries, 1, F.lit(None).cast(history.schema[value].dataType))
    known = side(history, 0, F.col(value)).withColumn("_q", F.lit(None).cast(asked.schema["_q"].dataType))
    known = known.select(*[F.col(c).cast(asked.schema[c].dataType) if known.schema[c].dataType.typeName() == "void" else F.col(c) for c in known.columns])
    asked = asked.select(*[F.col(c).cast(known.schema[c].dataType) for c in known.columns])
    rows = known.unionByName(asked).withColumn("_b", F.floor(F.col("_t") / bucket_us))
    sort = ["_t", "_kind", *[f"_o{i}" for i in range(len(order))]]
    ends = rows.where("_kind = 0").groupBy(*keys, "_b").agg(F.max_by("_v", F.struct(*sort)).alias("_end"))
    grid = rows.select(*keys, "_b").distinct().join(ends, [*keys, "_b"], "left")
    carried = grid.select(*keys, "_b", F.last("_end", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    within = F.last("_v", ignorenulls=True).over(Window.partitionBy(*keys, "_b").orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0))
    out = rows.withColumn("_in", within).where("_kind = 1").join(carried, [*keys, "_b"], "left")
    return out.select("_q.*", F.coalesce("_in", "_before").alias(name))
