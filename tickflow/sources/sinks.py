"""Sinks over Parquet tables: atomic insert-if-absent, latest-wins upserts, months, and archives that are verified before anything is dropped."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickflow.functions.scalars import DAY_US

TICK_KEYS = (("symbol", "t"), ("message_id", "t"))
FEATURE_KEYS = (("symbol", "t", "feature_set_version"),)
PREDICTION_KEYS = (("symbol", "t", "model_version"),)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at path, or an empty one of the same columns where there is none yet."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns) if has_rows(spark, path) else like.where("false")


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether anything is committed at path; what is written aside does not count."""
    return bool(folders(spark, f"{path}/[!_.]*"))


class Conflict(RuntimeError):
    """Other writers were first, again and again."""


def folders(spark: SparkSession, pattern: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return [str(f.getPath()) for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []]


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def commit_of(folder: str) -> int:
    """The number of the commit that a folder is, or is part of."""
    return int(folder.rpartition("commit=")[2].partition("/")[0])


def _next_commit(spark: SparkSession, path: str) -> int:
    return max((commit_of(f) for f in folders(spark, f"{path}/commit=*")), default=0) + 1


def _publish(spark: SparkSession, staged: str, target: str) -> bool:
    """Rename a written folder to its place, all or nothing; False if something is there already, and nothing was done."""
    fs = spark._jvm.org.apache.hadoop.fs
    source, place = fs.Path(staged), fs.Path(target)
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration()).rename(source, place, none)
    except Exception as e:
        if exists(spark, target) and exists(spark, staged):
            return False
        raise e
    return True


def first_rows(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key: the first by all columns."""
    w = Window.partitionBy(*key).orderBy(*([c for c in rows.columns if c not in key] or key))
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def new_rows(rows: DataFrame, table: DataFrame, keys: Sequence[Sequence[str]], *, whole: bool = False) -> DataFrame:
    """The rows of which no key is in the table, one per key, the first by all their columns; with `whole`, all rows of a key."""
    for key in keys:
        rows = (rows if whole else first_rows(rows, key)).join(table.select(*key), list(key), "left_anti").select(*rows.columns)
    return rows


def partitions_of(rows: DataFrame, partition: str) -> list:
    """The partitions that rows fall in: a handful of months."""
    return [r[0] for r in rows.select(partition).distinct().collect()]


def in_partitions(table: DataFrame, partition: str, values: Sequence) -> DataFrame:
    return table.where(F.col(partition).isin(list(values))) if len(values) else table.where("false")


def insert_if_absent(rows: DataFrame, path: str, keys: Sequence[Sequence[str]], *, partition: str | None = None, among: Sequence | None = None, whole: bool = False, tries: int = 20, before_commit: Callable[[], None] | None = None) -> bool:
    """Append the rows that the table has none of the keys of, the first of each key, or with `whole` all; whether there were any.

    The new rows are written aside and appear as a whole by one rename, to the next number after the commits that were compared with. If
    another writer took that number first, the comparison is made again, so two writers at a time leave one row per key; if a job dies
    before the rename, nothing has changed, and running it again adds what it would have. A job that died between two sinks is made good in
    the same way, as each sink compares with what it has itself. A partition column has to follow from each key: only the partitions that
    the rows fall in are read, so the cost does not grow with the table's age; where the caller knows which these are, or more, `among` saves
    computing the rows once only to learn them. before_commit is called once the rows are written."""
    spark = rows.sparkSession
    for _ in range(tries):
        number = _next_commit(spark, path)  # before the table is listed: whatever is committed later takes this number
        table = stored(spark, path, rows)
        if partition:
            table = in_partitions(table, partition, partitions_of(rows, partition) if among is None else among)
        staged = f"{path}/_staging/{uuid.uuid4().hex}"
        writer = new_rows(rows, table, keys, whole=whole).write
        (writer.partitionBy(partition) if partition else writer).parquet(staged)
        some = bool(folders(spark, f"{staged}/{partition}=*")) if partition else not spark.read.schema(rows.schema).parquet(staged).isEmpty()
        if not some and (number > 1 or partition):
            _delete(spark, staged)
            return False
        if before_commit:
            before_commit()
        if _publish(spark, staged, f"{path}/commit={number:08d}"):
            return some
        _delete(spark, staged)
    raise Conflict(f"{path}: {tries} times another writer was first")


def with_month(rows: DataFrame, time: str = "t", name: str = "month") -> DataFrame:
    """rows with the calendar month (UTC) of a time in microseconds, as yyyy-MM: the partition of stored ticks and features."""
    return rows.withColumn(name, F.date_format(F.date_from_unix_date(F.floor(F.col(time) / DAY_US).cast("int")), "yyyy-MM"))  # a date, so the session's zone is of no matter


def months_between(start_us: int, end_us: int) -> list[str]:
    """The months that [start, end) touches: a predicate on the partition that goes with a range of time."""
    from datetime import UTC, datetime, timedelta

    at, last = datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=start_us), datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=max(end_us - 1, start_us))
    first, final = at.year * 12 + at.month - 1, last.year * 12 + last.month - 1
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, final + 1)]


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """The table after the rows: of each key the row of greatest `newest`, and of equal ones that of the new rows."""
    both = table.withColumn("_side", F.lit(0)).unionByName(rows.withColumn("_side", F.lit(1)))
    rest = [c for c in both.columns if c not in keys]
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(newest, "_side")).alias("_x"))
    return best.select(*keys, "_x.*").drop("_side").select(*table.columns)


def upsert_stored(rows: DataFrame, path: str, keys: Sequence[str], newest: str, partition: str, *, before_swap: Callable[[], None] | None = None) -> list:
    """Bring rows into the table at path, partitioned by a column that follows from the keys: of each key the row of greatest `newest`
    stays, the new one of equal ones. Returns the partitions that changed; no other is written, and rows that change nothing change none.

    The changed partitions are written aside first and then swapped in by an overwrite of just these. What a job that died in between left
    aside is complete, and is swapped in by the next call before anything else. One writer at a time."""
    spark = rows.sparkSession
    for left in sorted(folders(spark, f"{path}/_redo/*")):
        if exists(spark, f"{left}/_SUCCESS"):
            _swap(spark, left, path, rows, partition)
        _delete(spark, left)
    touched = partitions_of(rows, partition)
    table = in_partitions(stored(spark, path, rows), partition, touched)
    after = upsert(table, rows, keys, newest)
    changed = sorted(r[0] for r in after.exceptAll(table).select(partition).distinct().collect())  # of the partitions that rows fall in
    if changed:
        staged = f"{path}/_redo/{uuid.uuid4().hex}"
        in_partitions(after, partition, changed).write.partitionBy(partition).parquet(staged)
        if before_swap:
            before_swap()
        _swap(spark, staged, path, rows, partition)
        _delete(spark, staged)
    return changed


def _swap(spark: SparkSession, staged: str, path: str, like: DataFrame, partition: str) -> None:
    new = spark.read.schema(like.schema).parquet(staged).select(*like.columns)
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def latest_stage(events: DataFrame) -> DataFrame:
    """The current stage of each model version, of append-only stage events (model_version, stage, at)."""
    return events.groupBy("model_version").agg(F.max_by("stage", "at").alias("stage"), F.max("at").alias("at"))


def fingerprint(df: DataFrame) -> tuple[int, int]:
    """(rows, checksum) of a table, the same in any order of its rows."""
    one = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
    return int(one[0]), int(one[1])


def archivable_months(table: DataFrame, as_of_us: int, keep_months: int = 6, month: str = "month") -> list[str]:
    limit = months_between(as_of_us, as_of_us + 1)[0]
    ordinal = lambda m: int(m[:4]) * 12 + int(m[5:])
    return sorted(r[0] for r in table.select(month).distinct().collect() if r[0] and ordinal(r[0]) < ordinal(limit) - keep_months)  # one value per month


def archive_month(spark: SparkSession, path: str, archive: str, audit: str, month: str, *, table: str = "ticks", drop: bool = True) -> DataFrame:
    """Copy one month to the archive, read the copy back, compare rows and checksum, append the audit row, and only then drop the month.
    A copy that differs raises and leaves the source as it is. Returns the audit row."""
    source = spark.read.parquet(path).where(F.col("month") == month).drop("month", "commit")
    target = f"{archive}/{table}/month={month}"
    source.write.mode("overwrite").parquet(target)
    rows, checksum = fingerprint(source)
    if fingerprint(spark.read.schema(source.schema).parquet(target)) != (rows, checksum):
        raise OSError(f"the archived copy of {table} {month} differs; nothing was dropped")
    row = spark.createDataFrame([(table, month, rows, target, str(checksum))], "table string, month string, rows long, location string, checksum string")
    row.write.mode("append").parquet(audit)
    if drop:
        for folder in folders(spark, f"{path}/month={month}") + folders(spark, f"{path}/commit=*/month={month}"):
            _delete(spark, folder)
    return row
