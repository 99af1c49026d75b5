"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows turned into Python objects at once. Spark bounds the bytes of an Arrow batch (spark.sql.execution.arrow.maxBytesPerBatch).
ARROW_ROWS = 500
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_own: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir. Where that is unset, one of this machine's, which only a
    local master can share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="spark-"))
    return f"{base}/tickflow-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that begin herein delete their shuffle files once they have ended. Else these stay until the driver's garbage is collected,
    beside those of the steps that follow."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts the lineage, and what Python computed is computed once. What was
    shuffled for it is deleted when it is written."""
    spark = df.sparkSession
    path = shared_dir(spark)
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table that materialize() wrote and that no later result reads."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """mapInArrow for a function of one batch. Its batches are cut to ARROW_ROWS rows, whatever the session's batch size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ARROW_ROWS):
                yield fn(batch.slice(at, ARROW_ROWS))

    return df.mapInArrow(run, schema)


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def utf8_length(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return df["`" + name.replace("`", "``") + "`"]
