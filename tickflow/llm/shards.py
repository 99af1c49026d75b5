"""Sharding by proportional stratified interleaving: every shard holds the mixture of sources that the corpus holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickflow.llm.common import column, materialize, read, utf8_length

N_SHARDS, SEED, OVERHEAD = 40, "7", 16
#: Rows that one task ranks, about; a table of fewer is dealt to all tasks as long as each gets LEAST_ROWS.
BUCKET_ROWS, LEAST_ROWS = 50_000, 100


def ranked(df: DataFrame, group: str, bucket: str, order: list[Column], name: str) -> DataFrame:
    """df with a rank from 1 within each group, in the order of the buckets and, within one, of `order`. A group is spread over its
    buckets, so that no task ranks a whole group: counts of the buckets give each bucket's first rank."""
    counts = df.groupBy(group, bucket).agg(F.count(F.lit(1)).alias("rows"))
    first = counts.select(group, bucket, (F.sum("rows").over(Window.partitionBy(group).orderBy(bucket)) - F.col("rows")).alias("before"))
    within = df.withColumn("at", F.row_number().over(Window.partitionBy(group, bucket).orderBy(*order)))
    return within.join(first, [group, bucket]).withColumn(name, F.col("before") + F.col("at")).drop("before", "at")


def cut_evenly(rows: DataFrame, total: int, n_shards: int) -> DataFrame:
    """rows with the shard and the slot of their `place` from 0 to total - 1; the n_shards runs of places differ by one at most. Whole
    numbers only: shard k begins at k * total / n_shards, rounded up."""
    rows = rows.withColumn("shard", F.expr(f"cast(cast(place AS decimal(20,0)) * {n_shards} div {max(total, 1)} AS int)"))
    return rows.withColumn("slot", F.expr(f"place - cast((cast(shard AS decimal(20,0)) * {total} + {n_shards - 1}) div {n_shards} AS long)"))


def assign_shards(df: DataFrame, n_shards: int = N_SHARDS, *, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row (doc_id, size, text_crc32, source, shard, slot) per row of df.

    Within a source, rows are ranked in the order of md5(seed:doc_id); rank - 1/2 over the source's rows is the fractional rank. All rows
    in the order of the fractional rank, ties by that md5 and the id, are cut into n_shards runs whose lengths differ by one at most; the
    place in the run is the slot. A null source is a source like any other, a null text is empty, a null id hashes as an empty string,
    and repeated rows each get a place (in an order that only their equal columns leave open). An empty table gives no rows. Only the
    id, text and source are read. The text is read once, for its size and checksum, and never shuffled."""
    text, key = column(df, text_col), column(df, id_col)
    rows = df.select(key.alias("doc_id"), (utf8_length(text) + OVERHEAD).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.coalesce(F.concat(F.lit("="), column(df, source_col).cast("string")), F.lit("")).alias("stratum"), F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary")).alias("h"))
    rows = materialize(rows)
    per_source = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("of"))
    total = rows.count()
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(65536, max(total // bucket_rows, min(tasks, total // LEAST_ROWS)) + 1)
    order = [F.col("h"), F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    rows = rows.withColumn("part", F.floor(F.conv(F.substring("h", 1, 4), 16, 10).cast("int") * buckets / 65536).cast("int"))
    rows = ranked(rows, "stratum", "part", order, "rank").join(per_source, "stratum")
    rows = rows.withColumn("fraction", (2 * F.col("rank") - 1) / (2 * F.col("of")))
    rows = rows.withColumn("part", F.least(F.floor(F.col("fraction") * buckets), F.lit(buckets - 1)).cast("int")).withColumn("all", F.lit(0))
    rows = ranked(rows, "all", "part", [F.col("fraction"), *order], "place").withColumn("place", F.col("place") - 1)
    rows = cut_evenly(rows, total, n_shards)
    return rows.select("doc_id", "size", "text_crc32", F.when(F.col("stratum") != "", F.substring("stratum", 2, 1 << 30)).alias("source"), "shard", "slot")


def write_shards(df: DataFrame, path: str, n_shards: int = N_SHARDS, *, id_col: str = "doc_id", **options) -> None:
    """Write df's rows below path as shard=K folders, each in the order of its slots. Ids have to be unique and not null."""
    places = assign_shards(df, n_shards, id_col=id_col, **options).select(F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    rows = df.join(places, column(df, id_col) == F.col("_id")).drop("_id").withColumnRenamed("_shard", "shard")
    rows.repartitionByRange("shard", "_slot").sortWithinPartitions("shard", "_slot").drop("_slot").write.partitionBy("shard").parquet(path)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign_shards(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


#: crc32: the reflected polynomial 0xEDB88320 (a fixed value), a byte at a time, by a table that the query builds.
OP5_SQL = f"""
WITH poly AS (
  SELECT list(list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, (c & 1) * 3988292384)::BIGINT) ORDER BY i) AS t FROM range(256) r(i)
), d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), c AS (
  SELECT doc_id, source, h, octet_length(encode(text)) + {OVERHEAD} AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)),
                         lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])::BIGINT), 4294967295)::BIGINT AS text_crc32
  FROM d, poly
), f AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY h, doc_id) - 1)::DOUBLE / (2 * count(*) OVER (PARTITION BY source)) AS fraction FROM c
), p AS (
  SELECT *, row_number() OVER (ORDER BY fraction, h, doc_id) - 1 AS place, count(*) OVER () AS n FROM f
), s AS (
  SELECT *, (place * {N_SHARDS} // n)::INT AS shard FROM p
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, shard, (place - (shard::BIGINT * n + {N_SHARDS - 1}) // {N_SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard, source FROM s
"""
