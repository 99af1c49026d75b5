"""Tick sources: decoding, validation, dead letters, de-duplication, and the payloads of price services."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions.scalars import micros

#: Prices and volumes arrive as text or numbers; both are read as text and cast.
ENVELOPE = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("correlation_id", T.StringType()),
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("emitted_at", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("payload", T.StructType([T.StructField("price", T.StringType()), T.StructField("volume", T.StringType()), T.StructField("provider_observed_at", T.StringType())])),
    ]
)
_OFFSET = r"(?i)^\d{4}-\d\d-\d\d[T ]\d\d:\d\d(:\d\d(\.\d+)?)?\s*(Z|[+-]\d\d:?\d\d)$"
PRICE, VOLUME = T.DecimalType(20, 8), T.DecimalType(24, 8)


def _instant(text: Column) -> Column:
    """A timestamp of text that states its offset; without one it is null, not local time."""
    return F.when(text.rlike(_OFFSET), F.try_to_timestamp(text))


def decode(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Tick columns of JSON envelopes, with `reason`: null for a valid tick, else what is wrong with the message. Works on streams too."""
    e = F.from_json(F.col(value_col).cast("string"), ENVELOPE, {"mode": "PERMISSIVE"})
    rows = messages.withColumn("e", e)
    rows = rows.select(
        F.col(value_col).cast("string").alias("value"), "e.message_id", "e.correlation_id", F.col("e.schema_version").cast("short").alias("schema_version"), _instant(F.col("e.emitted_at")).alias("emitted_at"), "e.symbol",
        _instant(F.col("e.payload.provider_observed_at")).alias("observed_at"), F.col("e.payload.price").try_cast(PRICE).alias("price"), F.col("e.payload.volume").try_cast(VOLUME).alias("volume"),
    )
    needed = ("message_id", "correlation_id", "schema_version", "emitted_at", "observed_at")
    wrong = F.when(F.coalesce(F.trim("symbol"), F.lit("")) == "", "symbol").when(F.col("price").isNull() | (F.col("price") <= 0), "price").when(F.col("volume").isNull() | (F.col("volume") < 0), "volume")
    for c in needed:
        wrong = wrong.when(F.col(c).isNull(), c)
    return rows.withColumn("reason", wrong)


def encode(ticks: DataFrame, *keep: str) -> DataFrame:
    """Ticks as JSON envelopes in a column `value`, as the sinks of text and of message logs take them; columns to keep stand beside it."""
    stamp = lambda c: F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    payload = F.struct(F.col("price").cast("string").alias("price"), F.col("volume").cast("string").alias("volume"), stamp("observed_at").alias("provider_observed_at"))
    return ticks.select(F.to_json(F.struct("message_id", "correlation_id", "schema_version", stamp("emitted_at").alias("emitted_at"), "symbol", payload.alias("payload"))).alias("value"), *keep)


def split_valid(decoded: DataFrame, *, expire_before: Column | None = None, late_before: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid ticks, dead letters); dead letters carry reason dead.validation, dead.expired or dead.late and the fault."""
    why = F.when(F.col("reason").isNotNull(), "dead.validation")
    if expire_before is not None:
        why = why.when(F.col("emitted_at") < expire_before, "dead.expired")
    if late_before is not None:
        why = why.when(F.col("observed_at") < late_before, "dead.late")
    rows = decoded.withColumn("dead", why)
    return rows.where("dead is null").drop("dead", "reason", "value"), rows.where("dead is not null").select("value", F.col("dead").alias("reason"), F.col("reason").alias("fault"))


def event_ticks(events: DataFrame) -> DataFrame:
    """Ticks of an events table: symbol, t (microseconds), price, volume, message_id, and reason as in decode()."""
    volume = F.get_json_object("props", "$.k").try_cast("double")
    rows = events.select(F.col("event_type").alias("symbol"), micros("ts").alias("t"), F.col("value").alias("price"), volume.alias("volume"), F.col("event_id").cast("string").alias("message_id"))
    return rows.withColumn("reason", F.when(F.coalesce(F.trim("symbol"), F.lit("")) == "", "symbol").when(F.col("price").isNull() | ~(F.col("price") > 0), "price").when(F.col("volume").isNull() | (F.col("volume") < 0), "volume").when(F.col("t").isNull(), "observed_at"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid ticks of the events table."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return event_ticks(spark.read.parquet(f"{sf_dir}/events.parquet")).where("reason is null").drop("reason")


def deduplicated(rows: DataFrame) -> DataFrame:
    """One tick per (symbol, t) and one per message_id at a time, the smallest message_id first (by length, then text), as numbers sort."""
    order = F.struct(F.length("message_id"), "message_id")
    first = lambda df, *keys: df.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in df.columns if c not in keys]), order).alias("x")).select(*keys, "x.*")
    return first(first(rows, "symbol", "t"), "message_id", "t").select(*rows.columns)


def history_rows(payloads: DataFrame, symbol_col: str = "symbol") -> DataFrame:
    """Ticks of history payloads: prices and total_volumes, two arrays of [ms, value] that are zipped by position; the shorter ends both."""
    n = F.least(F.size("prices"), F.size("total_volumes"))
    pair = F.explode(F.arrays_zip(F.slice("prices", F.lit(1), n).alias("p"), F.slice("total_volumes", F.lit(1), n).alias("v")))
    rows = payloads.select(F.col(symbol_col).alias("symbol"), pair.alias("x"))
    return rows.select("symbol", (F.col("x.p")[0] * 1000).cast("long").alias("t"), F.col("x.p")[1].alias("price"), F.col("x.v")[1].alias("volume"))


def spot_rows(payloads: DataFrame, symbols: DataFrame, now_us: int, value_col: str = "value", currency: str = "usd") -> DataFrame:
    """Ticks of spot payloads, a map from coin to its figures. Coins that symbols (coin, symbol) lacks, or without a price in the
    currency, are left out; a missing volume is 0 and a missing time is now."""
    kind = f"map<string, struct<{currency}: double, {currency}_24h_vol: double, last_updated_at: bigint>>"
    rows = payloads.select(F.explode(F.from_json(F.col(value_col), kind)).alias("coin", "x")).join(symbols, "coin").where(F.col(f"x.{currency}").isNotNull())
    return rows.select("symbol", F.coalesce(F.col("x.last_updated_at") * 1_000_000, F.lit(now_us)).alias("t"), F.col(f"x.{currency}").alias("price"), F.coalesce(F.col(f"x.{currency}_24h_vol"), F.lit(0.0)).alias("volume"))


def envelopes(rows: DataFrame) -> DataFrame:
    """Provider rows (symbol, t, price, volume) as ticks, with new message and correlation ids, emitted now."""
    return rows.select(F.uuid().alias("message_id"), F.uuid().alias("correlation_id"), F.lit(1).cast("short").alias("schema_version"), F.current_timestamp().alias("emitted_at"), "symbol", F.timestamp_micros("t").alias("observed_at"), F.col("price").cast(PRICE).alias("price"), F.col("volume").cast(VOLUME).alias("volume"))
