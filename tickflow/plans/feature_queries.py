"""Queries over ticks and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.functions.registry import FEATURE_NAMES, to_columns, to_map
from tickflow.functions.scalars import DAY_US
from tickflow.operators.features import latest_per_symbol
from tickflow.operators.scans import page
from tickflow.plans.base import FEATURES_SQL, MIDDLE_US, NOW_US, TICKS_SQL, features, rounded
from tickflow.sources.ingest import deduplicated, event_ticks, history_rows, ticks

GROUPS = {
    "feat_moving_averages": ("ma_5m", "ma_15m", "ma_60m"),
    "feat_price_to_ma": ("price_to_ma_5m", "price_to_ma_15m", "price_to_ma_60m"),
    "feat_ema": ("ema_15m",),
    "feat_volatility": ("volatility_15m", "volatility_60m"),
    "feat_realised_vol": ("realised_vol_1h", "realised_vol_24h"),
    "feat_range_roc": ("high_low_range_15m", "roc_1m", "roc_5m", "roc_15m"),
    "feat_rsi": ("rsi_15m",),
    "feat_streak": ("direction_streak",),
    "feat_volume": ("volume_change", "volume_relative_to_ma_15m"),
    "feat_temporal": ("hour_sin", "hour_cos", "dow_sin", "dow_cos"),
}


def _sql(names) -> str:
    return ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in names)


def ticks_valid(spark, sf_dir):
    return ticks(spark, sf_dir).select("symbol", "t", "price", "volume", "message_id")


def ticks_dead_letter(spark, sf_dir):
    """Dead letters of events whose values are lowered by 5, which leaves some without a positive price."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("value", F.round(F.col("value") - 5, 6))
    return event_ticks(events).where("reason is not null").select("message_id", "symbol", "t", "price", "volume", F.lit("dead.validation").alias("route"), F.col("reason").alias("fault"))


def ticks_dedup(spark, sf_dir):
    rows = ticks(spark, sf_dir)
    again = rows.where(F.col("message_id").cast("long") % 10 == 0)
    renamed = rows.where(F.col("message_id").cast("long") % 15 == 0).withColumn("message_id", (F.col("message_id").cast("long") + 10_000_000).cast("string"))
    return deduplicated(rows.unionByName(again).unionByName(renamed)).select("symbol", "t", "price", "volume", "message_id")


def tick_page(spark, sf_dir):
    """The second page of 50 ticks of one symbol, newest first, and whether there are more."""
    rows = page(ticks(spark, sf_dir).where("symbol = 'click'"), ["t"], limit=50, offset=50)
    return rows.select("symbol", "t", "price", "volume", "place", "has_more")


def ticks_in_range(spark, sf_dir):
    return ticks(spark, sf_dir).where((F.col("t") >= MIDDLE_US) & (F.col("t") < MIDDLE_US + DAY_US)).select("symbol", "t", "price", "volume")


def ticks_recent(spark, sf_dir):
    return ticks(spark, sf_dir).where(F.col("t") >= NOW_US - DAY_US).select("symbol", "t", "price", "volume")


def latest_tick_per_symbol(spark, sf_dir):
    return ticks(spark, sf_dir).groupBy("symbol").agg(F.max("t").alias("t"))


def history_arrays_explode(spark, sf_dir):
    """Ticks packed into payload arrays of a day and symbol, then unpacked as a history source gives them."""
    day = F.floor(F.col("t") / DAY_US)
    pair = lambda v: F.array((F.col("t") / 1000).cast("long").cast("double"), F.col(v))
    payloads = ticks(spark, sf_dir).groupBy("symbol", day.alias("day")).agg(F.array_sort(F.collect_list(F.struct("t", pair("price").alias("p"), pair("volume").alias("v")))).alias("x"))
    payloads = payloads.select("symbol", F.col("x.p").alias("prices"), F.col("x.v").alias("total_volumes"))
    return history_rows(payloads).select("symbol", "t", "price", "volume")


def _group(names):
    return lambda spark, sf_dir: rounded(features(spark, sf_dir, names).select("symbol", "t", *names))


def feat_flags(spark, sf_dir):
    return features(spark, sf_dir, ()).select("symbol", "t", "insufficient_history", "has_gap")


def feature_vector(spark, sf_dir):
    return rounded(features(spark, sf_dir))


def latest_features_per_symbol(spark, sf_dir):
    return rounded(latest_per_symbol(features(spark, sf_dir)))


def feature_rows_range(spark, sf_dir):
    """Stored feature maps of a day, back as columns in registry order."""
    stored = features(spark, sf_dir).select("symbol", "t", to_map().alias("feature_values"), F.lit(1).alias("version"))
    day = stored.where((F.col("t") >= MIDDLE_US) & (F.col("t") < MIDDLE_US + DAY_US) & (F.col("version") == 1))
    return rounded(day.select("symbol", "t", *to_columns("feature_values")))


def features_join_price(spark, sf_dir):
    left = features(spark, sf_dir, ("ma_60m",)).drop("price", "volume")
    return rounded(left.join(ticks(spark, sf_dir).select("symbol", "t", "price"), ["symbol", "t"]).select("symbol", "t", "price", "ma_60m", "insufficient_history", "has_gap"))


QUERIES = {f.__name__: f for f in (ticks_valid, ticks_dead_letter, ticks_dedup, tick_page, ticks_in_range, ticks_recent, latest_tick_per_symbol, history_arrays_explode, feat_flags, feature_vector, latest_features_per_symbol, feature_rows_range, features_join_price)}
QUERIES |= {name: _group(names) for name, names in GROUPS.items()}

_COLUMNS = f"symbol, t, round(price, 6) + 0.0 AS price, round(volume, 6) + 0.0 AS volume, {_sql(FEATURE_NAMES)}, insufficient_history, has_gap"
SQL = {name: f"WITH {FEATURES_SQL} SELECT symbol, t, {_sql(names)} FROM f" for name, names in GROUPS.items()}
SQL |= {
    "ticks_valid": f"WITH {TICKS_SQL} SELECT symbol, t, price, volume, message_id FROM ticks",
    "ticks_dead_letter": "SELECT CAST(event_id AS VARCHAR) AS message_id, event_type AS symbol, epoch_us(ts) AS t, round(value - 5, 6) AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume, 'dead.validation' AS route, CASE WHEN event_type IS NULL OR trim(event_type) = '' THEN 'symbol' WHEN value IS NULL OR NOT round(value - 5, 6) > 0 THEN 'price' ELSE 'volume' END AS fault FROM events WHERE event_type IS NULL OR trim(event_type) = '' OR value IS NULL OR NOT round(value - 5, 6) > 0 OR NOT coalesce(CAST(json_extract_string(props, '$.k') AS DOUBLE) >= 0, false)",
    "ticks_dedup": f"WITH {TICKS_SQL} SELECT symbol, t, price, volume, message_id FROM ticks QUALIFY row_number() OVER (PARTITION BY symbol, t ORDER BY event_id) = 1",
    "tick_page": f"WITH {TICKS_SQL}, n AS (SELECT symbol, t, price, volume, row_number() OVER (ORDER BY t DESC) AS k, count(*) OVER () AS total FROM ticks WHERE symbol = 'click') SELECT symbol, t, price, volume, k - 50 AS place, total > 100 AS has_more FROM n WHERE k BETWEEN 51 AND 100",
    "ticks_in_range": f"WITH {TICKS_SQL} SELECT symbol, t, price, volume FROM ticks WHERE t >= {MIDDLE_US} AND t < {MIDDLE_US + DAY_US}",
    "ticks_recent": f"WITH {TICKS_SQL} SELECT symbol, t, price, volume FROM ticks WHERE t >= {NOW_US - DAY_US}",
    "latest_tick_per_symbol": f"WITH {TICKS_SQL} SELECT symbol, max(t) AS t FROM ticks GROUP BY symbol",
    "history_arrays_explode": f"WITH {TICKS_SQL} SELECT symbol, t // 1000 * 1000 AS t, price, volume FROM ticks",
    "feat_flags": f"WITH {FEATURES_SQL} SELECT symbol, t, insufficient_history, has_gap FROM f",
    "feature_vector": f"WITH {FEATURES_SQL} SELECT {_COLUMNS} FROM f",
    "latest_features_per_symbol": f"WITH {FEATURES_SQL} SELECT {_COLUMNS} FROM f QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY t DESC) = 1",
    "feature_rows_range": f"WITH {FEATURES_SQL} SELECT symbol, t, {_sql(FEATURE_NAMES)} FROM f WHERE t >= {MIDDLE_US} AND t < {MIDDLE_US + DAY_US}",
    "features_join_price": f"WITH {FEATURES_SQL} SELECT symbol, t, round(price, 6) + 0.0 AS price, round(ma_60m, 6) + 0.0 AS ma_60m, insufficient_history, has_gap FROM f",
}
