"""What the queries share: inputs derived from the driver's tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.registry import FEATURE_NAMES
from tickflow.functions.scalars import DAY_US, HOUR_US, MINUTE_US
from tickflow.operators.features import compute_features
from tickflow.sources.ingest import ticks

#: The clock of every query: 2024-01-30 00:00:00 UTC.
NOW_US = 1_706_572_800_000_000
START_US, MIDDLE_US = 1_704_067_200_000_000, 1_704_067_200_000_000 + 15 * DAY_US
#: Events are sparse, so gaps are long ones.
GAP_US = 2 * HOUR_US
HORIZON_US, TOLERANCE_US, THETA = HOUR_US, 30 * MINUTE_US, 0.5

TICKS_SQL = """ticks AS (
  SELECT event_type AS symbol, epoch_us(ts) AS t, value AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume, CAST(event_id AS VARCHAR) AS message_id, event_id
  FROM events WHERE value > 0 AND CAST(json_extract_string(props, '$.k') AS DOUBLE) >= 0 AND event_type IS NOT NULL AND trim(event_type) <> '' AND ts IS NOT NULL
)"""


def features(spark: SparkSession, sf_dir: str, names: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """The features as their SQL has them: the past that a tick knows is bounded in time, not in rows."""
    return compute_features(ticks(spark, sf_dir), gap_us=GAP_US, history_rows=None, names=names)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles with 6 decimals, so that sums in another order compare equal; -0.0 becomes 0.0."""
    return df.select(*[(F.round(F.col(f"`{c}`"), 6) + F.lit(0.0)).alias(c) if kind == "double" else F.col(f"`{c}`") for c, kind in df.dtypes])




def features_sql(ticks_sql: str = TICKS_SQL, gap_us: int = GAP_US) -> str:
    """The features by self-join and lists, not by the window formulas of the DataFrame side: CTEs of which the last is f."""
    return f"""{ticks_sql}, near AS (
  SELECT a.symbol, a.t, any_value(a.price) AS price, any_value(a.volume) AS volume, min(b.t) AS oldest,
         list(b.price ORDER BY b.t) FILTER (b.t > a.t - {MINUTE_US}) AS p1, list(b.price ORDER BY b.t) FILTER (b.t > a.t - {5 * MINUTE_US}) AS p5, list(b.price ORDER BY b.t) FILTER (b.t > a.t - {15 * MINUTE_US}) AS p15,
         list(b.price ORDER BY b.t) FILTER (b.t > a.t - {HOUR_US}) AS p60, list(b.price ORDER BY b.t) FILTER (b.t > a.t - {DAY_US}) AS p24,
         list(b.volume ORDER BY b.t) FILTER (b.t > a.t - {15 * MINUTE_US}) AS v15, list(b.t ORDER BY b.t) FILTER (b.t > a.t - {DAY_US}) AS t24, list(b.volume ORDER BY b.t DESC) AS vs
  FROM ticks a JOIN ticks b ON a.symbol = b.symbol AND b.t BETWEEN a.t - {27 * HOUR_US} AND a.t
  GROUP BY a.symbol, a.t
), r AS (
  SELECT *, list_transform(range(1, len(p15)), lambda i: (p15[i + 1] - p15[i]) / nullif(p15[i], 0)) AS r15, list_transform(range(1, len(p60)), lambda i: (p60[i + 1] - p60[i]) / nullif(p60[i], 0)) AS r60,
         list_transform(range(1, len(p24)), lambda i: (p24[i + 1] - p24[i]) / nullif(p24[i], 0)) AS r24, list_transform(range(1, len(p15)), lambda i: p15[i + 1] - p15[i]) AS d15,
         list_transform(range(1, len(p60)), lambda i: sign(p60[len(p60) - i + 1] - p60[len(p60) - i])) AS back
  FROM near
), s AS (
  SELECT *, list_sum(list_transform(d15, lambda d: greatest(d, 0))) / len(d15) AS gain, list_sum(list_transform(d15, lambda d: greatest(-d, 0))) / len(d15) AS loss,
         coalesce(list_position(list_transform(back, lambda x: x <> back[1]), true) - 1, len(back)) AS run
  FROM r
), f AS (
  SELECT symbol, t, price, volume,
         CASE WHEN oldest <= t - {5 * MINUTE_US} THEN list_avg(p5) END AS ma_5m, CASE WHEN oldest <= t - {15 * MINUTE_US} THEN list_avg(p15) END AS ma_15m, CASE WHEN oldest <= t - {HOUR_US} THEN list_avg(p60) END AS ma_60m,
         CASE WHEN oldest <= t - {5 * MINUTE_US} THEN price / nullif(list_avg(p5), 0) - 1 END AS price_to_ma_5m, CASE WHEN oldest <= t - {15 * MINUTE_US} THEN price / nullif(list_avg(p15), 0) - 1 END AS price_to_ma_15m,
         CASE WHEN oldest <= t - {HOUR_US} THEN price / nullif(list_avg(p60), 0) - 1 END AS price_to_ma_60m,
         CASE WHEN oldest <= t - {15 * MINUTE_US} THEN list_reduce(p15, lambda e, p: 2.0 / (len(p15) + 1) * p + (1 - 2.0 / (len(p15) + 1)) * e) END AS ema_15m,
         CASE WHEN oldest <= t - {15 * MINUTE_US} AND len(r15) >= 2 THEN list_stddev_samp(r15) END AS volatility_15m, CASE WHEN oldest <= t - {HOUR_US} AND len(r60) >= 2 THEN list_stddev_samp(r60) END AS volatility_60m,
         CASE WHEN oldest <= t - {15 * MINUTE_US} THEN (list_max(p15) - list_min(p15)) / nullif(list_min(p15), 0) END AS high_low_range_15m,
         CASE WHEN oldest <= t - {HOUR_US} AND len(r60) >= 1 THEN sqrt(list_sum(list_transform(r60, lambda x: x * x))) END AS realised_vol_1h,
         CASE WHEN oldest <= t - {DAY_US} AND len(r24) >= 1 THEN sqrt(list_sum(list_transform(r24, lambda x: x * x))) END AS realised_vol_24h,
         CASE WHEN oldest <= t - {MINUTE_US} AND len(p1) >= 2 THEN (price - p1[1]) / nullif(p1[1], 0) END AS roc_1m, CASE WHEN oldest <= t - {5 * MINUTE_US} AND len(p5) >= 2 THEN (price - p5[1]) / nullif(p5[1], 0) END AS roc_5m,
         CASE WHEN oldest <= t - {15 * MINUTE_US} AND len(p15) >= 2 THEN (price - p15[1]) / nullif(p15[1], 0) END AS roc_15m,
         CASE WHEN oldest <= t - {15 * MINUTE_US} AND len(p15) >= 2 THEN CASE WHEN gain = 0 AND loss = 0 THEN 50 WHEN loss = 0 THEN 100 ELSE 100 - 100 / (1 + gain / loss) END END AS rsi_15m,
         CASE WHEN oldest <= t - {HOUR_US} THEN coalesce(back[1] * CASE WHEN back[1] = 0 THEN 0 ELSE run END, 0)::DOUBLE END AS direction_streak,
         volume / nullif(vs[2], 0) - 1 AS volume_change, CASE WHEN oldest <= t - {15 * MINUTE_US} THEN volume / nullif(list_avg(v15), 0) - 1 END AS volume_relative_to_ma_15m,
         sin(2 * pi() * (t // 1000000 % 86400) / 86400) AS hour_sin, cos(2 * pi() * (t // 1000000 % 86400) / 86400) AS hour_cos,
         sin(2 * pi() * (isodow(make_timestamp(t)) - 1) / 7) AS dow_sin, cos(2 * pi() * (isodow(make_timestamp(t)) - 1) / 7) AS dow_cos,
         NOT (oldest <= t - {DAY_US} AND len(vs) >= 2) AS insufficient_history,
         coalesce(list_bool_or(list_transform(range(1, len(t24)), lambda i: t24[i + 1] - t24[i] > {gap_us})), false) AS has_gap
  FROM s
)"""


FEATURES_SQL = features_sql()
