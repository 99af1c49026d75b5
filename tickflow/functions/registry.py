"""The feature registry: names in their one fixed order, and projections between maps and columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURE_SET_VERSION = 1

# The names and their order are the contract between stored feature maps and models.
FEATURE_NAMES = (
    "ma_5m",
    "ma_15m",
    "ma_60m",
    "price_to_ma_5m",
    "price_to_ma_15m",
    "price_to_ma_60m",
    "ema_15m",
    "volatility_15m",
    "volatility_60m",
    "high_low_range_15m",
    "realised_vol_1h",
    "realised_vol_24h",
    "roc_1m",
    "roc_5m",
    "roc_15m",
    "rsi_15m",
    "direction_streak",
    "volume_change",
    "volume_relative_to_ma_15m",
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
)


def to_map(names: Sequence[str] = FEATURE_NAMES) -> Column:
    """The feature columns as one map; a null value stays as a null under its name."""
    return F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).cast("double") for n in names]))


def to_columns(values: Column | str, names: Sequence[str] = FEATURE_NAMES) -> list[Column]:
    """Columns in registry order. A name that the map lacks is an error when the row is read; a null under the name is not."""
    m = F.col(values) if isinstance(values, str) else values
    return [F.when(F.map_contains_key(m, n), F.element_at(m, n)).otherwise(F.raise_error(F.lit(f"feature map lacks {n}"))).cast("double").alias(n) for n in names]


def ordered_values(values: Column | str, names: Sequence[str] = FEATURE_NAMES) -> Column:
    return F.array(*to_columns(values, names))


def unpivoted(df: DataFrame, keys: Sequence[str], names: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """One row (keys, feature, value) per row and feature."""
    return df.select(*keys, *[F.col(n).cast("double").alias(n) for n in names]).unpivot(list(keys), list(names), "feature", "value")


def finite(value: Column) -> Column:
    """Whether a value is neither null nor NaN nor infinite. Missing values are left out, never taken as 0."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
