"""Training data: forward labels, theta, the embargoed chronological split, and what is told about each split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.functions.registry import FEATURE_NAMES, finite, unpivoted
from tickflow.functions.scalars import DAY_US, LABELS, MINUTE_US, forward_return, label_of
from tickflow.operators.asof import forward_self
from tickflow.operators.halo import running
from tickflow.operators.quantiles import quantiles
from tickflow.sources.shared import drop, materialize


@dataclass(frozen=True)
class SplitConfig:
    train: float = 0.70
    validation: float = 0.15
    min_rows: int = 50
    min_class_share: float = 0.05


class InsufficientData(ValueError):
    """A split has too few rows, or too few of a label."""


def with_forward_return(rows: DataFrame, horizon_us: int, tolerance_us: int = 30_000_000) -> DataFrame:
    """rows with future, future_t and ret: the price one horizon on, and the return to it."""
    return forward_self(rows, "price", horizon_us, tolerance_us).withColumn("ret", forward_return(F.col("price"), F.col("future")))


def derive_theta(rows: DataFrame, quantile: float = 0.4) -> float:
    """The exact quantile, linearly interpolated, of the absolute returns of all symbols."""
    if not 0 < quantile < 1:
        raise ValueError("the quantile lies between 0 and 1")
    row = quantiles(materialize(rows.select(F.lit("ret").alias("feature"), F.abs("ret").alias("value"))), [quantile]).first()
    if row is None:
        raise InsufficientData("no returns to derive theta from")
    return float(row["q"][0])


def usable(rows: DataFrame) -> DataFrame:
    return rows.where("future is not null and not insufficient_history and not has_gap")


def split(rows: DataFrame, horizon_us: int, config: SplitConfig = SplitConfig(), *, bucket_us: int = DAY_US) -> DataFrame:
    """rows with `split`: train, validation or test; rows within an embargo, and symbols of fewer than three rows, go.

    Per symbol, in order of time: the first int(n * train) rows, then up to int(n * (train + validation)), then the rest; training rows
    end a horizon before the training bound, validation rows one before theirs. Places in the order are running counts over buckets of
    time, so a symbol may be of any size."""
    at = running(rows.withColumn("_one", F.lit(1)).withColumn("_b", F.floor(F.col("t") / bucket_us)), ["symbol"], "_b", ["t"], {"_rn": "_one"})
    totals = rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")).where("_n >= 3")
    ti = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(config.train)))
    vi = F.least(F.greatest(ti + 1, F.floor(F.col("_n") * F.lit(config.train + config.validation))), F.col("_n") - 1)
    totals = totals.withColumn("_ti", ti).withColumn("_vi", vi)
    edges = at.join(totals, "symbol").groupBy("symbol").agg(F.max(F.when(F.col("_rn") == F.col("_ti"), F.col("t"))).alias("_T"), F.max(F.when(F.col("_rn") == F.col("_vi"), F.col("t"))).alias("_V"))
    t, T, V = F.col("t"), F.col("_T"), F.col("_V")
    part = F.when(t <= T - horizon_us, "train").when((t > T) & (t <= V - horizon_us), "validation").when(t > V, "test")
    return rows.join(edges, "symbol").withColumn("split", part).where("split is not null").drop("_T", "_V")


def class_counts(rows: DataFrame, keys: Sequence[str] = ("split",)) -> DataFrame:
    """(keys, label, n) with every label, 0 where there is none."""
    counts = [F.count_if(F.col("label") == x).alias(x) for x in LABELS]
    return rows.groupBy(*keys).agg(*counts).unpivot(list(keys), list(LABELS), "label", "n")


def check_sufficiency(rows: DataFrame, config: SplitConfig = SplitConfig()) -> None:
    got = {s: {} for s in ("train", "validation", "test")}
    for r in class_counts(rows).collect():  # nine numbers
        got[r["split"]][r["label"]] = r["n"]
    for name, counts in got.items():
        total = sum(counts.values())
        if total < config.min_rows:
            raise InsufficientData(f"{name} has {total} rows of {config.min_rows}")
        for x in LABELS:
            if counts.get(x, 0) < config.min_class_share * total:
                raise InsufficientData(f"{name} has {counts.get(x, 0)} rows of {x} among {total}")


def assemble(features: DataFrame, horizon_us: int = 15 * MINUTE_US, *, tolerance_us: int = 30_000_000, theta: float | None = None, quantile: float = 0.4, config: SplitConfig = SplitConfig(), check: bool = True) -> tuple[DataFrame, float]:
    """(labelled and split rows, theta) of feature rows with prices. theta is the one number that reaches the driver. The features are
    computed once: theta, the split and its check read what was written of them."""
    rows = materialize(usable(with_forward_return(features, horizon_us, tolerance_us)))
    theta = derive_theta(rows, quantile) if theta is None else theta
    out = split(rows.withColumn("label", label_of(F.col("ret"), theta)), horizon_us, config)
    if check:
        out = materialize(out)
        check_sufficiency(out, config)
        drop(rows)
    return out, theta


def class_weights(rows: DataFrame) -> DataFrame:
    """(label, n, weight): n / (3 * count of the label), 1 for a label without rows."""
    counts = class_counts(rows.withColumn("_all", F.lit(0)), ("_all",)).drop("_all")
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select("label", "n", F.when(F.col("n") > 0, F.col("total") / (3 * F.col("n"))).otherwise(1.0).alias("weight"))  # three rows by one


def feature_stats(rows: DataFrame, names: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """(feature, mean, std, min, max, p50) of each feature, the population's std; a feature without values has no row."""
    rows = materialize(rows.select(*[F.col(n).cast("double").alias(n) for n in names]))
    long = unpivoted(rows, (), names).where(finite(F.col("value")))
    out = long.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    return out.join(quantiles(rows, [0.5], names=names).select("feature", F.get("q", F.lit(0)).alias("p50")), "feature")

