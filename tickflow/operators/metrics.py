"""Classification metrics per model, as aggregations: each model is a value of a key column, and one pass serves all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.functions.scalars import DAY_US, LABELS
from tickflow.operators.halo import running

#: The least probability that a logarithm sees: the spacing of doubles at 1.
EPS = 2.220446049250313e-16


def _cell(actual: str, predicted: str) -> Column:
    return F.count_if((F.col("actual") == actual) & (F.col("predicted") == predicted))


def confusion_matrix(rows: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """(keys, actual, predicted, n) over the full grid of labels, zeros included."""
    cells = [(a, p) for a in LABELS for p in LABELS]
    wide = rows.groupBy(*keys).agg(*[_cell(a, p).alias(f"{a}|{p}") for a, p in cells])
    long = wide.unpivot(list(keys), [f"{a}|{p}" for a, p in cells], "cell", "n")
    return long.select(*keys, F.split_part("cell", F.lit("|"), F.lit(1)).alias("actual"), F.split_part("cell", F.lit("|"), F.lit(2)).alias("predicted"), "n")


def _zero(a: Column, b: Column) -> Column:
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def class_metrics(rows: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """(keys, label, precision, recall, f1, support); 0 / 0 is 0."""
    kinds = [c for x in LABELS for c in (F.count_if((F.col("actual") == x) & (F.col("predicted") == x)).alias(f"tp_{x}"), F.count_if(F.col("predicted") == x).alias(f"p_{x}"), F.count_if(F.col("actual") == x).alias(f"a_{x}"))]
    wide = rows.groupBy(*keys).agg(*kinds)
    one = lambda x: F.struct(F.lit(x).alias("label"), _zero(F.col(f"tp_{x}"), F.col(f"p_{x}")).alias("precision"), _zero(F.col(f"tp_{x}"), F.col(f"a_{x}")).alias("recall"), _zero(2 * F.col(f"tp_{x}"), F.col(f"p_{x}") + F.col(f"a_{x}")).alias("f1"), F.col(f"a_{x}").alias("support"))
    return wide.select(*keys, F.explode(F.array(*[one(x) for x in LABELS])).alias("x")).select(*keys, "x.*")


def _f1(x: str) -> Column:
    hit = F.count_if((F.col("actual") == x) & (F.col("predicted") == x))
    return _zero(2 * hit, F.count_if(F.col("predicted") == x) + F.count_if(F.col("actual") == x))


def macro_f1() -> Column:
    """The mean of the three labels' F1; a label that is absent counts as 0."""
    return sum((_f1(x) for x in LABELS), F.lit(0.0)) / len(LABELS)


def accuracy() -> Column:
    return F.coalesce(F.avg((F.col("actual") == F.col("predicted")).cast("double")), F.lit(0.0))


def log_loss(p: str = "p") -> Column:
    """p: the probabilities of the labels in their order."""
    own = sum((F.when(F.col("actual") == x, F.col(p)[i]).otherwise(0.0) for i, x in enumerate(LABELS)), F.lit(0.0))
    return -F.avg(F.ln(F.greatest(F.least(own, F.lit(1.0)), F.lit(EPS))))


def brier(p: str = "p") -> Column:
    return F.avg(sum(((F.col(p)[i] - F.when(F.col("actual") == x, 1.0).otherwise(0.0)) ** 2 for i, x in enumerate(LABELS)), F.lit(0.0)))


def uniform_brier(n: int = len(LABELS)) -> float:
    return (n - 1) / n


def class_mix(column: str = "predicted") -> list[Column]:
    """The share of each label, 0 without rows."""
    return [F.coalesce(F.avg((F.col(column) == x).cast("double")), F.lit(0.0)).alias(f"share_{x}") for x in LABELS]


def summary(rows: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """(keys, n, accuracy, macro_f1, logloss, brier): everything but the grids, in one pass."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), accuracy().alias("accuracy"), macro_f1().alias("macro_f1"), log_loss().alias("logloss"), brier().alias("brier"))


def bucket_accuracy(rows: DataFrame, buckets: int = 5, keys: Sequence[str] = ("model",), *, order: Sequence[str] = ("t", "symbol"), chunk_us: int = DAY_US) -> DataFrame:
    """(keys, bucket, n, accuracy): rows in order of time, cut into near-equal buckets, the first ones larger by one. Places in the order
    are running counts, so no task orders all rows of a model. Empty buckets have no row."""
    at = running(rows.withColumn("_one", F.lit(1)).withColumn("_b", F.floor(F.col("t") / chunk_us)), list(keys), "_b", list(order), {"_rn": "_one"})
    sized = at.join(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), list(keys))
    q, r, i = F.floor(F.col("_n") / buckets), F.col("_n") % buckets, F.col("_rn") - 1
    bucket = F.when(i < r * (q + 1), F.floor(i / (q + 1))).otherwise(r + F.floor((i - r * (q + 1)) / F.greatest(q, F.lit(1))))
    return sized.withColumn("bucket", bucket.cast("long")).groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("n"), accuracy().alias("accuracy"))


def performance_slices(rows: DataFrame, key: str = "model_version") -> DataFrame:
    """One row per model version: counts, accuracy, macro F1, the nine cells and the predicted mix."""
    cells = [_cell(a, p).alias(f"n_{a}_{p}") for a in LABELS for p in LABELS]
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), accuracy().alias("accuracy"), macro_f1().alias("macro_f1"), *cells, *class_mix())


def distribution_shift(slices: DataFrame, prior: dict[str, float]) -> DataFrame:
    """slices with half the sum of absolute differences between their predicted mix and the prior."""
    return slices.withColumn("shift", 0.5 * sum((F.abs(F.col(f"share_{x}") - F.lit(float(prior.get(x, 0.0)))) for x in LABELS), F.lit(0.0)))


def majority_class(rows: DataFrame, label: str = "label") -> str:
    """The most frequent label, the first by name of equals."""
    top = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label).first()
    if top is None:
        raise ValueError("no labels")
    return top[0]


def latest_prior(runs: DataFrame) -> DataFrame:
    """The class shares of the newest training run (counts: map, finished: time); no counts, no row."""
    newest = runs.groupBy().agg(F.max_by("counts", "finished").alias("counts"))
    total = F.aggregate(F.map_values("counts"), F.lit(0).cast("bigint"), lambda a, v: a + v)
    return newest.where(total > 0).select(F.transform_values("counts", lambda _, v: v / total).alias("prior"))

