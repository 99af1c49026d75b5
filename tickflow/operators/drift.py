"""Drift of distributions: PSI, Kolmogorov-Smirnov and chi-square for all features in one job each."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from pyspark.sql.window import Window

from tickflow.functions.registry import FEATURE_NAMES, finite, unpivoted
from tickflow.functions.scalars import psi_severity, severity_rank
from tickflow.operators.quantiles import at_ranks, ordered, thinned
from tickflow.sources.shared import materialize

FLOOR = 1e-6


def clean(long: DataFrame) -> DataFrame:
    return long.where(finite(F.col("value")))


def counted(long: DataFrame, in_reference: Column, in_live: Column, parts: int | None = None, bins: int = 10, names: Sequence[str] = ()) -> DataFrame:
    """What PSI of so many bins and KS are read from, of (feature, value) rows that two conditions assign to the sides: a written table of
    each feature's values in order, (feature, value, r, o, sr, so, n_ref, n_live), with the sides' counts, running counts and totals; values
    that decide neither a bin's edge nor the KS distance are counted together. A row may be of both sides; values that are null or not
    finite are of none. names: the columns that hold values, where rows are not in long form; a feature is then the column's name followed by
    the row's `feature`. The rows are read three times, so they should be stored; no task holds a whole feature."""
    side = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    values = names or [(F.col("value") + 0.0).alias("value")]
    rows = (long if names else clean(long)).select("feature", *values, side(in_reference).alias("r"), side(in_live).alias("o")).where("r + o > 0")
    rows = ordered(thinned(rows, "feature", _shares(bins), distance=True, names=names), "feature", {"sr": "r", "so": "o"}, parts)
    totals = rows.groupBy("feature").agg(F.max("sr").alias("n_ref"), F.max("so").alias("n_live"))
    return materialize(rows.join(F.broadcast(totals), "feature"))  # one row per feature


def _shares(bins: int) -> list[float]:
    return [i / bins for i in range(bins + 1)]


def _sides(reference: DataFrame, live: DataFrame, parts: int | None = None, bins: int = 10) -> DataFrame:
    both = reference.select("feature", "value", F.lit(True).alias("_ref")).unionByName(live.select("feature", "value", F.lit(False).alias("_ref")))
    return counted(materialize(both), F.col("_ref"), ~F.col("_ref"), parts, bins)


def psi(reference: DataFrame, live: DataFrame, bins: int = 10) -> DataFrame:
    """(feature, psi, severity, n_live, evaluable) of (feature, value) rows.

    Bins are cut at the distinct quantiles of the reference, the outer ones open; shares are at least FLOOR. A side without values, or a
    reference of one value, gives 0 and is not evaluable."""
    return psi_of(_sides(reference, live, bins=bins), bins)


def psi_of(values: DataFrame, bins: int = 10) -> DataFrame:
    """psi() of a table of counted(), which is made for as many bins."""
    values = values.where("n_ref > 0")
    edges = at_ranks(values, _shares(bins), "feature", n="r", end="sr", total=F.col("n_ref")).select("feature", F.array_distinct("q").alias("edges"))
    inner = F.when(F.size("edges") > 2, F.slice("edges", F.lit(2), F.size("edges") - 2)).otherwise(F.array().cast("array<double>"))
    edges = edges.select("feature", F.size("edges").alias("k"), inner.alias("inner_edges"))
    binned = values.join(F.broadcast(edges), "feature")  # one row per feature
    counts = binned.groupBy("feature", F.size(F.filter("inner_edges", lambda e: e <= F.col("value"))).alias("bin")).agg(F.sum("r").alias("r"), F.sum("o").alias("o"), F.max("n_ref").alias("n_ref"), F.max("n_live").alias("n_live"), F.max("k").alias("k"))
    # a row per feature and bin from here on; bins without values have the least share on both sides, and add nothing
    share = lambda c, n: F.greatest(F.col(c) / F.nullif(F.col(n), F.lit(0)), F.lit(FLOOR))
    o, r = share("o", "n_live"), share("r", "n_ref")
    ok = (F.col("k") >= 2) & (F.col("n_live") > 0)
    out = counts.groupBy("feature").agg(F.sum(F.when(ok, (o - r) * F.ln(o / r)).otherwise(0.0)).alias("psi"), F.max("n_live").alias("n_live"), F.bool_and(ok).alias("evaluable"))
    return out.select("feature", "psi", psi_severity(F.col("psi")).alias("severity"), "n_live", "evaluable")


def _kolmogorov(d: Column, n: Column) -> Column:
    """The asymptotic p-value, for samples whose product of sizes is over EXACT."""
    lam = (F.sqrt(n) + 0.12 + 0.11 / F.sqrt(n)) * d
    total = sum((F.lit(2.0 * (-1) ** (k - 1)) * F.exp(-2.0 * k * k * lam * lam) for k in range(1, 101)), F.lit(0.0))
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


#: Up to this product of the two sample sizes the law of the KS distance is counted path by path.
EXACT = 100_000


def smirnov_tail(d: float, m: int, n: int) -> float:
    """The probability that two samples of m and n values without ties, of one distribution, are at least d apart.

    The order of the values is a lattice path from (0, 0) to (m, n), and all are equally likely; the share that stays within d is counted
    column by column, scaled as it goes so that it stays a probability."""
    if m < 1 or n < 1:
        return 1.0
    far = round(d * m * n)  # distances are whole numbers of 1 / (m * n)
    if far <= 0:
        return 1.0
    inside = lambda i: np.abs(i * n - np.arange(n + 1) * m) < far
    p = np.cumprod(inside(0).astype(float))  # the first column: straight on, as long as it stays within
    # p[j] is the share, among the paths to (i, j), of those that stayed within
    j = np.arange(n + 1)
    for i in range(1, m + 1):
        ok, out, last = inside(i), np.empty(n + 1), 0.0
        come = i / (i + j)
        part = come * p
        for k in range(n + 1):
            last = (part[k] + (1 - come[k]) * last) if ok[k] else 0.0
            out[k] = last
        p = out
    return float(min(1.0, max(0.0, 1.0 - p[n])))


@F.pandas_udf(DoubleType())
def _smirnov(d: pd.Series, m: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([smirnov_tail(a, int(b), int(c)) for a, b, c in zip(d, m, n, strict=True)])


def _gamma_tail(df: Column, x: Column) -> Column:
    """The upper tail of the chi-square law for any whole number of degrees of freedom: Q(df/2, x/2), the regularised incomplete gamma
    function, by its recurrence from Q(1, y) = exp(-y) or Q(1/2, y) = erfc(sqrt(y)); all terms are positive. Terms are logarithms until they
    are added, so neither many degrees nor large statistics overflow."""
    y, odd = x / 2, df % 2 == 1
    begin = F.when(odd, 0.5).otherwise(1.0)
    # log of y^a exp(-y) / gamma(a + 1) at the first a, then by y / (a + k) from term to term
    first = F.when(odd, 0.5 * F.ln(y) - y - F.lit(math.log(math.gamma(1.5)))).otherwise(F.ln(y) - y)
    steps = F.greatest(F.floor((df - 1) / 2).cast("int"), F.lit(0))
    step = lambda s, k: F.struct((s["t"] + F.ln(y) - F.ln(begin + k)).alias("t"), (s["total"] + F.exp(s["t"])).alias("total"))
    summed = F.aggregate(F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")), F.struct(first.alias("t"), F.lit(0.0).alias("total")), step)
    return F.when(x <= 0, 1.0).otherwise(F.least(F.lit(1.0), F.when(odd, _erfc(F.sqrt(y))).otherwise(F.exp(-y)) + summed["total"]))


def _erfc(z: Column) -> Column:
    """The complementary error function of z >= 0: a series of positive terms below 2.5, a continued fraction from there."""
    terms = F.aggregate(F.sequence(F.lit(1), F.lit(60)), F.struct(z.alias("t"), z.alias("total")), lambda s, k: F.struct((s["t"] * 2 * z * z / (2 * k + 1)).alias("t"), (s["total"] + s["t"] * 2 * z * z / (2 * k + 1)).alias("total")))["total"]
    series = 1 - 2 / math.sqrt(math.pi) * F.exp(-z * z) * terms
    fraction = F.aggregate(F.sequence(F.lit(80), F.lit(1), F.lit(-1)), z.cast("double"), lambda v, k: z + (k / 2) / v)
    return F.when(z < 2.5, series).otherwise(F.exp(-z * z) / (math.sqrt(math.pi) * fraction))


def ks(reference: DataFrame, live: DataFrame, parts: int | None = None) -> DataFrame:
    """(feature, ks, p_value, n_ref, n_live): the greatest distance between the two distribution functions, exactly; (0, 1) if a side is
    empty. The p-value is that of the exact law where the sizes' product is at most EXACT, else the asymptotic one. Running counts go over `parts` ranges of
    values, by default as many as the shuffle's partitions."""
    return ks_of(_sides(reference, live, parts))


def ks_of(values: DataFrame) -> DataFrame:
    """ks() of a table of counted()."""
    gap = F.abs(F.col("sr") / F.nullif(F.col("n_ref"), F.lit(0)) - F.col("so") / F.nullif(F.col("n_live"), F.lit(0)))
    out = values.groupBy("feature").agg(F.coalesce(F.max(gap), F.lit(0.0)).alias("ks"), F.max("n_ref").alias("n_ref"), F.max("n_live").alias("n_live"))
    both = (F.col("n_ref") > 0) & (F.col("n_live") > 0)
    size = F.when(both, F.col("n_ref") * F.col("n_live") / F.nullif(F.col("n_ref") + F.col("n_live"), F.lit(0)))
    small = both & (F.col("n_ref") * F.col("n_live") <= EXACT)
    # a row per feature: the exact law only of those that are small, whose sizes are 0 otherwise
    exact = _smirnov("ks", F.when(small, F.col("n_ref")).otherwise(0), F.when(small, F.col("n_live")).otherwise(0))
    p = F.when(small, F.col("exact")).when(both, _kolmogorov(F.col("ks"), size)).otherwise(1.0)
    return out.withColumn("exact", exact).select("feature", "ks", p.alias("p_value"), "n_ref", "n_live")


def chi_square(reference: DataFrame, live: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, statistic, p_value, n_live) of (keys, category, n) counts: live against the reference's shares over the union of categories.
    Expected counts are at least FLOOR, then scaled to the live total. Without counts on a side: 0 and 1."""
    rows = reference.select(*keys, "category", F.col("n").alias("r"), F.lit(0).alias("o")).unionByName(live.select(*keys, "category", F.lit(0).alias("r"), F.col("n").alias("o"))).groupBy(*keys, "category").agg(F.sum("r").alias("r"), F.sum("o").alias("o"))
    totals = rows.groupBy(*keys).agg(F.sum("r").alias("nr"), F.sum("o").alias("no"), F.collect_list(F.struct("r", "o")).alias("cells"))
    raw = lambda c: F.greatest(c["r"] * F.col("no") / F.nullif(F.col("nr"), F.lit(0)), F.lit(FLOOR))
    scale = F.col("no") / F.aggregate("cells", F.lit(0.0), lambda a, c: a + raw(c))
    out = totals.withColumn("scale", F.when((F.col("nr") > 0) & (F.col("no") > 0), scale))
    out = out.withColumn("statistic", F.aggregate("cells", F.lit(0.0), lambda a, c: a + (c["o"] - raw(c) * F.col("scale")) ** 2 / (raw(c) * F.col("scale")))).withColumn("df", F.size("cells") - 1)
    x = F.col("statistic")
    p = F.when(F.col("scale").isNull() | (F.col("df") < 1), 1.0).otherwise(_gamma_tail(F.col("df"), x))
    return out.select(*keys, F.coalesce("statistic", F.lit(0.0)).alias("statistic"), p.alias("p_value"), F.col("no").alias("n_live"))


def metric_rows(psi_rows: DataFrame, ks_rows: DataFrame, window_start: int, window_end: int, computed_at: int, model_version: str) -> DataFrame:
    """The long table: a row per feature and metric; KS inherits the severity of PSI."""
    a = psi_rows.select("feature", F.lit("psi").alias("metric"), F.col("psi").alias("value"), F.lit(None).cast("double").alias("p_value"), "severity", F.col("n_live").alias("sample_size"))
    b = ks_rows.join(psi_rows.select("feature", "severity"), "feature").select("feature", F.lit("ks").alias("metric"), F.col("ks").alias("value"), "p_value", "severity", F.col("n_live").alias("sample_size"))
    return a.unionByName(b).select("*", F.lit(window_start).alias("window_start"), F.lit(window_end).alias("window_end"), F.lit(computed_at).alias("computed_at"), F.lit(model_version).alias("model_version"))


def worst_severity(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, severity) of the worst row; without keys and rows: stable."""
    out = rows.groupBy(*keys).agg(F.max_by("severity", severity_rank(F.col("severity"))).alias("severity"))
    return out.select(*keys, F.coalesce("severity", F.lit("stable")).alias("severity"))


def psi_heatmap(rows: DataFrame, windows: Sequence[int]) -> DataFrame:
    """One row per feature and a column per window end, named w_<end>."""
    values = rows.where("metric = 'psi'").groupBy("feature").pivot("window_end", list(windows)).agg(F.max("value"))
    return values.select("feature", *[F.col(f"`{w}`").alias(f"w_{w}") for w in windows])


def correlated_breach(rows: DataFrame, least: int = 3, keys: Sequence[str] = ("window_end",)) -> DataFrame:
    """(keys, n, features) where at least so many different features are not stable; the names are sorted."""
    out = rows.where("severity <> 'stable'").groupBy(*keys).agg(F.array_sort(F.collect_set("feature")).alias("f"))
    return out.where(F.size("f") >= least).select(*keys, F.size("f").cast("long").alias("n"), F.concat_ws(",", "f").alias("features"))


def reference_samples(stats: DataFrame, n: int = 1000, seed: int = 42) -> DataFrame:
    """(feature, value): n normal draws per feature of stats, within its least and greatest value; constant where the std is not positive."""
    rows = stats.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(n))))
    digits = lambda s: F.substring(F.md5(F.concat_ws("|", "feature", "_k", F.lit(s)).cast("binary")), 1, 13)
    u = lambda s: (F.conv(digits(s), 16, 10).cast("long") + 1) / F.lit(float((1 << 52) + 1))  # noqa: E731  thirteen hexadecimal digits are 52 bits
    draw = F.sqrt(-2 * F.ln(u(seed))) * F.cos(2 * F.pi() * u(seed + 1))
    return rows.select("feature", F.when(F.col("std") > 0, F.least(F.greatest(F.col("mean") + F.col("std") * draw, F.col("min")), F.col("max"))).otherwise(F.col("mean")).alias("value"))


def numeric_stats(stats: DataFrame, column: str = "stats", schema: Sequence[str] = ("mean", "std", "min", "max", "p50")) -> DataFrame:
    """(feature, mean, std, min, max, p50) of rows (feature, JSON text of a map): entries that are not numbers are null, and features
    without a mean, or whose text is no map, have no row."""
    entries = F.from_json(column, "map<string,string>")
    number = lambda c: F.try_element_at(entries, F.lit(c)).try_cast("double")
    return stats.select("feature", *[F.when(finite(number(c)), number(c)).alias(c) for c in schema]).where("mean is not null")


def drift_run(live: DataFrame, reference: tuple[str, DataFrame] | None, now_us: int, window_us: int, *, draws: int = 1000, seed: int = 42) -> DataFrame:
    """The metric rows of feature rows in [now - window, now), all symbols together and rows without enough history left out, against
    `draws` samples from the statistics that the Production model was stored with. reference: (model version, statistics) as
    model.production_stats() gives it; None gives no rows."""
    start = now_us - window_us
    version, stats = reference or ("", live.sparkSession.createDataFrame([], "feature string, mean double, std double, min double, max double, p50 double"))
    ref = reference_samples(stats.where("mean is not null"), draws, seed)
    rows = live.where((F.col("t") >= start) & (F.col("t") < now_us) & ~F.col("insufficient_history"))
    rows = unpivoted(rows, (), FEATURE_NAMES).join(F.broadcast(stats.select("feature")), "feature", "left_semi")  # one row per feature
    values = _sides(ref, rows)
    return metric_rows(psi_of(values), ks_of(values), start, now_us, now_us, version)


def newest_per_window(rows: DataFrame) -> DataFrame:
    """The newest of the rows that are written for one feature, metric, window and model."""
    keys = ["feature", "metric", "window_start", "window_end", "model_version"]
    w = Window.partitionBy(*keys).orderBy(F.desc("computed_at"))
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
