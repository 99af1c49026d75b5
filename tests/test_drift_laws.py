"""Exact laws of the KS distance and of chi-square, against counting and against closed forms."""

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickflow.operators import drift
from tickflow.operators.quantiles import quantiles


def counted(m, n, d):
    """The share of all orders of m and n values whose distribution functions are at least d apart."""
    far = total = 0
    for places in combinations(range(m + n), m):
        own, i, j, most = set(places), 0, 0, 0.0
        for k in range(m + n):
            i, j = i + (k in own), j + (k not in own)
            most = max(most, abs(i * n - j * m))
        far += most >= round(d * m * n)
        total += 1
    return far / total


@pytest.mark.parametrize("m, n", [(1, 1), (1, 5), (3, 4), (5, 5), (6, 4), (7, 3), (2, 9)])
def test_smirnov_by_counting(m, n):
    for k in range(m * n + 1):
        d = k / (m * n)
        assert drift.smirnov_tail(d, m, n) == pytest.approx(counted(m, n, d), abs=1e-12)


def test_smirnov_meets_its_asymptote(spark):
    d = 0.12
    limit = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * d * d * 300 * 320 / 620) for k in range(1, 50))
    assert drift.smirnov_tail(d, 300, 320) == pytest.approx(limit, rel=0.12)


def test_ks_uses_the_exact_law(spark):
    frame = lambda values: spark.createDataFrame([("a", float(v)) for v in values], "feature string, value double")
    row = drift.ks(frame([1, 2, 3, 4]), frame([2.5, 5, 6])).first()
    assert row["ks"] == pytest.approx(2 / 3) and row["p_value"] == pytest.approx(counted(4, 3, 2 / 3), abs=1e-12)
    row = drift.ks(frame([1, 2]), frame([])).collect()
    assert row[0]["p_value"] == 1.0


def chi_tail(df, x):
    """By the integral of the density, in steps of Simpson's rule, from a closed form's neighbour for odd degrees."""
    if df % 2 == 0:
        return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(df // 2))
    out = math.erfc(math.sqrt(x / 2))
    for k in range(1, df // 2 + 1):
        out += math.exp(-x / 2 + (k - 0.5) * math.log(x / 2) - math.lgamma(k + 0.5))
    return out


def test_chi_square_tail_of_any_degree(spark):
    cases = [(df, x) for df in range(1, 61) for x in (0.01, 0.5, 2.0, 5.0, 12.4, 12.6, 30.0, 90.0, 200.0)]
    rows = spark.createDataFrame([(df, x) for df, x in cases], "df int, x double").select("df", "x", drift._gamma_tail(F.col("df"), F.col("x")).alias("p")).collect()
    for r in rows:
        assert r.p == pytest.approx(chi_tail(r.df, r.x), abs=1e-10, rel=1e-7), (r.df, r.x)


def test_chi_square_of_odd_degrees(spark):
    counts = lambda ns: spark.createDataFrame([(f"c{k}", n) for k, n in enumerate(ns)], "category string, n long")
    row = drift.chi_square(counts([100, 100]), counts([60, 40])).first()
    assert row["statistic"] == pytest.approx(4.0) and row["p_value"] == pytest.approx(math.erfc(math.sqrt(2.0)), abs=1e-12)


def test_values_that_decide_nothing_are_counted_together(spark):
    """PSI, KS and quantiles of 120,000 values are those of numpy, and are read from few rows; a cell between two ranks that only the live
    side fills is looked into, and a distance that lies inside a cell is found."""
    rng = np.random.default_rng(3)
    ref, live = rng.normal(size=40_000), rng.normal(0.02, 1.1, size=80_000)
    gap = {"ref": np.repeat([0.0, 10.0], [500, 501]), "live": np.concatenate((np.zeros(10), rng.uniform(0, 10, 30_000)))}
    atoms = {"ref": rng.integers(0, 3, 3000).astype(float), "live": rng.integers(0, 4, 3000).astype(float)}
    data = {"normal": {"ref": ref, "live": live}, "gap": gap, "atoms": atoms}
    rows = pd.concat([pd.DataFrame({"feature": f, "side": s, "value": x}) for f, sides in data.items() for s, x in sides.items()])
    table = spark.createDataFrame(rows).repartition(4)
    values = drift.counted(table, F.col("side") == "ref", F.col("side") == "live")
    assert values.where("feature = 'normal'").count() < 20_000
    found = {r["feature"]: (r["psi"], r["n_live"]) for r in drift.psi_of(values).collect()}
    far = {r["feature"]: (r["ks"], r["n_ref"]) for r in drift.ks_of(values).collect()}
    middle = {r["feature"]: list(r["q"]) for r in quantiles(table.select("feature", "value"), [0.5, 0.73]).collect()}
    for f, x in data.items():
        a, b = np.sort(x["ref"]), np.sort(x["live"])
        edges = np.unique(np.quantile(a, np.arange(11) / 10))[1:-1]
        r, o = (np.maximum(np.bincount(np.searchsorted(edges, s, "right"), minlength=len(edges) + 1) / len(s), 1e-6) for s in (a, b))
        assert found[f] == (pytest.approx(((o - r) * np.log(o / r)).sum(), rel=1e-9), len(b))
        every = np.concatenate((a, b))
        want = np.abs(np.searchsorted(a, every, "right") / len(a) - np.searchsorted(b, every, "right") / len(b)).max()
        assert far[f] == (pytest.approx(want, rel=1e-12), len(a))
        assert middle[f] == pytest.approx(np.quantile(every, [0.5, 0.73]), rel=1e-12)
