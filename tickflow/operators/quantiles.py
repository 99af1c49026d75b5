"""Exact quantiles of groups of any size: counts of distinct values, ranks by running sums over ranges of values."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickflow.functions.registry import finite
from tickflow.operators.halo import running
from tickflow.sources.shared import materialize


def ordered(counts: DataFrame, key: str, sums: Mapping[str, str], parts: int | None = None) -> DataFrame:
    """counts of distinct (key, value) with inclusive running sums {name: column} in the order of value. They are sorted into ranges and
    written once; the ranges are `parts`, or as many as the shuffle's partitions, and hold about equally many values."""
    sizes = () if parts is None else (parts,)
    table = materialize(counts.repartitionByRange(*sizes, key, "value").withColumn("_b", F.spark_partition_id()))
    return running(table, [key], "_b", ["value"], dict(sums)).drop("_b")


#: Values are first counted in about so many cells a key, and all keys together have at most so many.
CELLS, ALL_CELLS = 4096, 1 << 20


def _values(batch: pa.RecordBatch, key: str, names: Sequence[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """The keys of a batch's values, with the places of their rows and the values."""
    codes = batch.column(key).dictionary_encode()
    at = codes.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(at, kind="stable")
    ends = np.searchsorted(at[order], np.arange(len(codes.dictionary) + 1))
    groups = [(k, order[ends[i] : ends[i + 1]]) for i, k in enumerate(codes.dictionary.to_pylist())]
    for name in names or ("value",):
        column = batch.column(name).to_numpy(zero_copy_only=False) + 0.0
        for k, rows in groups:
            if names:
                rows = rows[np.isfinite(column[rows])]
            yield (name + k if names else k), rows, column[rows]


def _cell_counts(key: str, names: Sequence[str], edges: Mapping[str, np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            sides = [batch.column(c).to_numpy() for c in ("r", "o")]
            for k, rows, value in _values(batch, key, names):
                if len(rows):
                    cell, n = np.searchsorted(edges[k], value), len(edges[k]) + 1
                    table = counts.setdefault(k, np.zeros((2, n), "int64"))
                    for total, side in zip(table, sides, strict=True):
                        total += np.bincount(cell, side[rows], n).astype("int64")
        for k, (r, o) in counts.items():
            cell = np.flatnonzero(r + o)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(cell), pa.string()), pa.array(cell.astype("int32")), pa.array(r[cell]), pa.array(o[cell])], names=[key, "cell", "r", "o"])

    return run


def _in_cells(key: str, names: Sequence[str], edges: Mapping[str, np.ndarray], wanted: Mapping[str, np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r, o = (batch.column(c).to_numpy() for c in ("r", "o"))
            for k, rows, value in _values(batch, key, names):
                if len(rows):
                    kept = wanted[k][np.searchsorted(edges[k], value)]
                    rows = rows[kept]
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(rows), pa.string()), pa.array(value[kept]), pa.array(r[rows]), pa.array(o[rows])], names=[key, "value", "r", "o"])

    return run


def thinned(rows: DataFrame, key: str, fractions: Sequence[float], distance: bool = False, names: Sequence[str] = ()) -> DataFrame:
    """(key, value, r, o), the counts of two sides by distinct value, of rows (key, value, r, o) whose values are finite; values that can
    neither be at the rank of one of the fractions of side r nor, with distance, have the greatest distance between the two sides'
    distribution functions are counted together, under a value that no such rank or distance lies between. Whatever is read of those is
    exact, but only the values near them are grouped and sorted one by one. names: the columns that hold the values instead of `value`;
    a value's key is then the column's name followed by the row's key, and values that are null or not finite are left out.

    rows are read three times: for cells of about equally many values (any cells would do), for the sides' exact counts in each, and for
    the values in the cells that matter. If all cells do, all values are counted one by one. The cells' edges reach the driver, ALL_CELLS
    numbers at most."""
    shares = ", ".join(f"{i / CELLS}D" for i in range(1, CELLS))
    long = rows.select(key, *names).unpivot([key], list(names), "_name", "value").where(finite(F.col("value"))).select(F.concat("_name", key).alias(key), (F.col("value") + 0.0).alias("value")) if names else rows
    cuts = materialize(long.groupBy(key).agg(F.expr(f"percentile_approx(value, array({shares}), {2 * CELLS})").alias("e")))
    each = -(-cuts.count() * CELLS // ALL_CELLS)
    edges = {k: np.unique(np.asarray(e)) for k, e in cuts.select(key, F.filter("e", lambda e, i: i % max(each, 1) == 0)).collect()}  # bounded by ALL_CELLS
    cells = rows.mapInArrow(_cell_counts(key, names, edges), f"{key} string, cell int, r long, o long").groupBy(key, "cell").agg(F.sum("r").alias("r"), F.sum("o").alias("o"))
    w, whole = Window.partitionBy(key).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(key)  # a key's cells, CELLS at most
    cells = cells.select("*", F.sum("r").over(w).alias("sr"), F.sum("o").over(w).alias("so"), F.sum("r").over(whole).alias("nr"), F.sum("o").over(whole).alias("no"))
    wanted = F.lit(False)
    for p in fractions:  # the cells that hold a rank's lower and upper neighbour, those between the two and the ones next to them
        at = (F.col("nr") - 1) * F.lit(float(p))
        wanted |= (F.col("nr") > 0) & (F.col("sr") >= F.floor(at)) & (F.col("sr") - F.col("r") <= F.ceil(at) + 1)
    if distance:
        share = lambda c, n: F.col(c) / F.nullif(F.col(n), F.lit(0))
        gap = share("sr", "nr") - share("so", "no")
        # within a cell, the gap reaches at most what it is with all of one side's values and none of the other's
        reach = F.greatest(F.abs(gap + share("o", "no")), F.abs(gap - share("r", "nr")))
        cells = cells.withColumns({"gap": F.abs(gap), "reach": reach})
        wanted |= F.coalesce(F.col("reach") > F.max("gap").over(whole), F.lit(False))
    cells = materialize(cells.select(key, "cell", "r", "o", wanted.alias("wanted")))
    fine = {k: np.zeros(len(e) + 1, bool) for k, e in edges.items()}
    for k, c in cells.where("wanted").groupBy(key).agg(F.collect_list("cell")).collect():  # no more than edges
        fine[k][c] = True
    values = rows.mapInArrow(_in_cells(key, names, edges, fine), f"{key} string, value double, r long, o long").groupBy(key, "value").agg(F.sum("r").alias("r"), F.sum("o").alias("o"))
    tops = rows.sparkSession.createDataFrame([(k, [*e.tolist(), float(np.finfo(float).max)]) for k, e in edges.items()], f"{key} string, e array<double>")
    rest = cells.where("not wanted").join(F.broadcast(tops), key).select(key, F.get("e", F.col("cell")).alias("value"), "r", "o")  # ALL_CELLS numbers
    return values.unionByName(rest)


def at_ranks(rows: DataFrame, fractions: Sequence[float], key: str, *, n: str, end: str, total: Column) -> DataFrame:
    """(key, q array<double>) of distinct values with their counts `n` and inclusive running counts `end`. A value that counts none is at no
    rank; a key without values has no row."""
    rows = rows.where(F.col(n) > 0)
    at = [(total - 1) * F.lit(float(p)) for p in fractions]
    holds = lambda rank: (F.col(end) - F.col(n) <= rank) & (rank < F.col(end))
    pick = lambda rank, name: F.max(F.when(holds(rank), F.col("value"))).alias(name)
    part = lambda a, i: F.max(a - F.floor(a)).alias(f"part{i}")
    ends = rows.groupBy(key).agg(*[pick(F.floor(a), f"lo{i}") for i, a in enumerate(at)], *[pick(F.ceil(a), f"hi{i}") for i, a in enumerate(at)], *[part(a, i) for i, a in enumerate(at)])
    between = [F.when(F.col(f"lo{i}") == F.col(f"hi{i}"), F.col(f"lo{i}")).otherwise((1 - F.col(f"part{i}")) * F.col(f"lo{i}") + F.col(f"part{i}") * F.col(f"hi{i}")) for i in range(len(at))]
    return ends.select(key, F.array(*between).alias("q"))


def quantiles(rows: DataFrame, fractions: Sequence[float], key: str = "feature", names: Sequence[str] = ()) -> DataFrame:
    """(key, q array<double>): the quantiles of (key, value), linearly interpolated between the two nearest ranks. Null values are left
    out; a key without values has no row. With names, each of these columns is a key, and its finite values count. The rows are read three
    times, so they should be stored; no task holds a whole key."""
    one = [F.lit(n).cast("long").alias(c) for c, n in (("r", 1), ("o", 0))]
    rows = rows.select(F.lit("").alias(key), *names, *one) if names else rows.where("value is not null").select(key, (F.col("value").cast("double") + 0.0).alias("value"), *one)
    counts = thinned(rows, key, fractions, names=names).select(key, "value", F.col("r").alias("n"))
    rows = ordered(counts, key, {"end": "n"})
    totals = rows.groupBy(key).agg(F.max("end").alias("total"))
    return at_ranks(rows.join(F.broadcast(totals), key), fractions, key, n="n", end="end", total=F.col("total"))  # one row per feature
