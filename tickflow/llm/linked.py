"""Groups of rows that meet under common keys and pass a check, without all pairs of a key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import drop_table, materialize
from tickflow.llm.components import connected_components

#: Rows of one key that a task compares with as many others; a larger key is compared in pairs of blocks.
BLOCK = 1024


def _counted(rows: DataFrame) -> DataFrame:
    """A row (key, n, id) per row and key that n > 1 rows have; both tables are written, so that a hot key's rows can be split."""
    counts = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    out = materialize(rows.join(counts, "key").select("key", "n", "id"))
    drop_table(counts)
    return out


def ends_of(pairs: DataFrame) -> DataFrame:
    """(id) of what is in any pair (a, b)."""
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def linked_groups(rows: DataFrame, near: Column, verified: Callable[[DataFrame], DataFrame], *, common: int | None = None, split: str | None = None, block: int = BLOCK, drop: bool = False) -> DataFrame:
    """(node, component) of the rows (id, keys, ...) that are linked to any: two rows are that share a key, for whose other columns (those of
    the second with b_ before their names) `near` holds, and whose pair (a, b) is among the edges (src, dst), a written table, that
    verified(pairs) returns.

    Each row is compared with the first row of each of its keys, and then only with rows of the key that are in other groups, so that no
    pairs within a group are written; a key of many rows is compared in pairs of blocks of `block` rows, or `common` if that is less, so none
    lands whole in a task and none of its pairs is left out. `split` names a column that is not looked at. With `drop`, the written table of
    rows is deleted once read."""
    seen = [c for c in rows.columns if c not in ("id", "keys", split)]
    other = [F.col(c).alias(f"b_{c}") for c in seen]
    block = min(block, common or block)
    shared = _counted(rows.select("id", F.explode("keys").alias("key")))
    met = materialize(shared.join(rows.select("id", *seen), "id"))
    leads = materialize(met.groupBy("key").agg(F.min("id").alias("b"), *[F.min_by(c, "id").alias(f"b_{c}") for c in seen]))
    if drop:
        drop_table(rows)
    star = materialize(met.join(leads, "key").where("id <> b").where(near).select(F.col("id").alias("a"), "b").distinct())
    edges = verified(star)
    drop_table(star)
    groups = materialize(connected_components(edges))

    drop_table(leads)
    own = materialize(met.where("n > 2").join(groups, F.col("id") == F.col("node"), "left").withColumn("own", F.coalesce("component", "id")).drop("node", "component"))
    drop_table(met)
    largest = own.groupBy("key", "own").agg(F.count(F.lit(1)).alias("size")).groupBy("key").agg(F.max_by("own", F.struct("size", "own")).alias("big"), F.count(F.lit(1)).alias("groups"))
    largest = materialize(largest.where("groups > 1").select("key", "big"))
    dealt_rows = own.join(largest, "key").withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn("at", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt_rows = materialize(dealt_rows)
    drop_table(own)
    drop_table(largest)
    dealt = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = dealt_rows.select("key", F.col("at").alias("i"), dealt.alias("j"), *seen, F.col("id").alias("a"), "own", "big")
    right = dealt_rows.where("own <> big").select("key", dealt.alias("i"), F.col("at").alias("j"), *other, F.col("id").alias("b"), F.col("own").alias("b_own"))
    cross = left.join(right, ["key", "i", "j"]).where("own <> b_own and (own = big or a < b)").where(near)
    cross = materialize(cross.select("a", "b").distinct())
    drop_table(dealt_rows)
    if cross.isEmpty():
        return groups
    more = verified(cross)
    drop_table(cross)
    return groups if more.isEmpty() else connected_components(edges.unionByName(more))
