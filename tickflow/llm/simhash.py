"""SimHash near-duplicates, with candidates from pigeonring chains.

A fingerprint is a ring of tau + 1 segments. If two fingerprints differ in at most tau bits, there is a segment from which, for every l,
the next l segments together differ in at most l * tau / (tau + 1) bits, that is in at most l - 1. So the first segment is equal, the
second differs in one bit at most and has an equal half, and the third has an equal third. Equal first segments and parts of the next are
the keys of a join; the whole chain is then checked before the Hamming distance is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.common import batch, column, drop_table, map_batches, materialize, read
from tickflow.llm.components import connected_components
from tickflow.llm.linked import ends_of, linked_groups

SHINGLE, TAU, SEED, BITS = 4, 4, 42, 64
#: Fingerprints of one key that a task compares at a time; a larger key is compared in pairs of blocks.
BLOCK = 1024
#: Keys of a sketch, and the least hashes that each is of.
SKETCH, OF = 6, 3
_HASHES = 1 << 16


def _shingle_hashes(text: str | None, size: int) -> Iterator[tuple[bytes, int, np.ndarray]]:
    """(the words joined, number of shingles, hashes) of parts of a whole text's word shingles (A-Z lower-cased, repeats counted)."""
    words = (text or "").encode().lower().split()
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - size + 1)
    starts, ends = starts[:n].tolist(), ends[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _HASHES):
        yield line, n, np.array([digest(line[a:b], SEED) for a, b in zip(starts[at : at + _HASHES], ends[at : at + _HASHES], strict=True)], "<u8")


def _votes(part: np.ndarray) -> np.ndarray:
    return np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def _majority(votes: np.ndarray, n: int) -> int:
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The 64-bit SimHash of a whole text's word shingles; 0 without words."""
    votes, n = np.zeros(BITS, np.int64), 0
    for _, n, part in _shingle_hashes(text, size):
        votes += _votes(part)
    return _majority(votes, n)


def sketch(text: str | None, size: int) -> tuple[int, int, int, np.ndarray, list[int]]:
    """The fingerprint, two hashes of the words, the distinct shingles' hashes and SKETCH keys: each is of the OF least of these hashes under
    one mixing, so texts of shingle similarity s share one with probability 1 - (1 - s ** OF) ** SKETCH."""
    votes, n, parts, line = np.zeros(BITS, np.int64), 0, [], b""
    for line, n, part in _shingle_hashes(text, size):
        votes += _votes(part)
        parts.append(part)
    if not parts:
        return 0, 0, 0, np.zeros(0, np.uint64), []
    own, keys = np.unique(np.concatenate(parts)), []
    with np.errstate(over="ignore"):
        for k in range(SKETCH):
            x = (own ^ np.uint64(xxhash.xxh64_intdigest(b"mix", k))) * np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            least = np.sort(np.partition(x, OF - 1)[:OF] if len(x) > OF else x)
            keys.append(xxhash.xxh64_intdigest(least.tobytes(), k))
    return _majority(votes, n), xxhash.xxh64_intdigest(line, 1), xxhash.xxh64_intdigest(line, 2), own, keys


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())


def fingerprints(df: DataFrame, size: int = SHINGLE, *, sketches: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp holds the 64 bits in a signed long. With sketches, also h and g, two hashes of the words, length, the
    number of distinct shingles, and keys, by which similar texts meet."""

    def look(rows: pa.RecordBatch) -> pa.RecordBatch:
        if not sketches:
            return batch(doc_id=rows.column(0), fp=_signed([fingerprint(t, size) for t in rows.column(1).to_pylist()]))
        fp, h, g, own, keys = zip(*[sketch(t, size) for t in rows.column(1).to_pylist()], strict=True) if rows.num_rows else ([],) * 5
        ends = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
        return batch(doc_id=rows.column(0), fp=_signed(fp), h=_signed(h), g=_signed(g), length=pa.array([len(o) for o in own], pa.int64()), keys=pa.ListArray.from_arrays(pa.array(ends), _signed([x for k in keys for x in k])))

    docs = df.select(column(df, id_col).alias("doc_id"), column(df, text_col).cast("string").alias("text"))
    more = ", h long, g long, length long, keys array<long>" if sketches else ""
    return map_batches(docs, look, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long{more}")


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """(id, own) of (id, text): the distinct shingles' hashes."""

    def look(rows: pa.RecordBatch) -> pa.RecordBatch:
        own = [np.unique(np.concatenate(p)) if (p := [x for _, _, x in _shingle_hashes(t, size)]) else np.zeros(0, np.uint64) for t in rows.column(1).to_pylist()]
        ends = np.concatenate(([0], np.cumsum([len(o) for o in own]))).astype(np.int32)
        return batch(id=rows.column(0), own=pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*own, np.zeros(0, np.uint64)]).view(np.int64))))

    return map_batches(docs, look, "id long, own array<long>")


def segments(tau: int) -> list[tuple[int, int]]:
    """(first bit, width) of the tau + 1 segments of the ring."""
    cuts = [BITS * k // (tau + 1) for k in range(tau + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _split(first: int, width: int, parts: int) -> list[tuple[int, int]]:
    cuts = [width * k // parts for k in range(parts + 1)]
    return [(first + a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def key_masks(tau: int, length: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(segment that the chain begins at, bit ranges that have to be equal): one for each choice of an equal part in each of the first
    `length` segments of the chain. Any two fingerprints within tau bits agree on at least one of them."""
    ring = segments(tau)
    out = []
    for i in range(tau + 1):
        ways: list[list[tuple[int, int]]] = [[]]
        for j in range(length):
            ways = [w + [p] for w in ways for p in _split(*ring[(i + j) % (tau + 1)], j + 1)]
        out += [(i, w) for w in ways]
    return out


def chain_length(n: int, tau: int) -> int:
    """The shortest chain whose keys have the bits to keep chance meetings few among n fingerprints. Any length finds all links."""
    for length in range(1, tau + 1):
        if min(sum(w for _, w in ranges) for _, ranges in key_masks(tau, length)) >= np.log2(max(n, 2)) + 1:
            return length
    return tau


def _bits(fp: Column, ranges: list[tuple[int, int]]) -> Column:
    out = F.lit(0).cast("long")
    for first, width in ranges:
        out = F.shiftleft(out, width).bitwiseOR(F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1)))
    return out


def _links_in(fps: np.ndarray, ids: np.ndarray, chain: list[np.uint64], tau: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among one key's fingerprints: no pair is listed whose ends are already joined."""
    n = len(fps)
    group, out = np.arange(n), []
    for i in range(n - 1):
        x = fps[i] ^ fps[i + 1 :]
        near = np.arange(i + 1, n)
        for l, mask in enumerate(chain):  # at most l bits within the first l + 1 segments
            ok = np.bitwise_count(x & mask) <= l
            if not ok.all():
                x, near = x[ok], near[ok]
        for j in near[np.bitwise_count(x) <= tau]:
            if group[i] != group[j]:
                group[group == group[j]] = group[i]
                out.append((ids[i], ids[j]))
    return out


def links(nodes: DataFrame, tau: int = TAU, *, length: int | None = None, block: int = BLOCK) -> DataFrame:
    """Links (src, dst) that join what is within tau bits, among nodes (fp long, distinct; node). Every two such fingerprints meet under
    some key; of those that meet, a spanning forest is returned, which has the same components. A key of many fingerprints is dealt into
    blocks of about `block`, and tasks compare pairs of blocks: no key lands whole in a task, and no pairs are written."""
    length = length or chain_length(nodes.count(), tau)
    ways = key_masks(tau, length)
    ring = segments(tau)
    full = [sum(((1 << w) - 1) << a for a, w in (ring[(i + j) % (tau + 1)] for j in range(l + 1))) for i in range(tau + 1) for l in range(tau)]
    chains = [[np.uint64(m) for m in full[i * tau : (i + 1) * tau]] for i in range(tau + 1)]
    keys = nodes.select("fp", "node", F.explode(F.array(*[F.struct(F.lit(k).alias("way"), _bits(F.col("fp"), ranges).alias("value")) for k, (_, ranges) in enumerate(ways)])).alias("key"))
    keys = materialize(keys.select("key.way", "key.value", "fp", "node"))  # both are written, so that they are made once and a hot key's rows can be split
    shared = materialize(keys.groupBy("way", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    met = keys.join(shared, ["way", "value"]).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    own = F.pmod(F.xxhash64("fp", "way"), F.col("blocks")).cast("int")
    met = met.withColumn("pair", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(own, j).alias("a"), F.greatest(own, j).alias("b")))))
    met = met.select("way", "value", F.col("pair.a").alias("a"), F.col("pair.b").alias("b"), "fp", "node")
    by = ["way", "value", "a", "b"]
    starts = [i for i, _ in ways]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[np.ndarray]] = []

        def groups(columns: list[np.ndarray], cuts: np.ndarray) -> pa.RecordBatch:
            found = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b - a > 1:
                    found += _links_in(columns[4][a:b], columns[5][a:b], chains[starts[columns[0][a]]], tau)
            return batch(src=pa.array([x for x, _ in found], pa.int64()), dst=pa.array([y for _, y in found], pa.int64()))

        for rows in batches:
            if not rows.num_rows:
                continue
            kept.append([c.to_numpy(zero_copy_only=False) for c in rows.columns])
            columns = [np.concatenate(c) for c in zip(*kept, strict=True)]
            columns[4] = columns[4].astype(np.int64).view(np.uint64)
            change = np.zeros(len(columns[0]), bool)
            for c in columns[:4]:
                change[1:] |= c[1:] != c[:-1]
            cuts = np.concatenate(([0], np.flatnonzero(change)))
            if len(cuts) > 1:  # the last group may go on in the next batch
                yield groups(columns, cuts)
            columns[4] = columns[4].view(np.int64)
            kept = [[c[cuts[-1] :] for c in columns]]
        if kept:
            columns = kept[0]
            columns[4] = columns[4].view(np.uint64)
            yield groups(columns, np.array([0, len(columns[0])]))

    found = materialize(met.repartition(*by).sortWithinPartitions(*by).mapInArrow(compare, "src long, dst long").distinct())
    drop_table(keys)
    drop_table(shared)
    return found


def similar_texts(df: DataFrame, prints: DataFrame, nodes: DataFrame, similarity: float, size: int, id_col: str, text_col: str) -> DataFrame:
    """Links (src, dst) between the nodes of texts whose sets of shingles have that Jaccard similarity, found by the sketches' keys and
    verified on the whole sets."""
    texts = prints.where("doc_id is not null and length > 0").groupBy("h", "g").agg(F.min(F.col("doc_id").cast("long")).alias("id"), F.min("fp").alias("fp"), F.min("length").alias("length"), F.first("keys").alias("keys"))
    texts = materialize(texts.select("id", "fp", "length", "keys"))
    docs = df.select(column(df, id_col).cast("long").alias("id"), column(df, text_col).cast("string").alias("text"))

    def verified(pairs: DataFrame) -> DataFrame:
        sets = materialize(shingle_sets(docs.join(ends_of(pairs), "id", "left_semi"), size).dropDuplicates(["id"]))
        both = pairs.join(sets.select(F.col("id").alias("a"), F.col("own").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("own").alias("y")), "b")
        both = both.select("a", "b", F.size("x").alias("m"), F.size("y").alias("n"), F.size(F.array_intersect("x", "y")).alias("both"))
        return materialize(both.where(F.col("both") >= similarity * (F.col("m") + F.col("n") - F.col("both")) - 1e-9).select(F.col("a").alias("src"), F.col("b").alias("dst")))

    near = F.least("length", "b_length") >= similarity * F.greatest("length", "b_length") - 1e-9
    groups = linked_groups(texts.select("id", "length", "keys"), near, verified)
    of = texts.select("id", "fp").join(nodes, "fp").select("id", F.col("node").alias("at"))
    left = groups.where("node <> component").join(of.withColumnRenamed("id", "node").withColumnRenamed("at", "src"), "node")
    return left.join(materialize(of).withColumnRenamed("id", "component").withColumnRenamed("at", "dst"), "component").select("src", "dst")


def near_duplicates(df: DataFrame, *, size: int = SHINGLE, tau: int = TAU, similarity: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, fingerprint, component_id) per row of df; component_id is the smallest id reachable over links of at most tau
    differing bits, the row's own included. With `similarity`, texts whose sets of shingles are that similar (Jaccard) are linked too: at
    0.8 fingerprints differ in about ten bits, which no fingerprint key finds.

    Ids are whole numbers. Texts without words (null, empty, white space) have fingerprint 0 and are linked like any other; texts of fewer
    words than a shingle are one shingle. Rows with a null id keep their fingerprint, are linked to nothing and have a null component.
    Repeated rows each give a row. An empty table gives none; other columns of df are not looked at. Documents of one fingerprint are one
    node, so that copies cost nothing. Similar texts are found with probability 1 - (1 - s ** 3) ** 6 (0.986 at s = 0.8), one pair at a time."""
    prints = materialize(fingerprints(df, size, sketches=similarity is not None, id_col=id_col, text_col=text_col))
    nodes = materialize(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").cast("long").alias("node")))
    edges = links(nodes, tau)
    if similarity is not None:
        edges = edges.unionByName(similar_texts(df, prints, nodes, similarity, size, id_col, text_col))
    groups = connected_components(edges)
    parts = nodes.join(groups, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    kind = prints.schema["doc_id"].dataType
    out = prints.join(parts, "fp", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).cast(kind))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(df: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of df that are the first of their component, with df's columns, and those with a null id. Of rows that have the id of one
    that stays, one stays."""
    parts = materialize(near_duplicates(df, id_col=id_col, **options).select("doc_id", "component_id"))
    key = column(df, id_col)
    gone = parts.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone"))
    kept = df.join(gone, key == F.col("__gone"), "left_anti")
    again = materialize(parts.where("doc_id = component_id").groupBy(F.col("doc_id").alias("__again")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__again"))
    if again.isEmpty():
        return kept
    same = key == F.col("__again")
    return kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates([id_col]))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
