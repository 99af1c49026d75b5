"""Periodic runs of words, as maximal pairs of a bottom-up LCP-interval tree.

A pair of equal stretches (i, j, length) is maximal if neither the words before nor the words after them are equal. A run of period q is
the maximal pair of its words with themselves q words on: start i, j = i + q, and length + q words in all. So a maximal pair is a run if
its distance is at most its length, and nothing has to be extended. Of the occurrences of one stretch, only neighbours in text order can
have the smallest period: if an occurrence lay between, its distance would be a period too, and with q it would have a common divisor that
is one. Hence each node of the tree looks at new neighbours only, and the tree makes O(n log n) of them.

A run of `least` words or more has a pair of at least half as many words, so the tree has only the suffixes whose first words occur again
in the same text, and only intervals of that depth.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.common import batch, column, map_batches, read

LEAST = 12
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _repeated(x: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """The positions whose `size` words occur again in the same text (and, by chance of 64-bit hashes, a few more)."""
    n = len(x) - size + 1
    if n < 2:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        one = _mixed(x.astype(np.uint64) * _ODD + np.uint64(1))
        h = _mixed(text[:n].astype(np.uint64) * _ODD)
        for k in range(size):
            h = _mixed(h + one[k : k + n]) if k == size // 2 else h * _ODD + one[k : k + n]
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    return np.sort(order[np.concatenate((same, [False])) | np.concatenate(([False], same))])


def _changes(keys: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    return new


def _suffixes(x: np.ndarray, text: np.ndarray, some: np.ndarray, size: int) -> np.ndarray:
    """The positions `some` in the order of their suffixes, by prefix doubling; beyond them only the suffixes `size` words on are ranked,
    as what is compared further on is in `some` itself."""
    last = len(x) - 1
    ranked = np.union1d(some, np.minimum(some + size, last))
    keys = [text[ranked], *[x[np.minimum(ranked + k, last)] for k in range(size)]]
    order = np.lexsort(keys[::-1])
    new = _changes(keys, order)
    rank = np.full(len(x), -1, np.int64)
    rank[ranked[order]] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    lone = np.zeros(len(x), bool)
    lone[ranked[order]] = new & np.concatenate((new[1:], [True]))
    open_, depth = some[~lone[some]], size
    while len(open_):
        first, then = rank[open_], rank[np.minimum(open_ + depth, last)]
        order = np.lexsort((then, first))
        first, then, open_ = first[order], then[order], open_[order]
        begins = np.concatenate(([True], first[1:] != first[:-1]))
        new = begins | np.concatenate(([True], then[1:] != then[:-1]))
        place = np.arange(len(open_))
        rank[open_] = first + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(begins, place, 0))
        open_ = open_[~(new & np.concatenate((new[1:], [True])))]
        depth *= 2
    return some[np.argsort(rank[some])]


def _common(x: list[int], order: list[int], size: int) -> list[int]:
    """Of each suffix in order the number of words it shares with the one before it, 0 if under `size`. The suffixes are visited in the
    text's order, as the next one shares at most one word less."""
    before = dict(zip(order[1:], order, strict=False))
    shared: dict[int, int] = {}
    at, have = -2, 0
    for i in sorted(before):
        j = before[i]
        have = have - 1 if i == at + 1 and have > size else 0
        while x[i + have] == x[j + have]:
            have += 1
        shared[i], at = have, i
    return [n if (n := shared.get(i, 0)) >= size else 0 for i in order]


def _merged(depth: int, parts: list[tuple[list[int], int]], x: list[int], least: int, out: list[tuple[int, int, int]]) -> tuple[list[int], int]:
    """The node of these children: its positions in text order, and the left word they all have, -1 if not all the same. A list of one left
    word is merged without a look: such pairs are longer to the left, so not maximal."""
    parts.sort(key=lambda p: -len(p[0]))
    own, left = parts[0]
    alike = left >= 0 and all(p[1] == left for p in parts)
    for more, _ in parts[1:]:
        if 8 * len(more) > len(own):
            own += more
            own.sort()
        else:
            for p in more:
                insort(own, p)
    if alike:
        return own, left
    found = set()
    for more, _ in parts[1:]:
        for p in more:
            k = bisect_left(own, p)
            for i, j in ((own[k - 1], p) if k else (p, p), (p, own[k + 1]) if k + 1 < len(own) else (p, p)):
                q = j - i
                if 0 < q <= depth and depth + q >= least and x[i - 1] != x[j - 1] and x[i + depth] != x[j + depth]:
                    found.add((i, depth + q, q))
    out.extend(found)
    return own, -1


def maximal_pairs(x: list[int], order: list[int], shared: list[int], least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least `least` words, from the suffixes in order and the words shared by neighbours."""
    out: list[tuple[int, int, int]] = []
    open_: list[tuple[int, list]] = []
    node = None
    for p, depth in zip([*order, 0], [*shared, 0], strict=True):
        while open_ and open_[-1][0] > depth:
            deep, parts = open_.pop()
            parts.append(node)
            node = _merged(deep, parts, x, least, out)
        if depth:
            if open_ and open_[-1][0] == depth:
                open_[-1][1].append(node)
            else:
                open_.append((depth, [node]))
        node = ([p], x[p - 1])
    return out


def runs_of(x: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in x, by start and period.

    x: the texts' words as numbers, each text with a number after it that occurs nowhere else, and one more such at the end of all; text:
    the text that each belongs to."""
    size = max(1, (least + 1) // 2)
    some = _repeated(x, text, size)
    if not len(some):
        return []
    order = _suffixes(x, text, some, size).tolist()
    words = x.tolist()
    return sorted((a, n, q) for a, n, q in maximal_pairs(words, order, _common(words, order, size), least))


def collapse_runs(df: DataFrame, *, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, text, n_words, runs array<struct<start, length, period>>) per row of df: the words of the text that no run repeats,
    joined by one space, and its runs by start and period.

    Words are what white space of ASCII separates. A run is a stretch of consecutive words with the smallest period q (words q apart are
    identical), of `least` words or more and of at least 2 * q, that no neighbouring word extends. A word goes if any run has it after that
    run's first q words. Runs may overlap; each is found by itself.

    Null and empty texts have no words, no runs and an empty text. Repeated rows and null ids give a row each, and an empty table none;
    other columns are not looked at. A text is looked at whole, in one task, with memory for itself alone."""

    def look(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.ascii_trim_whitespace(rows.column(1).fill_null("").cast(pa.large_string()))
        words = pc.ascii_split_whitespace(texts)
        sizes = np.where(pc.binary_length(texts).to_numpy() > 0, pc.list_value_length(words).to_numpy(), 0)
        flat = pc.list_flatten(words).dictionary_encode()
        ids = flat.indices.to_numpy().astype(np.int64)
        if (sizes == 0).any():  # an empty text is split into one empty word
            ids = ids[np.repeat(sizes > 0, pc.list_value_length(words).to_numpy())]
        n, many = len(flat.dictionary), rows.num_rows
        ends = np.cumsum(sizes)
        x = np.append(np.insert(ids, ends, n + np.arange(many)), n + many)
        text = np.append(np.repeat(np.arange(many), sizes + 1), many)
        found = runs_of(x, text, least)
        starts = ends - sizes + np.arange(many)
        of = np.searchsorted(starts, [a for a, _, _ in found], "right") - 1
        runs: list[list[dict]] = [[] for _ in range(many)]
        for k, (a, length, q) in zip(of.tolist(), found, strict=True):
            runs[k].append({"start": a - int(starts[k]), "length": length, "period": q})
        left = pc.binary_join(words, pa.scalar(" ", pa.large_string()))
        if found:
            kept = left.to_pylist()
            for k in set(of.tolist()):
                mark = np.zeros(int(sizes[k]) + 1, np.int64)
                for r in runs[k]:
                    mark[r["start"] + r["period"]] += 1
                    mark[r["start"] + r["length"]] -= 1
                kept[k] = " ".join([w for w, g in zip(kept[k].split(" "), np.cumsum(mark[:-1]).tolist(), strict=True) if not g])
            left = pa.array(kept, pa.string())
        run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        return batch(doc_id=rows.column(0), text=left.cast(pa.string()), n_words=pa.array(sizes, pa.int64()), runs=pa.array(runs, run))

    docs = df.select(column(df, id_col).alias("doc_id"), column(df, text_col).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, look, f"doc_id {kind}, text string, n_words long, runs array<struct<start: long, length: long, period: long>>")


def planted(doc_id: Column, text: Column) -> Column:
    """The text as the query takes it: of every document whose id's CRC has the last digit 0, the words from some place on are those of a
    period over and over."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, g = F.size(words), F.floor(h / 10)
    start = F.pmod(g, n).cast("int")
    period = (1 + F.floor((n - start) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, start + 1, period), F.ceil((n - start) / period).cast("int")))
    new = F.array_join(F.concat(F.slice(words, 1, start), F.slice(tail, 1, n - start)), " ")
    return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), new).otherwise(text)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    out = collapse_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    out = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).alias("listed"), "text")
    start, length, period = -F.col("best.col2"), F.col("best.length"), -F.col("best.col3")
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return out.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"), digest("listed").alias("runs_sha256"), digest("text").alias("collapsed_sha256"))
