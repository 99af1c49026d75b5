"""Substring deduplication on a compacted de Bruijn graph of word k-mers.

Nodes are the k-mers that are least by hash in some window of `window` words (so equal windows have equal nodes at equal offsets). An edge
is a node with the words around it that its windows cover. A node with one kind of edge is not branching: all its windows repeat as often
as the edge does, so the whole path is one row. Only at branching nodes are single windows compared, from the coordinates of one source per
kind of edge. Thus about one row in fifteen windows is shuffled, and every decision is exact up to 128 bits of hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.common import batch, column, map_batches, materialize, read

WINDOW, K = 35, 8
_BASES = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)
#: Words whose hashes a worker remembers; the memo is emptied when full.
_MEMO = 1 << 20
_memo: dict[bytes, int] = {}


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_memo) > _MEMO:
        _memo.clear()
    get, put, digest = _memo.get, _memo.__setitem__, xxhash.xxh64_intdigest

    def of(w: bytes) -> int:
        h = get(w)
        if h is None:
            put(w, h := digest(w, 1))
        return h

    return np.fromiter(map(of, words), np.uint64, len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def rolling(x: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """The polynomial hash of every `size` consecutive items, by doubling."""
    out, done, have, block = None, 0, 1, x
    while size:
        if size & 1:
            out, done = (block, have) if out is None else (out[: len(out) - have] * _power(base, have) + block[done:], done + have)
        size >>= 1
        if size:
            block, have = block[:-have] * _power(base, have) + block[have:], 2 * have
    return out


def edges_of(words: list[bytes], window: int = WINDOW, k: int = K) -> tuple[np.ndarray, ...]:
    """Of a text's words: first window, number of windows, offset of the node in the first window, node hash, edge hash. The edges'
    windows are all the text's windows, each once."""
    with np.errstate(over="ignore"):
        x = word_hashes(words)
        mers = _mixed(rolling(x, k, _BASES[0]))
        n, span = len(words) - window + 1, window - k + 1
        least = np.lib.stride_tricks.sliding_window_view(mers, span)
        at = np.empty(n, np.int64)
        for a in range(0, n, 1 << 16):
            at[a : a + (1 << 16)] = least[a : a + (1 << 16)].argmin(1)
        at += np.arange(n)
        first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
        count = np.diff(np.concatenate((first, [n])))
        sums = np.concatenate(([np.uint64(0)], np.cumsum(x * _powers(len(x)), dtype=np.uint64)))
        # hash of the words [a, b): a difference of prefix sums, scaled to the same place for every text
        a, b = first, first + count - 1 + window
        edge = (sums[b] - sums[a]) * _powers_back(len(x))[a]
        edge = _mixed(edge + _mixed((count.astype(np.uint64) << np.uint64(8)) + (at[first] - first).astype(np.uint64)))
    return first, count, at[first] - first, mers[at[first]], edge


_table: dict[bool, np.ndarray] = {}
_INVERSE = np.uint64(pow(int(_BASES[1]), -1, 1 << 64))


def _grown(back: bool, n: int) -> np.ndarray:
    got = _table.get(back)
    if got is None or len(got) < n:
        with np.errstate(over="ignore"):
            base = _INVERSE if back else _BASES[1]
            got = np.cumprod(np.concatenate(([np.uint64(1)], np.full(max(n, 4096) * 5 // 4, base))), dtype=np.uint64)
        if len(got) < 1 << 21:
            _table[back] = got
    return got[:n]


def _powers(n: int) -> np.ndarray:
    return _grown(False, n)


def _powers_back(n: int) -> np.ndarray:
    return _grown(True, n)


def _docs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows under a key of their content: repeated rows share it, and rows of one id with other texts do not."""
    key, text = column(df, id_col), column(df, text_col).cast("string")
    return df.select(F.xxhash64(key, text).alias("row"), F.coalesce(F.xxhash64(key), F.lit(0)).alias("part"), key.alias("doc_id"), text.alias("text"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """(row, part, spans array<struct<s, n>>): of each text with any, the runs of windows that start anywhere else too: n from word s.

    docs: (row, part, doc_id, text)."""

    def graph(rows: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        which = []
        for k_, text in enumerate(rows.column(2).to_pylist()):
            words = (text or "").encode().split()
            if len(words) >= window:
                found = edges_of(words, window, k)
                which.append(np.full(len(found[0]), k_))
                for o, f in zip(out, found, strict=True):
                    o.append(f)
        pick = pa.array(np.concatenate(which) if which else np.zeros(0, np.int64))
        s, n, hi, node, edge = (np.concatenate(o) if o else np.zeros(0, np.int64) for o in out)
        return batch(row=rows.column(0).take(pick), part=rows.column(1).take(pick), s=pa.array(s.astype(np.int32)), n=pa.array(n.astype(np.int16)), hi=pa.array(hi.astype(np.int16)), node=pa.array(node.astype(np.uint64).view(np.int64)), edge=pa.array(edge.astype(np.uint64).view(np.int64)))

    edges = materialize(map_batches(docs.select("row", "part", "text"), graph, "row long, part long, s int, n short, hi short, node long, edge long"))
    nodes = edges.groupBy("node").agg(F.count(F.lit(1)).alias("times"), F.min("edge").alias("least"), F.max("edge").alias("most")).where("times > 1")
    nodes = materialize(nodes.select("node", (F.col("least") != F.col("most")).alias("branching")))  # written, so that a hot node's edges can be split
    kept = materialize(edges.join(nodes, "node"))
    straight = kept.where("not branching").select("row", "part", F.col("s").cast("int").alias("s"), F.col("n").cast("int").alias("n"))

    kinds = kept.where("branching").groupBy("node", "edge").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("row", "part", "s", "n", "hi")).alias("at"))
    sources = kinds.groupBy("at.row", "at.part").agg(F.collect_list(F.struct("at.s", "at.n", "at.hi", "node", "edge", "times")).alias("edges"))

    def expand(rows: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        with np.errstate(over="ignore"):
            for text, own in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                hashes = _mixed(rolling(word_hashes(text.encode().split()), window, _BASES[1]))
                for e in own:
                    s, n = e["s"], e["n"]
                    for o, f in zip(out, (np.full(n, e["node"]), np.full(n, e["edge"]), e["hi"] - np.arange(n), hashes[s : s + n].view(np.int64), np.full(n, e["times"])), strict=True):
                        o.append(f)
        node, edge, off, h, times = (np.concatenate(o) if o else np.zeros(0, np.int64) for o in out)
        return batch(node=pa.array(node), edge=pa.array(edge), off=pa.array(off.astype(np.int16)), h=pa.array(h), times=pa.array(times))

    windows = materialize(map_batches(docs.join(sources, ["row", "part"]).select("text", "edges"), expand, "node long, edge long, off short, h long, times long"))
    again = windows.groupBy("node", "off", "h").agg(F.sum("times").alias("all")).where("all > 1").select("node", "off", "h")
    offsets = windows.join(again, ["node", "off", "h"]).groupBy("node", "edge").agg(F.collect_set("off").alias("offs"))
    crossed = kept.where("branching").join(offsets, ["node", "edge"]).select("row", "part", F.explode("offs").alias("off"), "s", "hi")
    crossed = crossed.select("row", "part", (F.col("s") + F.col("hi") - F.col("off")).cast("int").alias("s"), F.lit(1).alias("n"))
    return straight.unionByName(crossed).groupBy("row", "part").agg(F.collect_set(F.struct("s", "n")).alias("spans"))


def drop_repeated_spans(df: DataFrame, *, window: int = WINDOW, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, text, n_words, n_removed, spans) per row of df: the words that are left, joined by one space, and the removed runs
    of words as (first word, number of words).

    Words are what white space of ASCII separates, unchanged. A word goes if it is covered by `window` words that also start anywhere else,
    in this text or another, as the input has it; so of a passage that repeats no copy stays. Texts shorter than a window lose nothing; a
    null text has no words. Repeated rows count as copies. Null ids are ids like any other; an empty table gives no rows; other columns
    are not looked at."""
    docs = _docs(df, id_col, text_col)
    spans = repeated_spans(docs, window, k)
    joined = docs.join(spans, ["row", "part"], "left").select("doc_id", "text", "spans")

    def cut(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts, totals, removed, runs = [], [], [], []
        for text, own in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True):
            words = (text or "").encode().split()
            mark = np.zeros(len(words) + 1, np.int64)
            for e in own or ():
                mark[e["s"]] += 1
                mark[e["s"] + e["n"] - 1 + window] -= 1
            gone = np.cumsum(mark[:-1]) > 0
            step = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
            texts.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if own else words).decode())
            totals.append(len(words))
            removed.append(int(gone.sum()))
            runs.append([{"first": int(a), "words": int(b - a)} for a, b in zip(step[::2], step[1::2], strict=True)])
        run = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))
        return batch(doc_id=rows.column(0), text=pa.array(texts, pa.string()), n_words=pa.array(totals, pa.int64()), n_removed=pa.array(removed, pa.int64()), spans=pa.array(runs, run))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(joined, cut, f"doc_id {kind}, text string, n_words long, n_removed long, spans array<struct<first: long, words: long>>")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_spans(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)
), hit AS (
  SELECT doc_id, unnest(range(i, i + {WINDOW})) AS i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS n FROM g) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, i FROM hit
), x AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
), left_over AS (
  SELECT x.doc_id, string_agg(word, ' ' ORDER BY i) FILTER (gone.i IS NULL) AS t, count(gone.i) AS n FROM x LEFT JOIN gone USING (doc_id, i) GROUP BY x.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN left_over USING (doc_id)
"""
