"""Packing by deficit round-robin: source queues fill every sequence to the target token proportions.

The queue of a source is the stream of its documents' tokens. Each round adds a quantum, in proportion to the source's target, to the
source's deficit, and the source sends a block of tokens whenever its deficit has a block. What is left of a deficit is carried on, so the
round in which block j of a source goes is known without running the rounds before it: the first in which (rounds * quantum) reaches j + 1
blocks. Spark sorts the blocks by round in buckets, and prefix sums over the buckets carry positions across partitions.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickflow.llm.common import batch, column, map_batches, materialize, read

LENGTH, BLOCK, END_ID = 2048, 256, 1
VOCABULARY = "byte_bpe_50k.json"
#: Runs of letters, digits or punctuation whose ids a worker remembers, in each of two generations.
_MEMO = 500_000
#: Documents, and rounds, that one task orders, about.
BUCKET_ROWS, BUCKET_ROUNDS, MOST_BUCKETS = 5_000, 512, 1 << 17
#: A table of few documents is dealt to all tasks as long as each gets so many.
LEAST_ROWS = 100


class Memo(dict):
    """What make(key) gives, for the most recent keys: the newer of two generations fills, then the older is dropped."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        self[key] = found = self.make(key) if found is None else found
        return found

    def turn(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Encoder:
    """Token ids of whole texts, each as little-endian numbers of two or four bytes.

    The vocabulary's own first step cuts a text into runs of letters, digits or punctuation, each with a lone space before it, and line
    feeds. In texts of Latin letters without apostrophes, whose white space is lone line feeds and lone spaces before runs, these cuts are
    the matches of one pattern; the vocabulary's model then encodes each new run once. Other texts are encoded whole."""

    _RUNS = re.compile("(?: ?(?:[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+|[0-9]+|[!-&(-/:-@\\[-`{-~]+))|\\n")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind, self.letter = ("<u2", "H") if self.tokenizer.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        self.letters = dict(enumerate(_byte_letters()))
        self.runs = Memo(self._run, _MEMO)

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.letter}", *ids)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self._packed(x.ids) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _run(self, run: str) -> bytes:
        return self._packed([t.id for t in self.tokenizer.model.tokenize(run.encode().decode("latin-1").translate(self.letters))])

    @classmethod
    def cut(cls, text: str) -> list[str] | None:
        """The runs of a text, or None for a text that has to be encoded whole."""
        if "\n\n" in text:
            return None
        runs = cls._RUNS.findall(text)
        return runs if sum(map(len, runs)) == len(text) else None

    def encode(self, texts: list[str]) -> list[bytes]:
        out, whole = [], []
        for k, text in enumerate(texts):
            runs = self.cut(text)
            if runs is None:
                whole.append(k)
                out.append(b"")
            else:
                self.runs.turn()
                out.append(b"".join(map(self.runs.__getitem__, runs)))
        for k, ids in zip(whole, self._whole([texts[k] for k in whole]), strict=True):
            out[k] = ids
        return out


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


_encoders: dict[str, Encoder] = {}


def tokenize(df: DataFrame, *, path: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, n, ids binary) of every row: the ids of the whole text, then end_id. A null text is empty."""

    def look(rows: pa.RecordBatch) -> pa.RecordBatch:
        where = path or vocabulary_path()
        encoder = _encoders.get(where) or _encoders.setdefault(where, Encoder(where))
        end = np.array([end_id], encoder.kind).tobytes()
        ids = [x + end for x in encoder.encode([t or "" for t in rows.column(2).to_pylist()])]
        return batch(doc_id=rows.column(0), source=rows.column(1), n=pa.array([len(x) // len(end) for x in ids], pa.int64()), ids=pa.array(ids, pa.binary()))

    docs = df.select(column(df, id_col).alias("doc_id"), column(df, source_col).cast("string").alias("source"), column(df, text_col).cast("string").alias("text"))
    return map_batches(docs, look, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, source string, n long, ids binary")


def _running(df: DataFrame, group: list[str], bucket: str, order: list[str], amount: str, name: str) -> DataFrame:
    """df with the sum of `amount` over all rows before this one in its group, by bucket and then by order. No task has a whole group."""
    sums = df.groupBy(*group, bucket).agg(F.sum(amount).alias("sum"))
    before = sums.select(*group, bucket, (F.sum("sum").over(Window.partitionBy(*group).orderBy(bucket)) - F.col("sum")).alias("before"))
    within = F.sum(amount).over(Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col(amount)
    return df.withColumn("within", within).join(before, [*group, bucket]).withColumn(name, F.col("before") + F.col("within")).drop("before", "within")


def schedule(totals: DataFrame, block: int = BLOCK, weights: Mapping[str, float] | None = None) -> DataFrame:
    """(stratum, j, at): the place in the packed stream of block j of each source; totals: (stratum, tokens).

    Without weights the targets are the corpus's own proportions, so all sources end together; with them, sources end as their tokens
    run out and the others go on. A source that weights leaves out has the least weight given."""
    if weights:
        shares = totals.sparkSession.createDataFrame([("=" + k, float(v)) for k, v in weights.items()], "stratum string, weight double")
        least = float(min(weights.values()))
        totals = totals.join(shares, "stratum", "left").withColumn("weight", F.coalesce("weight", F.lit(least)))
    else:
        totals = totals.withColumn("weight", F.col("tokens").cast("double"))
    blocks = F.ceil(F.col("tokens") / block).cast("long")
    top = totals.agg(F.max("weight")).first()[0] or 1.0
    plan = totals.withColumn("blocks", blocks).withColumn("wait", F.lit(top) / F.col("weight"))  # rounds between two blocks of a source
    rounds = plan.agg(F.max(F.ceil(F.col("blocks") * F.col("wait")))).first()[0] or 1
    step = max(BUCKET_ROUNDS, int(rounds) // MOST_BUCKETS)
    part = 4096
    runs = plan.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / part)))).repartition("stratum", "run")
    each = runs.withColumn("j", F.explode(F.sequence(F.col("run") * part, F.least(F.col("run") * part + part, F.col("blocks")) - 1)))
    each = each.select("stratum", "j", F.least(F.lit(block).cast("long"), F.col("tokens") - F.col("j") * block).alias("size"), F.ceil((F.col("j") + 1) * F.col("wait")).cast("long").alias("round"))
    each = each.withColumn("bucket", F.floor(F.col("round") / step)).withColumn("one", F.lit(0))
    return _running(each, ["one"], "bucket", ["round", "stratum", "j"], "size", "at").select("stratum", "j", "at")


def pack(df: DataFrame, *, length: int = LENGTH, block: int = BLOCK, weights: Mapping[str, float] | None = None, path: str | None = None, end_id: int = END_ID, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per piece: doc_id, start (the document's ids before it), number of ids, their crc32, the document's ids, sequence_id and
    offset there; with_ids adds the ids themselves.

    All sequences but the last are full, and each id lies in one piece. Within a source, documents come in the order of a hash of their id.
    A null source is a source like any other; a null or empty text is its end_id alone; null ids and repeated rows are packed like any
    other row; an empty table gives no rows. Only the id, text and source are read. The ids are computed once and kept in the shared
    folder until they meet their places; the places are computed from the lengths."""
    rows = tokenize(df, path=path, end_id=end_id, id_col=id_col, text_col=text_col, source_col=source_col)
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()))
    short = rows.select("row", "n", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("stratum"), F.xxhash64("doc_id").alias("h"))
    tasks, total = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count()
    buckets = min(MOST_BUCKETS, max(total // BUCKET_ROWS, min(tasks, total // LEAST_ROWS)) + 1)
    short = _running(short.withColumn("bucket", F.pmod("h", F.lit(buckets))), ["stratum"], "bucket", ["h", "row"], "n", "begin")
    places = schedule(rows.groupBy(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("stratum")).agg(F.sum("n").alias("tokens")), block, weights)
    parts = short.select("row", "n", "stratum", "begin", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("n") - 1) / block))).alias("j"))
    parts = parts.join(places, ["stratum", "j"])
    first, last = F.greatest("begin", F.col("j") * block), F.least(F.col("begin") + F.col("n"), (F.col("j") + 1) * block)
    parts = parts.select("row", F.struct((first - F.col("begin")).alias("start"), (last - first).alias("count"), (F.col("at") + first - F.col("j") * block).alias("at")).alias("piece"))
    lists = parts.groupBy("row").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))

    def cut(rows: pa.RecordBatch) -> pa.RecordBatch:
        n = rows.column(1).to_numpy()
        ids, lists = rows.column(2).cast(pa.binary()), rows.column(3)
        spans = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
        width = (spans[-1] - spans[0]) // max(n.sum(), 1)
        tokens = np.frombuffer(ids.buffers()[2], np.uint8)[spans[0] : spans[-1]].view(f"<u{width}").astype("<u4") if len(n) else np.zeros(0, "<u4")
        pieces = lists.flatten()
        start, count, at = (pieces.field(x).to_numpy() for x in ("start", "count", "at"))
        row = np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy())
        # each piece at the ends of sequences, then what lies side by side in one sequence together
        first = at // length
        parts = (at + count - 1) // length - first + 1
        of = np.repeat(np.arange(len(at)), parts)
        sequence = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        low, high = np.maximum(at[of], sequence * length), np.minimum((at + count)[of], (sequence + 1) * length)
        row, start = row[of], start[of] + low - at[of]
        new = np.ones(len(of), bool)
        new[1:] = (row[1:] != row[:-1]) | (sequence[1:] != sequence[:-1]) | (low[1:] != high[:-1])
        begin = np.flatnonzero(new)
        size = np.add.reduceat(high - low, begin) if len(begin) else np.zeros(0, np.int64)
        row, start, sequence, low = row[begin], start[begin], sequence[begin], low[begin]
        ends = np.cumsum(size)  # a row's pieces, in order, are its ids
        data = memoryview(tokens.tobytes())
        crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip((ends - size).tolist(), ends.tolist(), strict=True)]
        columns = {"start": start, "length": size, "ids_crc32": crc, "doc_tokens": n[row], "sequence_id": sequence, "offset": low % length}
        more = {"ids": pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(tokens.astype(np.int32)))} if with_ids else {}
        return batch(doc_id=rows.column(0).take(pa.array(row, pa.int64())), **{x: pa.array(v, pa.int64()) for x, v in columns.items()}, **more)

    kind = rows.schema["doc_id"].dataType.simpleString()
    met = rows.join(lists, "row").select("doc_id", "n", "ids", "pieces")
    return map_batches(met, cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
