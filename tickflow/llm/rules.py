"""Quality rules: a ledger of measurements and failure bits, written once; policies and ablations are bit operations on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.common import batch, column, map_batches, read

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: (name, SQL condition over the measures under which a text fails). The place in the list is the bit.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
)
#: Versions of the policy: the rules whose failure rejects a text.
POLICIES: Mapping[str, tuple[str, ...]] = {"base": ("few_words", "repeated_words"), "v1": ("few_words", "repeated_words", "symbols", "duplicate_lines", "short_words", "long_words")}
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\v\f"))
_INNER = (np.arange(256) & 0xC0) == 0x80  # bytes inside a code point


def repeated_words(words: Sequence[bytes], size: int = 3) -> int:
    """How many words lie in a window of `size` words that occurs twice or more in the text."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    key = seq[:n].copy()
    for j in range(1, size):
        _, key = np.unique(key, return_inverse=True) if len(ids) ** 2 * n > 2**62 else (None, key)
        key = key * len(ids) + seq[j : n + j]
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(count[place] > 1)
    np.add.at(hit, starts, 1)
    np.add.at(hit, starts + size, -1)
    return int((np.cumsum(hit[:-1]) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The MEASURES of one whole text; a null text has none of anything."""
    raw = (text or "").encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256, np.int64)
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    words = raw.split()
    return len(words), int(counts.sum() - counts[_SPACE].sum() - counts[_INNER].sum()), int(counts[_SYMBOL].sum()), len(lines), len(lines) - len(set(lines)), repeated_words(words)


def ledger(df: DataFrame, rules: Sequence[tuple[str, str]] = RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, MEASURES, failed) per row of df: every rule is evaluated once, and bit k of failed is set if rule k fails.

    Null and empty texts measure 0. Null ids and repeated rows each keep their row; an empty table gives none. At most 63 rules; only
    the id and the text of df are read, so further columns do no harm. Write it once, then apply policies to it."""
    if len(rules) > 63:
        raise ValueError("a ledger has 63 bits")

    def look(rows: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([measure(t) for t in rows.column(1).to_pylist()], np.int64).reshape(rows.num_rows, len(MEASURES))
        return batch(doc_id=rows.column(0), **{m: pa.array(found[:, k]) for k, m in enumerate(MEASURES)})

    docs = df.select(column(df, id_col).alias("doc_id"), column(df, text_col).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = map_batches(docs, look, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = F.lit(0).cast("long")
    for k, (_, fails) in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return out.withColumn("failed", bits)


def mask(policy: str | Sequence[str], rules: Sequence[tuple[str, str]] = RULES) -> int:
    """The bits of a policy: a version's name, or names of rules."""
    names = POLICIES[policy] if isinstance(policy, str) else policy
    place = {name: k for k, (name, _) in enumerate(rules)}
    return sum(1 << place[name] for name in set(names))


def apply_policy(book: DataFrame, policy: str | Sequence[str], rules: Sequence[tuple[str, str]] = RULES, name: str = "kept") -> DataFrame:
    """The ledger with a boolean: whether no rule of the policy fails."""
    return book.withColumn(name, F.col("failed").bitwiseAND(F.lit(mask(policy, rules))) == 0)


def ablation(book: DataFrame, policy: str | Sequence[str], rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """One row per rule of the policy: how many texts fail it, fail nothing else, and stay if the policy has all rules but it; and
    which other rules ever fail, or always fail, beside it (bits). One aggregation over the ledger; an empty one gives zeros."""
    full = mask(policy, rules)
    named = [(name, 1 << k) for k, (name, _) in enumerate(rules) if full >> k & 1]
    hit = F.col("failed").bitwiseAND(F.lit(full))
    columns = [F.count_if(hit == 0).alias("kept")]
    for name, bit in named:
        fails = hit.bitwiseAND(F.lit(bit)) != 0
        columns += [F.count_if(fails).alias(f"{name}_n"), F.count_if(hit == bit).alias(f"{name}_only"), F.bit_or(F.when(fails, hit)).alias(f"{name}_ever"), F.bit_and(F.when(fails, hit)).alias(f"{name}_always")]
    row = book.agg(*columns)
    rest = lambda name, bit, kind: F.coalesce(F.col(f"{name}_{kind}").bitwiseAND(F.lit(full & ~bit)), F.lit(0).cast("long")).alias(f"{kind}_with")
    return row.select(F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"{name}_n").alias("fails"), F.col(f"{name}_only").alias("only_this"), (F.col("kept") + F.col(f"{name}_only")).alias("kept_without"), rest(name, bit, "ever"), rest(name, bit, "always")) for name, bit in named])).alias("x")).select("x.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = apply_policy(apply_policy(ledger(read(spark, sf_dir, "documents")), "base", name="base_ok"), "v1")
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~F.col("base_ok")).alias("base_failed"), "kept", "failed", "n_lines")


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), hit AS (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i) AS n FROM hit GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id)
), f AS (
  SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > 3 * n_words)::INT + 8 * (100 * n_dup_lines > 30 * n_lines)::INT
             + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 20 * n_words)::INT)::BIGINT AS failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed, n_lines FROM f
"""
