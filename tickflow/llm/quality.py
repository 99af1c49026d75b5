"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.common import batch, column, map_batches, materialize, read

#: Scores from here on predict quality 1.
THRESHOLD = 0.3
#: Shrinkage of a class covariance towards the pooled one, of the result towards its own diagonal, and the least variance.
TO_POOLED, TO_DIAGONAL, RIDGE = 0.2, 0.1, 1e-3
#: What multiplies the log-density difference: the statistics are not independent normals, so raw differences are overconfident.
TEMPERATURE = 0.25

FEATURES = ("words", "word_length", "symbols", "bars", "exclamations", "upper", "digits", "punctuation", "distinct_words", "distinct_lines", "short_words", "repeated_pairs")
SYMBOLS = b"#*$%&|<>"
_IS = {name: np.isin(np.arange(256), list(chars)) for name, chars in {"space": b" \t\n\r\v\f", "symbol": SYMBOLS, "punctuation": b".,;:?\"'()-", "upper": bytes(range(65, 91)), "digit": b"0123456789"}.items()}


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text: logarithms of sizes, arcsine roots of shares. A null or empty text has zeros."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    seen = n and len(raw) - int(counts[_IS["space"]].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = lambda part, whole: float(np.arcsin(np.sqrt(min(1.0, part / whole)))) if whole else 0.0
    of = lambda name: int(counts[_IS[name]].sum())
    pairs = n - 1
    return [
        float(np.log1p(n)), float(np.log(seen / n)), share(of("symbol"), seen), share(int(counts[124]), n), share(int(counts[33]), seen), share(of("upper"), seen), share(of("digit"), seen),
        share(of("punctuation"), seen), share(len(set(words)), n), share(len(set(lines)), len(lines)), share(sum(len(w) < 4 for w in words), n), share(pairs - len(set(zip(words, words[1:], strict=False))), pairs),
    ]


def document_statistics(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x array<double>) of every row, null ids and texts included."""

    def measure(rows: pa.RecordBatch) -> pa.RecordBatch:
        return batch(doc_id=rows.column(0), x=pa.array([statistics(t) for t in rows.column(1).to_pylist()], pa.list_(pa.float64())))

    docs = df.select(column(df, id_col).alias("doc_id"), column(df, text_col).cast("string").alias("text"))
    return map_batches(docs, measure, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Two normal densities by their means and inverse Cholesky factors; constant where a class had no labelled row."""

    means: np.ndarray
    inverse_factors: np.ndarray
    log_constants: np.ndarray
    constant: float | None = None
    temperature: float = TEMPERATURE

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Of each row the probability of class 1."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        logs = [c - 0.5 * np.square((x - m) @ f.T).sum(1) for m, f, c in zip(self.means, self.inverse_factors, self.log_constants, strict=True)]
        return 1 / (1 + np.exp(np.clip(self.temperature * (logs[0] - logs[1]), -500, 500)))


def fit(labelled: DataFrame, *, to_pooled: float = TO_POOLED, to_diagonal: float = TO_DIAGONAL, ridge: float = RIDGE, temperature: float = TEMPERATURE) -> Discriminant:
    """Fit on all rows of labelled (x array<double>, label int). Spark sums the moments of each class (two rows reach the driver);
    the covariances are shrunk towards the pooled one and its diagonal, and their Cholesky factors are kept."""
    d = len(FEATURES)
    sums = [F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(d)] + [F.sum(F.get("x", F.lit(i)) * F.get("x", F.lit(j))).alias(f"p{i}_{j}") for i in range(d) for j in range(i + 1)]
    got = {r["label"]: r for r in labelled.where("label in (0, 1)").groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums).collect()}
    if len(got) < 2:
        return Discriminant(np.zeros(0), np.zeros(0), np.zeros(0), constant=float(next(iter(got), 1)) if got else 0.5)
    n = np.array([got[k]["n"] for k in (0, 1)], float)
    means = np.array([[got[k][f"s{i}"] for i in range(d)] for k in (0, 1)]) / n[:, None]
    second = np.array([[[got[k][f"p{max(i, j)}_{min(i, j)}"] for j in range(d)] for i in range(d)] for k in (0, 1)]) / n[:, None, None]
    covariances = second - means[:, :, None] * means[:, None, :]
    pooled = np.tensordot(n / n.sum(), covariances, 1)
    scale = np.sqrt(np.diag(pooled) + ridge)
    factors, constants = [], []
    for k in (0, 1):
        c = (1 - to_pooled) * covariances[k] + to_pooled * pooled
        c = (1 - to_diagonal) * c + to_diagonal * np.diag(np.diag(c)) + ridge * np.diag(scale**2)
        factor = np.linalg.cholesky(c)
        factors.append(np.linalg.inv(factor))
        constants.append(np.log(n[k] / n.sum()) / temperature - np.log(np.diag(factor)).sum())
    return Discriminant(means, np.array(factors), np.array(constants), temperature=temperature)


def quality_scores(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, hold_out: int = 5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **fitting) -> DataFrame:
    """One row (doc_id, held_out, score, predicted) per row of docs; the score is the probability of label 1.

    The model learns from the labelled documents whose crc32(doc_id as text) mod hold_out is not 0, all of them, and from the text alone.
    Null labels and ids teach nothing; of a document with several labels the mean decides (1 from one half on). Without labelled rows
    every score is 0.5; with one class only, that class. Null and empty texts are scored like any other. Repeated rows each give a row.
    Only the id and the text of docs are read."""
    stats = materialize(document_statistics(docs, id_col=id_col, text_col=text_col))
    held = lambda key: F.coalesce(F.crc32(key.cast("string").cast("binary")) % hold_out == 0, F.lit(False))
    marks = labels.select(column(labels, id_col).alias("doc_id"), column(labels, label_col).alias("label")).dropna().groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    model = fit(stats.join(marks.where(~held(F.col("doc_id"))), "doc_id").select("x", "label"), **fitting)

    def judge(rows: pa.RecordBatch) -> pa.RecordBatch:
        x = rows.column(1).flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, len(FEATURES))
        return batch(doc_id=rows.column(0), score=pa.array(model.scores(x), pa.float64()))

    scored = map_batches(stats, judge, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
