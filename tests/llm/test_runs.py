"""Periodic runs against their definition, on whole tables and hard rows."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tickflow.llm.runs import collapse_runs, op11_runs, planted

RUN = ("start", "length", "period")


def plain_runs(words, least=12):
    """All runs by going through all periods."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            begin = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - begin + q
            if length >= max(least, 2 * q) and not any(all(words[k] == words[k + p] for k in range(begin, begin + length - p)) for p in range(1, q)):
                out.append((begin, length, q))
            i += 1
    return sorted(out)


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_against_the_definition(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op11_runs(spark, sf).collect()
    assert len(rows) == len(docs) and sum(r.n_runs > 0 for r in rows) > 20
    short = [r for r in rows if len((docs[r.doc_id] or "").split()) < 700]
    assert len(short) > 150
    for r in short:
        assert tuple(r)[1:] == plain_row(r.doc_id, docs[r.doc_id]), r.doc_id


@pytest.mark.parametrize("least", [12, 3])
def test_random_words_of_small_alphabets(spark, least):
    draw = random.Random(least)
    texts = []
    for _ in range(300):
        words = [draw.choice("abcde"[: draw.randint(1, 5)]) for _ in range(draw.choice([0, 1, 11, 12, 13, 40, 90]))]
        if words and draw.random() < 0.5:
            a = draw.randrange(len(words))
            p = 1 + (len(words) - a) // draw.randint(2, 9)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        texts.append(" ".join(words))
    rows = collapse_runs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), least=least).collect()
    for r in rows:
        assert [tuple(x[c] for c in RUN) for x in r.runs] == plain_runs(texts[r.doc_id].split(), least)


def test_hard_rows(spark):
    one, long = "ab " * 12, " ".join(["w"] * 30_000 + [str(i) for i in range(30_000)])
    rows = [(1, None, 1), (2, "", 2), (3, " \t\n\v\f\r", 3), (4, one, 4), (4, one, 4), (None, f"\n{one}", 5), (6, "ab " * 11, 6), (7, long, 7), (8, "é  " * 12, 8), (9, "\x1c \x1c\x1d " * 12, 9)]
    df = spark.createDataFrame(rows, "`doc id` long, `te.xt` string, start int")
    out = {}
    for r in collapse_runs(df, id_col="doc id", text_col="te.xt").collect():
        out.setdefault(r.doc_id, []).append(r)
    run = lambda r: [tuple(x[c] for c in RUN) for x in r.runs]
    assert all(out[k][0].text == "" and out[k][0].n_words == 0 and not out[k][0].runs for k in (1, 2, 3))
    assert len(out[4]) == 2 and all(run(r) == [(0, 12, 1)] and r.text == "ab" for r in [*out[4], *out[None]])
    assert not out[6][0].runs and out[6][0].text == " ".join(["ab"] * 11)
    assert run(out[7][0]) == [(0, 30_000, 1)] and out[7][0].text.split() == ["w", *[str(i) for i in range(30_000)]]
    assert out[8][0].text == "é "  # a no-break space separates no words, nor do the separators below the blank
    assert run(out[9][0]) == [(0, 24, 2)]
    assert collapse_runs(df.limit(0), id_col="doc id", text_col="te.xt").count() == 0


def test_planted_texts(spark):
    texts = spark.range(300).select(F.col("id").alias("doc_id"), F.expr("array_join(transform(sequence(0, id % 50), x -> string(x)), ' ')").alias("text"))
    texts = texts.unionByName(spark.createDataFrame([(None, "x y"), (10, None), (11, "")], "doc_id long, text string"))
    for r in texts.select("doc_id", "text", planted(F.col("doc_id"), F.col("text")).alias("new")).collect():
        words, h = (r.text or "").split(), zlib.crc32(str(r.doc_id).encode())
        if r.doc_id is None or h % 10 or not words:
            assert r.new == r.text
            continue
        a = h // 10 % len(words)
        p = 1 + (len(words) - a) // (3 + h // 10 % 8)
        assert r.new == " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(len(words)))
