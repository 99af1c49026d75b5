"""Corpus operators against brute force, exact round trips, and hard inputs."""

import hashlib
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.oracle import same
from tickflow.llm import common, components, lines, packing, quality, queries, rules, shards, simhash, substrings, templates, urls, warc

LONG = "word " * 30_000 + "end."
DOCS = [(1, "Aa bb cc dd ee. " * 12, "s"), (1, "Aa bb cc dd ee. " * 12, "s"), (2, None, None), (3, "", "s"), (4, "   \n\t ", "t"), (None, "x y z", "s"), (5, LONG, "s"), (6, "Aa bb cc dd ee. " * 12, "t"), (7, "é ü 日本   x²", "t")]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and further columns of clashing names."""
    rows = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    return rows.withColumns({"n": F.lit(1), "h": F.lit("h"), "fp": F.lit(2), "host": F.lit("x"), "score": F.lit(9), "lang": F.lit("en"), "n_chars": F.length("text").cast("long"), "row": F.lit(0), "id": F.lit(4), "line": F.lit(1)})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, sf, name):
    same(queries.QUERIES[name](spark, sf), queries.SQL[name], sf)


def roots(n, edges):
    p = list(range(n))

    def find(x):
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        p[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(400 + k, 401 + k) for k in range(40)] + [(7, 7)] + [(500, 501 + k) for k in range(50)]
    frame = spark.createDataFrame([*edges, (3, None)], "src long, dst long")
    got = {r.node: r.component for r in components.connected_components(frame).collect()}
    want = roots(600, edges)
    touched = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: want[x] for x in touched}
    assert components.connected_components(frame.where("false")).count() == 0


# 1 -------------------------------------------------------------------------------------------------------------------------------------


def test_urls(spark):
    rules_ = [("block", "a.com/x"), ("allow", "a.com/x/y/"), ("block", "b.a.com/"), ("block", "org/q/z"), ("allow", "")]
    names = ["http://a.com/xy", "http://a.com/x/y/z", "HTTP://B.A.COM/x", "http://c.b.a.com?x", "http://xa.com/x", "x.org/q/z", "ftp://x.org/q/zz#f", "http://", "http://a.com", "http://.com/", None, "", "http://x.org/q"]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(names)] + [(None, None, "h"), (0, names[0], "h")], "page_id long, url string, host string")

    def fits(rule, host, path):
        h, p = urls.split_rule(rule)
        return (host == h or host.endswith("." + h) or False) and path.startswith(p)

    for size in (urls.MAX_TRIE_BYTES, 0):
        rows = urls.filter_urls(pages, rules_, default="none", max_trie_bytes=size).collect()
        assert len(rows) == len(names) + 2
        for r in rows:
            found = [x for _, x in rules_ if fits(x, r.host, r.path)]
            best = max(found, key=lambda x: (urls.split_rule(x)[0].count("."), len(urls.split_rule(x)[1])), default=None)
            assert r.rule == best, r
    assert urls.filter_urls(pages.where("false")).count() == 0
    assert urls.filter_urls(pages, []).where("rule is not null").count() == 0
    holes = spark.createDataFrame([("block", "a.com/x"), (None, "org/"), ("allow", None)], "verdict string, rule string")
    for size in (urls.MAX_TRIE_BYTES, 0):
        assert {r.rule for r in urls.filter_urls(pages, holes, max_trie_bytes=size).collect()} == {"a.com/x", None}


# 2 -------------------------------------------------------------------------------------------------------------------------------------


def plain_fingerprint(text, k=4):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, sf):
    rows = queries.QUERIES["op2_simhash"](spark, sf).orderBy("doc_id").collect()
    texts = {r.doc_id: r.text for r in common.read(spark, sf, "documents").collect()}
    prints = [plain_fingerprint(texts[r.doc_id]) for r in rows]
    assert [r.fingerprint for r in rows] == [f"{p:016x}" for p in prints]
    want = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    assert [r.component_id for r in rows] == [rows[w].doc_id for w in want]


@pytest.mark.parametrize(("length", "block"), [(1, 1024), (2, 3), (3, 1024)])
def test_pigeonring_keys_lose_nothing(spark, length, block):
    rng = np.random.default_rng(2)
    prints = set()
    for b in rng.integers(0, 2**63, 60, dtype=np.uint64):
        for _ in range(5):
            x = int(b)
            for k in rng.choice(64, rng.integers(0, 7), replace=False):
                x ^= 1 << int(k)
            prints.add(x)
    prints = sorted(prints)
    nodes = spark.createDataFrame([(int(np.uint64(p).view(np.int64)), i) for i, p in enumerate(prints)], "fp long, node long")
    got = [(r.src, r.dst) for r in simhash.links(nodes, 4, length=length, block=block).collect()]
    assert all((prints[a] ^ prints[b]).bit_count() <= 4 for a, b in got)
    near = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    assert roots(len(prints), got) == roots(len(prints), near)


def test_simhash_hard(docs, none):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(DOCS)
    parts = {r.doc_id: r.component_id for r in rows}
    assert parts[2] == parts[3] == parts[4] == 2 and parts[1] == parts[6] == 1 and parts[None] is None and parts[5] == 5
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 5, 7, None}
    assert simhash.near_duplicates(none).count() == 0


def shingle_set(text, k=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def similar_texts(texts, least):
    """All pairs (i, j) of different texts whose shingle sets have that Jaccard similarity."""
    sets = [shingle_set(t) for t in texts]
    return [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j] and texts[i] != texts[j] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])]


def test_similar_texts_are_linked(spark):
    """Against all pairs by shingle similarity: copies of 0.7 to 1, one or a few words exchanged in texts of 8 to 400 words."""
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghilmnoprstu"), 5))
    texts = []
    for n in (8, 30, 60, 120, 400):
        for _ in range(40):
            base = [word() for _ in range(n)]
            copy = list(base)
            for at in rng.choice(n, max(1, int(n * rng.uniform(0, 0.035))), replace=False):
                copy[at] = word()
            texts += [" ".join(base), " ".join(copy if n > 8 else [*base, word()])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    part = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame, size=5, similarity=0.8).collect()}
    pairs = similar_texts(texts, 0.8)
    assert len(pairs) > 60 and sum(part[i] == part[j] for i, j in pairs) / len(pairs) >= 0.95
    prints = [plain_fingerprint(t, 5) for t in texts]
    close = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    top = roots(len(texts), pairs + close)
    assert all(top[i] == top[part[i]] for i in range(len(texts)))


# 3 -------------------------------------------------------------------------------------------------------------------------------------


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = quality.op3_quality(spark, sf).join(common.read(spark, sf, "labels"), "doc_id").where("held_out and quality is not null").toPandas()
    assert (rows.predicted == rows.quality).mean() > 0.97
    assert (rows[rows.quality == 1].predicted == 1).mean() > 0.97
    rank, good = rows.score.rank(), rows.quality == 1
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.99


def test_quality_hard(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (6, 0), (3, None), (None, 1), (7, 0), (7, 1)], "doc_id long, quality int")
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == len(DOCS) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    assert {r.score for r in quality.quality_scores(docs, labels.where("false")).collect()} == {0.5}
    assert {r.score for r in quality.quality_scores(docs, labels.where("quality = 1")).collect()} <= {1.0, 0.5}
    assert quality.quality_scores(none, labels).count() == 0


def test_quality_is_the_plain_discriminant(spark):
    """Scores against a plain fit by numpy: covariances of all labelled rows, determinants and inverses, without cached factors."""
    sf = "/root/testdata/sf0.01"
    stats = {r.doc_id: np.array(r.x) for r in quality.document_statistics(common.read(spark, sf, "documents")).collect()}
    labels = {r.doc_id: r.quality for r in common.read(spark, sf, "labels").collect() if r.quality is not None}
    rows = [[stats[d] for d, y in labels.items() if y == k and zlib.crc32(str(d).encode()) % 5] for k in (0, 1)]
    share = [len(x) / sum(map(len, rows)) for x in rows]
    own = [np.cov(np.array(x).T, bias=True) for x in rows]
    pooled = share[0] * own[0] + share[1] * own[1]
    logs = []
    for k in (0, 1):
        c = (1 - quality.TO_POOLED) * own[k] + quality.TO_POOLED * pooled
        c = (1 - quality.TO_DIAGONAL) * c + quality.TO_DIAGONAL * np.diag(np.diag(c)) + quality.RIDGE * np.diag(np.diag(pooled) + quality.RIDGE)
        inverse, mean = np.linalg.inv(c), np.mean(rows[k], axis=0)
        logs.append({d: -0.5 * (x - mean) @ inverse @ (x - mean) - 0.5 * np.linalg.slogdet(c)[1] + np.log(share[k]) / quality.TEMPERATURE for d, x in stats.items()})
    for r in quality.op3_quality(spark, sf).collect():
        want = 1 / (1 + np.exp(np.clip(quality.TEMPERATURE * (logs[0][r.doc_id] - logs[1][r.doc_id]), -500, 500)))
        assert abs(r.score - want) < 1e-6 and r.predicted == (r.score >= 0.3)


# 4 -------------------------------------------------------------------------------------------------------------------------------------


def test_rules_hard(docs, none):
    rows = rules.apply_policy(rules.ledger(docs), "v1").collect()
    assert len(rows) == len(DOCS)
    by = {r.doc_id: r for r in rows}
    assert by[2].n_words == by[3].n_words == by[4].n_words == 0 and not by[2].kept
    assert by[5].n_words == 30_001 and by[5].n_repeat_words == 30_000
    assert by[7].word_chars == 8 or by[7].word_chars == 7  # the no-break space is part of a word
    assert rules.ledger(none).count() == 0 and rules.ablation(rules.ledger(none), "v1").where("fails > 0").count() == 0


def test_ablation(spark, sf):
    book = rules.ledger(common.read(spark, sf, "documents"))
    failed = [r.failed for r in book.collect()]
    names = [n for n, _ in rules.RULES]
    for r in rules.ablation(book, "v1").collect():
        bit = 1 << names.index(r.rule)
        rest = rules.mask([n for n in names if n != r.rule])
        assert r.fails == sum(f & bit > 0 for f in failed) and r.kept_without == sum(f & rest == 0 for f in failed)
        assert r.only_this == sum(f == bit for f in failed)


# 5 -------------------------------------------------------------------------------------------------------------------------------------


def test_shards_hold_the_mixture(spark, sf):
    rows = shards.assign_shards(common.read(spark, sf, "documents"), 8, bucket_rows=13).toPandas()
    sizes = rows.groupby("shard").size()
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in rows.groupby("shard"))
    mixes = rows.groupby(["source", "shard"]).size().unstack(fill_value=0)
    assert (mixes.max(axis=1) - mixes.min(axis=1)).max() <= 2


@pytest.mark.parametrize("total", [4_000_001, 2_000_003, 41, 40, 3])
def test_shards_of_many_rows(spark, total):
    rows = shards.cut_evenly(spark.range(total).withColumnRenamed("id", "place"), total, 40).groupBy("shard").agg(F.min("slot").alias("a"), F.max("slot").alias("b"), F.count("*").alias("n")).collect()
    assert all(r.a == 0 and r.b == r.n - 1 and r.n - total // 40 in (0, 1) and 0 <= r.shard < 40 for r in rows) and sum(r.n for r in rows) == total


def test_shards_of_the_last_of_many_rows(spark):
    total = 10**11 + 7
    last = shards.cut_evenly(spark.range(total - 3, total).withColumnRenamed("id", "place"), total, 40).collect()
    assert {r.shard for r in last} == {39} and max(r.slot for r in last) == total // 40 - 1


def test_shards_of_an_empty_source(spark):
    rows = shards.assign_shards(spark.createDataFrame([(1, "a", ""), (2, "b", None), (3, "c", "=")], "doc_id long, text string, source string"), 2).collect()
    assert {r.doc_id: r.source for r in rows} == {1: "", 2: None, 3: "="}


def test_shards_hard(docs, none, tmp_path):
    rows = shards.assign_shards(docs, 4).collect()
    assert len(rows) == len(DOCS) and {r.size for r in rows if r.doc_id in (2, 3)} == {16} and {r.text_crc32 for r in rows if r.doc_id in (2, 3)} == {0}
    assert shards.assign_shards(none).count() == 0
    shards.write_shards(docs.where("doc_id > 1").select("doc_id", "text", "source"), f"{tmp_path}/out", 2)
    assert docs.sparkSession.read.parquet(f"{tmp_path}/out").count() == 6


# 6 -------------------------------------------------------------------------------------------------------------------------------------


def test_templates(spark):
    items = [(1, "If Anna buys 12 apples for 3 dollars and sells 12 of them to Peter how many does she have"), (2, "short one here"), (3, None), (4, ""), (None, "x"), (1, "If Anna buys 12 apples for 3 dollars and sells 12 of them to Peter how many does she have")]
    texts = {
        10: "Foo bar. If Maria buys 40 apples for 7 euros and sells 40 of them to John how many does she have left",
        11: "If Maria buys 40 apples for 7 euros and sells 41 of them to John how many does she have",
        12: "a short one here ok", 13: None, 14: "y\n" + items[0][1], 15: "the short one sat", 16: "", 17: "word " * 50_000 + "\n" + items[0][1],
    }
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(k, v) for k, v in texts.items()] + [(14, texts[14]), (None, texts[14])], "doc_id long, text string").withColumns({"h": F.lit(1), "pos": F.lit(1), "of": F.lit(1)})
    for sent in (1 << 20, 0):
        got = {(r.doc_id, r.item_id): r.exact for r in templates.contaminated(docs, bench, max_sent=sent).collect()}
        assert got == {(10, 1): False, (14, 1): True, (17, 1): True, (12, 2): True}
    assert {r.doc_id for r in templates.drop_contaminated(docs, bench).collect()} == {11, 13, 15, 16, None}
    assert templates.contaminated(docs.where("false"), bench).count() == 0 and templates.contaminated(docs, bench.where("false")).count() == 0


def test_planted_items(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = common.read(spark, sf, "documents").collect(), common.read(spark, sf, "benchmark").collect()
    want = {(d.doc_id, b.item_id) for d in docs for b in bench if b.text in d.text}
    got = {(r.doc_id, r.item_id) for r in templates.op6_decontamination(spark, sf).collect()}
    assert want and got == want


def test_names_anywhere(spark):
    item = "{0} has 5 apples. {1} has 7 apples. {0} gives {1} 2 apples. How many apples has {0} now?"
    pairs = [("Tom", "Ann"), ("Eve", "Bob"), ("McDonald", "O'Brien"), ("NASA", "Li")]
    docs = spark.createDataFrame([(k, "Read this. " + item.format(*p)) for k, p in enumerate(pairs)] + [(9, item.format("Eve", "Bob").replace("has Eve now", "has Bob now"))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item.format("Tom", "Ann"))], "item_id long, text string")
    got = {r.doc_id: (r.coverage, r.exact) for r in templates.contaminated(docs, bench).collect()}
    assert got == {0: (1.0, True), 1: (1.0, False), 2: (1.0, False), 3: (1.0, False)}


def test_copied_items(spark):
    short = "which of these seven rivers flows into the black sea after passing four old capital cities"
    items = {1: "There are 12 boxes on the left shelf of the old store and a clerk then puts exactly 12 more boxes beside them", 2: "12 + 7 = 19 and 3 x 5 = 15 but 81 / 9 = 9", 3: short}
    texts = {1: items[1].replace("12 more", "13 more"), 2: "So: " + items[2], 3: short.replace("flows", "runs"), 4: "14 + 7 = 21 and 3 x 6 = 18 but 72 / 9 = 8", 5: "which of these seven rivers is long"}
    frames = [spark.createDataFrame(list(x.items()), f"{k} long, text string") for k, x in (("doc_id", texts), ("item_id", items))]
    got = {(r.doc_id, r.item_id): r.exact for r in templates.contaminated(*frames).collect()}
    assert got == {(1, 1): False, (2, 2): True, (3, 3): True}


def plain_template(text):
    """(kind, word) of the words that have letters or digits, one at a time."""
    out = []
    for line in templates._GLUED.sub(" ", text or "").split("\n"):
        starts = True
        for w in line.split():
            kind, bare = templates.classify(w, starts)
            starts = bool(templates._STOP.search(w))
            out += [(kind, bare)] if bare else []
    return out


def plain_contaminated(docs, items):
    """All documents against all items, window by window: {(doc, item): (coverage, matched, exact)}."""

    def windows(tokens, size):
        for p in range(len(tokens) - size + 1):
            part = tokens[p : p + size]
            rich = sum(k == 0 for k, _ in part) >= templates.LITERAL * size
            yield p, (rich, tuple((k, "" if k else w) if rich else w for k, w in part)), [w for k, w in part if k]

    out = {}
    for i, item in items.items():
        tokens = plain_template(item)
        size = templates.window_of(len(tokens), templates.WINDOW)
        own = list(windows(tokens, size)) if size else []
        for d, doc in docs.items():
            met = [(p - q, q, key[0], slots, theirs) for p, key, theirs in (windows(plain_template(doc), size) if own else ()) for q, k, slots in own if k == key]
            values = {}
            for shift, _, _, slots, theirs in met:
                for x, y in zip(slots, theirs, strict=True):
                    values.setdefault(shift, {}).setdefault(x, set()).add(y)
            torn = {s for s, v in values.items() if any(len(y) > 1 for y in v.values())}
            changed = {s for s, v in values.items() if any(y != {x} for x, y in v.items())}
            good = [m for m in met if m[3] == m[4] or m[2] and m[0] not in torn]
            n, rich = len({m[1] for m in good}), len({m[1] for m in good if m[2]})
            riches = sum(k[0] for _, k, _ in own)
            coverage = max(n / len(own), rich / riches if riches else 0) if good else 0
            if coverage >= templates.COVERAGE:
                out[d, i] = (round(coverage, 9), n, not any(m[0] in changed for m in good))
    return out


def test_templates_against_all_pairs(spark):
    """Word problems with other numbers, names and units, verbatim items and unrelated texts; repeated values stay repeated."""
    rng = np.random.default_rng(5)
    names, units = ["Anna", "Peter", "Maria", "John", "Tom", "Lena", "Omar", "Ruth"], ["apples", "pears", "coins", "books"]
    forms = ["{a} has {x} {u} and buys {y} more {u} at the market. How many {u} does {a} have now?", "A train leaves {a} at {x} km per hour and reaches {b} after {y} hours of travel. How far is {b} from {a}?", "If {a} shares {x} {u} with {b} and keeps {y} of them for the weekend, how many {u} does {b} get?", "{a} reads {x} pages each day for {y} days, then {b} reads twice as many pages in half the time."]
    fill = lambda form, u: form.format(a=names[k[0]], b=names[k[1]], x=rng.integers(2, 90), y=rng.integers(2, 90), u=u) if (k := rng.permutation(8)[:2]) is not None else ""
    items = {i: fill(form, units[i % 4]) for i, form in enumerate(forms)} | {10: "the old mill by the river was closed for good in the winter of that year", 11: "", 12: "two words"}
    filler = lambda: " ".join(rng.choice(["grey", "stone", "walks", "under", "seven", "lamps", "slowly", "green"], 30))
    docs, plants = {}, set()
    for d in range(60):
        i = int(rng.integers(4))
        docs[d] = f"{filler()}. {fill(forms[i], units[i % 4]) if d % 3 else filler()} {filler()}"
        plants |= {(d, i)} if d % 3 else set()
    docs |= {100: filler() + "\n" + items[10], 101: items[0] + " " + items[0], 102: "", 103: items[1].replace("km", "miles"), 104: "two words"}
    got = {(r.doc_id, r.item_id): (round(r.coverage, 9), r.matched, r.exact) for r in templates.contaminated(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    assert got == plain_contaminated(docs, items)
    assert len(plants & got.keys()) >= 0.9 * len(plants) and {d for d, _ in got} <= {d for d, _ in plants} | {100, 101, 103, 104}


# 7 -------------------------------------------------------------------------------------------------------------------------------------


def whole_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    tokenizer.encode_special_tokens = True
    return [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_encoder(spark, sf):
    odd = ["", " lead", "trail ", "a  b", "tab\tx", "it's don't, o'clock!! it's.", "x²,½ é́a!! 12,000.5km ", "nul\0x y", "日本語。 テスト,ok", "a\n\nb", "foo_bar. __x__, 'quoted', ''s", "<|endoftext|> a<|endoftext|>.", "a b c", "ªº µ ÷×", "ß Œ ſ!?12ab", "\n", " "]
    texts = odd + [r.text for r in common.read(spark, sf, "documents").collect()]
    encoder = packing.Encoder(packing.vocabulary_path())
    assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)] == whole_ids(texts)


def unpacked(rows):
    """The ids of each document, put together from its pieces; checks pieces and sequences on the way."""
    for _, g in rows.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset.to_numpy() == np.concatenate(([0], g.length.cumsum()[:-1]))).all()
    sizes = rows.groupby("sequence_id").length.sum()
    assert (sizes.sort_index().iloc[:-1] == 2048).all() and sizes.max() <= 2048


def test_packing_round_trip(spark, sf):
    docs = common.read(spark, sf, "documents")
    rows = packing.pack(docs, with_ids=True).toPandas()
    unpacked(rows)
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = dict(zip(texts, [x + [1] for x in whole_ids(list(texts.values()))], strict=True))
    for doc, g in rows.groupby("doc_id"):
        g = g.sort_values("start")
        assert np.concatenate(g.ids.tolist()).tolist() == want[doc] and set(g.doc_tokens) == {len(want[doc])}
        assert all(zlib.crc32(np.array(i, "<u4").tobytes()) == c for i, c in zip(g.ids, g.ids_crc32, strict=True))
    assert rows.doc_id.nunique() == len(texts)
    # every sequence but the last few holds the sources in proportion, to a block or two
    source = {r.doc_id: r.source for r in docs.collect()}
    rows["source"] = rows.doc_id.map(source)
    shares = rows.groupby("source").length.sum() / rows.length.sum()
    upto = rows[rows.sequence_id < rows.sequence_id.max() // 2].groupby("source").length.sum()
    assert (abs(upto - shares * upto.sum()) < 3 * packing.BLOCK).all()


def test_packing_hard(docs, none):
    rows = packing.pack(docs).toPandas()
    unpacked(rows)
    assert rows[rows.doc_id.isin([2, 3])].doc_tokens.tolist() == [1, 1] and rows.doc_id.isna().sum() >= 1
    total = sum(len(x) + 1 for x in whole_ids([t or "" for _, t, _ in DOCS]))
    assert rows.length.sum() == total
    assert packing.pack(none).count() == 0
    first = packing.pack(docs, weights={"s": 0.2, "t": 0.8}).toPandas()
    assert first.length.sum() == total


# 8 -------------------------------------------------------------------------------------------------------------------------------------


def plain_removal(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = {}
    for w in words:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_substrings(spark, seed):
    rng = np.random.default_rng(seed)
    passages = [" ".join(f"w{x}" for x in rng.integers(0, 9 + 40 * seed, rng.integers(5, 30))) for _ in range(12)]
    texts = [" ".join(passages[k] if rng.random() < 0.7 else f"u{rng.integers(1e6)}" for k in rng.integers(0, 12, rng.integers(0, 12))) for _ in range(60)]
    texts += ["a a a a " * 20, "a a a a " * 20, "", None, "b " * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = substrings.drop_repeated_spans(docs, window=10, k=4).orderBy("doc_id").collect()
    got = [(r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in rows]
    assert got == plain_removal(texts, 10)
    assert all(sum(s["words"] for s in r.spans) == r.n_removed for r in rows)


def test_substrings_hard(docs, none):
    rows = substrings.drop_repeated_spans(docs).collect()
    assert len(rows) == len(DOCS)
    by = {r.doc_id: r for r in rows}
    assert by[1].n_removed == by[6].n_removed == 60 and by[2].text == by[3].text == "" and by[5].n_removed == 30_000 and by[None].n_removed == 0
    assert substrings.drop_repeated_spans(none).count() == 0


# 9 -------------------------------------------------------------------------------------------------------------------------------------


def plain_words(line):
    import regex

    return [w for w in regex.split(r"[^\p{L}\p{N}]+", line.lower()) if w]


def every_line(texts):
    """{(doc, line): the line as it is compared}; None for a line without words."""
    return {(d, k): " ".join(plain_words(x)) or None for d, t in texts if t is not None for k, x in enumerate(t.split("\n"))}


def similar_lines(flat):
    """All pairs of different lines of edit similarity 0.8 or more, whatever the operator looks for them by."""
    import duckdb
    import pandas as pd

    t = pd.DataFrame({"x": sorted({x for x in flat.values() if x})})
    return duckdb.sql("SELECT a.x, b.x FROM t a, t b WHERE a.x < b.x AND least(length(a.x), length(b.x)) >= 0.79 * greatest(length(a.x), length(b.x)) AND levenshtein(a.x, b.x) <= floor(greatest(length(a.x), length(b.x)) * 0.2 + 1e-9)").fetchall()


def check_lines(texts, rows, least):
    """Rows against all pairs of lines by edit similarity alone: nothing is grouped that such pairs do not connect, equal lines always are,
    and so are at least that share of the pairs. Returns the share."""
    flat = every_line(texts)
    top = {(r.doc_id, r.line_no): (r.group_doc_id, r.group_line_no) for r in rows}
    assert top.keys() == flat.keys() and all(r.kept == ((r.doc_id, r.line_no) == (r.group_doc_id, r.group_line_no)) for r in rows)
    assert all(top[k] == k for k, x in flat.items() if x is None)
    groups = {}
    for k, x in flat.items():
        if x:
            groups.setdefault(x, set()).add(top[k])
    assert all(len(g) == 1 for g in groups.values())
    found = {x: next(iter(g)) for x, g in groups.items()}
    pairs, names = similar_lines(flat), sorted(found)
    number = {x: k for k, x in enumerate(names)}
    want = roots(len(names), [(number[x], number[y]) for x, y in pairs])
    whole = {}
    for k, x in flat.items():
        if x:
            whole.setdefault(found[x], set()).add(want[number[x]])
    assert all(len(g) == 1 for g in whole.values())
    firsts = {}
    for k, x in flat.items():
        if x:
            firsts[found[x]] = min(firsts.get(found[x], k), k)
    assert all(g == k for g, k in firsts.items())
    share = sum(found[x] == found[y] for x, y in pairs) / len(pairs) if pairs else 1.0
    assert share >= least, share
    return share


def mixed_lines(rng, bases, copies):
    """Lines of 1 to 30 words with copies of which letters or words are exchanged, left out or repeated, some further than 0.8."""
    vocabulary = ["".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(2, 9))) for _ in range(400)] + ["the", "of", "in", "a", "to"] * 20
    out = []
    for _ in range(bases):
        words = rng.choice(vocabulary, rng.integers(1, 31)).tolist()
        out.append(" ".join(words))
        for _ in range(rng.integers(0, copies)):
            w = list(words)
            for _ in range(rng.integers(1, 4)):
                at = int(rng.integers(len(w)))
                w[at : at + 1] = [[str(rng.choice(vocabulary))], [w[at], w[at]], w[at + 1 : at + 1] or [w[at]], [w[at][::-1]], [w[at] + "x"]][rng.integers(5)]
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_lines(spark, seed):
    rng = np.random.default_rng(seed)
    pool = mixed_lines(rng, 150, 5)
    texts = []
    for d in range(90):
        own = [pool[rng.integers(len(pool))] for _ in range(5)]
        texts.append((d, "\n".join([own[0].capitalize() + ("." if rng.random() < 0.5 else "!"), *own[1:], "", "short line", "* * *"])))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = lines.line_groups(docs).collect()
    check_lines(texts, rows, 0.95)
    kept = {(r.doc_id, r.line_no): r.kept for r in rows}
    new = {r.doc_id: r.text for r in lines.drop_fuzzy_lines(docs).collect()}
    assert all(new[d] == "\n".join(x for k, x in enumerate(t.split("\n")) if kept[d, k]) for d, t in texts)


def test_lines_of_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in common.read(spark, sf, "documents").orderBy("doc_id").collect()][:90]  # all pairs of more take minutes
    check_lines(texts, lines.line_groups(spark.createDataFrame(texts, "doc_id long, text string")).collect(), 0.95)


def test_a_hot_key_is_split(spark, monkeypatch):
    """Many lines that differ share a pair of words; blocks of three, and a low bound for what is common, change no group."""
    from tickflow.llm import linked

    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdefghilmnoprstu"), 6))
    texts = []
    for _ in range(40):
        words = [word() for _ in range(12)]
        words[4:6] = ["internationally", "recommended"]
        texts += [" ".join(words), " ".join([*words[:-1], word()])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {r.doc_id: r.group_doc_id for r in lines.line_groups(frame).collect()}
    assert want == {d: d - d % 2 for d in want}
    rows = common.materialize(lines.keyed_lines(frame.select(F.col("doc_id").alias("doc"), "text")).select(F.col("doc").alias("id"), "length", "keys", "sample"))
    words = frame.select(F.col("doc_id").alias("id"), F.split("text", " ").alias("words"))
    for block, most in ((3, None), (3, 10)):
        got = linked.linked_groups(rows, F.col("length") > 0, lambda p: lines._verified(p, words, 0.8), common=most, split="sample", block=block).collect()
        assert {r.node: r.component for r in got} == want


def test_links_do_not_depend_on_how_many_lines_share_a_key(spark, monkeypatch):
    """Lines of one opening and six other words, up to three of them exchanged: pairs that are linked alone are linked among ten times as
    many, with all the opening's runs far above the bound of what is common."""
    monkeypatch.setattr(lines, "COMMON", 40)
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(3, 10))))
    opening, texts = [word() for _ in range(12)], []
    for _ in range(300):
        one = [word() for _ in range(6)]
        two = [word() if k in rng.choice(6, int(rng.integers(0, 4)), replace=False) else w for k, w in enumerate(one)]
        texts += [" ".join(opening + one), " ".join(opening + two)]
    near = {frozenset(p) for p in similar_lines(dict(enumerate(texts)))}
    pairs = [k for k in range(0, 600, 2) if texts[k] != texts[k + 1] and frozenset(texts[k : k + 2]) in near]
    got = []
    for many in (60, 600):
        frame = spark.createDataFrame(list(enumerate(texts))[:many], "doc_id long, text string")
        group = {r.doc_id: r.group_doc_id for r in lines.line_groups(frame).collect()}
        got.append({k for k in pairs if k < many and group[k] == group[k + 1]})
    assert got[0] <= got[1] and len(got[1]) >= 0.97 * len(pairs)


def test_a_hot_key_loses_no_pair(spark, monkeypatch):
    """Lines of one opening and six words out of twelve, of which pairs differ in the second and fourth: they share neither a rare word nor
    a rare run, nor the same frequent words, and are linked all the same."""
    monkeypatch.setattr(lines, "COMMON", 8)
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 8))
    opening, few, texts = [word() for _ in range(12)], [word() for _ in range(12)], []
    for _ in range(200):
        one = list(rng.permutation(few)[:8])
        texts += [" ".join(opening + one[:6]), " ".join([*opening, one[0], one[6], one[2], one[7], *one[4:6]])]
    group = {r.doc_id: r.group_doc_id for r in lines.line_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    near = {frozenset(p) for p in similar_lines(dict(enumerate(texts)))}
    pairs = [k for k in range(0, 400, 2) if frozenset(texts[k : k + 2]) in near]
    assert len(pairs) > 150 and sum(group[k] == group[k + 1] for k in pairs) >= 0.97 * len(pairs)


def test_simhash_of_a_sample(spark):
    rng = np.random.default_rng(0)
    rows = [(k, [int(x) for x in np.sort(rng.integers(-(2**63), 2**63 - 1, n))]) for k, n in enumerate([*range(lines.SAMPLE + 1)] * 2)]
    for r in lines.with_simhash(spark.createDataFrame(rows, "k int, s array<long>"), "s").collect():
        h = [xxhash.xxh64_intdigest(np.int64(x).tobytes(), 42) for x in r.s]
        assert r.sim % 2**64 == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_lines_hard(docs, none):
    rows = lines.line_groups(docs).collect()
    got = {(r.doc_id, r.line_no, r.group_doc_id, r.group_line_no, r.kept) for r in rows}
    assert got == {(1, 0, 1, 0, True), (6, 0, 1, 0, False), (5, 0, 5, 0, True), (3, 0, 3, 0, True), (4, 0, 4, 0, True), (4, 1, 4, 1, True), (7, 0, 7, 0, True)}
    out = lines.drop_fuzzy_lines(docs, length_col="n_chars")
    assert out.columns == docs.columns and out.count() == len(DOCS)
    by = {r.doc_id: r for r in out.collect()}
    assert by[6].text == "" and by[6].n_chars == 0 and by[2].text is None and by[5].text == LONG and by[None].text == "x y z"
    assert lines.line_groups(none).count() == 0 and lines.drop_fuzzy_lines(none).count() == 0


def test_long_lines(spark):
    """Lines of many words, and one of many letters without a gap."""
    words = [f"w{k * k % 977}x" for k in range(20_000)]
    texts = [" ".join(words), " ".join([*words[:900], "other", *words[901:]]), "ab" * 15_000 + "c" * 5_000, "q" * 30_000]
    rows = lines.line_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.group_doc_id for r in rows} == {0: 0, 1: 0, 2: 2, 3: 3}


def edited(rng, words, share, letters):
    """A line and a copy of an edit similarity of 0.8 or more: that share of words, or of letters, is exchanged."""
    a = list(" ".join(words)) if letters else list(words)
    b = list(a)
    for at in rng.choice(len(a), max(1, int(share * len(a))), replace=False):
        b[at] = "qxzjk"[rng.integers(5)] if letters else words[at][::-1]
    return ("" if letters else " ").join(a), ("" if letters else " ").join(b)


@pytest.mark.parametrize(("share", "letters", "least"), [(0, False, 0.97), (0, True, 0.97), (0.15, False, 0.9), (0.05, True, 0.9)])
def test_similar_lines_are_found(spark, share, letters, least):
    """Against edit similarity alone: what was exchanged is known to leave 0.8 or more."""
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghilmnoprstu"), 5))
    vocabulary = [word() for _ in range(800)]
    texts = []
    for n in (10, 20, 30, 50):
        for _ in range(100):
            texts += edited(rng, rng.choice(vocabulary, n).tolist(), share, letters)
    rows = lines.line_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {r.doc_id for r in rows if r.doc_id % 2 and r.group_doc_id == r.doc_id - 1}
    shares = [len([d for d in found if d // 200 == k]) / 100 for k in range(4)]
    assert all(r.group_doc_id // 2 == r.doc_id // 2 for r in rows) and min(shares) >= least, shares


def test_texts_meet_only_for_pairs_that_share_words(spark):
    """Marks of the words lose no pair that shares half of them, and long texts of all other pairs are not sent about."""
    words = {k: [f"w{(k * 31 + i * i) % 5000 if i > 20 else i}x{'y' * 20}" for i in range(100)] for k in range(120)}
    words |= {k + 120: [*words[k][:90], *"abcdefghij"] for k in range(20)}
    texts = spark.createDataFrame(list(words.items()), "id long, words array<string>")
    pairs = spark.createDataFrame([(a, b) for a in words for b in words if a < b], "a long, b long")
    share = {(a, b) for a in words for b in words if a < b and 2 * len({*words[a]} & {*words[b]}) >= min(len({*words[a]}), len({*words[b]}))}
    left = {tuple(r) for r in lines._sharing(pairs, lines._marked(texts)).collect()}
    assert share <= left and len(left) < len(share) + 100 < len(words) ** 2 // 4

    store = spark.sparkContext._jsc.sc().statusStore()

    def written():
        stages = store.stageList(spark._jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), spark._jvm.java.util.ArrayList())
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}

    before = written()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        edges = {tuple(r) for r in lines._verified(common.materialize(pairs), texts, 0.8).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {(k, k + 120) for k in range(20)} <= edges <= share
    assert sum(n for k, n in written().items() if k not in before) < 400 * pairs.count()  # a text has over 2,000 characters


def test_lines_that_differ_in_digits(spark):
    texts = ["12 34 56 78 90", "98 76 54 32 11", "Item 1234567 of 7654321 sold for 8888888", "Item 9876543 of 1234567 sold for 1111111", "The shop on the corner sold 12 apples", "The shop on the corner sold 35 apples"]
    rows = lines.line_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.group_doc_id for r in rows} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 4}


def test_short_lines(spark, tmp_path):
    texts = ["Chapter one\n---\n", "chapter one!\n東京都千代田区丸の内一丁目九番一号の駅", "東京都千代田区丸の内一丁目九番二号の駅\nOther", "Headquarters Administration", "Headquarters Administratlon", "7", "8", "7"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.QUERIES["op9_lines"](spark, str(tmp_path)).collect()
    got = {(r.doc_id, r.line_no): (r.group_doc_id, r.group_line_no) for r in rows}
    assert all(got.pop(k) == k for k in ((0, 1), (0, 2)))
    assert got == {(0, 0): (0, 0), (1, 0): (0, 0), (1, 1): (1, 1), (2, 0): (1, 1), (2, 1): (2, 1), (3, 0): (3, 0), (4, 0): (3, 0), (5, 0): (5, 0), (6, 0): (6, 0), (7, 0): (5, 0)}


# 10 ------------------------------------------------------------------------------------------------------------------------------------


def test_warc(spark, tmp_path):
    import base64

    inner = "x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc"
    pages = [(1, "http://a/", inner * 3 + "\r\n"), (2, "http://b/\r\nX: y", "é日" * 900), (3, None, None), (4, "u", ""), (5, "u", "same"), (6, "v", "same"), (7, "w", "\r\n\r\n\r\n"), (None, "n", "same"), (8, "z", "\r\n\r\nWARC/1.0\r\n")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "payload": F.lit(2), "id": F.lit(3)})
    for chunk in (warc.CHUNK, 7):
        path = f"{tmp_path}/{chunk}"
        warc.write_archive(frame, path, chunk=chunk)
        assert warc.read_chunks(spark, path).where("length > 28").count() == (0 if chunk == 7 else warc.read_chunks(spark, path).where("length > 28").count())
        rows = warc.read_archive(spark, path).collect()
        assert len(rows) == len(pages) and all(r.intact for r in rows)
        for r in rows:
            body = (next(h for i, _, h in pages if i == r.page_id) or "").encode()
            assert r.payload_bytes == len(body) and r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        kinds = {r.page_id: (r.record_type, r.refers_to) for r in rows}
        assert kinds[5] == ("revisit", 6) and kinds[3] == ("revisit", 4) and kinds[6] == kinds[4] == kinds[None] == ("response", None)
    warc.write_archive(frame.where("false"), f"{tmp_path}/none")
    assert warc.read_archive(spark, f"{tmp_path}/none").count() == 0


# pipeline ------------------------------------------------------------------------------------------------------------------------------


def check_stage(name, old, new, sf, spark):
    """One stage's rows against a plain version of what it has to do."""
    import corpus_pipeline as cp

    if name == "quality":
        bad = {r.doc_id for r in quality.quality_scores(spark.createDataFrame([(r.doc_id, r.text) for r in old.values()], "doc_id long, text string"), common.read(spark, sf, "labels")).where("score < 0.3").collect()}
        assert set(old) - set(new) == bad
    elif name == "lines":
        assert set(old) == set(new)
        texts = sorted((d, r.text) for d, r in old.items())
        rows = lines.line_groups(spark.createDataFrame(texts, "doc_id long, text string")).collect()
        kept = {(r.doc_id, r.line_no): r.kept for r in rows}
        for d, t in texts:
            want = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if kept[d, k])
            assert new[d].text == want and (t is None or new[d].n_chars == len(want))
    elif name == "near_duplicates":
        ids = sorted(old)
        texts = [old[d].text for d in ids]
        prints = [plain_fingerprint(t, cp.SHINGLE) for t in texts]
        near = similar_texts(texts, cp.SIMILARITY)
        top = roots(len(ids), near + [(i, j) for i in range(len(ids)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
        assert {ids[k] for k in set(top)} <= set(new)  # clean documents and the first of each group stay
        assert len(set(new) - {ids[k] for k in set(top)}) <= 0.05 * len(set(top)) and len(new) < len(old)
    else:
        items = [r.text for r in common.read(spark, sf, "benchmark").collect()]
        gone = set(old) - set(new)
        assert gone == {d for d, r in old.items() if any(x in (r.text or "") for x in items)}


def test_pipeline(spark, sf):
    import corpus_pipeline as cp

    docs = common.read(spark, sf, "documents")
    columns = docs.columns
    for name, stage in cp.STAGES[:-1]:
        before, after = docs, common.materialize(stage(spark, docs, sf))
        assert after.columns == columns, name
        old, new = ({r.doc_id: r for r in x.collect()} for x in (before, after))
        assert set(new) <= set(old) and len(new) == after.count()
        check_stage(name, old, new, sf, spark)
        docs = after
    rows = cp.STAGES[-1][1](spark, docs, sf).toPandas()
    unpacked(rows)
    assert rows.doc_id.nunique() == docs.count()


def test_stages_on_hard_rows(spark, docs, sf):
    """Nulls, empty and very long texts, repeated rows and clashing columns: each stage keeps the columns, and rows with a null id or text
    are treated as its docstring says."""
    import corpus_pipeline as cp

    left = {"quality": None, "lines": {1, 2, 3, 4, 5, 6, 7, None}, "near_duplicates": {1, 2, 5, 7, None}, "decontamination": {1, 2, 3, 4, 5, 6, 7, None}}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, sf)
        rows = out.collect()
        assert out.columns == docs.columns, name
        ids = {r.doc_id for r in rows}
        assert None in ids and (left[name] is None or ids == left[name]), name
        if name in ("lines", "decontamination"):
            assert len(rows) == len(DOCS)
    unpacked(cp.packing(spark, docs, sf).toPandas())


def test_pipeline_of_nothing(spark, tmp_path, sf):
    import corpus_pipeline as cp

    for t in ("documents", "labels", "benchmark"):
        common.read(spark, sf, t).where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_pairs_of_lines_are_compared_in_rounds(spark, monkeypatch):
    """Pairs whose texts are several times as long as the lines themselves are compared in several rounds, each pair in one, with the same edges."""
    words = {k: [f"word{(k % 4 * 17 + i) % 90}" if i != k else "other" for i in range(20)] for k in range(30)}
    texts = spark.createDataFrame(list(words.items()), "id long, words array<string>")
    pairs = common.materialize(spark.createDataFrame([(a, b) for a in words for b in words if a < b], "a long, b long"))
    edges = lambda: sorted(tuple(r) for r in lines._verified(pairs, texts, 0.8).collect())
    want, sent = edges(), []
    assert want and {a % 4 == b % 4 for a, b in want} == {True}
    compared = lines._compared
    monkeypatch.setattr(lines, "_compared", lambda p, *more: sent.append(p.count()) or compared(p, *more))
    monkeypatch.setattr(lines, "ROUND", 1)
    assert edges() == want and len(sent) > 2 and max(sent) < 0.5 * sum(sent)


def test_shuffles_go_with_the_table_that_they_were_for(spark):
    """What a step shuffled is not on disk any more when its table is written."""

    def left():
        files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    before, conf = left(), spark.conf.getAll
    table = common.materialize(spark.range(1000).selectExpr("id % 7 AS k", "id").groupBy("k").agg(F.sum("id").alias("s")))
    assert left() <= before and table.count() == 7
    assert spark.conf.getAll == conf  # the session is as it was
