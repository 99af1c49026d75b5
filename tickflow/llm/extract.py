"""Main text of web pages by wrappers: one union-free regular expression per host, inferred from its pages' structure.

Pages are parsed once, into blocks of text and the folded expression of their structure. The few distinct expressions of a host are aligned
in a tree of bounded groups until one wrapper is left; every page's slots are then placed in it, and Spark sums up each slot's texts over
all pages of the host: how much text, how much of it linked, and whether it is the same everywhere. From these and the elements' kinds it
follows which slots hold the article. No stage sees all pages of a host, and what is joined back has a row per host and expression.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.common import batch, column, map_batches, materialize, read
from tickflow.llm.wrappers import ASIDE, HEADINGS, Node, align, dump, folded, load, parse, slots

#: Expressions that a task aligns at a time.
GROUP = 32
#: Pages that a template's text has to be the same on; the share of letters that makes a list one of links, and a region the main one.
SAME, LINKED, REGION = 3, 0.6, 0.8
Stats = tuple[int, int, bool, int, int]


def _aside(n: Node) -> bool:
    return n.tag in ASIDE or n.role not in ("", "main")


def _head(n: Node) -> bool:
    """A header that holds a heading: the article's own, if it is in it."""
    return (n.tag == "header" or n.role == "header") and _headed(n)


def _headed(n: Node) -> bool:
    return n.tag in HEADINGS or any(_headed(k) for k in n.kids if k.key[0] == "*" or not _aside(k) or k.role == "header")


def _articles(n: Node, strict: bool) -> list[Node]:
    """The elements that say they are the article: an article within main, and articles that have none in them. If strict, none that is
    in an element set aside by its class; never one in an element that HTML sets aside, or among comments."""
    if n.tag in ASIDE or n.role == "comment" or strict and n.role not in ("", "main") and n.tag not in ("html", "body"):
        return []
    inner = [a for k in n.kids for a in _articles(k, strict)]
    return inner or ([n] if n.tag in ("article", "main") or n.role == "main" else [])


def _within(n: Node, out: list[Node]) -> None:
    """The slots of an article, without what is set aside in it."""
    for k in n.kids:
        if k.key == "#":
            out.append(k)
        elif not _aside(k) or _head(k):
            _within(k, out)


def _region(wrapper: Node, stats: dict[int, Stats]) -> set[int]:
    """The slots of a host's main region, where no element says so: of the innermost element that has most of the free text, and of the one
    it shares with the page's title. Text that is the same on all pages of the host, or is mostly links, is none."""
    varied = any(not same for _, _, same, _, _ in stats.values())
    weight: dict[int, int] = {}

    def free(s: int) -> int:
        pages, items, same, letters, links = stats.get(s, (0, 0, False, 0, 0))
        fixed = varied and same and pages >= SAME and items == pages
        return 0 if fixed or links > LINKED * letters else letters

    def weigh(n: Node) -> int:
        weight[id(n)] = free(n.own[0]) if n.key == "#" else sum(weigh(k) for k in n.kids)
        return weight[id(n)]

    def cut(n: Node) -> None:
        n.kids = [k for k in n.kids if k.key == "#" or not _aside(k) or k.tag in ("html", "body") or k.role not in ("", "comment") and k.tag not in ASIDE and 2 * weight[id(k)] > total]
        for k in n.kids:
            cut(k)

    total = weigh(wrapper)
    cut(wrapper)
    total = weigh(wrapper)
    path = [wrapper]
    while heavy := [k for k in path[-1].kids if k.key != "#" and weight[id(k)] >= REGION * total]:
        path.append(heavy[0])
    titled = [n for n in path if any(s for s in _titles(n) if free(s))]
    best = titled[-1] if titled else path[-1]
    return {s.own[0] for s in slots(best) if free(s.own[0])}


def _titles(n: Node) -> list[int]:
    return [s.own[0] for k in n.kids for s in (slots(k) if k.tag == "h1" else ())] + [s for k in n.kids if k.tag != "h1" for s in _titles(k)]


@lru_cache(256)
def _main(wrapper: str, stats: str) -> frozenset[int]:
    tree = load(wrapper)
    for k, s in enumerate(slots(tree)):
        s.own = [k]
    return frozenset(_region(tree, {int(k): tuple(v) for k, v in json.loads(stats).items()}))


def _paths(n: Node, above: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Of each slot the elements it is in, without groups."""
    if n.key == "#":
        return [above]
    return [p for k in n.kids for p in _paths(k, above if k.key[0] in "*#" else (*above, k.key))]


def placed(shape: str, wrapper: str) -> list[int]:
    """The wrapper's slot that each slot of the expression is in: by alignment, and what its order leaves over is in the first slot of the
    same elements. The wrapper has them all, as no round of its inference drops any."""
    tree, host = load(shape), load(wrapper)
    leaves = slots(tree)
    paths, first = _paths(tree), {}
    for k, p in enumerate(_paths(host)):
        first.setdefault(p, k)
    for k, s in enumerate(slots(host)):
        s.own = [k]
    for k, s in enumerate(leaves):
        s.own = [-1 - k]
    out = [-1] * len(leaves)
    for s in (s for k in align(host.kids, tree.kids) for s in slots(k)):
        at = min((x for x in s.own if x >= 0), default=-1)
        for x in s.own:
            if x < 0:
                out[-1 - x] = at if at >= 0 else first.get(paths[-1 - x], -1)
    return out


def kept(shape: str, wrapper: str, stats: str, places: list[int]) -> list[bool]:
    """Which slots of an expression are the article's."""
    tree = load(shape)
    found = _articles(tree, True) or _articles(tree, False)
    if found:
        inside: list[Node] = []
        for a in found:
            _within(a, inside)
        chosen = {id(s) for s in inside}
        return [id(s) in chosen for s in slots(tree)]
    main = _main(wrapper, stats)
    outside = {id(s) for s in slots(tree)} - {id(s) for s in _plain(tree)}
    return [p in main and id(s) not in outside for s, p in zip(slots(tree), places, strict=True)]


def _plain(tree: Node) -> list[Node]:
    """The slots of a page that are in no element that HTML itself sets aside."""
    return [tree] if tree.key == "#" else [s for k in tree.kids if k.tag not in ASIDE for s in _plain(k)]


def blocks(df: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(page_id, url, host, shape, expression, blocks array<struct<slot, text, links>>) of every row."""
    url = column(df, url_col).cast("string")
    host = F.lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))
    pages = df.select(column(df, id_col).alias("page_id"), url.alias("url"), host.alias("host"), column(df, html_col).cast("string").alias("html"))
    kind = pages.schema["page_id"].dataType.simpleString()

    def look(rows: pa.RecordBatch) -> pa.RecordBatch:
        shapes, expressions, found = [], [], []
        for html in rows.column(3).to_pylist():
            tree, texts = parse(html or "")
            tree = folded(tree)
            expression = dump(tree)
            of = {b: k for k, s in enumerate(slots(tree)) for b in s.own}
            found.append([{"slot": of[k], "text": text, "links": links} for k, (text, links) in enumerate(texts)])
            shapes.append(xxhash.xxh128_digest(expression.encode()))
            expressions.append(expression)
        item = pa.struct([("slot", pa.int32()), ("text", pa.string()), ("links", pa.int32())])
        return batch(page_id=rows.column(0), url=rows.column(1), host=rows.column(2), shape=pa.array(shapes, pa.binary()), expression=pa.array(expressions, pa.string()), blocks=pa.array(found, pa.list_(item)))

    return map_batches(pages, look, f"page_id {kind}, url string, host string, shape binary, expression string, blocks array<struct<slot: int, text: string, links: int>>")


def host_wrappers(shapes: DataFrame, group: int = GROUP) -> DataFrame:
    """(host, wrapper) from (host, expression): each round aligns groups of about `group` expressions of a host, until one is left."""

    def one(rows: pa.Table) -> pa.Table:
        trees = sorted(rows.column("expression").to_pylist())
        out = load(trees[0])
        for t in trees[1:]:
            out.kids = align(out.kids, load(t).kids)
        return pa.table({"host": rows.column("host")[:1], "expression": [dump(out)]})

    now = shapes.select("host", "expression")
    while True:
        counts = materialize(now.groupBy("host").agg(F.count(F.lit(1)).alias("n")))
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return now.select("host", F.col("expression").alias("wrapper"))
        dealt = now.join(counts, "host").withColumn("bucket", F.when(F.col("n") <= group, 0).otherwise(F.pmod(F.xxhash64("expression"), F.ceil(F.col("n") / F.lit(group)))))
        now = materialize(dealt.select("host", "bucket", "expression").groupBy("host", "bucket").applyInArrow(one, "host string, expression string"))


def main_text(df: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row (page_id, url, text, n_chars) per row of df: the article of each page, its blocks joined by an empty line.

    A page's article is what its article or main element holds, without menus, headers (but the article's own, with its heading), footers,
    sidebars, notices, adverts, forms, scripts, styles and reader comments, which are known by their element or by a word of their class, id
    or role. Pages without such an element have the main region of their host's wrapper: the innermost part with most of the free text, and
    the title's; text that is the same on all of the host's pages (SAME or more), and lists of links, are none.

    Character references are decoded, and the white space in a block, line breaks included, is one space. Null and empty pages have an empty
    text. A null url, or one without a host, counts to the host without a name. Repeated rows and null ids give a row each; an empty table
    gives none; other columns are not looked at."""
    pages = materialize(blocks(df, id_col, url_col, html_col))
    shapes = materialize(pages.groupBy("host", "shape").agg(F.min("expression").alias("expression")))
    wrappers = materialize(host_wrappers(shapes))

    def place(rows: pa.RecordBatch) -> pa.RecordBatch:
        places = [placed(e, w) for e, w in zip(rows.column(2).to_pylist(), rows.column(3).to_pylist(), strict=True)]
        return batch(**{c: rows.column(c) for c in ("host", "shape", "expression", "wrapper")}, places=pa.array(places, pa.list_(pa.int32())))

    fitted = map_batches(shapes.join(wrappers, "host").select("host", "shape", "expression", "wrapper"), place, "host string, shape binary, expression string, wrapper string, places array<int>")
    fitted = materialize(fitted)

    # of each slot of the host: pages and blocks with it, whether its text is the same on all, its letters and those in links
    per_page = pages.select("host", "shape", F.explode("blocks").alias("b")).groupBy("host", "shape", "b.slot")
    text = F.xxhash64("b.text")
    per_shape = per_page.agg(F.count(F.lit(1)).alias("items"), F.min(text).alias("least"), F.max(text).alias("most"), F.sum(F.length("b.text")).alias("letters"), F.sum("b.links").alias("links"))
    times = pages.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("pages"))
    known = fitted.select("host", "shape", F.posexplode("places").alias("slot", "place"))
    per_slot = materialize(per_shape).join(known, ["host", "shape", "slot"]).join(materialize(times), ["host", "shape"]).groupBy("host", "place")
    per_slot = per_slot.agg(F.sum("pages").alias("pages"), F.sum("items").alias("items"), (F.min("least") == F.max("most")).alias("same"), F.sum("letters").alias("letters"), F.sum("links").alias("links"))
    stats = per_slot.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", "pages", "items", "same", "letters", "links"))).alias("stats"))

    def judge(rows: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for e, w, places, own in zip(*(rows.column(c).to_pylist() for c in ("expression", "wrapper", "places", "stats")), strict=True):
            table = json.dumps({s["place"]: [s["pages"], s["items"], s["same"], s["letters"], s["links"]] for s in own or ()})
            out.append(kept(e, w, table, places))
        return batch(host=rows.column("host"), shape=rows.column("shape"), kept=pa.array(out, pa.list_(pa.bool_())))

    judged = materialize(map_batches(fitted.join(materialize(stats), "host", "left").select("host", "shape", "expression", "wrapper", "places", "stats"), judge, "host string, shape binary, kept array<boolean>"))
    of = judged.select(F.col("host").alias("h"), F.col("shape").alias("s"), "kept")
    joined = pages.select("page_id", "url", "host", "shape", "blocks").join(of, (F.col("host") == F.col("h")) & (F.col("shape") == F.col("s")), "left")
    chosen = F.filter("blocks", lambda b: F.coalesce(F.get("kept", b["slot"]), F.lit(False)))
    out = joined.select("page_id", "url", F.array_join(F.transform(chosen, lambda b: b["text"]), "\n\n").alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read(spark, sf_dir, "pages"))
