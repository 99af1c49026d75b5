"""URL filter: a trie over reversed host labels, then path segments, with the longest match deciding between allow and block."""

from __future__ import annotations

import string
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.common import batch, column, map_batches, read

ALLOW, BLOCK = "allow", "block"
#: (verdict, rule); a rule is a host and a path prefix, as in a url.
RULES = ((ALLOW, "com/"), (BLOCK, "example.com/en/"), (ALLOW, "www.example.com/en/"), (BLOCK, "net/es/"), (BLOCK, "net/fr/"))
#: The trie goes to every executor only while its rules are at most so many bytes; longer lists are joined.
MAX_TRIE_BYTES = 32 << 20


def split_rule(rule: str) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; a rule without a slash has the empty path, which every url starts with."""
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)), slash + path


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


class Node:
    """A trie node. below: by host label or whole path segment; paths: where the path part of this host begins; tails: what the
    next segment has to start with, longest first, and the rule that then fits."""

    __slots__ = ("below", "paths", "tails")

    def __init__(self):
        self.below: dict[str, Node] = {}
        self.paths: Node | None = None
        self.tails: list[tuple[str, int]] = []


def build_trie(rules: Sequence[tuple[str, str]]) -> Node:
    """Of rules for one host and path the first stands."""
    root, seen = Node(), set()
    for k, (_, rule) in enumerate(rules):
        host, path = split_rule(rule)
        if (host, path) in seen:
            continue
        seen.add((host, path))
        node = root
        for label in reversed(host.split(".")):
            node = node.below.setdefault(label, Node())
        node.paths = node.paths or Node()
        node = node.paths
        *whole, tail = path.split("/")
        for segment in whole:
            node = node.below.setdefault(segment, Node())
        node.tails = sorted([*node.tails, (tail, k)], key=lambda x: -len(x[0]))
    return root


def longest(root: Node, host: str, path: str) -> int:
    """The number of the rule with most host labels, then the longest path; -1 if none fits."""
    found, node = -1, root
    for label in reversed(host.split(".")):
        node = node.below.get(label)
        if node is None:
            break
        if node.paths is None:
            continue
        at = node.paths
        for segment in path.split("/"):
            found = next((k for tail, k in at.tails if segment.startswith(tail)), found)
            at = at.below.get(segment)
            if at is None:
                break
    return found


def _by_trie(urls: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    trie = urls.sparkSession.sparkContext.broadcast(rules)
    kept: list[Node] = []

    def look(rows: pa.RecordBatch) -> pa.RecordBatch:
        if not kept:
            kept.append(build_trie(trie.value))
        hit = [longest(kept[0], h, p) for h, p in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True)]
        return batch(page_id=rows.column(0), host=rows.column(1), path=rows.column(2), k=pa.array(hit, pa.int32()))

    kind = urls.schema["page_id"].dataType.simpleString()
    out = map_batches(urls, look, f"page_id {kind}, host string, path string, k int")
    verdicts, names = (F.array(*[F.lit(x[i]) for x in rules]) if rules else F.array().cast("array<string>") for i in (0, 1))
    return out.select("page_id", "host", "path", F.get(names, F.col("k")).alias("rule"), F.get(verdicts, F.col("k")).alias("found"))


def _by_join(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by equi-joins, for rule lists too long to broadcast: each distinct host and path meets the rules of its host suffixes."""
    parts = rules.select("verdict", "rule", F.translate(F.substring_index("rule", "/", 1), string.ascii_uppercase, string.ascii_lowercase).alias("rule_host"), F.regexp_extract("rule", "(?s)^[^/]*(/.*)?$", 1).alias("rule_path"), "k")
    parts = parts.withColumn("stem", F.regexp_extract("rule_path", "(?s)^(.*/)?[^/]*$", 1))
    labels = F.split("host", r"\.")
    steps = F.split("path", "/")
    sites = urls.select("host", "path").distinct()
    keys = sites.withColumn("rule_host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))))
    keys = keys.withColumn("stem", F.explode(F.transform(F.sequence(F.lit(0), F.size(steps) - 1), lambda i: F.concat(F.array_join(F.slice(steps, F.lit(1), i), "/"), F.when(i > 0, "/").otherwise("")))))
    hits = keys.join(parts, ["rule_host", "stem"]).where(F.col("path").startswith(F.col("rule_path")))
    rank = F.struct(F.size(F.split("rule_host", r"\.")).alias("n"), F.length("rule_path").alias("p"), (-F.col("k")).alias("k"))
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), rank).alias("hit"))
    return urls.join(best, ["host", "path"], "left").select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.col("hit.verdict").alias("found"))


def filter_urls(df: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame = RULES, *, id_col: str = "page_id", url_col: str = "url", default: str = ALLOW, max_trie_bytes: int = MAX_TRIE_BYTES) -> DataFrame:
    """One row (page_id, host, path, rule, verdict) per row of df; rule is null where no rule fits, and the verdict then is default.

    rules: (verdict, rule) pairs, or a DataFrame with these two columns. Of the rules that fit, the one with most host labels wins, then
    the one with the longest path; a rule that is both allow and block allows; rows of rules with a null are no rules. A null url, or one
    without "://", has an empty host and path and is judged like any other. Repeated rows each give a row, an empty table gives none, null
    ids stay null; other columns of df are not looked at. Only df's url and id are read. Lists over max_trie_bytes are joined instead of
    broadcast, with the same result."""
    urls = df.select(column(df, id_col).alias("page_id"), host_of(column(df, url_col)).alias("host"), path_of(column(df, url_col)).alias("path"))
    if isinstance(rules, DataFrame):
        rules = rules.dropna(subset=["verdict", "rule"])
        size = rules.agg(F.sum(F.octet_length("rule") + F.octet_length("verdict"))).first()[0] or 0
        if size <= max_trie_bytes:
            rules = [(r.verdict, r.rule) for r in rules.collect()]
    else:
        size = sum(len(v.encode()) + len(r.encode()) for v, r in rules)
    if size <= max_trie_bytes:
        out = _by_trie(urls, sorted(rules, key=lambda x: (x[1], x[0])))
    else:
        if not isinstance(rules, DataFrame):
            rules = df.sparkSession.createDataFrame(list(rules), "verdict string, rule string")
        out = _by_join(urls, rules.groupBy("rule").agg(F.min("verdict").alias("verdict")).withColumn("k", F.lit(0)))
    return out.select("page_id", "host", "path", "rule", F.coalesce("found", F.lit(default)).alias("verdict"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"))


OP1_SQL = r"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), r(rule, rule_host, rule_path, verdict) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'), ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
         ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
)
SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, coalesce(arg_max(verdict, length(rule)), 'allow') AS verdict
FROM u LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY page_id, host, path
"""
