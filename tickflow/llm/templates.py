"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question whose values were exchanged keeps its template. Windows of template
tokens are joined by hash; along each alignment of document and item, the exchanged values then have to be exchanged consistently.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.common import batch, column, map_batches, materialize, read

WINDOW, COVERAGE = 8, 0.5
#: A window of which a smaller share is no placeholder is looked for with its values instead of placeholders.
LITERAL = 0.5
#: The shortest window of items that have WINDOW words or more.
LEAST = 5
#: Up to so many item windows (8 bytes each) go to the executors, to leave out other windows before the join.
MAX_SENT = 1 << 22
#: Units of measure, money and time (fixed values).
UNITS = frozenset(
    "% percent ° °c °f k mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
    "mg g kg t oz lb lbs gram grams kilogram kilograms ton tons tonne tonnes ounce ounces pound pounds ml cl l gal liter liters litre litres gallon gallons "
    "ms s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years "
    "hz khz mhz ghz w kw mw kwh v a j kj cal kcal pa kpa mph kph b kb mb gb tb $ € £ ¥ usd eur gbp dollar dollars euro euros cent cents".split()
)
_NUMBER = re.compile(r"[+-]?[$€£¥]?\d[\d.,:/]*(?:st|nd|rd|th)?$")
_EDGE = re.compile(r"^[^\w$€£¥%°+-]+|[^\w%°]+$")
_GLUED = re.compile(r"(?<=\d)(?=[^\W\d_]|[%°€£])")
_STOP = re.compile(r"[.!?:…][\"'”’)\]]*$")
_LITERAL, _NUM, _UNIT, _NAME = range(4)
_PLACE = ("", "\0number", "\0unit", "\0name")
_MEMO = 1 << 20


def classify(word: str, starts: bool) -> tuple[int, str]:
    """The kind and the bare lower-case form of a word; starts: it begins a sentence, where a capital makes no unit of it. Any word of two
    letters or more with a capital is a name, wherever it stands: 'The' is then a value that has to be exchanged like any other."""
    bare = _EDGE.sub("", word)
    low = bare.lower()
    if _NUMBER.match(low):
        return _NUM, low
    if low in UNITS and not (starts and bare != low):
        return _UNIT, low
    if len(bare) > 1 and bare != low:
        return _NAME, low
    return _LITERAL, low


class Canonical:
    """Template tokens of texts. A worker remembers what its words are; the memo is emptied when full."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.hashes = np.zeros((2, _MEMO), np.uint64)
        self.plain = np.zeros(_MEMO, np.uint64)
        self.kinds = np.zeros((2, _MEMO), np.int8)
        self.empty, self.stops = np.zeros(_MEMO, bool), np.zeros(_MEMO, bool)

    def _new(self, word: str) -> int:
        k = self.place[word] = len(self.place)
        bare = word if word.isalpha() else word[:-1]
        if bare.isalpha() and bare.islower() and (bare is word or word[-1] in ".,;:!?"):  # what most words are: the same at both places
            self.kinds[:, k] = kind = _UNIT if bare in UNITS else _LITERAL
            self.hashes[:, k] = xxhash.xxh64_intdigest(_PLACE[kind] or bare, 3)
            self.plain[k] = self.hashes[0, k] if kind == _LITERAL else xxhash.xxh64_intdigest(bare, 3)
            self.empty[k], self.stops[k] = False, bare is not word and word[-1] in ".:!?"
            return k
        for starts in (0, 1):
            kind, bare = classify(word, bool(starts))
            self.kinds[starts, k] = kind
            self.hashes[starts, k] = xxhash.xxh64_intdigest(_PLACE[kind] or bare, 3)
        self.plain[k] = xxhash.xxh64_intdigest(bare, 3)
        self.empty[k], self.stops[k] = not bare, bool(_STOP.search(word))
        return k

    def __call__(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The words of the texts that have letters or digits, one text after the other, their tokens' hashes, their kinds, the words' own
        hashes, and which text each is of."""
        words, begins, counts = [], [], []
        for text in texts:
            if any(c in text for c in "0123456789"):
                text = _GLUED.sub(" ", text)
            before = len(words)
            for line in text.split("\n"):
                begins.append(len(words))
                words += line.split()
            counts.append(len(words) - before)
        text_of = np.repeat(np.arange(len(texts)), counts)
        if len(words) <= _MEMO // 2:
            found = self._part(words, 0, begins)
        else:  # one very long text: what it has is found part by part
            parts = [self._part(words[a : a + _MEMO // 2], a, begins) for a in range(0, len(words), _MEMO // 2)]
            found = tuple(np.concatenate(x) for x in zip(*parts, strict=True))
        keep, tokens, kinds, plain = found
        if not keep.all():
            words, tokens, kinds, plain, text_of = [w for w, x in zip(words, keep.tolist(), strict=True) if x], tokens[keep], kinds[keep], plain[keep], text_of[keep]
        return words, tokens, kinds, plain, text_of

    def _part(self, words: list[str], at: int, begins: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if len(self.place) + len(words) > _MEMO:
            self.place.clear()
        get, new = self.place.get, self._new
        k = np.fromiter((new(w) if (i := get(w)) is None else i for w in words), np.int64, len(words))
        starts = np.zeros(len(words) + 1, np.int64)
        starts[1:] = self.stops[k]
        b = np.array(begins) - at
        starts[b[(b >= 0) & (b < len(words))]] = 1
        starts = starts[:-1]
        return ~self.empty[k], self.hashes[starts, k], self.kinds[starts, k], self.plain[k]


def _mixed(tokens: np.ndarray, sizes: list[int], seed: int) -> Iterator[tuple[int, np.ndarray]]:
    """The hashes of all windows of each size: a longer window's goes on from a shorter one's."""
    h = np.full(len(tokens), seed, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(sizes[-1]):
            h = (h[: len(tokens) - j] ^ tokens[j:]) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            if j + 1 in sizes:
                yield j + 1, h


def windows(tokens: np.ndarray, kinds: np.ndarray, plain: np.ndarray, text_of: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each size (ascending): the first words of the windows that lie in one text, their hashes, and whether enough of each is literal.
    Other windows' hashes are of the words as they are."""
    held = np.concatenate(([0], np.cumsum(kinds == _LITERAL)))
    sizes = [s for s in sizes if 0 < s <= len(tokens)]
    if not sizes:
        return
    for (size, h), (_, own) in zip(_mixed(tokens, sizes, 0x9E3779B97F4A7C15 >> 8), _mixed(plain, sizes, 0xC2B2AE3D27D4EB4F >> 8), strict=True):
        rich = held[size:] - held[:-size] >= LITERAL * size
        at = np.flatnonzero(text_of[: len(h)] == text_of[size - 1 :])
        yield size, at, np.where(rich, h, own)[at], rich[at]


def window_of(n: int, window: int) -> int:
    """The window of an item of n words: about a third of a short item's, so that a changed word leaves half of the windows."""
    return min(window, n) if n <= window else max(min(window, (n + 1) // 3), min(window, LEAST))


_canonical: list[Canonical] = []
#: Letters of texts that are looked at together.
_LETTERS = 1 << 20


class Known:
    """A set of hashes, for asking which of many are in it: a bit table settles most, a sorted array the rest."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.mask = np.uint64((1 << max(20, int(len(self.sorted)).bit_length() + 3)) - 1)
        self.bits = np.zeros(int(self.mask) + 1, bool)
        self.bits[self.sorted & self.mask] = True

    def where(self, h: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.bits[h & self.mask])
        if not len(at):
            return at
        near = np.minimum(np.searchsorted(self.sorted, h[at]), len(self.sorted) - 1)
        return at[self.sorted[near] == h[at]]


_known: dict[str, Known] = {}


def _known_of(name: str, sent: Broadcast) -> Known:
    """What a broadcast holds, made once per worker."""
    if name not in _known:
        _known.clear()
        _known[name] = Known(sent.value)
    return _known[name]


def _together(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts): neighbours of up to _LETTERS letters in all, or one longer text."""
    first, held, size = 0, [], 0
    for k, text in enumerate(texts):
        if held and size + len(text) > _LETTERS:
            yield first, held
            first, held, size = k, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def _slots(words: list[str], kinds: np.ndarray, at: int, size: int) -> list[str]:
    return [_EDGE.sub("", words[at + j]).lower() for j in np.flatnonzero(kinds[at : at + size]).tolist()]


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, size, pos, of, rich, riches, h, slots) of all windows of each item, whose size is what window_of() says. rich: the hash is
    of placeholders. of, riches: how many windows, and rich ones, the item has."""

    def look(rows: pa.RecordBatch) -> pa.RecordBatch:
        if not _canonical:
            _canonical.append(Canonical())
        which, out, slots = [], [[] for _ in range(6)], []
        for k, text in enumerate(rows.column(1).to_pylist()):
            words, tokens, kinds, plain, text_of = _canonical[0]([text or ""])
            for size, at, h, rich in windows(tokens, kinds, plain, text_of, [window_of(len(words), window)]):
                which += [k] * len(at)
                for o, v in zip(out, (np.full(len(at), size), at, np.full(len(at), len(at)), rich, np.full(len(at), rich.sum()), h.view(np.int64)), strict=True):
                    o += v.tolist()
                slots += [_slots(words, kinds, p, size) for p in at.tolist()]
        return batch(item_id=rows.column(0).take(pa.array(which, pa.int64())), size=pa.array(out[0], pa.int32()), pos=pa.array(out[1], pa.int64()), of=pa.array(out[2], pa.int64()), rich=pa.array(out[3], pa.bool_()), riches=pa.array(out[4], pa.int64()), h=pa.array(out[5], pa.int64()), slots=pa.array(slots, pa.list_(pa.string())))

    kind = items.schema["item_id"].dataType.simpleString()
    return map_batches(items, look, f"item_id {kind}, size int, pos long, of long, rich boolean, riches long, h long, slots array<string>")


def _text_windows(docs: DataFrame, sizes: list[int], only: np.ndarray | None) -> DataFrame:
    """(doc_id, size, pos, h, slots) of the windows of each text: all, or those whose hash is in `only`."""
    sent, name = (docs.sparkSession.sparkContext.broadcast(only), uuid.uuid4().hex) if only is not None else (None, "")

    def look(rows: pa.RecordBatch) -> pa.RecordBatch:
        if not _canonical:
            _canonical.append(Canonical())
        which, out, slots = [], [[] for _ in range(3)], []
        for first, texts in _together([t or "" for t in rows.column(1).to_pylist()]):
            words, tokens, kinds, plain, text_of = _canonical[0](texts)
            begin = np.searchsorted(text_of, np.arange(len(texts)))
            for size, at, h, _ in windows(tokens, kinds, plain, text_of, sizes):
                if sent is not None:
                    hit = _known_of(name, sent).where(h)
                    at, h = at[hit], h[hit]
                which += (first + text_of[at]).tolist()
                for o, v in zip(out, (np.full(len(at), size), at - begin[text_of[at]], h.view(np.int64)), strict=True):
                    o += v.tolist()
                slots += [_slots(words, kinds, p, size) for p in at.tolist()]
        return batch(doc_id=rows.column(0).take(pa.array(which, pa.int64())), size=pa.array(out[0], pa.int32()), pos=pa.array(out[1], pa.int64()), h=pa.array(out[2], pa.int64()), slots=pa.array(slots, pa.list_(pa.string())))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, look, f"doc_id {kind}, size int, pos long, h long, slots array<string>")


def contaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_sent: int = MAX_SENT) -> DataFrame:
    """One row (doc_id, item_id, coverage, matched, exact) per document and benchmark item whose template windows it holds.

    coverage: the share of the item's windows that the document has with the item's values, whatever is around them, or along alignments
    whose values are exchanged consistently (equal values of the item by equal values). Windows of which over half is placeholders count
    only with the item's values; where leaving them out gives a larger share, that is the coverage. Rows have at least `coverage`.
    matched: how many windows the document has. exact: no value is exchanged. Items of up to `window` words are one window, and those of
    under three windows have shorter ones. Null and empty texts, and null ids, match nothing; repeated rows of a document or an item count once; an empty
    table on either side gives no rows. Whole texts are read; only the ids and texts are. Item windows up to max_sent are sent to the
    executors to thin the documents' windows before the join; more are joined as they are, with the same result."""
    left = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).cast("string").alias("text")).where("doc_id is not null")
    right = benchmark.select(column(benchmark, item_col).alias("item_id"), column(benchmark, item_text_col).cast("string").alias("text")).where("item_id is not null")
    items = materialize(_item_windows(right, window).distinct())
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())
    hashes = items.select("h").distinct()
    only = None
    if (n := hashes.count()) <= max_sent:
        only = hashes.toArrow().column(0).to_numpy().view(np.uint64)
    if not n:
        sizes = [window]
    found = _text_windows(left, sizes, only).distinct()
    met = found.join(items.select("item_id", "size", F.col("pos").alias("item_pos"), "of", "rich", "riches", "h", F.col("slots").alias("item_slots")), ["size", "h"])
    met = materialize(met.withColumn("shift", F.col("pos") - F.col("item_pos")))
    line = ["doc_id", "item_id", "shift"]
    values = met.select(*line, F.explode(F.arrays_zip("item_slots", "slots")).alias("v")).groupBy(*line, "v.item_slots").agg(F.min("v.slots").alias("a"), F.max("v.slots").alias("b"))
    values = values.groupBy(*line).agg(F.bool_or(F.col("a") != F.col("b")).alias("torn"), F.bool_or((F.col("a") != F.col("item_slots")) | (F.col("b") != F.col("item_slots"))).alias("changed"))
    good = met.join(values, line, "left").where("slots = item_slots or (rich and not coalesce(torn, false))")
    out = good.groupBy("doc_id", "item_id").agg(F.count_distinct("item_pos").alias("matched"), F.count_distinct(F.when(F.col("rich"), F.col("item_pos"))).alias("_rich"), F.max("of").alias("of"), F.max("riches").alias("_riches"), F.bool_and(~F.coalesce("changed", F.lit(False))).alias("exact"))
    return out.withColumn("coverage", F.greatest(F.col("matched") / F.col("of"), F.col("_rich") / F.nullif(F.col("_riches"), F.lit(0)))).where(F.col("coverage") >= coverage).select("doc_id", "item_id", "coverage", "matched", "exact")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of docs, with their columns, that hold no benchmark item."""
    bad = contaminated(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, column(docs, id_col) == F.col("__bad"), "left_anti")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
