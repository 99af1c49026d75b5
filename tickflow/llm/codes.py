"""Vector codes: product quantization whose assignments keep adaptive lower bounds from round to round.

Every part of a vector has, beside its entry, the `near` closest other entries, each with a lower bound of its distance, in order, and one
outer bound for all the rest. When the entries move, a bound falls by its entry's shift, the outer bound by the largest shift. A part whose
exact distance is below its first bound stays without a look at any other entry; one below a later bound is compared with the entries before
that bound; only one beyond the outer bound is compared with all. Whatever is compared is compared in whole numbers, so bounds save work and
change no result. Each round counts how many bounds were needed, and the next one keeps so many.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.common import batch, column, drop_table, materialize, read

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Bounds that a part has in the first round and at least, and the share of the parts whose needs the next round has to meet.
NEAR, LEAST, SHARE = 32, 4, 0.995
#: Vectors that a worker holds distances of at a time.
ROWS = 2048
#: Components from here on, after scaling, are an error: squares would not fit into 64 bits.
LIMIT = 1 << 27
_EXACT = 1 << 22


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """All squared distances as whole numbers: rows of x by entries. Doubles hold them exactly unless components are large."""
    if max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)) < _EXACT // int(np.ceil(np.sqrt(x.shape[1]))):
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], 1)


def _below(distance: np.ndarray) -> np.ndarray:
    """Numbers of 32 bits that are no larger."""
    return np.nextafter((distance * (1 - 1e-12)).astype(np.float32), np.float32(-np.inf))


def _ranked(d: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From all squared distances: the entry, the closest others, and their bounds with the outer one."""
    own = d.argmin(1)
    rest = d.astype(np.float64)
    rest[np.arange(len(d)), own] = np.inf
    if near + 1 < rest.shape[1]:
        close = np.argpartition(rest, near, 1)[:, : near + 1]
    else:
        close = np.broadcast_to(np.arange(rest.shape[1]), rest.shape)
    far = np.take_along_axis(rest, close, 1)
    order = np.argsort(far, 1, kind="stable")
    close, far = np.take_along_axis(close, order, 1), np.take_along_axis(far, order, 1)
    bounds = np.full((len(d), near + 1), np.inf, np.float32)
    bounds[:, : min(near + 1, far.shape[1])] = _below(np.sqrt(far[:, : near + 1]))
    nearest = np.zeros((len(d), near), np.uint8)
    nearest[:, : min(near, close.shape[1])] = close[:, :near]
    return own.astype(np.uint8), nearest, bounds


def assigned(x: np.ndarray, entries: np.ndarray, state: tuple[np.ndarray, np.ndarray, np.ndarray] | None, shifts: np.ndarray | None, near: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(entry, closest others, bounds, squared distance, bounds needed) of one part of many vectors. state: what the last round returned,
    with the shifts of the entries since then."""
    if state is None:
        own, nearest, bounds = _ranked(d := squares(x, entries), near)
        return own, nearest, bounds, d[np.arange(len(x)), own], np.zeros(len(x), np.int64)
    own, nearest, bounds = (a.copy() for a in state)
    have = nearest.shape[1]
    moved = np.concatenate((shifts[nearest], np.full((len(x), 1), shifts.max())), 1)
    bounds = _below(np.maximum(bounds - moved, -1.0))
    error = ((x - entries[own]) ** 2).sum(1)
    sure = np.minimum.accumulate(bounds[:, ::-1], 1)[:, ::-1]  # what holds for an entry and for all after it
    need = (np.sqrt(error.astype(np.float64))[:, None] * (1 + 1e-12) >= sure).sum(1)
    some = np.flatnonzero((need > 0) & (need <= have))
    if len(some):
        most = int(need[some].max())
        ids = np.concatenate((own[some, None], nearest[some, :most]), 1)
        d = ((x[some, None, :] - entries[ids]) ** 2).sum(2)
        unseen = np.arange(-1, most)[None, :] >= need[some, None]
        order = np.lexsort((ids, np.where(unseen, np.iinfo(np.int64).max, d)), axis=1)
        ids, d, unseen = (np.take_along_axis(a, order, 1) for a in (ids, d, unseen))
        own[some], error[some] = ids[:, 0], d[:, 0]
        # those compared have their exact distances now; the others keep their place, as they are sorted last
        mine, low = nearest[some], bounds[some]
        mine[:, :most] = np.where(unseen[:, 1:], mine[:, :most], ids[:, 1:])
        low[:, :most] = np.where(unseen[:, 1:], low[:, :most], _below(np.sqrt(d[:, 1:].astype(np.float64))))
        nearest[some], bounds[some] = mine, low
    whole = np.flatnonzero(need > have)
    if len(whole):
        d = squares(x[whole], entries)
        own[whole], nearest[whole], bounds[whole] = _ranked(d, have)
        error[whole] = d[np.arange(len(whole)), own[whole]]
    if near < have:  # what is given up is under the outer bound from now on
        bounds = np.concatenate((bounds[:, :near], bounds[:, near:].min(1, keepdims=True)), 1)
        nearest = np.ascontiguousarray(nearest[:, :near])
    return own, nearest, bounds, error, need


def _rows(array: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(array.to_pylist()), kind).reshape(len(array), width)


def _packed(values: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(values)], pa.binary())


def _round(table: DataFrame, entries: np.ndarray, before: np.ndarray | None, have: int, near: int, last: bool) -> DataFrame:
    """The rows with their new state, and with them each task's sums by part and entry (n, sums) and counts of the bounds needed."""
    parts, many, width = entries.shape
    shifts = None if before is None else np.sqrt(((entries - before) ** 2).sum(2).astype(np.float64)) * (1 + 1e-12)
    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    schema = f"kind byte, id {kinds['id']}, label {kinds['label']}, vec binary, own binary, near binary, low binary, error long, part int, entry int, n long, sums array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, needs = np.zeros((parts, many), np.int64), np.zeros((parts, many, width), np.int64), np.zeros(have + 2, np.int64)
        types = None
        for whole in batches:
            types = whole.schema.field("id").type, whole.schema.field("label").type
            for at in range(0, whole.num_rows, ROWS):
                rows = whole.slice(at, ROWS)
                m = rows.num_rows
                x = _rows(rows.column("vec"), np.int32, parts * width).reshape(m, parts, width).astype(np.int64)
                if before is not None:
                    state = _rows(rows.column("own"), np.uint8, parts), _rows(rows.column("near"), np.uint8, parts * have).reshape(m, parts, have), _rows(rows.column("low"), np.float32, parts * (have + 1)).reshape(m, parts, have + 1)
                new = [assigned(x[:, p], entries[p], None if before is None else tuple(s[:, p] for s in state), None if before is None else shifts[p], near) for p in range(parts)]
                own, nearest, low, error, need = (np.stack([n[k] for n in new], 1) for k in range(5))
                needs += np.bincount(need.ravel(), minlength=have + 2)
                if not last:
                    for p in range(parts):
                        counts[p] += np.bincount(own[:, p], minlength=many)
                        np.add.at(sums[p], own[:, p], x[:, p])
                none = pa.nulls(m, pa.binary())
                yield batch(kind=pa.array(np.zeros(m, np.int8)), id=rows.column("id"), label=rows.column("label"), vec=none if last else rows.column("vec"), own=_packed(own), near=none if last else _packed(nearest), low=none if last else _packed(low), error=pa.array(error.sum(1)), part=pa.nulls(m, pa.int32()), entry=pa.nulls(m, pa.int32()), n=pa.nulls(m, pa.int64()), sums=pa.nulls(m, pa.list_(pa.int64())))
        if types is None:
            return
        p, e = np.nonzero(counts)
        used = np.flatnonzero(needs)
        m = len(p) + len(used)
        lists = [*sums[p, e].tolist(), *[None] * len(used)]
        yield batch(kind=pa.array(np.repeat([1, 2], [len(p), len(used)]).astype(np.int8)), id=pa.nulls(m, types[0]), label=pa.nulls(m, types[1]), **{c: pa.nulls(m, pa.binary()) for c in ("vec", "own", "near", "low")}, error=pa.nulls(m, pa.int64()), part=pa.array(np.concatenate((p, np.zeros(len(used)))).astype(np.int32)), entry=pa.array(np.concatenate((e, used)).astype(np.int32)), n=pa.array(np.concatenate((counts[p, e], needs[used]))), sums=pa.array(lists, pa.list_(pa.int64())))

    columns = ["id", "label", "vec", *([] if before is None else ["own", "near", "low"])]
    return materialize(table.select(*columns).mapInArrow(run, schema))


def _moved(table: DataFrame, entries: np.ndarray) -> np.ndarray:
    """The floor of each entry's mean; unused entries stay. At most one row for each part and entry comes to the driver."""
    width = entries.shape[2]
    totals = table.where("kind = 1").groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(width)])
    out = entries.copy()
    for r in totals.collect():
        out[r.part, r.entry] = [r[f"s{k}"] // r.n for k in range(width)]
    return out


def _needed(table: DataFrame, have: int) -> int:
    """The bounds that SHARE of the parts did with, LEAST or more, and at most as many as they have."""
    counts = {r.entry: r.n for r in table.where("kind = 2").groupBy("entry").agg(F.sum("n").alias("n")).collect()}
    met, enough = 0, 0
    for need in sorted(counts):
        if met < SHARE * sum(counts.values()):
            enough = need
        met += counts[need]
    return min(have, max(LEAST, enough))


def scaled(df: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, vec array<long>) of the rows whose vector is whole: no null, no infinite and no undefined component."""
    vec, whole = column(df, vector_col), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))
    kept = df.select(column(df, id_col).alias("id"), column(df, label_col).alias("label"), vec.cast("array<double>").alias("vec")).where(F.coalesce(F.forall("vec", whole), F.lit(False)))
    return kept.select("id", "label", F.transform("vec", lambda x: F.floor(x * scale).cast("long")).alias("vec"))


def vector_codes(df: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, near: int = NEAR, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """One row (id, label, own binary, error) per whole vector of df, and the codebooks as parts x entries x components.

    A component x is floor(scale * x). The codebooks begin as the parts of the vectors of the `entries` smallest ids (of equal ids, the
    smaller vectors; fewer rows give fewer entries); each round assigns every part to the nearest entry of its codebook (squared Euclidean
    distance in whole numbers, ties to the lower number) and moves every entry to the floor of its parts' mean; then parts are assigned
    again. own has a byte for each part, error the sum of its parts' squared distances.

    Rows without a whole vector have no code, nor have vectors of another length than that of the smallest id, which `parts` has to divide.
    Rows with a null id have a code, but come last in the codebook's choice. Repeated rows each count. An empty table gives no rows and an
    empty codebook. Scaled components of LIMIT or more are an error."""
    if not 1 <= entries <= 256:
        raise ValueError("a byte holds the number of an entry: entries has to be from 1 to 256")
    spark = df.sparkSession
    kept = scaled(df, scale, id_col, vector_col, label_col)
    seeds = kept.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()
    size = len(seeds[0].vec) if seeds else 0
    seeds = [r.vec for r in seeds if len(r.vec) == size]
    if not size:
        return kept.select("id", "label", F.lit(None).cast("binary").alias("own"), F.lit(None).cast("long").alias("error")).where("false"), np.zeros((parts, 0, 0), np.int64)
    if size % parts:
        raise ValueError(f"vectors of {size} components have no {parts} equal parts")
    books = np.array(seeds, np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2).copy()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            x = rows.column("vec").flatten().to_numpy().reshape(rows.num_rows, size)
            if np.abs(x).max(initial=0) >= LIMIT:
                raise ValueError(f"a scaled component of {LIMIT} or more")
            yield batch(id=rows.column("id"), label=rows.column("label"), vec=_packed(x.astype(np.int32)))

    kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    table = kept.where(F.size("vec") == size).mapInArrow(pack, f"id {kinds['id']}, label {kinds['label']}, vec binary")
    before, have = None, min(near, len(seeds))
    want = have
    for k in range(rounds + 1):
        new = _round(table, books, before, have, want, last=k == rounds)
        if k:
            drop_table(table)
        table, have = new.where("kind = 0"), want
        if k < rounds:
            before, books = books, _moved(new, books)
            want = _needed(new, have) if k else have
    return table.select("id", "label", "own", "error"), books


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = vector_codes(read(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    totals = materialize(out.groupBy("label").agg(F.sum("error").alias("label_error"))).select(F.col("label").alias("of"), "label_error")
    named = out.join(totals, F.col("label").eqNullSafe(F.col("of")))
    return named.select(F.col("id").alias("vec_id"), F.lower(F.hex("own")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
