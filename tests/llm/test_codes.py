"""Vector codes against a plain version in whole numbers, hard rows, and the bounds against all distances."""

import hashlib

import numpy as np
import pytest

from tickflow.llm import codes


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """(codes, errors, codebooks) of (id, ints), by comparing everything with everything."""
    rows = sorted(rows)
    x = np.array([v for _, v in rows], np.int64).reshape(len(rows), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def assign():
        d = ((x.transpose(1, 0, 2)[:, :, None, :] - books[:, None, :, :]) ** 2).sum(3)
        return d.argmin(2), d.min(2)

    for _ in range(rounds):
        own, _ = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[own[p] == e, p]
                if len(mine):
                    books[p, e] = [int(s) // len(mine) for s in mine.sum(0)]
    own, d = assign()
    return {k: own[:, i].tolist() for i, (k, _) in enumerate(rows)}, {k: int(d[:, i].sum()) for i, (k, _) in enumerate(rows)}, books


@pytest.fixture(scope="module")
def table(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet")


def test_query_against_a_plain_version(spark, sf, table):
    rows = {r.vec_id: (r.label, [int(np.floor(1024 * x)) for x in r.embedding]) for r in table.collect()}
    own, errors, books = plain_codes([(k, v) for k, (_, v) in rows.items()])
    got = codes.op13_vector_codes(spark, sf).collect()
    digest = hashlib.sha256(",".join(str(v) for v in books.ravel().tolist()).encode()).hexdigest()
    totals = {}
    for k, (label, _) in rows.items():
        totals[label] = totals.get(label, 0) + errors[k]
    assert {tuple(r) for r in got} == {(k, "".join(f"{e:02x}" for e in own[k]), errors[k], totals[rows[k][0]], digest) for k in rows} and len(got) == len(rows)


@pytest.mark.parametrize("near, many, spread", [(4, 40, 3), (2, 16, 40), (8, 9, 4000), (32, 256, 12)])
def test_bounds_change_nothing(near, many, spread):
    """Rounds of moving entries, with ties, equal entries and large components."""
    rng = np.random.default_rng(near)
    x = rng.integers(-spread, spread, (600, 4)) * (1 if near < 8 else 1 << 12)
    entries, before, state, have = x[:many].copy(), None, None, near
    for k in range(8):
        shifts = None if before is None else np.sqrt(((entries - before) ** 2).sum(1).astype(float)) * (1 + 1e-12)
        want = max(1, have - k // 3)
        own, nearest, bounds, error, need = codes.assigned(x, entries, state, shifts, want)
        d = ((x[:, None] - entries[None]) ** 2).sum(2)
        assert (own == d.argmin(1)).all() and (error == d.min(1)).all()
        root = np.sqrt(d)
        assert (bounds[:, :-1] <= np.take_along_axis(root, nearest.astype(int), 1) + (bounds[:, :-1] == np.inf)).all() or many <= near + 1
        others = root.copy()
        np.put_along_axis(others, own[:, None].astype(int), np.inf, 1)
        np.put_along_axis(others, nearest.astype(int), np.inf, 1)
        assert (bounds[:, -1] <= others.min(1)).all()
        state, have, before = (own, nearest, bounds), want, entries
        entries = np.array([x[own == e].sum(0) // max((own == e).sum(), 1) if (own == e).any() else entries[e] for e in range(many)])


def test_hard_rows(spark, table):
    v = lambda a, b: [float(a)] * 4 + [float(b)] * 4
    rows = [(1, v(0, 1), "x", 1), (1, v(0, 1), "x", 1), (2, None, "x", 2), (3, [*v(0, 1)[:-1], None], "x", 3), (4, [*v(0, 1)[:-1], float("nan")], "x", 4), (5, [*v(0, 1)[:-1], float("inf")], "x", 5), (None, v(0.25, 1), None, 6), (7, [1.0], "y", 7), (8, v(-0.0004, 1), None, 8), (9, [], "y", 9)]
    df = spark.createDataFrame(rows, "`vec id` long, `v.v` array<float>, own string, error int")
    names = {"id_col": "vec id", "vector_col": "v.v", "label_col": "own"}
    out, books = codes.vector_codes(df, entries=2, **names)
    got = sorted((r.id if r.id is not None else 99, r.label, r.own.hex(), r.error) for r in out.collect())
    # two equal entries: the lower number takes all, the other one stays; floor(1024 * -0.0004) is -1
    assert [r[0] for r in got] == [1, 1, 8, 99] and got[0] == got[1]
    assert books.shape == (4, 2, 2) and {r[2][:4] for r in got[:2]} == {"0101"} and got[2][2][:4] == "0101"
    few, small = codes.vector_codes(df.where("`vec id` = 8"), **names)
    assert [(r.id, r.own.hex(), r.error) for r in few.collect()] == [(8, "00000000", 0)] and small[0, 0, 0] == -1
    empty, none = codes.vector_codes(table.limit(0))
    assert empty.count() == 0 and none.size == 0
    with pytest.raises(Exception, match="or more"):
        codes.vector_codes(spark.createDataFrame([(1, [1e30] * 4, 0)], "vec_id long, embedding array<float>, label int"))[0].count()


def test_needs_are_met_with_fewer_bounds(spark, table):
    """The codes are the same whatever number of bounds is kept."""
    once = codes.vector_codes(table, near=64, entries=64)
    again = codes.vector_codes(table, near=1, entries=64)
    assert (once[1] == again[1]).all()
    assert {(r.id, bytes(r.own), r.error) for r in once[0].collect()} == {(r.id, bytes(r.own), r.error) for r in again[0].collect()}
