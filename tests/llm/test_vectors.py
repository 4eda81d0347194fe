"""Both vector searches against all pairs of vectors."""

import numpy as np
import pytest
from pyspark.sql import types as T

from tidemark.llm import adscan, balltree
from tidemark.llm.vectors import Top

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("score", T.IntegerType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def good(rows, zero):
    out = {(i, tuple(np.float32(x) for x in v)) for i, v in rows
           if i is not None and v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all()}
    return sorted((i, v) for i, v in out if zero or any(v))


def exact(rows, measure, k=5, zero=True):
    rows = good(rows, zero)
    out = {}
    for q, v in rows:
        if q % 50 == 0:
            found = sorted(((-measure(np.array(v, float), np.array(u, float)), i) for i, u in rows if i != q))[:k]
            out.setdefault(q, []).append([(i, -s) for s, i in found])
    return out


def inner(a, b):
    return int((np.floor(256 * a).astype(int) * np.floor(256 * b).astype(int)).sum())


def cosine(a, b):
    return float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)))


def results(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def cloud(n, seed=1, d=16):
    rng = np.random.RandomState(seed)
    centres = rng.normal(size=(8, d))
    return [(i, (centres[rng.randint(8)] + 0.4 * rng.normal(size=d)).astype(np.float32).tolist()) for i in range(n)]


def test_ball_tree_is_exact_over_shards(spark):
    rows = cloud(1200)
    rows += [(2000 + i, rows[3][1]) for i in range(300)]  # a large group of copies, some of them queries
    got = results(balltree.search(frame(spark, rows), shard_rows=100, block_rows=7))
    want = exact(rows, inner)
    assert got == {q: v[0] for q, v in want.items()}


def test_bounds_save_work_and_lose_nothing():
    rng = np.random.RandomState(2)
    x = np.floor(256 * (rng.normal(size=(2000, 8)) + 6 * rng.normal(size=(20, 8))[rng.randint(20, size=2000)])).astype(np.int64)
    order, *tree = balltree.build(x.astype(float))
    q = x[:40]
    top = Top(40, 5, kind=np.int64)
    scored = balltree.walk(q, top, tree, x[order], order)
    s = q @ x.T
    assert np.array_equal(top.score, -np.sort(-s, axis=1)[:, :5]) and scored < 0.5 * s.size


def test_products_beyond_doubles_are_exact():
    a = np.array([[2**30 + 1, 3]])
    assert balltree.products(a, a)[0, 0] == (2**30 + 1) ** 2 + 9
    b = np.array([[2**40 + 1, -(2**40)], [2**40, 2**40]])
    assert balltree.products(b, b[:1])[:, 0].tolist() == [balltree.HIGH, 2**40]
    assert balltree.products(-b[1:], b[1:]).tolist() == [[balltree.LOW]]


DOUBLES = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def test_integer_scores_beyond_doubles(spark):
    """Scores that differ in their last digits above 2**53 keep their values and their order."""
    rows = [(0, [2.0**20 + 1 / 256, 2.0**20 + 3 / 256])] + [(i, [2.0**20 + (1 + i % 5) / 256, 2.0**20 + (3 + i % 3) / 256]) for i in range(1, 40)]
    got = results(balltree.search(spark.createDataFrame(rows, DOUBLES), shard_rows=7))
    whole = {i: [int(256 * x) for x in v] for i, v in rows}
    want = sorted(((-sum(a * b for a, b in zip(whole[0], v)), i) for i, v in whole.items() if i))[:5]
    assert got == {0: [(i, -s) for s, i in want]}
    assert got[0][0][1] > 2**53


def test_saturating_scores(spark):
    """Beyond long a score is the largest or least long, and ranks as that, ties to the smaller id."""
    rows = [(0, [1e15, 1.0])] + [(i, [(-1) ** i * 1e15, float(i)]) for i in range(1, 20)] + [(20, [1.0, 1.0])]
    got = results(balltree.search(spark.createDataFrame(rows, DOUBLES), k=19, shard_rows=4))[0]
    assert [i for i, _ in got] == [*range(2, 20, 2), 20, *range(1, 18, 2)]
    assert got[0][1] == balltree.HIGH and got[-1][1] == balltree.LOW


SIZES = [1e-200, 1e200, 1e-320, 1e308, 1.0, 3e-160]


def test_cosine_of_extreme_components(spark):
    """Squares of components under- or overflow; the cosine doesn't."""
    base = [(1.0, 2.0), (1.0, 1.0), (-1.0, 0.5), (2.0, 0.0), (0.25, 0.5), (1.0, -1.0)]
    rows = [(50 * i, [0.5 * x * SIZES[i], 0.5 * y * SIZES[i]]) for i, (x, y) in enumerate(base)]
    got = results(adscan.search(spark.createDataFrame(rows, DOUBLES)))
    assert len(got) == 6 and all(len(v) == 5 for v in got.values())
    for q, found in got.items():
        for i, s in found:
            a, b = np.array(base[q // 50]), np.array(base[i // 50])
            assert s == pytest.approx(cosine(a, b), abs=1e-3 if 100 in (q, i) else 1e-12)


def test_adaptive_scan_finds_the_nearest(spark):
    rows = cloud(3000, 3)
    rows += [(5000 + i, rows[7][1]) for i in range(400)]
    got = results(adscan.search(frame(spark, rows), list_block=64, query_block=16))
    want = exact(rows, cosine)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q][0]}) for q in want)
    assert hits >= 0.9 * sum(len(v[0]) for v in want.values())
    vectors = {i: np.array(v, float) for i, v in good(rows, False)}
    for q, found in got.items():
        for i, s in found:
            assert s == pytest.approx(cosine(vectors[q], vectors[i]), abs=1e-12)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_copies_come_in_order_of_their_ids(spark):
    rows = [(i, [1.0, 2.0, 2.0]) for i in range(0, 120)] + [(500, [2.0, 4.0, 4.5])]
    got = results(adscan.search(frame(spark, rows)))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[50]] == [0, 1, 2, 3, 4]
    assert results(balltree.search(frame(spark, rows)))[100] == [(500, inner(np.array([1., 2, 2]), np.array([2., 4, 4.5])))] + [
        (i, 9 * 65536) for i in range(4)]


def test_abandoning_reads_less(spark):
    rng = np.random.RandomState(4)
    d = 64
    turn = adscan.rotation(d, 1)
    assert np.allclose(turn @ turn.T, np.eye(d))
    x = adscan.unit(rng.normal(size=(2000, d)) + 3 * rng.normal(size=(10, d))[rng.randint(10, size=2000)])
    q = x[:20]
    s = q @ x.T
    top = Top(20, 6, -np.sort(-s, axis=1)[:, 5] - 1e-9)  # the k-th scores are known from elsewhere
    read = adscan.scan_block(q @ turn, q, x @ turn, x, np.arange(2000), top, 2.1)
    assert read < 0.6 * s.size * d and np.allclose(top.score, -np.sort(-s, axis=1)[:, :6], atol=1e-6)


BAD = [(None, [1.0, 1.0]), (50, None), (51, [1.0, None]), (52, [float("nan"), 1.0]), (53, [float("inf"), 1.0]), (54, []), (55, [1.0, 2.0, 3.0]),
       (100, [0.0, 0.0]), (0, [0.6, 0.8]), (0, [0.6, 0.8]), (1, [0.8, 0.6]), (2, [-1.0, 0.001])]


def test_rows_that_take_no_part(spark):
    got = results(adscan.search(frame(spark, BAD)))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [1, 2]}
    usable = [r for r in BAD if r[1] is None or len(r[1]) != 3]
    assert results(balltree.search(frame(spark, BAD))) == {q: v[0] for q, v in exact(usable, inner).items()}


@pytest.mark.parametrize("search", [adscan.search, balltree.search])
def test_nothing_to_search(spark, search):
    assert search(frame(spark, [])).count() == 0
    assert search(frame(spark, [(50, None)])).count() == 0
    assert search(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no query
    assert search(frame(spark, [(50, [1.0, 2.0])])).count() == 0                  # no other row
