"""The adaptive scan: what the driver holds, and what is sent, written and scored."""

import os
import tracemalloc

import numpy as np
import pytest
from pyarrow import parquet
from pyspark.sql import functions as F
from tests.llm.test_vectors import cloud, frame, results

from tidemark.llm import adscan, common, vectors
from tidemark.llm.vectors import Top


def test_the_sample_is_not_fitted_in_the_driver(spark, monkeypatch):
    rows = frame(spark, cloud(400))
    want = results(adscan.search(rows))

    driver = os.getpid()

    def elsewhere(fn):
        def run(*args, **kwargs):
            assert os.getpid() != driver
            return fn(*args, **kwargs)
        return run

    for name in ("unit", "fit_centroids", "lists_needed", "enough_lists"):
        monkeypatch.setattr(adscan, name, elsewhere(getattr(adscan, name)))
    assert results(adscan.search(rows)) == want


def test_fitting_takes_bounded_memory():
    x = adscan.unit(np.random.RandomState(1).normal(size=(20_000, 8)))
    tracemalloc.start()
    try:
        centroids = adscan.fit_centroids(x, 2500, 1, rounds=1)
        n = adscan.lists_needed(x, centroids, 5, 0.97, queries=100)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert 0 < n < 2500 and peak < 60e6


def test_lists_needed_counts_over_all_pieces(monkeypatch):
    x = adscan.unit(np.random.RandomState(3).normal(size=(900, 8)))
    centroids = adscan.fit_centroids(x, 60, 1)
    whole = adscan.lists_needed(x, centroids, 5, 0.9)
    monkeypatch.setattr(adscan, "FIT_BYTES", 900 * 8 * 7)
    assert len(adscan.in_pieces(x[:400], len(x))) > 50 and adscan.lists_needed(x, centroids, 5, 0.9) == whole


def test_few_pairs_of_a_first_block_are_scored(monkeypatch):
    rng = np.random.RandomState(5)
    x = adscan.unit(rng.normal(size=(1000, 16)))
    scored, cosine = [], adscan.cosine
    monkeypatch.setattr(adscan, "cosine", lambda a, b: scored.append(len(a)) or cosine(a, b))
    top = Top(50, 6)
    adscan.scan_block(x[:50], x[:50], x, x, np.arange(1000), top, 2.1)
    s = x[:50] @ x.T
    assert np.array_equal(top.id, np.argsort(-s, axis=1)[:, :6]) and np.allclose(top.score, -np.sort(-s, axis=1)[:, :6], atol=1e-12)
    assert sum(scored) < 0.1 * s.size


def test_offered_ties_go_to_the_smaller_id():
    top = Top(3, 2)
    adscan.offer(top, np.array([2, 0, 0, 0]), np.array([0.5, 0.1, 0.9, 0.9]), np.array([7, 1, 9, 4]))
    adscan.offer(top, np.array([0, 2]), np.array([0.9, 0.6]), np.array([3, 8]))
    assert top.id[[0, 2]].tolist() == [[3, 4], [8, 7]] and top.score[2].tolist() == [0.6, 0.5]
    assert not top.found()[1].any()


def alike(df):
    return sorted((r.id, *r.v) for r in df.collect())


@pytest.mark.parametrize("broadcast", [True, False])
def test_rows_without_copies_go_on_as_they_are(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(vectors, "SHARED", 0)
    plain = [(i, [float(i), 1.0]) for i in range(40)]
    copies = [(100 + i, [0.5, 0.25]) for i in range(9)] + [(7, [7.0, 1.0])] * 3 + [(7, [7.0, 2.0]), (-5, [0.5, 0.25])]

    def rows(given):
        return spark.createDataFrame(given, "id long, v array<float>")

    written = []
    saved = vectors.saved
    monkeypatch.setattr(vectors, "saved", lambda df, name: written.append(name) or saved(df, name))
    got, n = vectors.few_copies(rows(plain), 5)
    assert (alike(got), n) == (sorted((i, *v) for i, v in plain), 40) and not written
    got, n = vectors.few_copies(rows(plain + copies), 5)
    want = alike(vectors.candidates(rows(plain + copies), 5))
    assert alike(got) == want and n == len(want) == 47
    assert vectors.few_copies(rows(plain).where("id < 0"), 5)[1] == 0


def test_the_sample_is_whole_when_hashes_crowd(spark):
    """One id for all rows: the share of hashes that should hold the sample holds all rows or none."""
    rng = np.random.RandomState(6)
    for i in (1, 2, 3, 4):
        rows = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for _ in range(200)], "id long, v array<double>")
        centroids, shares, n_probe = adscan._fit(rows, 200, 5, 0.97, 24, 11)
        assert centroids.shape == (3, 4) and shares.sum() == pytest.approx(1) and 1 <= n_probe <= 3


def test_packs_and_parts_hold_every_row(spark, monkeypatch):
    rows = cloud(1500, 9)
    want = results(adscan.search(frame(spark, rows), recall=1.0, every=3))
    monkeypatch.setattr(adscan, "PACK_BYTES", 8 * 16 * 50)
    monkeypatch.setattr(adscan, "PART_BLOCKS", 1)
    got = results(adscan.search(frame(spark, rows), recall=1.0, every=3, list_block=7, query_block=33))
    assert got.keys() == want.keys() and {len(v) for v in got.values()} == {5}
    same = sum(got[q] == want[q] for q in want)
    assert same >= 0.98 * len(want)  # what is given up depends on what came before


def test_large_rows_are_read_a_few_at_a_time(spark):
    rng = np.random.RandomState(8)
    rows = spark.createDataFrame([(i, bytearray(rng.bytes(1 << 20))) for i in range(24)], "id long, v binary").coalesce(1)
    written = common.saved(rows, "large", common.LARGE_ROWS)
    assert written.agg(F.sum(F.length("v"))).first()[0] == 24 << 20
    (path,) = written.inputFiles()
    held = parquet.ParquetFile(path.removeprefix("file:")).metadata
    sizes = [held.row_group(i).num_rows for i in range(held.num_row_groups)]
    assert sum(sizes) == 24 and max(sizes) <= 10
