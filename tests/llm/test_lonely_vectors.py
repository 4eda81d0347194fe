"""Every query of the adaptive scan gets k rows when there are k others, however lonely it is."""

import numpy as np
from tests.llm.test_vectors import frame, results

from tidemark.llm import adscan
from tidemark.llm.vectors import Top


def lonely(seed, d=32):
    """Tight clusters (one list looked into would do), and triples far from all and from each other."""
    rng = np.random.RandomState(seed)
    centres = adscan.unit(np.hstack([rng.normal(size=(200, 8)), np.zeros((200, d - 8))]))
    rows = [centres[i % 200] + 0.001 * rng.normal(size=d) for i in range(1600)]
    for j in range(24):
        rows += [0.3 * centres[j] + np.eye(d)[8 + j] + 0.001 * rng.normal(size=d) for _ in range(3)]
    return [(i, v.tolist()) for i, v in enumerate(rows)]


def test_lonely_queries_get_k_rows(spark):
    rows = lonely(1)
    got = results(adscan.search(frame(spark, rows), every=1))
    assert len(got) == len(rows) and {len(v) for v in got.values()} == {5}
    for q in range(1600, len(rows)):  # the other two of a triple come first
        first = 1600 + (q - 1600) // 3 * 3
        assert {i for i, _ in got[q][:2]} == {first, first + 1, first + 2} - {q}


def test_lists_are_added_until_they_hold_enough():
    s = np.array([[0.9, 0.8, 0.1, 0.0], [0.0, 0.1, 0.2, 0.9], [0.9, 0.0, 0.1, 0.2]])
    got = adscan.enough_lists(s, 1, np.array([1, 0, 2, 9]), 6)
    assert [x.tolist() for x in got] == [[0, 1, 2, 3], [3], [0, 3]]
    assert [len(x) for x in adscan.enough_lists(s, 1, np.array([1, 0, 2, 0]), 6)] == [4, 4, 4]  # fewer rows than that: all lists
    assert [len(x) for x in adscan.enough_lists(s, 2, np.array([9, 9, 9, 9]), 6)] == [2, 2, 2]


def test_nothing_is_given_up_before_there_are_k():
    d = 128
    q = np.eye(d)[:1]
    x = np.vstack([-q] * 4)  # opposite, with all of the distance in the first block
    top = Top(1, 6)
    adscan.scan_block(q, q, x, x, np.arange(4), top, 2.1)
    assert top.id[0, :4].tolist() == [0, 1, 2, 3]
