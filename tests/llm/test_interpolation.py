"""Deleted interpolation against counts of the whole corpus."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import interpolation

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w] + [None]


def remainder(i):
    return zlib.crc32(str(i).encode()) % 7


def check(rows, got):
    """Counts, the base score, and the model's score from its own weights, found anew."""
    train = Counter(w for i, t in rows if i is not None and remainder(i) != 2 for w in tokens(t))
    n, v = sum(train.values()), len(train)
    want = sorted((i if i is not None else -1, len(tokens(t)), sum(train[w] > 0 for w in tokens(t)), n) for i, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, r.train_tokens) for r in got) == want
    texts = dict(rows)
    for r in got:
        assert r.held_out == (None if r.doc_id is None else remainder(r.doc_id) == 2)
        if r.doc_id is not None:
            base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in tokens(texts[r.doc_id]))
            assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
    return train, n, v


def by_hand(rows):
    """Scores with the same rule, all counts at once."""
    train = [(i, tokens(t)) for i, t in rows if remainder(i) != 2]
    one, two = Counter(), Counter()
    tune1, tune2 = Counter(), Counter()
    for i, ts in train:
        pairs = list(zip([None] + ts[:-1], ts))
        one.update(ts)
        two.update(pairs)
        if remainder(i) == interpolation.FOLD:
            tune1.update(ts)
            tune2.update(pairs)
    n, v = sum(one.values()), len(one)
    events = Counter()
    for i, ts in train:
        if remainder(i) == interpolation.FOLD:
            for h, w in zip([None] + ts[:-1], ts):
                c, d, e = one[h] - tune1[h], two[h, w] - tune2[h, w], one[w] - tune1[w]
                log = lambda x: round(math.log(x) / interpolation.BIN) if x > 0 else -10_000
                events[(int(c).bit_length(), log(d / c if c else 0), log(e))] += 1
    m, weight = interpolation.learn([(*k, float(x)) for k, x in sorted(events.items())], n - sum(tune1.values()), v)
    out = {}
    for i, t in rows:
        ts = tokens(t)
        s = 0.0
        for h, w in zip([None] + ts[:-1], ts):
            p1 = m * one[w] / n + (1 - m) / (v + 1)
            l = weight[int(one[h]).bit_length()]
            s += math.log10(l * (two[h, w] / one[h] if one[h] else 0) + (1 - l) * p1)
        out[i] = s
    return out, m, weight


def test_scores_are_those_of_the_rule(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = interpolation.score(docs).collect()
    check(rows, got)
    want, _, _ = by_hand(rows)
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], rel=1e-6)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_sum_to_one():
    rows = [(i, "a b a c b a" if i % 2 else "b c c a d") for i in range(60)]
    _, m, weight = by_hand(rows)
    train = [tokens(t) for i, t in rows if remainder(i) != 2]
    one = Counter(w for ts in train for w in ts)
    two = Counter(p for ts in train for p in zip([None] + ts[:-1], ts))
    n, v = sum(one.values()), len(one)
    for h in [*one, "unseen"]:
        l = weight[int(one[h]).bit_length()]
        total = sum(l * (two[h, w] / one[h] if one[h] else 0) + (1 - l) * (m * one[w] / n + (1 - m) / (v + 1)) for w in one)
        total += (1 - l) * (1 - m) / (v + 1)  # the one unknown word
        assert total == pytest.approx(1)


def test_learning_prefers_what_predicts():
    good = [(4, -1, 3, 50.0), (4, 0, 3, 50.0)]      # bigrams hold
    bad = [(2, -10_000, 3, 100.0)]                   # contexts seen, pairs not
    _, weight = interpolation.learn(good + bad, 1000.0, 50.0)
    assert weight[4] > 0.9 and weight[2] < 0.1 and weight[0] == 0
    assert interpolation.learn([], 0.0, 0.0)[0] == 0.0


def test_small_blocks_change_nothing(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * k) % 17}" for k in range(i % 23))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(interpolation, "BLOCK_TOKENS", 50)
    got = interpolation.score(docs).collect()
    check(rows, got)
    want, _, _ = by_hand(rows)
    assert all(r.score == pytest.approx(want[r.doc_id], rel=1e-6, abs=1e-9) for r in got)


def test_edges(spark):
    rows = [(1, None), (3, ""), (4, " \n"), (None, "no id"), (5, "Same same SAME"), (6, "x" * 100_000), (7, "same é É")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int")
    got = interpolation.score(docs).collect()
    check(rows, got)
    assert all(np.isfinite(r.score) and r.score <= 0 for r in got)
    twice = interpolation.score(docs.union(docs)).collect()
    assert len(twice) == 14 and {r.train_tokens for r in twice} == {2 * got[0].train_tokens}
    assert interpolation.score(docs.limit(0)).count() == 0
    none = [(i, "only held out") for i in range(40) if remainder(i) == 2]
    assert all(r.train_tokens == 0 and r.base_score == 0 for r in interpolation.score(spark.createDataFrame(none, "doc_id long, text string")).collect())
