"""Factorization machine: pairwise terms, held-out accuracy, edge cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import toxicity


def pairs_corpus(n, seed):
    """Toxic exactly when an insult and a group stand together; each alone is as common in both classes."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [rng.choice(["sun", "rain", "river", "stone", "cloud"]) for _ in range(12)]
        words += ["vermin"] * insult + ["strangers"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(insult and group)))
    return rows


def test_interactions_are_learned():
    """No linear weights tell XOR apart; the factors do."""
    rng = np.random.RandomState(0)
    docs, labels = [], []
    for _ in range(600):
        a, b = rng.rand(2) < 0.5
        docs.append(np.flatnonzero([a, b]))
        labels.append(float(a == b))
    labels = np.array(labels)
    m = toxicity.fit_machine(docs, labels, np.arange(2), epochs=120)
    at = np.concatenate(docs)
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    assert ((m._sigmoid(doc, at, len(docs)) > 0.5) == (labels > 0.5)).mean() == 1.0
    assert toxicity.fit_machine(docs, labels, np.arange(2), epochs=120).bias == m.bias  # the same again


def test_insult_with_group(spark):
    rows = pairs_corpus(800, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 600], "doc_id long, toxic int")
    machine = toxicity.fit(docs, labels, F.lit(True))
    got = {r.doc_id: r.score for r in toxicity.score(docs, machine, ["doc_id"]).collect()}
    held = [(got[i] >= 0.5) == bool(y) for i, _, y in rows if i >= 600]
    assert sum(held) / len(held) > 0.97


def test_held_out_documents(spark):
    """On the given tables: no clean document flagged, most toxic ones found."""
    from tidemark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    scored = QUERIES["op9_toxicity_fm"](spark, sf)
    known = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert scored.count() == 1000 and all(0 <= r.score <= 1 for r in known)
    toxic, clean = [r for r in known if r.toxic], [r for r in known if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)


def test_the_sample_is_bounded_and_labels_decide_nothing(spark):
    rows = pairs_corpus(300, 2)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    train = F.col("doc_id") < 200
    machine = toxicity.fit(docs, labels, train, sample=100)
    other = labels.withColumn("toxic", F.when(train, F.col("toxic")).otherwise(1 - F.col("toxic")))
    again = toxicity.fit(docs, other, train, sample=100)
    assert np.array_equal(machine.weights, again.weights) and machine.bias == again.bias


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "Idiot idiot", "y"), (None, "é" * 50_000, "z")], "doc_id long, text string, s string")
    empty = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    got = toxicity.score(docs, empty)
    assert got.columns == ["doc_id", "text", "s", "score"] and {r.score for r in got.collect()} == {0.5}
    some = toxicity.fit(docs, spark.createDataFrame([(2, 1), (2, 1), (1, 0), (None, 1), (3, None)], "doc_id long, toxic int"), F.lit(True))
    scores = [r.score for r in toxicity.score(docs, some).collect()]
    assert len(scores) == 4 and all(0 < s < 1 for s in scores) and scores[0] == scores[1]
    assert toxicity.score(docs.limit(0), some).count() == 0


def test_scores_are_the_plain_sum_over_pairs():
    """bias + sum of weights + sum over all pairs of terms of the inner product of their factors."""
    rng = np.random.RandomState(3)
    m = toxicity.Machine(np.arange(30), 0.2, rng.normal(size=30), rng.normal(size=(30, toxicity.FACTORS)))
    docs = [np.sort(rng.choice(30, size, replace=False)) for size in (0, 1, 2, 7, 20)]
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    got = m._sigmoid(doc, np.concatenate(docs).astype(int), len(docs))
    for d, score in zip(docs, got):
        z = 0.2 + sum(m.weights[i] for i in d) + sum(float(m.factors[i] @ m.factors[j]) for i in d for j in d if i < j)
        assert abs(score - 1 / (1 + np.exp(-np.clip(z, -35, 35)))) < 1e-12
