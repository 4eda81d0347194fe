"""Language identification against a plain sum over n-grams, held-out accuracy and edge cases."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string"
TEXTS = [(1, "The cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, "THE dog\tsees the cat!", "en"),
         (4, "Die Katze sieht den Hund; Straße", "de"), (5, "", "en"), (6, None, "de"), (7, "12 + 3", "en"), (8, "el perro", None)]


def words(text):
    out, word = [], ""
    for c in text:
        if c.isalpha():
            word += c.lower() if len(c.lower()) == 1 else c
        elif word:
            out, word = [*out, word], ""
    return out + [word] * bool(word)


def plain_grams(text):
    """(n, n-gram) with 0 for a word edge; between two words there is one edge."""
    out = Counter()
    for w in words(text):
        codes = [0, *map(ord, w), 0]
        for n in range(1, language.ORDER + 1):
            for i in range(len(codes) - n + 1):
                if n > 1 or codes[i]:
                    out[tuple(codes[i:i + n])] += 1
    return out


def bucket(gram):
    h = sum(c * int(p) for c, p in zip(gram, language._PLACE)) & 0xFFFFFFFF
    m = ((h + len(gram)) * 0x9E3779B1) & 0xFFFFFFFF
    m ^= m >> 15
    return ((m * 0x85EBCA77) & 0xFFFFFFFF) >> 16


def plain(train, text):
    """(language, posterior) by sums in plain Python."""
    if not text or not words(text):
        return "und", 0.0
    docs, counts = Counter(), {}
    for t, lang in train:
        docs[lang] += 1
        counts.setdefault(lang, Counter()).update({})
        for g, n in plain_grams(t or "").items():
            counts[lang][bucket(g)] += n
    logs = {}
    for lang in sorted(docs):
        total = sum(counts[lang].values()) + language.SMOOTHING * language.BUCKETS
        logs[lang] = math.log(docs[lang] / sum(docs.values())) + sum(
            n * math.log((counts[lang][bucket(g)] + language.SMOOTHING) / total) for g, n in plain_grams(text).items())
    best = max(logs, key=logs.get)
    return best, 1 / sum(math.exp(x - logs[best]) for x in logs.values())


@pytest.mark.parametrize("matrix_bytes", [64 << 20, 4 * language.BUCKETS])
def test_against_plain_sums(spark, matrix_bytes):
    """Also where each language has a matrix and a pass of its own."""
    docs = spark.createDataFrame(TEXTS, SCHEMA)
    model = language.fit(docs, F.lit(True), matrix_bytes=matrix_bytes)
    assert len(model.blocks) == (1 if matrix_bytes > 4 * language.BUCKETS else 2)
    train = [(t, x) for _, t, x in TEXTS if x is not None]
    for r, (i, text, _) in zip(language.predict(docs, model, ["doc_id"]).orderBy("doc_id").collect(), TEXTS):
        lang, score = plain(train, text)
        assert (r.doc_id, r.lang_pred) == (i, lang)
        assert r.score == pytest.approx(score, abs=1e-4)


def test_pieces_of_a_long_text(monkeypatch):
    text = "Un texte assez long, avec des mots. " * 50
    code, first = language.letters(["", text, "x"])
    whole = [np.bincount(b, minlength=language.BUCKETS + 1) for b in language.grams(code, 0, len(code))]
    parts = [0] * language.ORDER
    for a in range(0, len(code), 7):
        parts = [p + np.bincount(b, minlength=language.BUCKETS + 1) for p, b in zip(parts, language.grams(code, a, min(a + 7, len(code))))]
    for x, y in zip(whole, parts):
        assert (x[:-1] == y[:-1]).all()
    assert sum(int(x[:-1].sum()) for x in whole) == sum(plain_grams(text).values()) + sum(plain_grams("x").values())
    assert first.tolist()[0] == first.tolist()[1]


def test_held_out_accuracy(spark):
    found = QUERIES["op12_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    out = [r for r in rows if r.held_out]
    assert len(out) > 100 and sum(r.lang == r.lang_pred for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark):
    """Nulls, repeated rows, no training rows, an empty table, clashing column names, very long texts."""
    docs = spark.createDataFrame([(None, "der Hund", "x"), (1, None, "y"), (1, "!?", "y"), (2, "the cat", "z"), (2, "the cat", "z"),
                                  (3, "the cat " * 300_000, "z")], "doc_id long, text string, t string")
    learned = language.fit(spark.createDataFrame(TEXTS, SCHEMA), F.lit(True))
    got = sorted(((r.doc_id, r.t, r.lang_pred) for r in language.predict(docs, learned, ["doc_id", "t"]).collect()), key=str)
    assert got == sorted([(None, "x", "de"), (1, "y", "und"), (1, "y", "und"), (2, "z", "en"), (2, "z", "en"), (3, "z", "en")], key=str)
    nothing = language.fit(spark.createDataFrame(TEXTS, SCHEMA), F.lit(False))
    assert {(r.lang_pred, r.score) for r in language.predict(docs, nothing, ["doc_id"]).collect()} == {("und", 0.0)}
    empty = language.predict(docs.limit(0), learned, ["doc_id"])
    assert empty.columns == ["doc_id", "lang_pred", "score"] and empty.count() == 0


def test_settings_come_back(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    language.predict(spark.createDataFrame(TEXTS, SCHEMA), language.fit(spark.createDataFrame(TEXTS, SCHEMA), F.lit(True)), ["doc_id"])
    assert spark.conf.get(name) == before
