"""Spelling variants against a plain search over all pairs, and edge cases."""

import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import spelling
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def plain_words(rows):
    out = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] or a[i + 1:] == b[i:] or a[i:] == b[i + 1:]


def plain(words):
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    out = {}
    for w, n in words.items():
        near = [x for k in (-1, 0, 1) for x in by_length.get(len(w) + k, []) if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        out[w] = [form, n, len(near), words[form] if form else None]
    rows = []
    for w, (form, n, k, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, k, form_n))
    return sorted(rows)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def texts(seed, words=60, alphabet="abé"):
    """Words over few letters, so that many are one edit apart, of counts over three powers of ten."""
    rng = random.Random(seed)
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(6, 9))) for _ in range(words)]
    every = [w for w in made for _ in range(rng.choice([1, 2, 3, 30, 300, 2000]))]
    rng.shuffle(every)
    return [(i, " ".join(every[i::40]).title() if i % 2 else "×".join(every[i::40]) * (i % 3 == 0) or ", ".join(every[i::40])) for i in range(40)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = texts(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(spelling.group(docs)) == plain(plain_words(rows))


def test_small_indexes(spark):
    """Buckets cut into many indexes, searched a few states at a time, give the same pairs."""
    rows = texts(3, words=120)
    words = plain_words(rows)
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    found = sorted((r.word, r.near, r.near_n) for r in spelling.pairs(table, index_words=5).collect())
    assert found == sorted((a, b, words[b]) for a in words for b in words if one_edit(a, b)) and found


def test_index_ranks():
    words = ["banana", "bandana", "anagram", "an", "nab"]
    index = spelling.Index(words)
    for w in words:
        who, near = index.near([w], 0)
        assert {words[i] for i in near} == {x for x in words if one_edit(w, x)}
    assert set(index.near(["bbandana"], 4)[1].tolist()) == {1}
    assert not len(index.near(["zzzzzz"], 3)[0])


def test_query(spark):
    found = got(QUERIES["op11_spelling_fm"](spark, SF))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert found == plain(plain_words([(r.doc_id, r.text) for r in docs]))


def test_chain_of_forms(spark):
    rows = [(1, "internal " * 2000 + "internel " * 150 + "interneel " * 12 + "lonelyword " * 3)]
    found = {r.word: r.root for r in spelling.group(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    expect = {w: root for w, _, root, *_ in plain(plain_words(rows))}
    assert found == expect


def test_edges(spark):
    """Nulls, empty and very long texts, repeated rows, ties, clashing names, an empty table."""
    long = "abcdefgh" * 5000
    rows = [(None, "strasse strassen strassem", "x"), (1, None, "y"), (2, "", "y"), (3, "gardens gardenz gardens", "z"),
            (3, "gardens gardenz gardens", "z"), (4, long + " " + long + " " + long + "x", "w"), (4, long + "x", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    assert got(spelling.group(docs)) == plain(plain_words([r[:2] for r in rows]))
    empty = spelling.group(docs.limit(0))
    assert sorted(empty.columns) == sorted(COLUMNS) and empty.count() == 0
