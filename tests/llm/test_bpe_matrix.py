"""Byte-level BPE against the reference library, round trips, edge cases."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tidemark.llm import bpe_matrix
from tidemark.llm.bpe_matrix import BPE

RANKS, PATTERN = P.path("byte_bpe_50k.tiktoken"), P.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(library, text):
    return np.array(library.encode_ordinary(text or ""), "<u4").tobytes()


def odd_texts():
    rng = random.Random(3)
    letters = "ab  \n\t  \x85\x1c'stre1é漢<|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    return texts + ["a" * 3000, " " * 700 + "x", "<|endoftext|> a", "".join(rng.choice("abcdeth") for _ in range(2000)),
                    "'s 's  's", "word, word; word!", "É'été", "x" * 511, "x" * 513, "  a", "\xa0 b", "", None]


def test_ids_equal_the_library(library):
    texts = odd_texts()
    bpe = BPE(RANKS, PATTERN)
    for text, ids in zip(texts, bpe.encode(texts)):
        assert ids == ids_of(library, text), repr(text)
        assert bpe.decode(ids) == (text or "").encode()


def test_a_small_memory_changes_nothing(library, monkeypatch):
    from tidemark.llm import chunks

    monkeypatch.setattr(chunks, "MAX_REMEMBERED", 5)
    bpe = BPE(RANKS, PATTERN)
    texts = odd_texts()[:200]
    for k in range(0, 200, 7):
        assert bpe.encode(texts[k:k + 7]) == [ids_of(library, t) for t in texts[k:k + 7]]


def test_rows_and_columns(spark, library):
    rows = [(1, "one two", "a", 0), (1, "one two", "b", 1), (None, "three", "c", 2), (2, None, "d", 3), (3, "", "e", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    got = bpe_matrix.encode(docs, RANKS, PATTERN).collect()
    assert sorted((r.doc_id or 0, r.ids) for r in got) == sorted((r[0] or 0, ids_of(library, r[1])) for r in rows)
    assert all(r.ids_sha256 == hashlib.sha256(r.ids).hexdigest() and r.n_tokens * 4 == len(r.ids) for r in got)
    back = bpe_matrix.decode(bpe_matrix.encode(docs, RANKS, PATTERN), RANKS, PATTERN)
    assert sorted(bytes(r.decoded) for r in back.collect()) == sorted((r[1] or "").encode() for r in rows)
    assert bpe_matrix.encode(docs.limit(0), RANKS, PATTERN).count() == 0


def test_the_query_on_whole_texts(spark, library):
    from tidemark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op8_byte_bpe"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = ids_of(library, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
