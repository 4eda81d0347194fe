"""Record files: format, damage, order, index, shuffled reads, edge cases."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tidemark.llm import records
from tidemark.session import shared_dir

VOCABULARY = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids_of(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


@pytest.mark.parametrize("width,ids", [(2, [0, 10, 65535]), (4, [1 << 31, 10]), (2, [])])
def test_a_frame_round_trips(width, ids):
    data = b"junk" + records.frame(-7, np.array(ids, "<u4"), width) + b"\n" + records.frame(None, np.array([3], "<u4"), 2) + b"\n"
    key, n, got, following = records.parse(data, 4)
    assert (key, n, got.tolist()) == (-7, len(ids), ids)
    assert records.parse(data, following)[0] is None and records.parse(data, following)[3] == len(data)


def test_every_damaged_byte_is_found():
    good = records.frame(5, np.array([1, 2, 3], "<u4"), 2)
    for i in range(len(good)):
        bad = bytearray(good)
        bad[i] ^= 0x40
        with pytest.raises(ValueError):
            records.parse(bytes(bad), 0)
    with pytest.raises(ValueError):
        records.parse(good[:-1], 0)


ROWS = [(5, "b c"), (2, "line\nfeed"), (9, None), (2, "line\nfeed"), (None, "no id"), (7, ""), (1, "<|endoftext|> x" * 40)]


def test_files_hold_all_rows_in_order(spark, library):
    docs = spark.createDataFrame([(k, t, 1) for k, t in ROWS], "doc_id long, text string, start int")
    path = shared_dir(spark, "t_records")
    records.write(docs, path, VOCABULARY)
    got = records.with_start(records.scan(spark, path), records.index(spark, path)).orderBy("start").collect()
    want = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.id for r in got] == [k for k, _ in want]
    start = 0
    for r, (_, t) in zip(got, want):
        assert r.ids == ids_of(library, t).tobytes() and r.start == start
        start += r.n_tokens


def test_an_index_finds_records_in_any_order(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 5)) for i in range(200)], "doc_id long, text string")
    path = shared_dir(spark, "t_records")
    records.write(docs, path, VOCABULARY)
    idx = records.index(spark, path)
    some = idx.where("id % 7 = 0")
    assert sorted(r.id for r in records.scan(spark, path, at=some).collect()) == list(range(0, 200, 7))
    one, two = [[r.id for r in records.shuffled(spark, path, seed).collect()] for seed in (1, 2)]
    assert sorted(one) == sorted(two) == list(range(200)) and one != two and one != sorted(one)


def test_many_files_for_one_partition(spark, monkeypatch):
    monkeypatch.setattr(records, "RECORDS_PER_FILE", 16)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(150)], "doc_id long, text string")
    path = shared_dir(spark, "t_records")
    records.write(docs, path, VOCABULARY)
    got = records.with_start(records.scan(spark, path), records.index(spark, path)).orderBy("start").collect()
    assert [r.id for r in got] == list(range(150))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))


def test_files_are_bounded_by_bytes(spark, monkeypatch):
    """Many long texts make many files, each of few bytes unless one record alone has more."""
    monkeypatch.setattr(records, "BYTES_PER_FILE", 5000)
    rows = [(i, "long text here " * (20 if i % 7 else 4000)) for i in range(60)]
    path = shared_dir(spark, "t_records")
    records.write(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), path, VOCABULARY)
    got = records.with_start(records.scan(spark, path), records.index(spark, path)).orderBy("start").collect()
    assert [r.id for r in got] == list(range(60))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/data").select("length").collect()
    assert len(sizes) > 8 and sum(r.length > 5000 for r in sizes) == 9


ADDED = ["a <|endoftext|> b", "<|endoftext|>", " <|endoftext|>", "x<|endoftext|><|endoftext|> y  z", "one\n<|endoftext|>\n two", "<|endoftext| >", "no token"]


def test_strings_of_added_tokens(spark, library):
    """As the library does it as loaded, also where the string stands beside white space."""
    path = shared_dir(spark, "t_records")
    records.write(spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string"), path, VOCABULARY)
    got = {r.id: r.ids for r in records.scan(spark, path).collect()}
    assert got == {i: ids_of(library, t).tobytes() for i, t in enumerate(ADDED)}
    assert 50256 in np.frombuffer(got[0], "<u4")


def test_an_empty_table(spark):
    path = shared_dir(spark, "t_records")
    records.write(spark.createDataFrame([], "doc_id long, text string"), path, VOCABULARY)
    assert records.scan(spark, path).count() == 0 and records.index(spark, path).count() == 0


def test_the_query_on_whole_texts(spark, library):
    from tidemark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    start = 0
    got = {r.doc_id: r for r in QUERIES["op7_token_records"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = ids_of(library, r.text)
        assert tuple(got[r.doc_id])[1:] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
