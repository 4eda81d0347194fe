"""Registered queries with DuckDB statements, and the pipeline stage by stage."""

import duckdb
import public_tokenizers as P
import pytest

import corpus_pipeline
from check_oracles import TABLES, digest
from tests.llm import test_line_dedup, test_signature_tree
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.session import shared_dir

SF = "/root/testdata/sf0.001"


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols) and digest(df.columns, rows) == digest(cols, res.fetchall())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = shared_dir(spark, f"t_{name}")
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.dtypes == docs.dtypes
        before[name] = docs = after
    every = {name: [r.asDict() for r in df.collect()] for name, df in before.items()}
    texts = {name: [(r["doc_id"], r["text"]) for r in rows] for name, rows in every.items() if name != "encode"}
    # toxic documents go, the others stay as they were
    assert set(texts["toxicity"]) < set(texts[""])
    # lines: as by all pairs; documents without a line left go
    want = test_line_dedup.brute(texts["toxicity"])
    assert sorted(texts["line_dedup"]) == sorted((d, x) for (d, t), x in want.items() if x == t or x.strip(" \n"))
    assert all(r["n_chars"] == len(r["text"]) for r in every["line_dedup"])
    # near copies: one of each component
    groups = test_signature_tree.brute(texts["line_dedup"])
    assert sorted(d for d, _ in texts["near_dedup"]) == sorted({c for _, _, c in groups})
    # mixing only repeats and drops; encoding keeps every row
    assert set(texts["mix"]) <= set(texts["near_dedup"])
    assert sorted(r["doc_id"] for r in every["encode"]) == sorted(d for d, _ in texts["mix"])
    from tidemark.llm.bpe_matrix import BPE

    bpe = BPE(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    text = dict(texts["mix"])
    assert all(bpe.decode(bytes(r["ids"])) == text[r["doc_id"]].encode() for r in every["encode"])
