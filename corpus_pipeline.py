"""A training corpus from ``documents``: five stages, each written as Parquet and read by the next.

1. toxicity       documents scored toxic by a factorization machine go
2. line_dedup     lines that came before (up to one edit) go, and documents left without a line
3. near_dedup     of each group of near copies the document of smallest id stays
4. mix            documents are repeated so that all sources weigh the same, and shuffled
5. encode         texts become token ids

Every stage but the last returns the columns of ``documents``.  The last gives doc_id, source,
n_tokens, ids (little-endian unsigned 32-bit integers), and digests of the ids and of the bytes
that they decode to.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_matrix, line_dedup, mixing, signature_tree, toxicity
from tidemark.llm.common import crc_of_id, table
from tidemark.session import shared_dir

#: Documents scored this or more are rejected.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on the labels of three quarters of the ids; labels decide nothing by themselves."""
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.pmod(crc_of_id(), F.lit(4)) != 2)
    return toxicity.score(docs, machine).where(F.col("score") < TOXIC).drop("score")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document whose lines all came before goes; one that had no text stays as it is."""
    kept = line_dedup.dedup(docs)
    changed = F.col("n_dropped") > 0
    kept = kept.where(~changed | (F.trim("text") != ""))
    return kept.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return signature_tree.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, copy_col="_copy").drop("_copy")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_matrix.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=["source"])


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("encode", encode),
]

#: SQL can't express the fitted classifier nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
