"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import adscan, alignment, balltree, bpe_matrix, interpolation, language, line_dedup, mixing, records, secrets, signature_tree, spelling, toxicity
from tidemark.llm.common import crc_of_id, table
from tidemark.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return put


@query("op7_token_records")
def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "op7")
    records.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    read = records.scan(spark, path).select("file", "before", F.col("id").alias("doc_id"), "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return records.with_start(read, records.index(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_matrix.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                             public_tokenizers.PATTERN, keep_ids=False)


@query("op6_poisson_mix", mixing.sql())
def op6_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op9_toxicity_fm")
def op9_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.pmod(crc_of_id(), F.lit(4)) != 2)
    scored = toxicity.score(docs, machine, ["doc_id"])
    return scored.select("doc_id", (F.pmod(crc_of_id(), F.lit(4)) == 2).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op3_secret_scan", secrets.sql())
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda x: x["kind"] < 3)
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), count(3).alias("n_entropy"),
        F.sha2(secrets.text_of(base), 256).alias("base_sha256"), secrets.text_of(F.col("spans")).alias("spans"))


@query("op2_line_dedup", line_dedup.sql())
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents"))


@query("op1_adaptive_scan")
def op1_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adscan.search(table(spark, sf_dir, "embeddings"))


@query("op10_ball_tree")
def op10_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.search(table(spark, sf_dir, "embeddings"))


@query("op4_deleted_interpolation")
def op4_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score(table(spark, sf_dir, "documents"))


@query("op5_signature_tree")
def op5_signature_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_tree.join(table(spark, sf_dir, "documents"))


@query("op11_spelling_fm")
def op11_spelling_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


@query("op12_language_id")
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(crc_of_id(), F.lit(5)) == 0
    found = language.predict(docs, language.fit(docs, ~held_out), ["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"), keep_groups=False)


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
