"""One query for each operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusprep.llm import decontaminate, embeddings, hilbert, langid, lm, merkle, mixing, negatives, orc_tokens, quality, secrets, sentencepieces, simhash
from corpusprep.llm.common import table, tokenizer_file


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.op1(table(spark, sf_dir, "embeddings"))


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.op2(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op3(table(spark, sf_dir, "documents"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.op4(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.op5(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op6(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orc_tokens.op7(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op8(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op9(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op10(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.op11(table(spark, sf_dir, "documents"))


def op12_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op12(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.op13(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_dedup,
        op2_hilbert_shards,
        op3_secret_scan,
        op4_lm_score,
        op5_sentencepiece,
        op6_decontaminate,
        op7_orc_tokens,
        op8_language_id,
        op9_quality,
        op10_simhash,
        op11_merkle_manifest,
        op12_mixture,
        op13_hard_negatives,
    )
}

SQL: dict[str, str] = {
    "op1_embedding_dedup": embeddings.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op12_mixture": mixing.SQL,
    "op13_hard_negatives": negatives.SQL,
}
