"""The registered queries of this package: each applies its operator, with its
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import load
from . import (alignment, chat, iblt, licenses, linededup, mixing, neardup, pieces, quality, sharding, toxicity,
               warc, whitening)
from .common import documents

SHARDS = 8


def op1_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(documents(spark, sf_dir), SHARDS)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_table(documents(spark, sf_dir))


def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_table(documents(spark, sf_dir))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(documents(spark, sf_dir))


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(load(spark, sf_dir.rstrip("/"), "pages"))


def op6_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprint_table(documents(spark, sf_dir))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_table(documents(spark, sf_dir))


def op8_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_table(documents(spark, sf_dir), load(spark, sf_dir.rstrip("/"), "labels"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir)).drop("blocks")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_table(documents(spark, sf_dir))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_table(load(spark, sf_dir.rstrip("/"), "embeddings"))


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_table(load(spark, sf_dir.rstrip("/"), "conversations"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_table(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_jump_sharding, op2_quality_rules, op3_minhash_neardup, op4_source_mixing, op5_warc_round_trip,
    op6_paragraph_sketch, op7_sentencepiece, op8_toxicity_mil, op9_license_scan, op10_line_dedup, op11_embedding_whitening, op12_chat_formatting,
    op13_tokenizer_alignment)}
