"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing
and SentencePiece encoding, each stage on all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read back as the next stage's docs. All but the last return the
columns of documents. An ``n_chars`` column follows the text it counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.llm import linededup, mixing, neardup, pieces, quality
from regloom.llm.common import n_words
from regloom.session import ensure_checkpoint_dir, load


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A line found in at least ten documents stays only in the first text that
    holds it, and in that text's copies, which near_dedup removes. Documents go
    that lose their last word: each of their lines stands in another one."""
    out = linededup.keep_first(docs).where((F.col("_n_dropped") == 0) | (n_words() > 0))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: Jaccard similarity
    0.8 or more of their five-word shingles, directly or over others."""
    return neardup.keep_one(docs, percent=80, n_bands=44, width=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and round trip of every document: the columns of the encoding query."""
    return pieces.piece_table(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: SQL cannot express MinHash components nor SentencePiece; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir.rstrip("/"), "documents")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
