"""Shared column expressions and null rules of the text operators.

Null rules used everywhere unless an operator says otherwise: a null text is
an empty text; a null doc_id is a value of its own that sorts before all
others. Operators select the columns they need first, so extra columns of the
input, whatever their names, never meet an operator's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import load

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir.rstrip("/"), "documents")


def whole_text(col: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(col), F.lit(""))


def n_words(col: str = "text") -> Column:
    """Number of ASCII-white-space separated words of the whole text (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(col), F.lit(WORD)), F.lit(0)).cast("long")


def hash60(*parts: Column) -> Column:
    """60-bit non-negative hash (leading 15 hex digits of md5), the same in any SQL engine."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
