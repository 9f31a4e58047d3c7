"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Within a source every document expects ``target / source size`` copies. The
documents are put in order of size, the expected copies are prefix-summed, one
random offset per source is added, and a document is emitted once for each
integer boundary its stretch crosses. In size order each stretch of documents
of like size gives its share, so the words taken miss the target by about one
document.

Nulls: a null text has size 0; the null source is a source that sorts last.
Sources whose documents are all empty have target 0 and take nothing. Equal
rows are told apart by position only. An empty table gives an empty table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import hash60, n_words
from .ranks import packed_positions, unpack

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SUB_BITS = 8
#: Rates and offsets are whole numbers of 1/ONE copies: products with a position stay inside a long.
ONE = 1 << 31


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   most: int = MOST_COPIES) -> DataFrame:
    """(source, rank, source_size, target) from rows (source, size).

    All sources share the whole size by weight; a target stops at ``most``
    times its source's size and what is over is shared again by weight. The
    end of that resharing is a water level: with sources ordered by
    ``cap / weight``, the first whose cap reaches the level that its
    predecessors' caps leave over fixes it for all."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * most)
    ranked = ranked.withColumn("_ratio", F.col("_cap").cast("double") / F.col("_w"))
    whole = Window.partitionBy(F.lit(0))
    ahead = Window.partitionBy(F.lit(0)).orderBy("_ratio", "rank")
    level = ((F.sum("source_size").over(whole) - F.sum("_cap").over(ahead) + F.col("_cap"))
             .cast("double") / (F.sum("_w").over(whole) - F.sum("_w").over(ahead) + F.col("_w")))
    found = ranked.withColumn("_level", level).withColumn("_level", F.first(
        F.when(F.col("_ratio") >= F.col("_level"), F.col("_level")), ignorenulls=True).over(
            ahead.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return found.select("source", "rank", "source_size", F.least(
        F.col("_cap").cast("double"), F.col("_w") * F.col("_level")).alias("target"))


def _offset(seed: int) -> Column:
    """One uniform draw in [0, ONE) per source and seed."""
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("source"), F.lit("")))
    return F.shiftrightunsigned(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long"), 1)


def _copies(pos: Column) -> Column:
    """Integer boundaries crossed by the stretch of the document at ``pos``: the
    whole part of the rate, and one more where the fraction reaches the next."""
    whole, part = F.shiftrightunsigned("_rate", 31), F.col("_rate") % ONE
    start = (F.col("_u") + part * (pos % ONE)) % ONE
    return whole + (start + part >= ONE).cast("long")


def _plan(thin: DataFrame, seed: int, weights, most) -> DataFrame:
    """Distinct rows of ``thin`` with their first position in their source and
    the source's rate and offset."""
    targets = source_targets(thin, weights, most).select(
        F.col("source").alias("_s"), "rank", "source_size", "target", _offset(seed).alias("_u"),
        F.floor(F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)) * ONE).alias("_rate"))
    ranked = thin.join(targets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    return packed_positions(
        ranked, ["rank"], [F.col("size"), F.shiftrightunsigned("_mix", 60 - SUB_BITS)],
        ["size", "_mix", "_id"])


def _thin(df: DataFrame) -> DataFrame:
    """Size and identity of each row; the texts stay where they are. Rows that
    agree in id, source and text share ``_id``."""
    return df.select("doc_id", "source", n_words().alias("size"), _identity().alias("_id")).withColumn(
        "_mix", hash60(F.col("doc_id"), F.col("size")))


def _identity() -> Column:
    parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
             F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("-")),
             F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("-"))]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def mix_table(df: DataFrame, seed: int = 20, weights: tuple[int, ...] = WEIGHTS,
              most: int = MOST_COPIES) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, copies) of every row."""
    thin = materialize(_thin(df), "mix")
    rows = unpack(_plan(thin, seed, weights, most)).withColumn("copies", _copies(F.col("_pos")))
    return rows.select("doc_id", "size", "source_size", "target",
                       (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def mix(df: DataFrame, seed: int = 20, weights: tuple[int, ...] = WEIGHTS,
        most: int = MOST_COPIES) -> DataFrame:
    """The rows of ``df`` themselves, each as often as the mix takes it (all
    columns kept, whatever their names). Rows that agree in id, source and
    text count off among themselves, so each takes its own position."""
    tagged = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
                       _identity().alias("_id"))
    plan = _plan(materialize(_thin(df), "mix"), seed, weights, most).select(
        "_id", "_first", "_rate", "_u")
    nth = F.row_number().over(Window.partitionBy("_id").orderBy("_id")) - 1
    out = tagged.join(plan, "_id").withColumn("_n", _copies(F.col("_first") + nth)).where("_n > 0")
    return out.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).select("_row.*")
