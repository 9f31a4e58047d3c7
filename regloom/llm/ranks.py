"""Gapless positions inside groups without putting a group into one task.

A group is cut into sub-buckets that follow the wanted order; rows are ranked
inside a sub-bucket, and a small table of sub-bucket totals gives each
sub-bucket its offset. Rows that agree in every column are counted first, so a
row repeated a billion times is one row until the positions are dealt out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

CHUNK = 100_000


def packed_positions(df: DataFrame, group: list[str], bucket: list[Column],
                     order: list[str]) -> DataFrame:
    """One row per distinct row of ``df`` with ``_first`` (position, from 0, of
    its first copy inside ``group`` by ``order``) and ``_copies``.

    ``group`` columns hold no nulls; ``bucket`` expressions are monotone in
    ``order`` and not null; ``order`` together with ``group`` tells distinct
    rows apart. An empty table gives an empty table."""
    names = [f"_b{i}" for i in range(len(bucket))]
    packed = df.select("*", *[b.alias(n) for b, n in zip(bucket, names)])
    packed = packed.groupBy(*packed.columns).agg(F.count(F.lit(1)).alias("_copies"))
    packed = materialize(packed, "positions")
    inside = (Window.partitionBy(*group, *names).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    before = (Window.partitionBy(*group).orderBy(*names)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (packed.groupBy(*group, *names).agg(F.sum("_copies").alias("_n"))
               .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .drop("_n"))
    ranked = packed.withColumn("_in", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    return (ranked.join(offsets, [*group, *names])
            .withColumn("_first", F.col("_offset") + F.col("_in"))
            .drop("_offset", "_in", *names))


def unpack(packed: DataFrame, pos: str = "_pos") -> DataFrame:
    """A row for each copy, with its position. Copies are dealt out in chunks
    of ``CHUNK`` spread over the cluster before they are written out."""
    keys = [c for c in packed.columns if c not in ("_first", "_copies")]
    chunked = packed.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"),
                                       F.floor((F.col("_copies") - 1) / CHUNK))))
    spread = chunked.repartition("_first", "_chunk")
    low = F.col("_chunk") * CHUNK
    return spread.select(*keys, F.explode(F.sequence(
        F.col("_first") + low,
        F.col("_first") + F.least(low + CHUNK, F.col("_copies")) - 1)).alias(pos))
