"""Categorical encoding and scaling.

The encoded schema depends on the data (one column per level), so the plan
needs the level lists first. Only level lists that are *proven* small (at
most ``ONEHOT_MAX_LEVELS`` distinct values, checked exactly on the cluster)
come to the driver; high-cardinality columns are label-encoded through a
distributed dictionary and a join, never collected."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranking import with_position

# Fixed value: at most this many distinct values -> one-hot, more -> label code
ONEHOT_MAX_LEVELS = 100


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


@dataclass
class EncodingPlan:
    onehot: dict[str, list[str]] = field(default_factory=dict)  # column -> sorted levels
    label: list[str] = field(default_factory=list)


def plan_encoding(df: DataFrame, columns: Sequence[str] | None = None,
                  max_levels: int = ONEHOT_MAX_LEVELS) -> EncodingPlan:
    """Route every string column to one-hot or label encoding.

    Pass 1: ``approx_count_distinct`` for all columns in one aggregate (no
    expansion of the data). Pass 2: exact distinct (column, level) pairs for
    the columns that may be small, counted on the cluster. Pass 3: collect the
    levels of the columns that are exactly small (<= max_levels each)."""
    cols = list(columns) if columns is not None else categorical_columns(df)
    plan = EncodingPlan()
    if not cols:
        return plan
    approx = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`"), 0.02).alias(f"a{i}")
                      for i, c in enumerate(cols)]).first()
    # HLL error at 2 % rsd is far below a factor 2, so > 2x the threshold is certainly large
    maybe_small = [c for i, c in enumerate(cols) if approx[f"a{i}"] <= 2 * max_levels]
    exact: dict[str, int] = {}
    if maybe_small:
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("level"))
            for c in maybe_small])).alias("s")).select("s.column", "s.level").where(
            F.col("level").isNotNull()).distinct()
        exact = {r["column"]: r["n"] for r in
                 long.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        small = [c for c in maybe_small if exact.get(c, 0) <= max_levels]
        if small:
            rows = long.where(F.col("column").isin(small)).collect()  # <= max_levels per column
            levels: dict[str, list[str]] = {c: [] for c in small}
            for r in rows:
                levels[r["column"]].append(r["level"])
            for c in small:
                plan.onehot[c] = sorted(levels[c])
    plan.label = [c for c in cols if c not in plan.onehot]
    return plan


def onehot_columns(plan: EncodingPlan, drop_first: bool = True):
    """N2 projections: ``<col>_<level>`` as 0/1 double, levels ascending, the
    first level dropped; missing -> all zeros."""
    out = []
    for c, levels in plan.onehot.items():
        for v in (levels[1:] if drop_first else levels):
            out.append(F.coalesce(F.col(f"`{c}`") == F.lit(v), F.lit(False))
                       .cast("double").alias(f"{c}_{v}"))
    return out


def label_dictionary(df: DataFrame, column: str) -> DataFrame:
    """N3 dictionary ``(level, code)``: code = rank of the level among the
    sorted distinct values, from 0. Built with the distributed positional
    index (no single-partition window)."""
    levels = df.select(F.col(f"`{column}`").cast("string").alias("level")).where(
        F.col("level").isNotNull()).distinct()
    return with_position(levels, ["level"], name="code")


def apply_encoding(df: DataFrame, plan: EncodingPlan) -> DataFrame:
    """N2 + N3: label codes replace their column in place (as double); one-hot
    indicators are appended after all other columns, in column order."""
    out = df
    for c in plan.label:
        d = label_dictionary(df, c).withColumnRenamed("level", f"_lv_{c}").withColumnRenamed(
            "code", f"_code_{c}")
        # dictionary size grows with the level count: a join, not a broadcast literal
        out = out.join(d, F.col(f"`{c}`").cast("string") == F.col(f"_lv_{c}"), "left")
    keep = []
    for c in df.columns:
        if c in plan.onehot:
            continue
        if c in plan.label:
            keep.append(F.col(f"_code_{c}").cast("double").alias(c))
        else:
            keep.append(F.col(f"`{c}`"))
    return out.select(*keep, *onehot_columns(plan))


def encode(df: DataFrame, columns: Sequence[str] | None = None,
           max_levels: int = ONEHOT_MAX_LEVELS) -> tuple[DataFrame, EncodingPlan]:
    plan = plan_encoding(df, columns, max_levels)
    return apply_encoding(df, plan), plan


def minmax_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """N4 fit: one aggregate for all columns."""
    if not columns:
        return {}
    r = df.agg(*[F.min(F.col(f"`{c}`")).alias(f"mn{i}") for i, c in enumerate(columns)],
               *[F.max(F.col(f"`{c}`")).alias(f"mx{i}") for i, c in enumerate(columns)]).first()
    return {c: (r[f"mn{i}"], r[f"mx{i}"]) for i, c in enumerate(columns)}


def minmax_scale(df: DataFrame, columns: Sequence[str],
                 stats: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """``(x - min) / (max - min)``; a constant column becomes 0."""
    stats = stats if stats is not None else minmax_stats(df, columns)
    sel = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        if c in stats:
            mn, mx = stats[c]
            if mn is None:
                col = col.cast("double")
            elif mx == mn:
                col = F.when(col.isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
            else:
                col = (col.cast("double") - F.lit(float(mn))) / F.lit(float(mx - mn))
        sel.append(col.alias(c))
    return df.select(*sel)


def standard_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """N5 fit: mean and *population* std per column, one aggregate."""
    if not columns:
        return {}
    r = df.agg(*[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(columns)],
               *[F.stddev_pop(F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return {c: (r[f"m{i}"] or 0.0, r[f"s{i}"] or 0.0) for i, c in enumerate(columns)}


def standardise(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """N5 transform: ``(x - mean) / std``, std 0 -> divide by 1."""
    sel = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        if c in stats:
            m, s = stats[c]
            col = (col.cast("double") - F.lit(float(m))) / F.lit(float(s) if s else 1.0)
        sel.append(col.alias(c))
    return df.select(*sel)


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """Row count, min, max, mean and population std of the target."""
    t = F.col(f"`{target}`")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(t).alias("min"), F.max(t).alias("max"),
                  F.avg(t).alias("mean"), F.stddev_pop(t).alias("std"))
