"""Exploratory profile (E1-E7) as aggregates over the raw table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse as P
from .ranking import exact_quantiles

_NUM = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
        T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUM)]


def _v(df: DataFrame, c: str) -> Column:
    col = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return P.nan_to_null(col)
    return col


def column_profile(df: DataFrame) -> DataFrame:
    """``(position, column, dtype, n_rows, n_missing, n_distinct)``;
    distinct counts exclude missing values."""
    # a column at a time: one aggregate of all distinct counts would make a row
    # of every column's width for each value, and shuffle them together
    out = None
    for i, c in enumerate(df.columns):
        values = df.select(_v(df, c).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        n, missing = F.sum("n"), F.sum(F.when(F.col("v").isNull(), F.col("n")))
        one = values.agg(F.coalesce(n, F.lit(0)).alias("n_rows"), F.coalesce(missing, F.lit(0)).alias("n_missing"),
                         F.count("v").alias("n_distinct")).select(
            F.lit(i).alias("position"), F.lit(c).alias("column"),
            F.lit(df.schema[c].dataType.simpleString()).alias("dtype"), "n_rows", "n_missing", "n_distinct")
        out = one if out is None else out.unionByName(one)
    return out


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, exact 25/50/75 % (linear), max per
    numeric column, one row per column."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), _v(df, c).cast("double").alias("value"))
        for c in cols])).alias("s")).select("s.column", "s.value")
    basic = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], by=["column"],
                        names=["p25", "p50", "p75"])
    return basic.join(q, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def target_summary(df: DataFrame, target: str, coerce: bool = True) -> DataFrame:
    """E3 + E4: text target coerced (``$`` and ``,`` removed) when it is not
    numeric, then min, max, mean, exact median, sample std."""
    t = F.col(f"`{target}`")
    if coerce and isinstance(df.schema[target].dataType, T.StringType):
        t = P.regex_strip_to_number(t)
    base = df.select(P.nan_to_null(t.cast("double")).alias("t"))
    agg = base.agg(F.min("t").alias("min"), F.max("t").alias("max"), F.avg("t").alias("mean"),
                   F.stddev_samp("t").alias("std"), F.lit(0).alias("_g"))
    med = exact_quantiles(base, "t", [0.5], names=["median"]).withColumn("_g", F.lit(0))
    return agg.join(med, "_g", "left").select("min", "max", "mean", "median", "std")


def correlation_long(df: DataFrame, columns: Sequence[str] | None = None,
                     only: str | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlation of all numeric columns as a
    long table ``(col_a, col_b, corr)`` covering the full matrix, or just the
    row and column of ``only``. A constant column gives NULL (never an ANSI
    divide error).

    Two passes of plain sums (cheap, code-generated aggregates): pass 1 the
    column means, min and max; pass 2 sums of products of mean-shifted values
    (the shifted-data form keeps the moment differences accurate). Pairs with
    a column that has missing values use masks so each pair sees the rows where
    both are present."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    vals = {c: _v(df, c).cast("double") for c in cols}
    p1 = df.agg(*[F.avg(vals[c]).alias(f"m{i}") for i, c in enumerate(cols)],
                *[F.count(vals[c]).alias(f"n{i}") for i, c in enumerate(cols)],
                *[F.min(vals[c]).alias(f"lo{i}") for i, c in enumerate(cols)],
                *[F.max(vals[c]).alias(f"hi{i}") for i, c in enumerate(cols)],
                F.count(F.lit(1)).alias("_rows")).first()
    rows = p1["_rows"]
    shift = {c: (p1[f"m{i}"] or 0.0) for i, c in enumerate(cols)}
    complete = {c: p1[f"n{i}"] == rows for i, c in enumerate(cols)}
    constant = {c: p1[f"lo{i}"] is None or p1[f"lo{i}"] == p1[f"hi{i}"] for i, c in enumerate(cols)}
    # a projection of its own, so that the many sums below refer to columns
    shifted = df.select(*[(vals[c] - F.lit(float(shift[c]))).alias(f"v{i}") for i, c in enumerate(cols)])
    sh = {c: F.col(f"v{i}") for i, c in enumerate(cols)}
    aggs, pairs = [], {}
    # shared per-column sums for pairs of complete columns
    for i, c in enumerate(cols):
        aggs += [F.count(sh[c]).alias(f"c{i}"), F.sum(sh[c]).alias(f"s{i}"),
                 F.sum(sh[c] * sh[c]).alias(f"q{i}")]
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            b = cols[j]
            if only is not None and only not in (a, b):
                continue
            if complete[a] and complete[b]:
                aggs.append(F.sum(sh[a] * sh[b]).alias(f"x{i}_{j}"))
                pairs[(i, j)] = (f"c{i}", f"s{i}", f"s{j}", f"q{i}", f"q{j}", f"x{i}_{j}")
            else:
                ma = F.when(sh[b].isNotNull(), sh[a])
                mb = F.when(sh[a].isNotNull(), sh[b])
                names = tuple(f"{part}{i}_{j}" for part in ("pn", "pa", "pb", "pqa", "pqb", "x"))
                sums = (F.count(ma), F.sum(ma), F.sum(mb), F.sum(ma * ma), F.sum(mb * mb), F.sum(ma * mb))
                aggs += [x.alias(name) for x, name in zip(sums, names)]
                pairs[(i, j)] = names
    # one row of sums, as wide as the matrix: its last arithmetic is done here
    sums, entries = shifted.agg(*aggs).first(), []
    for (i, j), names in pairs.items():
        n, sa, sb, qa, qb, sxy = (sums[name] for name in names)
        r = None
        if n and not constant[cols[i]] and not constant[cols[j]]:
            spread = max(qa - sa * sa / n, 0.0) * max(qb - sb * sb / n, 0.0)
            if spread != 0:
                r = min(1.0, max(-1.0, (sxy - sa * sb / n) / math.sqrt(spread)))
        entries.append((cols[i], cols[j], r))
        if i != j:
            entries.append((cols[j], cols[i], r))
    return df.sparkSession.createDataFrame(entries, "col_a string, col_b string, corr double")


def top_correlated(df: DataFrame, target: str, k: int = 10,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """The ``k`` features with the largest absolute correlation to the
    target (target itself excluded, undefined correlations last)."""
    corr = correlation_long(df, columns, only=target)
    return (corr.where((F.col("col_a") == target) & (F.col("col_b") != target))
            .select(F.col("col_b").alias("feature"), "corr")
            .orderBy(F.abs("corr").desc_nulls_last(), F.col("feature"))
            .limit(k))
