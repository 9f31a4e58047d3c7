"""Duplicates and the missing-value policy.

Two small eager aggregates (profile, then fill statistics) feed driver-side
decisions; the result is one lazy projection + filter over the input."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranking import exact_quantiles

# Policy thresholds (fraction of rows after de-duplication)
DROP_COLUMN_ABOVE = 0.50   # strictly more missing -> column dropped
DROP_ROWS_AT_MOST = 0.05   # this or less missing -> rows dropped
# in between -> median (numeric) or mode (other types) fill

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType, T.BooleanType)


def dedupe(df: DataFrame) -> DataFrame:
    """Exact duplicate rows removed (NULL equals NULL). Partial
    aggregation removes copies map-side, so a hot duplicated row does not
    travel to one reducer in full."""
    return df.dropDuplicates()


def is_missing(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def missing_profile(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """``(column, n_missing, pct)`` - one aggregate over all columns,
    pct over the row count; by default only columns with a missing value."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_n")] + [
        F.sum(is_missing(df, c).cast("long")).alias(f"m{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"),
                 F.coalesce(F.col(f"m{i}"), F.lit(0)).alias("n_missing"))
        for i, c in enumerate(cols)]))
    prof = wide.select("_n", stack.alias("s")).select(
        "s.column", "s.position", "s.n_missing",
        F.try_divide(F.col("s.n_missing").cast("double"), F.col("_n")).alias("pct"))
    return prof.where(F.col("n_missing") > 0) if only_missing else prof


@dataclass
class MissingPlan:
    drop_columns: list[str] = field(default_factory=list)
    drop_row_columns: list[str] = field(default_factory=list)
    fill_values: dict[str, object] = field(default_factory=dict)
    report: list[tuple[str, int, float, str]] = field(default_factory=list)


def plan_missing(df: DataFrame, drop_column_above: float = DROP_COLUMN_ABOVE,
                 drop_rows_at_most: float = DROP_ROWS_AT_MOST,
                 protect: tuple[str, ...] = ()) -> MissingPlan:
    """D3-D6 decisions. Fill statistics are computed over every row,
    including rows a <=5 % column will remove afterwards."""
    plan = MissingPlan()
    prof = missing_profile(df).orderBy("position").collect()  # one row per column
    medians, modes = [], []
    for r in prof:
        if r["pct"] > drop_column_above and r["column"] not in protect:
            plan.drop_columns.append(r["column"])
            action = "drop column"
        elif r["pct"] <= drop_rows_at_most:
            plan.drop_row_columns.append(r["column"])
            action = "drop rows"
        elif isinstance(df.schema[r["column"]].dataType, _NUMERIC):
            medians.append(r["column"])
            action = "median fill"
        else:
            modes.append(r["column"])
            action = "mode fill"
        plan.report.append((r["column"], r["n_missing"], r["pct"], action))
    if medians:
        # all medians in one distributed pass: long (column, value) table
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"),
                     F.col(f"`{c}`").cast("double").alias("value")) for c in medians])).alias("s")
        ).select("s.column", "s.value")
        for r in exact_quantiles(long, "value", [0.5], by=["column"], names=["median"]).collect():
            plan.fill_values[r["column"]] = r["median"]
    if modes:
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"),
                     F.col(f"`{c}`").cast("string").alias("value")) for c in modes])).alias("s")
        ).select("s.column", "s.value").where(F.col("value").isNotNull())
        counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
        # most frequent value, ties -> smallest value; bounded per-column state
        best = counts.groupBy("column").agg(
            F.min_by("value", F.struct((-F.col("cnt")).alias("k"), F.col("value"))).alias("mode"))
        found = {r["column"]: r["mode"] for r in best.collect()}
        for c in modes:
            plan.fill_values[c] = found.get(c, "unknown")
    return plan


def apply_missing(df: DataFrame, plan: MissingPlan) -> DataFrame:
    """D7 application: drop columns, fill, then drop rows (one projection and
    one filter)."""
    out = df.drop(*plan.drop_columns) if plan.drop_columns else df
    sel = []
    for c in out.columns:
        col = F.col(f"`{c}`")
        if c in plan.fill_values:
            v = plan.fill_values[c]
            if isinstance(out.schema[c].dataType, (T.DoubleType, T.FloatType)):
                col = F.coalesce(F.nanvl(col, F.lit(None).cast("double")), F.lit(v))
            elif isinstance(v, str):
                col = F.coalesce(col.cast("string"), F.lit(v))
            else:
                col = F.coalesce(col.cast("double"), F.lit(float(v)))
        sel.append(col.alias(c))
    out = out.select(*sel)
    if plan.drop_row_columns:
        keep = None
        for c in plan.drop_row_columns:
            ok = ~is_missing(out, c)
            keep = ok if keep is None else keep & ok
        out = out.where(keep)
    return out


def handle_missing(df: DataFrame, **kw) -> tuple[DataFrame, MissingPlan]:
    """Profile -> decisions -> lazy application."""
    plan = plan_missing(df, **kw)
    return apply_missing(df, plan), plan
