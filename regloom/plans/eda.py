"""Exploratory profile of one raw table (E1-E7) and of every catalogued
dataset with failures isolated (E8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile as E
from ..operators import report as R
from ..session import materialize
from ..sources import io
from ..sources.catalog import DatasetSpec


def run_eda(df: DataFrame, target: str, bins: int = 50, top: int = 10) -> dict[str, DataFrame]:
    """Named profile tables of one raw table (lazy DataFrames). The target is
    coerced from text (``$``/``,`` removed) when needed, as the profile does."""
    out = {"columns": E.column_profile(df), "describe": E.describe(df)}
    if target in df.columns:
        out["target"] = E.target_summary(df, target)
        t = df.schema[target].dataType.simpleString()
        tcol = F.col(f"`{target}`")
        if t == "string":
            from ..functions.parse import regex_strip_to_number
            tcol = regex_strip_to_number(tcol)
        with_t = df.withColumn(target, tcol.cast("double"))
        out["target_histogram"] = R.histogram(with_t, target, bins)
        nums = E.numeric_columns(with_t)
        if len(nums) > 1:
            out["correlation"] = E.correlation_long(with_t, nums)
            out["top_correlated"] = E.top_correlated(with_t, target, top, nums)
    return out


def run_all_eda(spark: SparkSession, specs: list[DatasetSpec]) -> tuple[dict, DataFrame]:
    """Profile every dataset; a failing one is reported, not fatal.
    Returns ({dataset: tables}, status table)."""
    tables, status = {}, []
    for spec in specs:
        try:
            # the profile's many passes read a typed columnar copy, not the text
            raw = materialize(io.read_csv(spark, spec.raw_path), "raw")
            t = run_eda(raw, spec.target)
            t["columns"] = materialize(t["columns"], "columns")  # surfaces errors here, per dataset
            tables[spec.index] = t
            status.append((spec.index, "ok", None))
        except Exception as e:  # noqa: BLE001
            status.append((spec.index, "failed", f"{type(e).__name__}: {str(e)[:300]}"))
    return tables, spark.createDataFrame(status, "dataset int, status string, error string")
