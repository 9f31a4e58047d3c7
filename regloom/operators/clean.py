"""Column drops and per-dataset cleaning.

Every function is ``DataFrame -> DataFrame`` and lazy; each transformation is
guarded by "column present", so one cleaner accepts any
variant of its raw table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse as P


def drop_if_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the listed columns that exist; ignore the rest."""
    present = [n for n in names if n in df.columns]
    return df.drop(*present) if present else df


def drop_containing(df: DataFrame, fragment: str = "Unnamed") -> DataFrame:
    """Drop every column whose name contains ``fragment``."""
    return drop_if_present(df, [c for c in df.columns if fragment in c])


def _is_string(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def clean_retail(df: DataFrame) -> DataFrame:
    """Retail profit table - drop country and the two free-text names."""
    return drop_if_present(df, ["Country", "Customer Name", "Product Name"])


def clean_flight(df: DataFrame) -> DataFrame:
    """C4: flight price table - drop the flight code and index columns, parse
    ``price`` text such as ``25,612``."""
    df = drop_containing(drop_if_present(df, ["flight"]), "Unnamed")
    if "price" in df.columns:
        df = df.withColumn("price", P.thousands_to_number("price"))
    return df


def clean_obesity(df: DataFrame) -> DataFrame:
    """Obesity table - drop the class label (weight is the target)."""
    return drop_if_present(df, ["NObeyesdad"])


def clean_used_car(df: DataFrame, base_year: int = 2026) -> DataFrame:
    """Used-car table, C2 and C6-C15 in this order, as one
    projection. Derived columns are appended in the order they are created;
    ``model``, ``accident``, ``engine``, ``transmission`` and ``model_year``
    are consumed."""
    df = drop_containing(drop_if_present(df, ["model"]), "Unnamed")
    cols = {c: F.col(f"`{c}`") for c in df.columns}
    order = list(df.columns)
    if "milage" in cols:
        cols["milage"] = P.unit_to_number(cols["milage"], "mi.")
    if "price" in cols:
        cols["price"] = P.currency_to_number(cols["price"])
    if "clean_title" in cols:
        cols["clean_title"] = P.fill_text(cols["clean_title"], "No")
    if "accident" in cols:
        src = cols.pop("accident")
        order.remove("accident")
        cols["accident_reported"] = P.contains_flag(src, P.ACCIDENT_REPORTED, "unknown")
        cols["accident_none"] = P.contains_flag(src, P.ACCIDENT_NONE, "unknown")
        order += ["accident_reported", "accident_none"]
    for colour in ("ext_col", "int_col"):
        if colour in cols:
            cols[colour] = P.simplify_colour(cols[colour])
    if "engine" in cols:
        src = cols.pop("engine")
        order.remove("engine")
        cols["engine_hp"] = P.engine_hp(src)
        cols["engine_liters"] = P.engine_litres(src)
        order += ["engine_hp", "engine_liters"]
    if "transmission" in cols:
        src = cols.pop("transmission")
        order.remove("transmission")
        cols["trans_automatic"] = P.contains_flag(src, P.TRANS_AUTOMATIC, "other")
        cols["trans_manual"] = P.contains_flag(src, P.TRANS_MANUAL, "other")
        order += ["trans_automatic", "trans_manual"]
    if "model_year" in cols:
        src = cols.pop("model_year")
        order.remove("model_year")
        cols["car_age"] = P.age_from_year(src, base_year)
        order += ["car_age"]
    return df.select(*[cols[c].alias(c) for c in order])


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    """Rows whose target is missing (NULL or NaN) are removed."""
    t = F.col(f"`{target}`")
    cond = t.isNotNull()
    if isinstance(df.schema[target].dataType, (T.DoubleType, T.FloatType)):
        cond = cond & ~F.isnan(t)
    return df.where(cond)


def require_target(df: DataFrame, target: str) -> None:
    """C17: the target must survive cleaning."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found; columns: {df.columns}")
