"""Regression metrics (M1-M10) as grouped Spark aggregates.

All nine metrics for every ``by`` group come out of two aggregation passes
(the RMSLE shift needs each group's minimum first) plus the exact median of
absolute errors. Every aggregate is algebraic (partial aggregation before the
shuffle), so a hot model/run group costs no more than its share of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, small_side
from .ranking import exact_quantiles

# fixed metric names and order of the run tables
METRICS = ["MSE", "RMSE", "MAE", "R2", "MAPE", "MedAE", "MaxError", "EVS", "RMSLE"]


def _finite_ratio_score(num, den):
    """1 - num/den with the 'force finite' rule: den == 0 -> 1 if num == 0 else 0."""
    return (F.when(den == 0, F.when(num == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
            .otherwise(F.lit(1.0) - F.try_divide(num, den)))


def regression_metrics(df: DataFrame, label: str = "y", prediction: str = "p",
                       by: Sequence[str] = (), materialize: bool = False) -> DataFrame:
    """One row per ``by`` group with the nine metric columns of ``METRICS``.

    Semantics: R2/EVS use population variances and return 1 (perfect) or 0
    for a constant label; MAPE is a percentage over rows with label != 0
    (NULL when none); RMSLE shifts both columns by ``|min|+1`` when the group
    minimum of either column is negative, then clips at 0.

    ``materialize`` checkpoints the ``(by, y, p)`` projection first, so an
    expensive prediction (a model transform) is evaluated once for the
    several passes instead of once per pass."""
    grouped = bool(by)
    # one struct key keeps groups whose key fields are NULL through the joins
    keys = ["_grp"] if grouped else ["_g"]
    base = df.select((F.struct(*[F.col(b) for b in by]) if grouped else F.lit(0)).alias(keys[0]),
                     F.col(label).cast("double").alias("_y"),
                     F.col(prediction).cast("double").alias("_p"))
    if materialize:
        base = cut_lineage(base)
    least = F.min(F.least("_y", "_p"))
    if grouped:
        shift = F.when(least < 0, F.abs(least) + 1).otherwise(F.lit(0.0))
        shifted = base.join(small_side(base.groupBy(*keys).agg(shift.alias("_shift"))), keys)
    else:
        low = base.agg(least).first()[0]
        shifted = base.withColumn("_shift", F.lit(abs(low) + 1.0 if low is not None and low < 0 else 0.0))
    e = F.col("_y") - F.col("_p")
    ly = F.log1p(F.greatest(F.col("_y") + F.col("_shift"), F.lit(0.0)))
    lp = F.log1p(F.greatest(F.col("_p") + F.col("_shift"), F.lit(0.0)))
    agg = (
        shifted.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.avg(e * e).alias("MSE"),
            F.avg(F.abs(e)).alias("MAE"),
            F.max(F.abs(e)).alias("MaxError"),
            F.sum(e * e).alias("_sse"),
            F.var_pop("_y").alias("_vy"),
            F.var_pop(e).alias("_ve"),
            (F.avg(F.when(F.col("_y") != 0, F.abs(e / F.col("_y")))) * 100).alias("MAPE"),
            F.sqrt(F.avg((ly - lp) * (ly - lp))).alias("RMSLE"),
        )
    )
    medae = exact_quantiles(base.withColumn("_ae", F.abs(e)), "_ae", [0.5], by=keys,
                            names=["MedAE"])
    out = agg.join(medae, keys, "left").select(
        *keys,
        F.col("MSE"),
        F.sqrt("MSE").alias("RMSE"),
        F.col("MAE"),
        _finite_ratio_score(F.col("_sse"), F.col("_vy") * F.col("_n")).alias("R2"),
        F.col("MAPE"),
        F.col("MedAE"),
        F.col("MaxError"),
        _finite_ratio_score(F.col("_ve"), F.col("_vy")).alias("EVS"),
        F.col("RMSLE"),
    )
    if not grouped:
        return out.drop("_g")
    return out.select(*[F.col(f"_grp.`{b}`").alias(b) for b in by], *METRICS)


def rmse(df: DataFrame, label: str = "y", prediction: str = "p") -> float | None:
    """Single RMSE to the driver (used by the search loop)."""
    e = F.col(label) - F.col(prediction)
    row = df.agg(F.sqrt(F.avg(e * e)).alias("rmse")).first()
    return None if row is None else row["rmse"]
