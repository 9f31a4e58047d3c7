"""Run aggregation and report tables (R1-R8, H8, E5 histogram).

These are the tables behind the study's figures; no image is drawn."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import small_side
from .metrics import METRICS
from .ranking import exact_quantiles


def _present(df: DataFrame, metrics: Sequence[str] | None) -> list[str]:
    return [m for m in (metrics or METRICS) if m in df.columns]


def _nan_to_null(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def long_runs(runs: DataFrame, ids: Sequence[str], metrics: Sequence[str] | None = None) -> DataFrame:
    """Wide run table -> ``(ids..., metric, value)`` with NaN as NULL."""
    ms = _present(runs, metrics)
    wide = runs.select(*ids, *[_nan_to_null(m).alias(m) for m in ms])
    return wide.unpivot(list(ids), ms, "metric", "value")


def aggregate_runs(runs: DataFrame, by: Sequence[str] = ("model",),
                   metrics: Sequence[str] | None = None, runs_bounded: bool = True) -> DataFrame:
    """Per group and metric: mean, population std, exact median, min, max
    over the runs, missing values skipped (a metric whose runs are all missing
    keeps its row with NULL statistics).

    A run table holds at most ``n_runs`` rows per (model, metric) - a study
    parameter, not a data size - so by default the median is Spark's exact
    ``percentile`` inside the same aggregate. ``runs_bounded=False`` uses the
    distributed positional quantile for tables whose groups grow with data."""
    keys = list(by) + ["metric"]
    lg = long_runs(runs, list(by), metrics)
    aggs = [F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
            F.min("value").alias("min"), F.max("value").alias("max")]
    if runs_bounded:
        stats = lg.groupBy(*keys).agg(*aggs, F.percentile("value", 0.5).alias("median"))
        return stats.select(*keys, "mean", "std", "median", "min", "max")
    stats = lg.groupBy(*keys).agg(*aggs)
    med = exact_quantiles(lg, "value", [0.5], by=keys, names=["median"])
    return stats.join(med, keys, "left").select(*keys, "mean", "std", "median", "min", "max")


def summarise(runs: DataFrame, by: Sequence[str] = ("model",),
              metrics: Sequence[str] | None = None) -> DataFrame:
    """``<metric>_mean`` and ``<metric>_std`` (sample std) per group,
    missing values dropped per column."""
    ms = _present(runs, metrics)
    aggs = []
    for m in ms:
        v = _nan_to_null(m)
        aggs += [F.avg(v).alias(f"{m}_mean"), F.stddev_samp(v).alias(f"{m}_std")]
    return runs.groupBy(*by).agg(*aggs)


def metric_matrix(runs: DataFrame, by: Sequence[str] = ("model",),
                  metrics: Sequence[str] | None = None) -> DataFrame:
    """Mean of every available metric per model (heat-map table)."""
    ms = _present(runs, metrics)
    return runs.groupBy(*by).agg(*[F.avg(_nan_to_null(m)).alias(m) for m in ms])


def bar_stats(runs: DataFrame, metric: str, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and sample std of one metric per model."""
    v = _nan_to_null(metric)
    return runs.groupBy(*by).agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))


def box_stats(runs: DataFrame, metric: str, by: Sequence[str] = ("model",),
              whis: float = 1.5, runs_bounded: bool = True) -> DataFrame:
    """Quartiles, whiskers (most extreme values inside ``whis``·IQR
    fences) and outlier count per model, as a box plot draws them. Quartiles
    as in ``aggregate_runs`` (bounded run groups: exact ``percentile``)."""
    keys = list(by)
    v = runs.select(*keys, _nan_to_null(metric).alias("_v")).where(F.col("_v").isNotNull())
    if runs_bounded:
        q = v.groupBy(*keys).agg(F.percentile("_v", [0.25, 0.5, 0.75]).alias("_q")).select(
            *keys, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
            F.col("_q")[2].alias("q3"))
    else:
        q = exact_quantiles(v, "_v", [0.25, 0.5, 0.75], by=keys, names=["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    lo_f = F.col("q1") - F.lit(whis) * iqr
    hi_f = F.col("q3") + F.lit(whis) * iqr
    inside = (F.col("_v") >= lo_f) & (F.col("_v") <= hi_f)
    w = v.join(q, keys).groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_hi"),
        F.count(F.when(~inside, F.lit(1))).alias("n_outliers"),
    )
    return w


def box_outliers(runs: DataFrame, metric: str, by: Sequence[str] = ("model",),
                 whis: float = 1.5, runs_bounded: bool = True) -> DataFrame:
    """The rows that a box plot draws as single points: (by..., value) of
    each run outside the fences of its group. Repeated values stay."""
    keys = list(by)
    v = runs.select(*keys, _nan_to_null(metric).alias("value")).where(F.col("value").isNotNull())
    box = small_side(box_stats(runs, metric, by, whis, runs_bounded).select(*keys, "q1", "q3"))
    reach = F.lit(whis) * (F.col("q3") - F.col("q1"))
    outside = (F.col("value") < F.col("q1") - reach) | (F.col("value") > F.col("q3") + reach)
    return v.join(box, keys).where(outside).select(*keys, "value")


def report_long(runs: DataFrame, by: Sequence[str] = ("model",),
                metrics: Sequence[str] = ("RMSE", "MAE", "R2", "MAPE")) -> DataFrame:
    """R9 as one table (report, metric, by..., statistic, value): the bars and
    boxes of the headline metrics that are there, and the mean of every metric."""
    keys, out = list(by), None
    for name, table in report_set(runs, by, metrics).items():
        kind, _, metric = name.partition("_")
        shown = table.select(*keys, *[F.col(c).cast("double").alias(c) for c in table.columns if c not in keys])
        long = shown.unpivot(keys, [c for c in shown.columns if c not in keys], "statistic", "value").select(
            F.lit(kind).alias("report"), F.lit(metric).alias("metric"), *keys, "statistic", "value")
        out = long if out is None else out.unionByName(long)
    return out


def histogram(df: DataFrame, value: str | Column, bins: int = 50,
              by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram over ``[min, max]`` with the last bin
    closed on the right; a constant column uses ``[v-0.5, v+0.5]``. Empty
    bins are kept (count 0). Output: by..., bin, lo, hi, count."""
    keys = list(by)
    grouped = bool(keys)
    keys = keys if grouped else ["_g"]
    v = F.col(value) if isinstance(value, str) else value
    base = df.select(*([F.col(k) for k in by] if grouped else [F.lit(0).alias("_g")]),
                     _nan_to_null(v).alias("_v")).where(F.col("_v").isNotNull())
    rng = base.groupBy(*keys).agg(F.min("_v").alias("_mn"), F.max("_v").alias("_mx"))
    rng = rng.select(
        *keys,
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"),
    )
    rng = small_side(rng)
    b = F.least(F.floor((F.col("_v") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))),
                F.lit(bins - 1)).cast("int")
    counts = base.join(rng, keys).groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    # every bin of every group, counted or not: groups x bins rows, derived from the data
    grid = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("_hi") - F.col("_lo")) / bins
    out = grid.join(counts, keys + ["bin"], "left").select(
        *keys, "bin",
        (F.col("_lo") + F.col("bin") * width).alias("lo"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"),
    )
    return out if grouped else out.drop("_g")


def residuals(pred: DataFrame, label: str = "y", prediction: str = "p") -> DataFrame:
    """Real minus predicted."""
    return pred.withColumn("residual", F.col(label) - F.col(prediction))


def axis_limits(pred: DataFrame, label: str = "y", prediction: str = "p",
                by: Sequence[str] = ()) -> DataFrame:
    """Common lower/upper limit of actual and predicted values."""
    return pred.groupBy(*by).agg(
        F.least(F.min(label), F.min(prediction)).alias("lo"),
        F.greatest(F.max(label), F.max(prediction)).alias("hi"),
    )


def convergence(trials: DataFrame, by: Sequence[str] = (), trial: str = "trial",
                value: str = "value") -> DataFrame:
    """H8: best value so far in trial order; missing values skipped, +inf
    before the first finished trial. One window partition per study, whose
    size is the trial budget of that study."""
    w = Window.partitionBy(*by).orderBy(trial).rowsBetween(Window.unboundedPreceding, 0)
    return trials.withColumn(
        "best_so_far", F.coalesce(F.min(_nan_to_null(value)).over(w), F.lit(float("inf"))))


def report_set(runs: DataFrame, by: Sequence[str] = ("model",),
               metrics: Sequence[str] = ("RMSE", "MAE", "R2", "MAPE")) -> dict[str, DataFrame]:
    """Bar and box tables for the four headline metrics present, plus the
    mean-metric matrix, as named DataFrames."""
    out: dict[str, DataFrame] = {}
    for m in metrics:
        if m in runs.columns:
            out[f"bar_{m.lower()}"] = bar_stats(runs, m, by)
            out[f"box_{m.lower()}"] = box_stats(runs, m, by)
    if _present(runs, None):
        out["heatmap_metrics"] = metric_matrix(runs, by)
    return out
