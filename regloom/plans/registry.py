"""Query registry: every operator group as ``(spark, sf_dir) -> DataFrame``
plus the DuckDB SQL that computes the same table.

The test tables are TPC-H-like; each query first derives the shape its
operator needs (a prediction table, text columns to parse, missing values to
handle) with the same deterministic rule in both dialects, then runs the
operator over the whole table. Floating outputs are rounded to 6 decimals in
both dialects so summation order does not decide the comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import metrics as M
from ..operators import report as R
from ..session import TABLES, cut_lineage, load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def fixture(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    """Run a fixture SQL text on the parquet tables of ``sf``."""
    for t in TABLES:
        if t in sql:
            load(spark, sf, t).createOrReplaceTempView(t)
    return spark.sql(sql)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


# ---------------------------------------------------------------------------
# prediction table derived from lineitem (M*, R*, H8)
# ---------------------------------------------------------------------------

PRED_SQL = """pred AS (
  SELECT 'm' || CAST(l_orderkey % 4 AS VARCHAR) AS model,
         CAST(l_orderkey % 21 AS INTEGER) AS run,
         l_quantity * (1 - l_discount) * (1 + l_tax) {shift} AS y,
         l_quantity * (1 - l_discount) + (l_linenumber - 3) * 0.75 + (l_partkey % 7) * 0.25 {shift} AS p
  FROM lineitem)"""


def prediction_table(spark: SparkSession, sf: str, shift: float = 0.0) -> DataFrame:
    li = load(spark, sf, "lineitem")
    y = F.col("l_quantity") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    p = (F.col("l_quantity") * (1 - F.col("l_discount"))
         + (F.col("l_linenumber") - 3) * 0.75 + (F.col("l_partkey") % 7) * 0.25)
    if shift:
        y, p = y - shift, p - shift
    return li.select(
        F.concat(F.lit("m"), (F.col("l_orderkey") % 4).cast("string")).alias("model"),
        (F.col("l_orderkey") % 21).cast("int").alias("run"),
        y.alias("y"), p.alias("p"))


def _pred_cte(shift: float = 0.0) -> str:
    return PRED_SQL.format(shift=f"- {shift}" if shift else "")


def _metrics_select(keys: str) -> str:
    return f"""mins AS (SELECT {keys}, min(least(y, p)) AS mn FROM pred GROUP BY {keys}),
s AS (SELECT pred.*, CASE WHEN mn < 0 THEN abs(mn) + 1 ELSE 0.0 END AS sh
      FROM pred JOIN mins USING ({keys})),
agg AS (
  SELECT {keys},
    avg((y - p) * (y - p)) AS "MSE",
    sqrt(avg((y - p) * (y - p))) AS "RMSE",
    avg(abs(y - p)) AS "MAE",
    CASE WHEN var_pop(y) * count(*) = 0
         THEN CASE WHEN sum((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END
         ELSE 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END AS "R2",
    avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100 AS "MAPE",
    median(abs(y - p)) AS "MedAE",
    max(abs(y - p)) AS "MaxError",
    CASE WHEN var_pop(y) = 0
         THEN CASE WHEN var_pop(y - p) = 0 THEN 1.0 ELSE 0.0 END
         ELSE 1 - var_pop(y - p) / var_pop(y) END AS "EVS",
    sqrt(avg((ln(1 + greatest(y + sh, 0)) - ln(1 + greatest(p + sh, 0)))
           * (ln(1 + greatest(y + sh, 0)) - ln(1 + greatest(p + sh, 0))))) AS "RMSLE"
  FROM s GROUP BY {keys})"""


def _round_all(cols: list[str], digits: int = 6) -> str:
    return ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in cols)


def runs_table(spark: SparkSession, sf: str) -> DataFrame:
    """Run table (model, run, nine metrics) derived from the prediction table;
    written once (checkpoint), as the study writes its run table, because
    every report reads it more than once."""
    return cut_lineage(M.regression_metrics(prediction_table(spark, sf), by=["model", "run"]))


RUNS_CTE = f"WITH {_pred_cte()},\n{_metrics_select('model, run')},\nruns AS (SELECT * FROM agg)"


@register("m10_metrics_by_run", f"""WITH {_pred_cte()},
{_metrics_select('model, run')}
SELECT model, run, {_round_all(M.METRICS)} FROM agg""")
def q_metrics(spark, sf):
    return rounded(runs_table(spark, sf))


@register("m10_metrics_negative_shift", f"""WITH {_pred_cte(20.0)},
{_metrics_select('model')}
SELECT model, {_round_all(M.METRICS)} FROM agg""")
def q_metrics_neg(spark, sf):
    return rounded(M.regression_metrics(prediction_table(spark, sf, 20.0), by=["model"]))


def _long_runs_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT model, '{m}' AS metric, CAST(\"{m}\" AS DOUBLE) AS value FROM runs"
        for m in M.METRICS)


@register("r1_aggregate_runs", f"""{RUNS_CTE},
lg AS ({_long_runs_sql()})
SELECT model, metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
       round(median(value), 6) AS median, round(min(value), 6) AS min, round(max(value), 6) AS max
FROM lg GROUP BY model, metric""")
def q_aggregate_runs(spark, sf):
    return rounded(R.aggregate_runs(runs_table(spark, sf), by=["model"]))


def _summary_sql(keys: str) -> str:
    cols = ", ".join(f'round(avg("{m}"), 6) AS "{m}_mean", round(stddev_samp("{m}"), 6) AS "{m}_std"'
                     for m in M.METRICS)
    return f"SELECT {keys}, {cols} FROM runs GROUP BY {keys}"


@register("r2_summary_by_model", f"{RUNS_CTE}\n{_summary_sql('model')}")
def q_summary(spark, sf):
    return rounded(R.summarise(runs_table(spark, sf), by=["model"]))


@register("r3_global_summary", f"""WITH {_pred_cte()},
{_metrics_select('model, run')},
a AS (SELECT 'base' AS dataset, * FROM agg),
pred2 AS (SELECT model, run, y - 20.0 AS y, p - 20.0 AS p FROM pred),
mins2 AS (SELECT model, run, min(least(y, p)) AS mn FROM pred2 GROUP BY model, run),
s2 AS (SELECT pred2.*, CASE WHEN mn < 0 THEN abs(mn) + 1 ELSE 0.0 END AS sh
       FROM pred2 JOIN mins2 USING (model, run)),
b AS (
  SELECT 'shifted' AS dataset, model, run,
    avg((y - p) * (y - p)) AS "MSE", sqrt(avg((y - p) * (y - p))) AS "RMSE", avg(abs(y - p)) AS "MAE",
    CASE WHEN var_pop(y) * count(*) = 0 THEN CASE WHEN sum((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END
         ELSE 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END AS "R2",
    avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100 AS "MAPE",
    median(abs(y - p)) AS "MedAE", max(abs(y - p)) AS "MaxError",
    CASE WHEN var_pop(y) = 0 THEN CASE WHEN var_pop(y - p) = 0 THEN 1.0 ELSE 0.0 END
         ELSE 1 - var_pop(y - p) / var_pop(y) END AS "EVS",
    sqrt(avg((ln(1 + greatest(y + sh, 0)) - ln(1 + greatest(p + sh, 0)))
           * (ln(1 + greatest(y + sh, 0)) - ln(1 + greatest(p + sh, 0))))) AS "RMSLE"
  FROM s2 GROUP BY model, run),
runs AS (SELECT * FROM a UNION ALL SELECT * FROM b)
{_summary_sql('dataset, model')}""")
def q_global_summary(spark, sf):
    a = runs_table(spark, sf).withColumn("dataset", F.lit("base"))
    b = M.regression_metrics(prediction_table(spark, sf, 20.0), by=["model", "run"]).withColumn(
        "dataset", F.lit("shifted"))
    return rounded(R.summarise(a.unionByName(b), by=["dataset", "model"]))


@register("r4_metric_matrix", f"""{RUNS_CTE}
SELECT model, {", ".join(f'round(avg("{m}"), 6) AS "{m}"' for m in M.METRICS)} FROM runs GROUP BY model""")
def q_matrix(spark, sf):
    return rounded(R.metric_matrix(runs_table(spark, sf)))


@register("r5_bar_rmse", f"""{RUNS_CTE}
SELECT model, round(avg("RMSE"), 6) AS mean, round(stddev_samp("RMSE"), 6) AS std FROM runs GROUP BY model""")
def q_bar(spark, sf):
    return rounded(R.bar_stats(runs_table(spark, sf), "RMSE"))


@register("r6_box_mae", f"""{RUNS_CTE},
q AS (SELECT model, quantile_cont("MAE", 0.25) AS q1, quantile_cont("MAE", 0.5) AS median,
             quantile_cont("MAE", 0.75) AS q3 FROM runs GROUP BY model),
j AS (SELECT runs.model, "MAE" AS v, q1, median, q3,
             ("MAE" >= q1 - 1.5 * (q3 - q1) AND "MAE" <= q3 + 1.5 * (q3 - q1)) AS inside
      FROM runs JOIN q USING (model))
SELECT model, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(CASE WHEN inside THEN v END), 6) AS whisker_lo,
       round(max(CASE WHEN inside THEN v END), 6) AS whisker_hi,
       count(CASE WHEN NOT inside THEN 1 END) AS n_outliers
FROM j GROUP BY model, q1, median, q3""")
def q_box(spark, sf):
    return rounded(R.box_stats(runs_table(spark, sf), "MAE"))


@register("r6_box_outliers", f"""{RUNS_CTE},
l AS ({" UNION ALL ".join(f"SELECT model, '{m}' AS metric, \"{m}\" AS v FROM runs" for m in M.METRICS)}),
q AS (SELECT model, metric, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM l GROUP BY model, metric)
SELECT model, metric, round(v, 6) AS value FROM l JOIN q USING (model, metric)
WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)""")
def q_outliers(spark, sf):
    runs = cut_lineage(runs_table(spark, sf))
    out = None
    for m in M.METRICS:
        own = R.box_outliers(runs, m).select("model", F.lit(m).alias("metric"), "value")
        out = own if out is None else out.unionByName(own)
    return rounded(out)


def _box_sql(m: str) -> str:
    inside = f'"{m}" >= q1 - 1.5 * (q3 - q1) AND "{m}" <= q3 + 1.5 * (q3 - q1)'
    return f"""SELECT model, q1, median, q3, min(CASE WHEN {inside} THEN "{m}" END) AS whisker_lo,
      max(CASE WHEN {inside} THEN "{m}" END) AS whisker_hi, count(CASE WHEN NOT ({inside}) THEN 1 END)::DOUBLE AS n_outliers
    FROM runs JOIN (SELECT model, quantile_cont("{m}", 0.25) AS q1, quantile_cont("{m}", 0.5) AS median,
      quantile_cont("{m}", 0.75) AS q3 FROM runs GROUP BY model) USING (model) GROUP BY model, q1, median, q3"""


_BOX = ("q1", "median", "q3", "whisker_lo", "whisker_hi", "n_outliers")


@register("r9_report_tables", f"""{RUNS_CTE}
{" UNION ALL ".join(
    [f"SELECT 'bar' AS report, '{m.lower()}' AS metric, model, '{s}' AS statistic, round({f}(\"{m}\"), 6) AS value FROM runs GROUP BY model"
     for m in ("RMSE", "MAE", "R2", "MAPE") for s, f in (("mean", "avg"), ("std", "stddev_samp"))]
    + [f"SELECT 'box', '{m.lower()}', model, '{s}', round({s}, 6) FROM ({_box_sql(m)})"
       for m in ("RMSE", "MAE", "R2", "MAPE") for s in _BOX]
    + [f"SELECT 'heatmap', 'metrics', model, '{m}', round(avg(\"{m}\"), 6) FROM runs GROUP BY model" for m in M.METRICS])}""")
def q_report_tables(spark, sf):
    return rounded(R.report_long(cut_lineage(runs_table(spark, sf))))


def _hist_sql(src: str, value: str, keys: str | None, bins: int = 50) -> str:
    k = f"{keys}, " if keys else ""
    on = f"USING ({keys}, bin)" if keys else "USING (bin)"
    gb = f"GROUP BY {keys}" if keys else ""
    join_r = f"JOIN r USING ({keys})" if keys else ", r"
    return f"""base AS (SELECT {k}CAST({value} AS DOUBLE) AS v FROM {src} WHERE {value} IS NOT NULL AND NOT isnan({value})),
r0 AS (SELECT {k}min(v) AS mn, max(v) AS mx FROM base {gb}),
r AS (SELECT {k}CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
             CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM r0),
c AS (SELECT {k}CAST(least(floor((v - lo) * {bins} / (hi - lo)), {bins - 1}) AS INTEGER) AS bin, count(*) AS cnt
      FROM base {join_r} GROUP BY ALL),
g AS (SELECT {k}lo, hi, CAST(unnest(range(0, {bins})) AS INTEGER) AS bin FROM r)
SELECT {k}bin, round(lo + bin * (hi - lo) / {bins}, 6) AS lo, round(lo + (bin + 1) * (hi - lo) / {bins}, 6) AS hi,
       coalesce(cnt, 0) AS count
FROM g LEFT JOIN c {on}"""


@register("r7_residual_histogram", f"""WITH {_pred_cte()},
res AS (SELECT model, y - p AS residual FROM pred),
{_hist_sql('res', 'residual', 'model')}""")
def q_residual_hist(spark, sf):
    res = R.residuals(prediction_table(spark, sf))
    return rounded(R.histogram(res, "residual", 50, by=["model"]))


@register("e5_target_histogram", f"""WITH {_hist_sql('events', 'value', None)}""")
def q_target_hist(spark, sf):
    return rounded(R.histogram(load(spark, sf, "events"), "value", 50))


@register("r8_axis_limits", f"""WITH {_pred_cte()}
SELECT model, round(least(min(y), min(p)), 6) AS lo, round(greatest(max(y), max(p)), 6) AS hi
FROM pred GROUP BY model""")
def q_axis(spark, sf):
    return rounded(R.axis_limits(prediction_table(spark, sf), by=["model"]))


@register("h8_convergence", f"""{RUNS_CTE}
SELECT model, run AS trial, round("RMSE", 6) AS value,
       round(min("RMSE") OVER (PARTITION BY model ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6)
         AS best_so_far
FROM runs""")
def q_convergence(spark, sf):
    trials = runs_table(spark, sf).select("model", F.col("run").alias("trial"),
                                          F.col("RMSE").alias("value"))
    return rounded(R.convergence(trials, by=["model"]))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Per-order feature table -> hash hold-out -> RBF network (k-means
    centres, Gram ridge) -> nine test metrics."""
    return q_models.q_single_run(spark, sf)


# further query groups register themselves on import
from . import q_models, q_prep, q_split  # noqa: E402,F401
