"""Registered queries for the model operators (B*, A*, F*, G1, L*, H*) and
the result sinks (S8, S10, R10).

Kernels with fixed parameters are plain SQL in DuckDB; fits are iterative
(rows-only in the driver's check, NumPy-checked in tests). The modelling
table is a per-order feature table: lineitem aggregated per order, joined to
orders and customer, categorical columns encoded and min-max scaled."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..models import numerics as NP
from ..models.anfis import ANFISRegressor, ask_premises, init_premises, select_by_correlation
from ..models.base import ScaledRegressor
from ..models.fcm import FCMNetworkRegressor
from ..models.mlp import MLPModel, MLPRegressor
from ..models.rbf import RBFRegressor, centre_widths
from ..models.scans import TrainingTable, fold_grams, ridge_path, serve
from ..operators import encode as N
from ..operators import gram as G
from ..operators import metrics as M
from ..operators import report as R
from ..operators import split as S
from ..session import load, materialize
from ..sources import io
from . import search, spaces, study
from .registry import RUNS_CTE, fixture, register, rounded, runs_table

# ---------------------------------------------------------------------------
# kernels with fixed parameters on part
# ---------------------------------------------------------------------------

PART_X = """SELECT p_partkey, CAST(p_size - 25 AS DOUBLE) / 15 AS x1, (p_retailprice - 1500) / 300 AS x2 FROM part"""
CENTRES = np.array([[-1.0, -0.5], [0.0, 0.5], [1.0, 0.0]])
SIGMAS = [0.8, 1.0, 1.2]
THETA_RBF = [2.0, -1.0, 0.5, 3.0]


def _sqd_sql(c) -> str:
    return f"((x1 - ({c[0]})) * (x1 - ({c[0]})) + (x2 - ({c[1]})) * (x2 - ({c[1]})))"


def _x():
    return [F.col("x1"), F.col("x2")]


@register("b3_rbf_activation", f"""WITH t AS ({PART_X})
SELECT p_partkey, {", ".join(f"round(exp(-{_sqd_sql(c)} / (2 * {s} * {s})), 6) AS a{i}"
                             for i, (c, s) in enumerate(zip(CENTRES, SIGMAS)))},
  round({" + ".join(f"exp(-{_sqd_sql(c)} / (2 * {s} * {s})) * ({w})" for c, s, w in zip(CENTRES, SIGMAS, THETA_RBF))}
        + ({THETA_RBF[-1]}), 6) AS prediction
FROM t""")
def q_rbf_act(spark, sf):
    t = fixture(spark, sf, PART_X)
    acts = K.rbf_activations(_x(), CENTRES, SIGMAS)
    pred = K.linear(acts, THETA_RBF)
    return rounded(t.select("p_partkey", *[a.alias(f"a{i}") for i, a in enumerate(acts[:-1])],
                            pred.alias("prediction")))


@register("a4_a6_membership_shapes", f"""WITH t AS ({PART_X})
SELECT p_partkey,
  round(least(1.0, greatest(1e-10, exp(-((x1 - 0.2) * (x1 - 0.2)) / (2 * 0.7 * 0.7 + 1e-10)))), 6) AS gaussian,
  round(least(1.0, greatest(1e-10, 1.0 / (1.0 + power((x1 - 0.2) / (0.7 + 1e-10), 4.0) + 1e-10))), 6) AS bell,
  round(least(1.0, greatest(1e-10, greatest(0.0, least((x1 - (-0.8)) / (0.2 - (-0.8) + 1e-10),
                                                      (1.2 - x1) / (1.2 - 0.2 + 1e-10))))), 6) AS triangular
FROM t""")
def q_mf_shapes(spark, sf):
    t = fixture(spark, sf, PART_X)
    x = F.col("x1")
    return rounded(t.select(
        "p_partkey",
        K.clamp_mf(K.gaussian_mf(x, 0.2, 0.7)).alias("gaussian"),
        K.clamp_mf(K.bell_mf(x, 0.2, 0.7, 2.0)).alias("bell"),
        K.clamp_mf(K.triangular_mf(x, -0.8, 0.2, 1.2)).alias("triangular")))


ANFIS_PRM = {"centers": np.array([[-1.0, 1.0], [-0.5, 0.5]]),
             "sigmas": np.array([[0.9, 1.1], [0.6, 0.8]])}
ANFIS_THETA = np.array([1.0, 0.5, -0.2, 2.0, -1.0, 0.1, 0.3, -0.5, 0.7, 0.0, 1.5, 0.25])


def _anfis_sql() -> str:
    mus = {}
    for j, xn in enumerate(["x1", "x2"]):
        for k in range(2):
            c, s = ANFIS_PRM["centers"][j][k], ANFIS_PRM["sigmas"][j][k]
            mus[(j, k)] = (f"least(1.0, greatest(1e-10, exp(-(({xn} - ({c})) * ({xn} - ({c}))) "
                           f"/ (2 * {s} * {s} + 1e-10))))")
    rules = K.rule_grid(2, 2)
    ws = [f"({mus[(0, r[0])]} * {mus[(1, r[1])]})" for r in rules]
    tot = "(" + " + ".join(ws) + " + 1e-10)"
    th = ANFIS_THETA.reshape(4, 3)
    outs = [f"({ws[i]} / {tot}) * (x1 * ({th[i][0]}) + x2 * ({th[i][1]}) + ({th[i][2]}))" for i in range(4)]
    cols = ", ".join(f"round({ws[i]} / {tot}, 6) AS wn{i}" for i in range(4))
    return f"WITH t AS ({PART_X}) SELECT p_partkey, {cols}, round({' + '.join(outs)}, 6) AS prediction FROM t"


@register("a7_a9_anfis_rules", _anfis_sql())
def q_anfis_rules(spark, sf):
    t = fixture(spark, sf, PART_X)
    mu = K.anfis_memberships(_x(), "gaussian", ANFIS_PRM)
    rules = K.rule_grid(2, 2)
    wn = K.normalised([mu[0][r[0]] * mu[1][r[1]] for r in rules])
    pred = K.anfis_prediction(_x(), "gaussian", ANFIS_PRM, ANFIS_THETA)
    return rounded(t.select("p_partkey", *[w.alias(f"wn{i}") for i, w in enumerate(wn)],
                            pred.alias("prediction")))


def _fcm_u_sql(m: float) -> str:
    e = 2.0 / (m - 1.0)
    d = [f"greatest(sqrt({_sqd_sql(c)}), 1e-10)" for c in CENTRES]
    raw = [f"(1.0 / ({' + '.join(f'power({di} / {dj}, {e})' for dj in d)} + 1e-10))" for di in d]
    tot = "(" + " + ".join(raw) + " + 1e-10)"
    return ", ".join(f"round({raw[i]} / {tot}, 6) AS u{i}" for i in range(len(raw)))


@register("f2_fcm_membership", f"WITH t AS ({PART_X}) SELECT p_partkey, {_fcm_u_sql(2.0)} FROM t")
def q_fcm_u(spark, sf):
    t = fixture(spark, sf, PART_X)
    u = K.fcm_memberships(_x(), CENTRES, 2.0)
    return rounded(t.select("p_partkey", *[ui.alias(f"u{i}") for i, ui in enumerate(u)]))


FCM_THETA = np.array([1.0, -2.0, 0.5, 0.3, 0.3, 0.3, -1.0, 0.0, 2.0])


def _fcm_pred_sql(mf: str) -> str:
    if mf == "bell":
        acts = [f"(1.0 / (1.0 + power(sqrt({_sqd_sql(c)}) / ({s} + 1e-10), 4.0) + 1e-10))"
                for c, s in zip(CENTRES, SIGMAS)]
    else:
        acts = [f"exp(-{_sqd_sql(c)} / (2 * {s} * {s} + 1e-10))" for c, s in zip(CENTRES, SIGMAS)]
    tot = "(" + " + ".join(acts) + " + 1e-10)"
    th = FCM_THETA.reshape(3, 3)
    outs = [f"({acts[i]} / {tot}) * (x1 * ({th[i][0]}) + x2 * ({th[i][1]}) + ({th[i][2]}))" for i in range(3)]
    return f"round({' + '.join(outs)}, 6)"


@register("f5_f7_fcm_activation_prediction", f"""WITH t AS ({PART_X})
SELECT p_partkey, {_fcm_pred_sql('gaussian')} AS gaussian_pred, {_fcm_pred_sql('bell')} AS bell_pred FROM t""")
def q_fcm_pred(spark, sf):
    t = fixture(spark, sf, PART_X)
    return rounded(t.select(
        "p_partkey",
        K.fcm_prediction(_x(), CENTRES, SIGMAS, "gaussian", FCM_THETA).alias("gaussian_pred"),
        K.fcm_prediction(_x(), CENTRES, SIGMAS, "bell", FCM_THETA).alias("bell_pred")))


# ---------------------------------------------------------------------------
# Gram aggregate (G1) - NumPy per partition, reduced on the cluster
# ---------------------------------------------------------------------------

GRAM_X = """SELECT l_quantity / 50.0 AS x0, l_discount * 10 AS x1, l_tax * 10 AS x2,
  l_quantity / 50.0 * (1 - l_discount) AS y FROM lineitem"""


def _gram_sql() -> str:
    cols = ["x0", "x1", "x2", "1.0", "y"]
    parts = []
    for i in range(5):
        for j in range(i, 5):
            parts.append(f"SELECT {i} AS i, {j} AS j, round(sum({cols[i]} * {cols[j]}), 4) AS value FROM g")
    parts.append("SELECT -1 AS i, -1 AS j, CAST(count(*) AS DOUBLE) AS value FROM g")
    return f"WITH g AS ({GRAM_X}) " + " UNION ALL ".join(parts)


@register("g1_gram_aggregate", _gram_sql())
def q_gram(spark, sf):
    t = fixture(spark, sf, GRAM_X)
    design = lambda X: np.hstack([X, np.ones((X.shape[0], 1))])
    long = G.gram_long(t, ["x0", "x1", "x2"], "y", design, 4)
    return long.select("i", "j", F.round("value", 4).alias("value"))


@register("g1_gram_aggregate_sql", _gram_sql())
def q_gram_sql(spark, sf):
    t = fixture(spark, sf, GRAM_X)
    long = G.gram_sql_long(t, [F.col("x0"), F.col("x1"), F.col("x2"), F.lit(1.0)], F.col("y"))
    n = t.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit(-1).alias("i"), F.lit(-1).alias("j"), "value")
    return long.select("i", "j", F.round("value", 4).alias("value")).unionByName(n)


# ---------------------------------------------------------------------------
# modelling table and fits (rows-only)
# ---------------------------------------------------------------------------

def order_features(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str], str, list[str]]:
    """Per-order regression table: (o_orderkey, scaled features..., target)."""
    li = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"),
        F.avg("l_discount").alias("disc"), F.avg("l_tax").alias("tax"),
        F.sum(F.col("l_quantity") * 10 * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("target"))
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority",
                                         F.month("o_orderdate").cast("double").alias("month"))
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    t = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
         .select("o_orderkey", F.col("n_lines").cast("double").alias("n_lines"), "qty", "disc", "tax",
                 "month", "c_acctbal", "o_orderpriority", "c_mktsegment", "target"))
    # several eager passes follow (levels, min/max, split boundaries): write the table once
    t = materialize(t, "orders")
    enc, _ = N.encode(t, ["o_orderpriority", "c_mktsegment"])
    feats = [c for c in enc.columns if c not in ("o_orderkey", "target")]
    scaled = N.minmax_scale(enc, feats)
    return scaled, feats, "target", ["o_orderkey"]


def _train_test(spark, sf):
    t, feats, label, key = order_features(spark, sf)
    # encoded, scaled and split once: the fits and the scores read it many times
    sp = materialize(S.holdout(t, key, 0.2, 42), "split")
    return (sp.where(F.col("split") == "train").drop("split"),
            sp.where(F.col("split") == "test").drop("split"), feats, label)


def _fit_predict(spark, sf, reg) -> DataFrame:
    train, test, feats, label = _train_test(spark, sf)
    model = ScaledRegressor(reg).fit(train, feats, label)
    return model.transform(test, "prediction").select("o_orderkey", label, "prediction")


@register("b5_rbf_fit_predict")
def q_rbf_fit(spark, sf):
    return _fit_predict(spark, sf, RBFRegressor(n_centers=20, sigma_mode="per_center",
                                                alpha=1e-3, random_state=0, n_init=2))


@register("a12_anfis_fit_predict")
def q_anfis_fit(spark, sf):
    return _fit_predict(spark, sf, ANFISRegressor(n_mfs=2, mf_type="gaussian", n_epochs=5,
                                                  learning_rate=0.01, lambda_reg=1e-4))


@register("f8_fcm_network_fit_predict")
def q_fcm_fit(spark, sf):
    return _fit_predict(spark, sf, FCMNetworkRegressor(n_clusters=4, n_epochs=100,
                                                       learning_rate=0.05, random_state=0))


@register("l1_mlp_fit_predict")
def q_mlp_fit(spark, sf):
    return _fit_predict(spark, sf, MLPRegressor(hidden_layer_sizes=(32,), max_iter=20,
                                                learning_rate_init=0.01, random_state=0))


@register("h9_single_run_metrics")
def q_single_run(spark, sf):
    train, test, feats, label = _train_test(spark, sf)
    met, _ = search.single_run("RBF Network", {"n_centers": 15, "sigma": 4.0, "sigma_mode": "fixed",
                                               "alpha": 1e-3}, train, test, feats, label, 0,
                               {"n_init": 1})
    return met


def _searched(spark, sf, models: dict[str, dict]) -> DataFrame:
    """Trials of searches with the study's candidates and folds."""
    train, _, feats, label = _train_test(spark, sf)
    out = None
    for model, overrides in models.items():
        st = search.cross_validate(spark, train, feats, label, ["o_orderkey"], model, overrides=overrides)
        own = st.trials.select(F.lit(model).alias("model"), "*")
        out = own if out is None else out.unionByName(own)
    return out


@register("h7_cv_search_trials")
def q_cv(spark, sf):
    return _searched(spark, sf, {"RBF Network": {"n_init": 1}, "FNN-FCM": {}})


@register("h7_cv_search_gradient_models")
def q_cv_gradient(spark, sf):
    return _searched(spark, sf, {"ANFIS": {}, "MLP": {}})


@register("h10_repeated_runs")
def q_runs(spark, sf):
    train, test, feats, label = _train_test(spark, sf)
    return search.repeated_runs(spark, "RBF Network", {"n_centers": 15, "sigma": 4.0, "sigma_mode": "fixed",
                                                       "alpha": 1e-3}, train, test, feats, label,
                                overrides={"n_init": 1})


# ---------------------------------------------------------------------------
# result sinks (S8, S10) and consolidation
# ---------------------------------------------------------------------------

@register("s8_upsert_runs", f"""{RUNS_CTE},
old AS (SELECT * FROM runs WHERE model IN ('m0', 'm1', 'm2')),
new AS (SELECT model, run, "MSE" + 1 AS "MSE", "RMSE", "MAE", "R2", "MAPE", "MedAE", "MaxError", "EVS", "RMSLE"
        FROM runs WHERE model IN ('m2', 'm3'))
SELECT model, run, {", ".join(f'round("{m}", 6) AS "{m}"' for m in M.METRICS)} FROM (
  SELECT * FROM old WHERE model NOT IN (SELECT DISTINCT model FROM new) UNION ALL SELECT * FROM new)""")
def q_upsert(spark, sf):
    runs = runs_table(spark, sf)
    path = io.scratch_path(spark, "all_results")
    runs.where(F.col("model").isin("m0", "m1", "m2")).write.mode("overwrite").parquet(path)
    new = runs.where(F.col("model").isin("m2", "m3")).withColumn("MSE", F.col("MSE") + 1)
    merged = io.upsert_runs(spark, new, path)
    return rounded(merged.select("model", "run", *M.METRICS))


@register("s10_r10_consolidation", f"""{RUNS_CTE},
tagged AS (SELECT 0 AS dataset, * FROM runs UNION ALL SELECT 2 AS dataset, * FROM runs WHERE model <> 'm1')
SELECT dataset, model, {", ".join(f'round(avg("{m}"), 6) AS "{m}_mean", round(stddev_samp("{m}"), 6) AS "{m}_std"'
                                   for m in M.METRICS)}
FROM tagged GROUP BY dataset, model""")
def q_consolidate(spark, sf):
    runs = runs_table(spark, sf)
    root = io.scratch_path(spark, "results")
    runs.write.mode("overwrite").parquet(f"{root}/dataset_0/all_results")
    runs.where(F.col("model") != "m1").write.mode("overwrite").parquet(f"{root}/dataset_2/all_results")
    allr = io.read_results(spark, root)
    return rounded(R.summarise(allr, by=["dataset", "model"]))


# ---------------------------------------------------------------------------
# F1 / F4 with fixed centres, H6, R9
# ---------------------------------------------------------------------------

def _u_raw_sql() -> list[str]:
    e = 2.0
    d = [f"greatest(sqrt({_sqd_sql(c)}), 1e-10)" for c in CENTRES]
    raw = [f"(1.0 / ({' + '.join(f'power({di} / {dj}, {e})' for dj in d)} + 1e-10))" for di in d]
    tot = "(" + " + ".join(raw) + " + 1e-10)"
    return [f"{raw[i]} / {tot}" for i in range(len(raw))]


@register("f1_f4_centre_update_widths", f"""WITH t AS ({PART_X}),
u AS (SELECT x1, x2, {", ".join(f"{u} AS u{i}" for i, u in enumerate(_u_raw_sql()))} FROM t),
c AS ({" UNION ALL ".join(
    f"SELECT {i} AS cluster, sum(power(u{i}, 2.0) * x1) / (sum(power(u{i}, 2.0)) + 1e-10) AS x1, "
    f"sum(power(u{i}, 2.0) * x2) / (sum(power(u{i}, 2.0)) + 1e-10) AS x2, sum(power(u{i}, 2.0)) AS weight FROM u"
    for i in range(3))}),
w AS ({" UNION ALL ".join(
    f"SELECT {i} AS cluster, greatest(avg(sqrt({_sqd_sql(c)})), 1e-6) * (1 + 0.1) AS width FROM t"
    for i, c in enumerate(CENTRES))})
SELECT cluster, round(x1, 6) AS x1, round(x2, 6) AS x2, round(weight, 4) AS weight, round(width, 6) AS width
FROM c JOIN w USING (cluster)""")
def q_fcm_update(spark, sf):
    from ..models.fcm import centre_update, cluster_widths
    t = fixture(spark, sf, PART_X)
    frame, u = K.fcm_membership_sql(t.select("x1", "x2"), ["x1", "x2"], CENTRES, 2.0, "_m")
    upd = centre_update(frame, ["x1", "x2"], u, 2.0)
    widths = cluster_widths(t, ["x1", "x2"], CENTRES, 0.1)
    wdf = spark.createDataFrame([(i, float(w)) for i, w in enumerate(widths)], "cluster int, width double")
    out = upd.join(wdf, "cluster")
    return out.select("cluster", F.round("x1", 6).alias("x1"), F.round("x2", 6).alias("x2"),
                      F.round("weight", 4).alias("weight"), F.round("width", 6).alias("width"))


@register("h6_best_trial", f"""{RUNS_CTE},
sc AS (SELECT model, run AS trial, "RMSE" AS value FROM runs),
r AS (SELECT model, trial, value, row_number() OVER (PARTITION BY model ORDER BY value, trial) AS rn FROM sc)
SELECT model, trial, round(value, 6) AS value FROM r WHERE rn = 1""")
def q_best_trial(spark, sf):
    scores = runs_table(spark, sf).select("model", F.col("run").alias("trial"),
                                          F.col("RMSE").alias("value"))
    return rounded(search.best_trial(scores, by=["model"]))


@register("r9_report_set", f"""{RUNS_CTE}
{" UNION ALL ".join(f"SELECT '{m}' AS metric, model, round(avg(\"{m}\"), 6) AS mean, "
                    f"round(stddev_samp(\"{m}\"), 6) AS std FROM runs GROUP BY model"
                    for m in ("RMSE", "MAE", "R2", "MAPE"))}""")
def q_report_set(spark, sf):
    rep = R.report_set(runs_table(spark, sf))
    parts = [rounded(rep[f"bar_{m.lower()}"]).withColumn("metric", F.lit(m))
             for m in ("RMSE", "MAE", "R2", "MAPE")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# S7 / E8 over raw CSV fixtures written from the given tables; H11 grid
# ---------------------------------------------------------------------------

def _raw_catalog(spark, sf):
    from ..sources.catalog import default_catalog
    from .q_prep import CAR_SQL, FLIGHT_SQL, RETAIL_SQL
    root = io.scratch_path(spark, "raw")
    io.write_csv(fixture(spark, sf, RETAIL_SQL), f"{root}/data1/superstore.csv")
    io.write_csv(fixture(spark, sf, FLIGHT_SQL), f"{root}/data2/flight_price.csv")
    io.write_csv(fixture(spark, sf, CAR_SQL), f"{root}/data3/used_car.csv")
    # data4 deliberately absent: its failure must not stop the others
    return root, default_catalog(root)


@register("s7_build_all_status")
def q_build_all(spark, sf):
    from .preprocess import build_all
    root, specs = _raw_catalog(spark, sf)
    status = build_all(spark, specs, f"{root}/processed")
    built = [spark.read.parquet(f"{root}/processed/processed_{s.index}").select(
        F.lit(s.index).alias("dataset"), F.count(F.lit(1)).alias("n_rows"))
        for s in specs if io.path_exists(spark, f"{root}/processed/processed_{s.index}")]
    sizes = built[0]
    for b in built[1:]:
        sizes = sizes.unionByName(b)
    return status.join(sizes, "dataset", "left")


@register("e8_profile_all")
def q_profile_all(spark, sf):
    from .eda import run_all_eda
    _, specs = _raw_catalog(spark, sf)
    tables, status = run_all_eda(spark, specs)
    out = None
    for idx, t in tables.items():
        part = t["columns"].drop("dtype").withColumn("dataset", F.lit(idx))
        out = part if out is None else out.unionByName(part)
    return out


@register("h11_experiment_grid")
def q_grid(spark, sf):
    """Two tables, four models, the study's candidates, folds and runs, interrupted after three cells and resumed."""
    def orders(sp):
        t, feats, label, _ = order_features(sp, sf)
        return t, feats, label

    def part(sp):
        return fixture(sp, sf, f"SELECT p_partkey, x1, x2, x1 * x2 + 3 * x1 AS y FROM ({PART_X})"), ["x1", "x2"], "y"
    sets = [study.Dataset(0, "orders", orders, ("o_orderkey",)), study.Dataset(1, "part", part, ("p_partkey",))]
    root = io.scratch_path(spark, "study")
    study.run_study(spark, root, sets, max_cells=3)
    ledger = study.run_study(spark, root, sets)
    return ledger.table("runs", "metrics")


# ---------------------------------------------------------------------------
# H1-H4 draws, H5 scores, and the algebra of the fits at fixed parameters
# ---------------------------------------------------------------------------

TRIALS = "SELECT c_custkey AS trial FROM customer"


def _draws_query(model: str):
    def q(spark, sf):
        return rounded(spaces.draws(fixture(spark, sf, TRIALS), model, search.RANDOM_STATE), 9)
    return q


for _name, _model in (("h1_space_mlp", "MLP"), ("h1_space_mlp_large", "MLP large"), ("h2_space_rbf", "RBF Network"),
                      ("h3_space_anfis", "ANFIS"), ("h4_space_fcm", "FNN-FCM")):
    register(_name, spaces.draws_sql(TRIALS, _model, search.RANDOM_STATE))(_draws_query(_model))


@register("h5_mean_of_folds", f"""{RUNS_CTE}
SELECT run AS trial, round(avg("RMSE"), 6) AS value FROM runs GROUP BY run""")
def q_mean_of_folds(spark, sf):
    cells = runs_table(spark, sf).select(F.col("run").alias("trial"), F.col("model").alias("fold"),
                                         F.col("RMSE").alias("rmse"))
    return rounded(search.mean_of_folds(cells))


ALPHAS = (0.1, 10.0, 1000.0)
FOLDED = """SELECT l_quantity / 50.0 AS x, l_quantity / 50.0 * (1 - l_discount) + l_tax AS y, {fold} AS fold FROM lineitem"""
_FOLD_SQL = "('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8))::BIGINT % 5"
_FOLD_SPARK = "CAST(CAST(conv(substr(md5(CAST(l_orderkey AS STRING)), 1, 8), 16, 10) AS BIGINT) % 5 AS DOUBLE)"


@register("h5_fold_ridge_path", f"""WITH t AS ({FOLDED.format(fold=_FOLD_SQL)}),
f AS (SELECT fold, sum(x * x) AS xx, sum(x) AS x, count(*) AS n, sum(x * y) AS xy, sum(y) AS y, sum(y * y) AS yy
      FROM t GROUP BY fold),
r AS (SELECT f.*, alpha, sum(xx) OVER w - xx + alpha AS a, sum(x) OVER w - x AS b, sum(n) OVER w - n + alpha AS d,
        sum(xy) OVER w - xy AS p, sum(y) OVER w - y AS q
      FROM f, (VALUES {", ".join(f"({a}::DOUBLE)" for a in ALPHAS)}) v(alpha) WINDOW w AS (PARTITION BY alpha)),
s AS (SELECT *, (d * p - b * q) / (a * d - b * b) AS slope, (a * q - b * p) / (a * d - b * b) AS bias FROM r)
SELECT fold::INT AS fold, alpha, round(slope, 6) AS slope, round(bias, 6) AS bias,
  round(sqrt((yy - 2 * (slope * xy + bias * y) + slope * slope * xx + 2 * slope * bias * x + bias * bias * n) / n), 6) AS rmse
FROM s""")
def q_ridge_path(spark, sf):
    """Every ridge value on every fold from one pass of fold Grams."""
    table = TrainingTable(fixture(spark, sf, FOLDED.format(fold=_FOLD_SPARK)), ["x"], "y", "fold", 5)
    try:
        grams = fold_grams(table, table.plain_view(), NP.augmented, 2)
    finally:
        table.release()
    rows = [(f, a, float(w[0]), float(w[1]), v) for f, a, v, w in ridge_path(grams, 2, ALPHAS)]
    return rounded(spark.createDataFrame(rows, "fold int, alpha double, slope double, bias double, rmse double"))


A1_X = """SELECT l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2, l_tax AS f3,
  CAST(l_linenumber AS DOUBLE) AS f4, CAST(l_partkey % 7 AS DOUBLE) AS f5, CAST(l_suppkey % 5 AS DOUBLE) AS f6, 1.0 AS f7,
  l_quantity * (1 - l_discount) + l_tax * 10 + l_linenumber - l_partkey % 7 * 0.5 + l_suppkey % 5 * 0.25 AS y FROM lineitem"""


@register("a1_selected_features", f"""WITH t AS ({A1_X}),
r AS ({" UNION ALL ".join(f"SELECT {i} AS feature, coalesce(CASE WHEN isnan(corr(f{i}, y)) THEN 0 ELSE abs(corr(f{i}, y)) END, 0) AS r FROM t" if i < 7 else "SELECT 7 AS feature, 0.0 AS r" for i in range(8))}),
s AS (SELECT *, row_number() OVER (ORDER BY r DESC, feature DESC) AS rank FROM r)
SELECT 6 - rank AS place, feature, round(r, 6) AS r FROM s WHERE rank <= 6""")
def q_selected(spark, sf):
    table = TrainingTable(fixture(spark, sf, A1_X), [f"f{i}" for i in range(8)], "y")
    try:
        r = table.plain_view().r
    finally:
        table.release()
    rows = [(place, i, float(r[i])) for place, i in enumerate(select_by_correlation(r))]
    return rounded(spark.createDataFrame(rows, "place long, feature int, r double"))


@register("a3_premise_grid", f"""WITH t AS ({A1_X}),
m AS ({" UNION ALL ".join(f"SELECT {i} AS feature, min(f{i}) AS lo, max(f{i}) AS hi FROM t" for i in range(4))}),
s AS (SELECT *, (hi - lo) / 2 AS step, unnest([0, 1, 2]) AS mf FROM m)
SELECT feature, mf, round(lo + mf * step, 6) AS centre, round(greatest(step / 2, 1e-6), 6) AS width, 2.0 AS slope,
  round(lo + mf * step - step, 6) AS foot_left, round(lo + mf * step + step, 6) AS foot_right FROM s""")
def q_premises(spark, sf):
    table = TrainingTable(fixture(spark, sf, A1_X), [f"f{i}" for i in range(4)], "y")
    try:
        v = table.plain_view()
    finally:
        table.release()
    bell, tri = (init_premises(v.low, v.high, 3, kind) for kind in ("bell", "triangular"))
    rows = [(j, k, *(float(x[j, k]) for x in (bell["centers"], bell["widths"], bell["slopes"], tri["lefts"],
                                              tri["rights"]))) for j in range(4) for k in range(3)]
    return rounded(spark.createDataFrame(
        rows, "feature int, mf int, centre double, width double, slope double, foot_left double, foot_right double"))


@register("b2_centre_widths", f"""WITH c AS (
  SELECT p_brand, avg(x1) AS a, avg(x2) AS b FROM (SELECT p_partkey, x1, x2 FROM ({PART_X})) JOIN part USING (p_partkey)
  GROUP BY p_brand)
SELECT c.p_brand, round(greatest(min(sqrt((c.a - d.a) * (c.a - d.a) + (c.b - d.b) * (c.b - d.b))), 1e-8), 6) AS width
FROM c JOIN c d ON c.p_brand <> d.p_brand GROUP BY c.p_brand""")
def q_widths(spark, sf):
    means = (fixture(spark, sf, PART_X).join(load(spark, sf, "part").select("p_partkey", "p_brand"), "p_partkey")
             .groupBy("p_brand").agg(F.avg("x1").alias("a"), F.avg("x2").alias("b")).collect())  # a row per brand
    widths = centre_widths(np.array([[r.a, r.b] for r in means]), 1.0, "per_center")
    return rounded(spark.createDataFrame([(r.p_brand, float(w)) for r, w in zip(means, widths)],
                                         "p_brand string, width double"))


PART_XY = f"SELECT x1, x2, 2 * x1 - x2 + x1 * x2 + 1 AS y FROM ({PART_X})"


def _det(m: list[list[str]]) -> str:
    """Determinant of a matrix of SQL expressions, by its first row."""
    if len(m) == 1:
        return m[0][0]
    terms = [f"{'-' if j % 2 else '+'} {m[0][j]} * ({_det([r[:j] + r[j + 1:] for r in m[1:]])})" for j in range(len(m))]
    return "(0 " + " ".join(terms) + ")"


def _ridge_sql(columns: list[str], alpha: float) -> str:
    """Ridge weights of design columns on PART_XY, by Cramer's rule over their sums."""
    p = len(columns)
    sums = ", ".join([f"sum({columns[i]} * {columns[j]}) AS g{i}{j}" for i in range(p) for j in range(p)]
                     + [f"sum({c} * y) AS c{i}" for i, c in enumerate(columns)])
    a = [[f"(g{i}{j} + {alpha})" if i == j else f"g{i}{j}" for j in range(p)] for i in range(p)]
    weights = " UNION ALL ".join(
        f"SELECT {k} AS j, round({_det([[f'c{i}' if j == k else a[i][j] for j in range(p)] for i in range(p)])} "
        f"/ {_det(a)}, 6) AS weight FROM g" for k in range(p))
    return f"WITH t AS ({PART_XY}), g AS (SELECT {sums} FROM t) {weights}"


def _weights(spark, sf, design, p: int, alpha: float) -> DataFrame:
    g = G.gram(fixture(spark, sf, PART_XY), ["x1", "x2"], "y", design, p)
    return rounded(spark.createDataFrame([(j, float(w)) for j, w in enumerate(G.ridge_solve(g, alpha))],
                                         "j int, weight double"))


@register("b4_rbf_output_weights", _ridge_sql(
    [f"exp(-{_sqd_sql(c)} / (2 * {s} * {s}))" for c, s in zip(CENTRES[:2], SIGMAS)] + ["1.0"], 0.5))
def q_rbf_weights(spark, sf):
    return _weights(spark, sf, lambda x: NP.rbf_design(x, CENTRES[:2], np.array(SIGMAS[:2])), 3, 0.5)


A8_PRM = {"centers": np.array([[-1.0, 1.0]]), "sigmas": np.array([[0.9, 1.1]])}


def _a8_columns() -> list[str]:
    mu = [f"least(1.0, greatest(1e-10, exp(-((x1 - ({c})) * (x1 - ({c}))) / (2 * {s} * {s} + 1e-10))))"
          for c, s in zip(A8_PRM["centers"][0], A8_PRM["sigmas"][0])]
    total = f"({mu[0]} + {mu[1]} + 1e-10)"
    return [f"({m} / {total} * {x})" for m in mu for x in ("x1", "1.0")]


@register("a8_consequents", _ridge_sql(_a8_columns(), 0.01))
def q_consequents(spark, sf):
    rules = np.array(K.rule_grid(1, 2), dtype=np.int64)
    return _weights(spark, sf, lambda x: NP.anfis_design(x[:, :1], "gaussian", A8_PRM, rules), 4, 0.01)


def _f6_sql(rate: float) -> str:
    acts = [f"exp(-{_sqd_sql(c)} / (2 * {s} * {s} + 1e-10))" for c, s in zip(CENTRES, SIGMAS)]
    total = "(" + " + ".join(acts) + " + 1e-10)"
    columns = [f"({a} / {total} * {x})" for a in acts for x in ("x1", "x2", "1.0")]
    error = "(" + " + ".join(f"{c} * ({t})" for c, t in zip(columns, FCM_THETA)) + " - y)"
    return f"WITH t AS ({PART_XY}) " + " UNION ALL ".join(
        f"SELECT {j} AS j, round({t} - {rate} * avg({c} * {error}), 6) AS theta FROM t"
        for j, (c, t) in enumerate(zip(columns, FCM_THETA)))


@register("f6_consequent_step", _f6_sql(0.05))
def q_consequent_step(spark, sf):
    """One step of the consequent descent from fixed parameters, by the Gram."""
    g = G.gram(fixture(spark, sf, PART_XY), ["x1", "x2"], "y",
               lambda x: NP.fcm_design(x, CENTRES, np.array(SIGMAS), "gaussian"), 9)
    theta = FCM_THETA - 0.05 * (g.ata @ FCM_THETA - g.aty) / g.n
    return rounded(spark.createDataFrame([(j, float(t)) for j, t in enumerate(theta)], "j int, theta double"))


def _a10_sql() -> str:
    mu = {}
    for j, x in enumerate(("x1", "x2")):
        for k in range(2):
            c, s = ANFIS_PRM["centers"][j][k], ANFIS_PRM["sigmas"][j][k]
            mu[j, k] = f"least(1.0, greatest(1e-10, exp(-(({x} - ({c})) * ({x} - ({c}))) / (2 * {s} * {s} + 1e-10))))"
    rules, th = K.rule_grid(2, 2), ANFIS_THETA.reshape(4, 3)
    named = ", ".join(f"{m} AS m{j}{k}" for (j, k), m in mu.items())
    w = ", ".join(f"m0{r[0]} * m1{r[1]} AS w{i}" for i, r in enumerate(rules))
    f = ", ".join(f"x1 * ({t[0]}) + x2 * ({t[1]}) + ({t[2]}) AS f{i}" for i, t in enumerate(th))
    out = []
    for j, x in enumerate(("x1", "x2")):
        for k in range(2):
            c, s = ANFIS_PRM["centers"][j][k], ANFIS_PRM["sigmas"][j][k]
            pull = " + ".join(f"(f{i} - p) * w{i} * (s - w{i})" for i, r in enumerate(rules) if r[j] == k)
            each = f"(p - y) * ({pull}) / (s * s + 1e-10) * m{j}{k} / (m{j}{k} + 1e-10)"
            out.append(f"SELECT {j} AS feature, {k} AS mf, round(avg({each} * ({x} - ({c})) / ({s} * {s} + 1e-10)), 6) AS centre, "
                       f"round(avg({each} * ({x} - ({c})) * ({x} - ({c})) / ({s} * {s} * {s} + 1e-10)), 6) AS sigma FROM q")
    return f"""WITH t AS ({PART_XY}), a AS (SELECT *, {named} FROM t), b AS (SELECT *, {w}, {f} FROM a),
c AS (SELECT *, w0 + w1 + w2 + w3 + 1e-10 AS s FROM b),
q AS (SELECT *, (w0 * f0 + w1 * f1 + w2 * f2 + w3 * f3) / s AS p FROM c) """ + " UNION ALL ".join(out)


@register("a10_premise_gradient", _a10_sql())
def q_premise_gradient(spark, sf):
    """Mean premise gradient at fixed parameters, summed over the packed table."""
    rules = np.array(K.rule_grid(2, 2), dtype=np.int64)
    table = TrainingTable(fixture(spark, sf, PART_XY), ["x1", "x2"], "y")

    def one():
        return (yield ask_premises(table.plain_view(), None, [0, 1], ANFIS_PRM, rules, ANFIS_THETA))
    try:
        (sums,) = serve(table, [one()])
    finally:
        table.release()
    g = sums[:-1].reshape(2, 2, 2) / sums[-1]
    return rounded(spark.createDataFrame(
        [(j, k, float(g[0, j, k]), float(g[1, j, k])) for j in range(2) for k in range(2)],
        "feature int, mf int, centre double, sigma double"))


MLP_THETA = np.array([0.5, -1.0, 0.25, 0.75, 0.1, -0.2, 1.5, -2.0, 0.3])  # 2 inputs, 2 logistic units, 1 output


@register("l2_mlp_predict", f"""SELECT p_partkey, round(1.5 / (1 + exp(-(x1 * 0.5 + x2 * 0.25 + 0.1)))
  - 2.0 / (1 + exp(-(x1 * -1.0 + x2 * 0.75 - 0.2))) + 0.3, 6) AS prediction FROM ({PART_X})""")
def q_mlp_predict(spark, sf):
    model = MLPModel(["x1", "x2"], [2, 2, 1], "logistic", MLP_THETA)
    return rounded(model.transform(fixture(spark, sf, PART_X)).select("p_partkey", "prediction"))


@register("s11_s12_summary_sinks", f"""{RUNS_CTE},
g AS (SELECT 'dataset' AS sink, model, avg("RMSE") AS rmse_mean, stddev_samp("RMSE") AS rmse_std FROM runs GROUP BY model
      UNION ALL SELECT 'global', model, avg("RMSE"), stddev_samp("RMSE") FROM runs GROUP BY model)
SELECT sink, model, round(rmse_mean, 6) AS rmse_mean, round(rmse_std, 6) AS rmse_std FROM g""")
def q_sinks(spark, sf):
    runs, root = runs_table(spark, sf), io.scratch_path(spark, "summaries")
    io.write_table(R.summarise(runs), f"{root}/dataset_0/summary")
    both = study.consolidate(runs.withColumn("dataset", F.lit(0)))
    io.write_table(both["summary"], f"{root}/global_summary")
    shown = ["model", F.col("RMSE_mean").alias("rmse_mean"), F.col("RMSE_std").alias("rmse_std")]
    return rounded(spark.read.parquet(f"{root}/dataset_0/summary").select(F.lit("dataset").alias("sink"), *shown)
                   .union(spark.read.parquet(f"{root}/global_summary").select(F.lit("global"), *shown)))
