"""Hyper-parameter search, repeated runs and the experiment grid.

Fits are coroutines over one packed table (:mod:`..models.scans`): all
candidates of a search on all folds, and all seeds of the repeated runs, are
answered by the same passes over the data, so a search of 15 candidates over 5
folds takes as many passes as its longest fit. A table that one task can hold
is sent to tasks instead, which run a fit each."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..models.anfis import ANFISRegressor
from ..models.base import ScaledModel, ScaledRegressor
from ..models.fcm import FCMNetworkRegressor
from ..models.mlp import MLPRegressor
from ..models.rbf import RBFRegressor
from ..models.scans import NUMERICAL, TrainingTable, View, ask_squares, rmse_of, serve, serve_each
from ..operators import metrics as M
from ..operators import split as S
from ..session import materialize, share
from .spaces import candidates

# Study configuration
N_RUNS = 21
N_FOLDS = 5
TEST_SIZE = 0.2
N_TRIALS = 15
RANDOM_STATE = 42
MODELS = ["MLP", "RBF Network", "ANFIS", "FNN-FCM"]
# named workload profiles: (dataset indices, model indices) per machine
PROFILES = {
    "pc1": ([1], [2]),
    "pc2": ([1], [3]),
    "pc3": ([1], [0, 1]),
    "pc4": ([0, 2, 3], [0, 1, 2, 3]),
}


def make_regressor(model: str, params: dict, seed: int | None,
                   overrides: dict | None = None) -> ScaledRegressor:
    """L3 pipeline for one model family and parameter set."""
    p = dict(params)
    p.update(overrides or {})
    if model == "MLP":
        inner = MLPRegressor(random_state=seed, **p)
    elif model == "RBF Network":
        inner = RBFRegressor(random_state=seed, **p)
    elif model == "ANFIS":
        inner = ANFISRegressor(random_state=seed, **p)
    elif model == "FNN-FCM":
        inner = FCMNetworkRegressor(random_state=seed, **p)
    else:
        raise ValueError(f"unknown model {model!r}")
    return ScaledRegressor(inner)


# ---------------------------------------------------------------------------
# H5-H7 cross-validated search
# ---------------------------------------------------------------------------

@dataclass
class Study:
    model: str
    trials: DataFrame          # trial, fold, rmse, error
    scores: DataFrame          # trial, value, params
    best_params: dict
    best_value: float
    n_folds: int


def fold_rmse(model: str, params: dict, table: DataFrame, features: Sequence[str],
              label: str, fold: int, seed: int | None, overrides: dict | None) -> tuple[float, str | None]:
    """One CV cell by itself: fit on ``fold != f``, RMSE on ``fold == f``. A
    numerical failure or a non-finite value scores +inf and names its cause;
    any other error is the caller's. :func:`cross_validate` scores all cells in
    shared passes instead and gives the same values."""
    try:
        fitted = make_regressor(model, params, seed, overrides).fit(
            table.where(F.col("fold") != fold), features, label)
        pred = fitted.transform(table.where(F.col("fold") == fold), "_pred")
        v = M.rmse(pred, label, "_pred")
    except NUMERICAL as e:
        return math.inf, f"{type(e).__name__}: {e}"
    return _scored(v)


def _scored(value) -> tuple[float, str | None]:
    if isinstance(value, Exception):
        return math.inf, f"{type(value).__name__}: {value}"
    if value is None or not math.isfinite(value):
        return math.inf, "score is not finite"
    return float(value), None


def _cell(regressor: ScaledRegressor, view: View, table: TrainingTable):
    """Fit on a view's training rows, RMSE over its held-out rows."""
    model = yield from regressor.steps(table, view, [])
    squares = yield ask_squares(view, model.inner.predict_numpy)
    return rmse_of(squares)


def score_cells(table: TrainingTable, regressors: Sequence[ScaledRegressor]) -> list[list[tuple]]:
    """(rmse, error) of every regressor on every fold, in shared passes or, on a
    small table, side by side in tasks that hold it."""
    views = [table.view(f) for f in range(table.n_folds)]
    own: list[list] = [[] for _ in regressors]
    for shared in (True, False):
        at = [i for i, r in enumerate(regressors) if r.regressor.shares == shared]
        cells = [partial(_cell, regressors[i], v) for i in at for v in views]
        found = (serve(table, [cell(table) for cell in cells]) if shared else serve_each(table, cells)) if cells else []
        for j, i in enumerate(at):
            own[i] = [_scored(v) for v in found[j * len(views):(j + 1) * len(views)]]
    return own


def mean_of_folds(trials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """H5 over a (trial, fold, rmse) table: (by..., trial, value), the mean over
    the folds; +inf where any fold failed (a missing or non-finite score)."""
    bad = F.col("rmse").isNull() | F.isnan("rmse") | (F.abs("rmse") == float("inf"))
    return trials.groupBy(*by, "trial").agg(F.max(bad).alias("_bad"), F.avg("rmse").alias("_mean")).select(
        *by, "trial", F.when(F.col("_bad"), F.lit(float("inf"))).otherwise(F.col("_mean")).alias("value"))


def folded_table(train: DataFrame, features: Sequence[str], label: str, key: Sequence[str], n_folds: int = N_FOLDS,
                 seed: int = RANDOM_STATE, row_cap: int | None = None) -> TrainingTable:
    """The training rows with their P2 folds, packed: it serves the searches of
    all models, and the repeated runs, which take all its rows."""
    n = train.count()
    sub = train if row_cap is None else S.exact_subset(train, key, row_cap, seed, n=n)
    folded = S.kfold(sub, key, n_folds, f"kfold:{seed}", n=n if row_cap is None else min(n, row_cap))
    return TrainingTable(folded, features, label, "fold", n_folds)


def cross_validate(spark: SparkSession, train: DataFrame, features: Sequence[str], label: str,
                   key: Sequence[str], model: str, n_trials: int = N_TRIALS, n_folds: int = N_FOLDS,
                   seed: int = RANDOM_STATE, overrides: dict | None = None, row_cap: int | None = None,
                   large_batch: bool = False, table: TrainingTable | None = None) -> Study:
    """H5-H7: P2 folds over all training rows, candidates x folds scored in
    shared passes over one packed table, value = mean of fold RMSEs, best =
    lowest value (ties -> lowest trial). ``row_cap`` (P3 subset) applies only
    when the caller gives one; P4's fold rule is ``split.adaptive_folds``, for
    the caller to apply. ``table``: the rows as :func:`folded_table` packs them
    for this key, fold count and seed, when the caller has them already."""
    k = n_folds if table is None else table.n_folds
    cands = candidates(spark, model, n_trials, seed, large_batch)
    own = table or folded_table(train, features, label, key, k, seed, row_cap)
    try:
        cells = score_cells(own, [make_regressor(model, c, seed, overrides) for c in cands])
    finally:
        if table is None:
            own.release()
    rows = [(t, f, *cell) for t, own in enumerate(cells) for f, cell in enumerate(own)]
    trials = spark.createDataFrame(rows, "trial int, fold int, rmse double, error string")
    params = spark.createDataFrame([(t, json.dumps(c, default=str)) for t, c in enumerate(cands)],
                                   "trial int, params string")
    scores = mean_of_folds(trials).join(F.broadcast(params), "trial")  # a row per candidate
    best = best_trial(scores).first()
    return Study(model, trials, scores, cands[best.trial], best.value, k)


def best_trial(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """H6 over a score table: lowest value, ties -> lowest trial (per study)."""
    b = F.min_by(F.struct("trial", "value"), F.struct("value", "trial")).alias("b")
    agg = scores.groupBy(*by).agg(b) if by else scores.agg(b)
    return agg.select(*by, "b.trial", "b.value")


# ---------------------------------------------------------------------------
# H9-H11 runs and the grid
# ---------------------------------------------------------------------------

def single_run(model: str, params: dict, train: DataFrame, test: DataFrame,
               features: Sequence[str], label: str, seed: int,
               overrides: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """H9: fit on train, predict test, nine metrics. Returns (metrics, predictions)."""
    fitted = make_regressor(model, params, seed, overrides).fit(train, features, label)
    pred = fitted.transform(test, "prediction")
    met = M.regression_metrics(pred, label, "prediction", materialize=True)
    return met, pred


def _predictions(test: DataFrame, features: Sequence[str], label: str, models: dict[int, ScaledModel]) -> DataFrame:
    """(run, y, p): every test row under every model, in one pass."""
    held = share(test.sparkSession, models)
    width = len(features)

    def run(stream):
        own = held.value
        for part in stream:
            x = np.column_stack([part.column(i).to_numpy(zero_copy_only=False) for i in range(width)])
            for seed, model in own.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(part.num_rows, seed, dtype=np.int32)), part.column(width),
                     pa.array(model.predict_numpy(x))], ["run", "y", "p"])

    columns = [F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    return test.select(*columns, F.col(f"`{label}`").cast("double").alias("y")).mapInArrow(
        run, "run int, y double, p double")


def _fit(regressor: ScaledRegressor, view: View, table: TrainingTable):
    return regressor.steps(table, view, [])


def repeated_runs(spark: SparkSession, model: str, params: dict, train: DataFrame,
                  test: DataFrame, features: Sequence[str], label: str, n_runs: int = N_RUNS,
                  overrides: dict | None = None, table: TrainingTable | None = None) -> DataFrame:
    """Seeds 0..n_runs-1 with fixed parameters and split, fitted in shared
    passes; failed runs are skipped. A model that draws nothing is fitted once
    and stands for every seed. Returns the run table ``(model, run, nine metrics)``."""
    regressors = [make_regressor(model, params, seed, overrides) for seed in range(n_runs)]
    alike = not regressors[0].regressor.draws if regressors else False
    own = table or TrainingTable(train, features, label)
    try:
        view = own.view()
        fits = serve_each(own, [partial(_fit, r, view) for r in (regressors[:1] if alike else regressors)])
    finally:
        if table is None:
            own.release()
    fits = fits * n_runs if alike else fits
    models = {seed: f for seed, f in enumerate(fits) if not isinstance(f, Exception)}
    schema = "model string, run int, " + ", ".join(f"{m} double" for m in M.METRICS)
    if not models:
        return spark.createDataFrame([], schema)
    met = M.regression_metrics(_predictions(test, features, label, models), "y", "p", by=["run"], materialize=True)
    sound = F.col("RMSE").isNotNull() & ~F.isnan("RMSE") & (F.abs("RMSE") < float("inf"))
    # a diverged fit (non-finite predictions) fails scoring and the run is skipped
    return met.where(sound).select(F.lit(model).alias("model"), "run", *M.METRICS)


def experiment(spark: SparkSession, table: DataFrame, features: Sequence[str], label: str,
               key: Sequence[str], models: Sequence[str] = tuple(MODELS),
               n_trials: int = N_TRIALS, n_runs: int = N_RUNS, n_folds: int = N_FOLDS,
               overrides: dict | None = None) -> tuple[DataFrame | None, dict]:
    """H11 for one dataset: P1 split, then per model H7 search and H10 runs; a
    failing model is skipped. Returns (runs of all models, studies)."""
    split = materialize(S.holdout(table, key, TEST_SIZE, RANDOM_STATE), "split")
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    runs, studies = None, {}
    packed = folded_table(train, features, label, key, n_folds)
    try:
        for model in models:
            ov = (overrides or {}).get(model)
            st = cross_validate(spark, train, features, label, key, model, n_trials, n_folds, overrides=ov, table=packed)
            studies[model] = st
            if math.isinf(st.best_value):  # no candidate could be fitted
                continue
            r = materialize(repeated_runs(spark, model, st.best_params, train, test, features, label, n_runs, ov,
                                          packed), "runs")
            runs = r if runs is None else runs.unionByName(r)
    finally:
        packed.release()
    return runs, studies


def profile_grid(name: str) -> tuple[list[int], list[str]]:
    """The (datasets, models) subset of a named workload profile."""
    ds, ms = PROFILES[name]
    return list(ds), [MODELS[i] for i in ms]
