import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from regloom.models.scans import TrainingTable
from regloom.operators.split import kfold
from regloom.plans import search, spaces
from regloom.session import materialize


def test_candidate_spaces_respect_ranges_and_conditions(spark):
    for large in (True, False):
        for p in search.candidates(spark, "MLP", 40, 42, large):
            layers = p["hidden_layer_sizes"]
            assert all(16 <= h <= 256 for h in layers) and 1 <= len(layers) <= 3
            assert 1e-5 <= p["alpha"] <= 0.1 or p["alpha"] == 0.0
            if large:
                assert p["solver"] in ("adam", "sgd") and p["batch_size"] in (256, 512, 1024, 2048)
                assert 100 <= p["max_iter"] <= 300 and p["max_iter"] % 50 == 0
            elif p["solver"] == "lbfgs":
                assert p["batch_size"] == "auto" and p["learning_rate_init"] == 0.001
            else:
                assert p["batch_size"] in (16, 32, 64, 128) and p["max_iter"] in range(200, 1001, 100)
    for r in search.candidates(spark, "RBF Network", 40, 42):
        assert 10 <= r["n_centers"] <= 200 and 1e-5 <= r["alpha"] <= 10
        assert r["sigma"] == 1.0 if r["sigma_mode"] == "per_center" else 0.1 <= r["sigma"] <= 10
    for a in search.candidates(spark, "ANFIS", 40, 42):
        assert 2 <= a["n_mfs"] <= 5 and a["n_epochs"] in range(50, 301, 50)
    for f in search.candidates(spark, "FNN-FCM", 40, 42):
        assert 2 <= f["n_clusters"] <= 10 and 1.5 <= f["fuzziness"] <= 3.0
    few, many = search.candidates(spark, "ANFIS", 5, 42), search.candidates(spark, "ANFIS", 9, 42)
    assert few == many[:5]  # a trial's draw does not depend on the number of trials


def test_draws_are_spread(spark):
    rows = spaces.draws(spark.range(4000).withColumnRenamed("id", "trial"), "RBF Network", 1).collect()
    logs = [math.log10(r.alpha) for r in rows]
    assert abs(sum(logs) / len(logs) + 2.0) < 0.1  # log-uniform over 1e-5 .. 1e1
    assert abs(sum(r.sigma_mode == "fixed" for r in rows) / 4000 - 0.5) < 0.03
    assert {r.n_centers for r in rows} >= {10, 200}


def test_best_trial_ties_and_profiles(spark):
    scores = spark.createDataFrame([(0, 2.0), (1, 1.0), (2, 1.0), (3, math.inf)], "trial int, value double")
    (b,) = search.best_trial(scores).collect()
    assert (b.trial, b.value) == (1, 1.0)
    assert search.profile_grid("pc3") == ([1], ["MLP", "RBF Network"])


def test_diverged_runs_are_skipped(spark):
    df = spark.range(400).select((F.col("id") % 17).cast("double").alias("a"),
                                 (F.col("id") % 13).cast("double").alias("b"),
                                 (F.col("id") % 7 * 100).cast("double").alias("y"))
    tr, te = df.where("a < 12"), df.where("a >= 12")
    ok = {"n_clusters": 3, "fuzziness": 2.0, "mf_type": "gaussian", "learning_rate": 0.05,
          "n_epochs": 50, "similarity_threshold": 0.1}
    bad = dict(ok, learning_rate=50.0, n_epochs=300)
    assert search.repeated_runs(spark, "FNN-FCM", ok, tr, te, ["a", "b"], "y", n_runs=2).count() == 2
    assert search.repeated_runs(spark, "FNN-FCM", bad, tr, te, ["a", "b"], "y", n_runs=2).count() == 0


def test_search_uses_every_training_row(spark, monkeypatch):
    seen = []

    def scored(table, regressors):
        seen.append((table.blocks.rows, [v.n + v.held_n for v in map(table.view, range(5))],
                     sum(table.view(f).held_n for f in range(5))))
        return [[(math.inf, "score is not finite") if f else (1.0, None) for f in range(5)] for _ in regressors]
    monkeypatch.setattr(search, "score_cells", scored)
    df = spark.range(110_000).select("id", F.col("id").cast("double").alias("a"), F.lit(1.0).alias("y"))
    study = search.cross_validate(spark, df, ["a"], "y", ["id"], "RBF Network", n_trials=1)
    assert seen == [(110_000, [110_000] * 5, 110_000)] and study.n_folds == 5
    assert study.trials.where("error is not null").count() == 4 and math.isinf(study.best_value)


CELLS = {
    "RBF Network": [{"n_centers": 7, "sigma_mode": "per_center", "alpha": 1e-3, "n_init": 3},
                    {"n_centers": 4, "sigma": 2.0, "sigma_mode": "fixed", "alpha": 1e-1, "n_init": 1}],
    "FNN-FCM": [{"n_clusters": 3, "fuzziness": 2.0, "n_epochs": 60, "learning_rate": 0.05, "fcm_max_iter": 8},
                {"n_clusters": 2, "fuzziness": 1.6, "mf_type": "bell", "n_epochs": 40, "fcm_max_iter": 5}],
    "ANFIS": [{"n_mfs": 2, "mf_type": "gaussian", "n_epochs": 3}, {"n_mfs": 3, "mf_type": "triangular"}],
    "MLP": [{"hidden_layer_sizes": (5,), "max_iter": 4, "batch_size": 64},
            {"hidden_layer_sizes": (4, 3), "solver": "lbfgs", "max_iter": 4}],
}


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.RandomState(4)
    x = rng.randn(900, 3) * [1.0, 5.0, 0.2] + [10.0, 0.0, 3.0]
    y = 100 + x[:, 0] * x[:, 1] + 5 * np.sin(x[:, 2]) + rng.randn(900) * 0.1
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    rows += [(900 + i, *r[1:]) for i, r in enumerate(rows[:60])]  # repeated rows
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double")
    return materialize(kfold(df, ["id"], 3, "kfold:1"), "folded")


@pytest.mark.parametrize("model", list(CELLS))
def test_shared_passes_give_the_score_of_each_cell(folded, model):
    feats = ["a", "b", "c"]
    table = TrainingTable(folded, feats, "y", "fold", 3)
    try:
        got = search.score_cells(table, [search.make_regressor(model, p, 0) for p in CELLS[model]])
    finally:
        table.release()
    for p, own in zip(CELLS[model], got):
        for fold, (value, error) in enumerate(own):
            want, _ = search.fold_rmse(model, p, folded, feats, "y", fold, 0, None)
            assert error is None and value == pytest.approx(want, rel=1e-8)


def test_numerical_failures_fail_their_cell_only(folded):
    table = TrainingTable(folded, ["a", "b", "c"], "y", "fold", 3)
    try:
        good, bad = search.score_cells(table, [
            search.make_regressor("FNN-FCM", {"n_clusters": 2, "n_epochs": 20, "learning_rate": lr, "fcm_max_iter": 4}, 0)
            for lr in (0.01, 1e9)])
    finally:
        table.release()
    assert all(e is None for _, e in good) and all(math.isinf(v) and e for v, e in bad)


def test_mean_of_folds(spark):
    t = spark.createDataFrame([(0, 0, 1.0), (0, 1, 3.0), (1, 0, math.inf), (1, 1, 1.0), (2, 0, None), (3, 0, math.nan)],
                              "trial int, fold int, rmse double")
    assert {r.trial: r.value for r in search.mean_of_folds(t).collect()} == {
        0: 2.0, 1: math.inf, 2: math.inf, 3: math.inf}


def test_runs_of_a_model_that_draws_nothing_are_alike(spark, folded):
    runs = search.repeated_runs(spark, "ANFIS", {"n_mfs": 2, "mf_type": "bell"}, folded.where("fold > 0"),
                                folded.where("fold = 0"), ["a", "b", "c"], "y", n_runs=3).collect()
    assert [r.run for r in sorted(runs, key=lambda r: r.run)] == [0, 1, 2] and len({r.RMSE for r in runs}) == 1
    seeded = search.repeated_runs(spark, "MLP", {"hidden_layer_sizes": (3,), "max_iter": 2}, folded.where("fold > 0"),
                                  folded.where("fold = 0"), ["a", "b", "c"], "y", n_runs=3).collect()
    assert len({r.RMSE for r in seeded}) == 3
