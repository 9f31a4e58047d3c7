"""The registered searches and the study run at the study's own size."""

from regloom.plans import q_models as Q, search, study


def test_gradient_models_are_searched_with_the_epochs_they_draw(spark, monkeypatch):
    asked = []

    def scored(table, regressors):
        asked.append([r.regressor for r in regressors])
        return [[(1.0, None)] * table.n_folds for _ in regressors]
    monkeypatch.setattr(search, "score_cells", scored)
    Q.q_cv_gradient(spark, "/root/testdata/sf0.001")
    anfis, mlp = asked
    assert len(anfis) == len(mlp) == 15
    drawn = search.candidates(spark, "ANFIS", 15, 42), search.candidates(spark, "MLP", 15, 42)
    assert [r.n_epochs for r in anfis] == [c["n_epochs"] for c in drawn[0]] and min(r.n_epochs for r in anfis) >= 50
    assert [r.max_iter for r in mlp] == [c["max_iter"] for c in drawn[1]] and min(r.max_iter for r in mlp) >= 200


def test_the_study_has_its_candidates_folds_and_runs(spark, monkeypatch):
    calls = []

    def run_study(spark, root, datasets, **size):
        calls.append(size)
        return study.Ledger(spark, root)
    monkeypatch.setattr(study, "run_study", run_study)
    Q.q_grid(spark, "/root/testdata/sf0.001")
    assert calls == [{"max_cells": 3}, {}]  # interrupted, then resumed, with nothing cut
