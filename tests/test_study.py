"""The study over stored tables: interrupted, resumed, with failing parts."""

import math

import pytest
from pyspark.errors import AnalysisException

from regloom.operators import metrics as M
from regloom.operators import split as S
from regloom.plans import search
from regloom.plans import study as T
from regloom.plans.preprocess import ROW_KEY, load_or_build, prepare
from regloom.sources import io
from regloom.sources.catalog import DatasetSpec

SMALL = {"n_trials": 2, "n_runs": 2, "n_folds": 2,
         "overrides": {"RBF Network": {"n_init": 1, "n_centers": 5}, "ANFIS": {"mf_type": "bell", "n_mfs": 2}}}
MODELS = ("RBF Network", "ANFIS")


@pytest.fixture(scope="module")
def datasets(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    specs = []
    for i in (0, 1):
        lines = ["a,b,kind,price"] + [f"{(k * 7) % 41},{(k * k) % 17},{'xyz'[k % 3]},{(k * 7) % 41 * 2 + (i + 1) * (k % 3)}"
                                      for k in range(160)]
        (root / f"t{i}.csv").write_text("\n".join(lines + lines[1:9]) + "\n")  # with repeated rows
        specs.append(DatasetSpec(i, f"table {i}", str(root / f"t{i}.csv"), "price"))
    specs.append(DatasetSpec(2, "absent", str(root / "nothing.csv"), "price"))
    return [T.stored_dataset(s, str(root / "store")) for s in specs]


def cells(ledger):
    return {(r.dataset, r.model, r.stage): r.status for r in ledger.rows().collect()}


@pytest.fixture(scope="module")
def finished(spark, datasets, tmp_path_factory):
    """A study that was interrupted twice and then ran to its end."""
    root = str(tmp_path_factory.mktemp("study"))
    first = T.run_study(spark, root, datasets, MODELS, max_cells=1, **SMALL)
    assert cells(first) == {(0, "RBF Network", "search"): "done"}
    paths = {r.path for r in first.rows().collect()}
    T.run_study(spark, root, datasets, MODELS, max_cells=4, **SMALL)
    ledger = T.run_study(spark, root, datasets, MODELS, **SMALL)
    assert paths < {r.path for r in ledger.rows().collect()}  # what was done is not done again
    return ledger


def test_the_grid_ends_whole_and_an_absent_dataset_fails_its_own_cells(finished):
    got = cells(finished)
    assert len(got) == 12
    assert all((v == "failed") == (k[0] == 2) for k, v in got.items())
    assert all(r.error for r in finished.rows().where("status = 'failed'").collect())


def test_a_finished_study_has_nothing_left_but_what_failed(spark, finished, datasets):
    left = finished.missing(T.grid(spark, [0, 1, 2], MODELS)).collect()
    assert {(r.dataset, r.stage) for r in left} == {(2, "search"), (2, "runs")}
    versions = io.folder_numbers(spark, f"{finished.root}/_ledger", "v")
    T.run_study(spark, finished.root, datasets[:2], MODELS, **SMALL)
    assert io.folder_numbers(spark, f"{finished.root}/_ledger", "v") == versions


def test_results_of_the_study(finished):
    out = T.study_results(finished)
    runs = out["runs"].collect()
    assert {(r.dataset, r.model, r.run) for r in runs} == {(d, m, s) for d in (0, 1) for m in MODELS for s in (0, 1)}
    by_hand = {}
    for r in runs:
        by_hand.setdefault((r.dataset, r.model), []).append(r.RMSE)
    for r in out["summary"].collect():
        own = by_hand[r.dataset, r.model]
        assert math.isclose(r.RMSE_mean, sum(own) / 2) and math.isclose(
            r.RMSE_std, abs(own[0] - own[1]) / math.sqrt(2), abs_tol=1e-12)
    assert {(r.dataset, r.model, r.trial) for r in out["convergence"].collect()} == {
        (d, m, t) for d in (0, 1) for m in MODELS for t in (0, 1)}
    assert {"bar_rmse", "box_mae", "heatmap_metrics"} <= set(out)


def test_result_tables_are_written_and_consolidated(spark, finished, tmp_path):
    written = T.write_results(finished, str(tmp_path))
    assert len(written) == 5 and T.write_results(finished, str(tmp_path)) == written  # models replace their rows
    both = T.consolidate_folders(spark, str(tmp_path), names={0: "zero", 1: "one"})
    rows = both["summary"].collect()
    assert {(r.dataset, r.dataset_name) for r in rows} == {(0, "zero"), (1, "one")}
    assert io.read_versioned(spark, f"{tmp_path}/dataset_0/all_results").count() == 4
    assert spark.read.parquet(f"{tmp_path}/global_summary").count() == 4
    assert T.consolidate_folders(spark, str(tmp_path / "nothing")) == {}


def test_a_profile_takes_its_part_of_the_grid(spark, datasets, tmp_path):
    ledger = T.run_study(spark, str(tmp_path), datasets, profile="pc1", **SMALL)
    assert set(cells(ledger)) == {(1, "ANFIS", "search"), (1, "ANFIS", "runs")}


def test_other_errors_stop_the_study(spark, tmp_path):
    def load(_):
        raise KeyError("a programming error")
    with pytest.raises(KeyError):
        T.run_study(spark, str(tmp_path), [T.Dataset(0, "x", load)], MODELS, **SMALL)


def test_row_key_tells_rows_apart_and_is_no_feature(spark, tmp_path):
    raw = spark.createDataFrame([(1.0, "a", 5.0), (1.0, "a", 5.0), (1.0, None, 5.0), (2.0, "b", None), (3.0, "b", 1.0)],
                                "x double, c string, price double")
    p = prepare(raw, "price", key=ROW_KEY)
    rows = p.table.collect()
    assert len({r[ROW_KEY] for r in rows}) == len(rows) and ROW_KEY not in p.features
    plain = prepare(raw, "price")
    assert sorted(map(tuple, plain.table.collect())) == sorted(tuple(r)[1:] for r in rows)


def test_stored_table_is_reused_until_forced(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,price\n1,2\n2,4\n3,7\n")
    spec = DatasetSpec(0, "t", str(tmp_path / "t.csv"), "price")
    store = str(tmp_path / "store")
    assert load_or_build(spark, spec, store).table.count() == 3
    (tmp_path / "t.csv").write_text("a,price\n1,2\n")
    assert load_or_build(spark, spec, store).table.count() == 3
    assert load_or_build(spark, spec, store, force=True).table.count() == 1
    (tmp_path / "gone").mkdir()
    with pytest.raises(AnalysisException):
        load_or_build(spark, DatasetSpec(1, "u", str(tmp_path / "no.csv"), "price"), str(tmp_path / "gone"))


def test_runs_have_the_nine_metrics(finished):
    assert set(M.METRICS) < set(T.study_results(finished)["runs"].columns)


def test_rows_of_a_dataset_are_packed_once_for_all_searches_and_runs(spark, datasets, tmp_path, monkeypatch):
    packed, real = [], search.TrainingTable

    def counted(*args):
        packed.append(real(*args))
        return packed[-1]
    monkeypatch.setattr(search, "TrainingTable", counted)
    ledger = T.run_study(spark, str(tmp_path / "study"), datasets[:1], MODELS, **SMALL)
    assert len(packed) == 1 and set(cells(ledger).values()) == {"done"}
    monkeypatch.undo()
    # the same trials as from a table of the search's own
    table, features, label = datasets[0].load(spark)
    train = S.holdout(table, [ROW_KEY], search.TEST_SIZE, search.RANDOM_STATE).where("split = 'train'").drop("split")
    alone = search.cross_validate(spark, train, features, label, [ROW_KEY], "RBF Network", 2, 2,
                                  overrides=SMALL["overrides"]["RBF Network"])
    got = ledger.table("search", "trials").where("model = 'RBF Network'").orderBy("trial", "fold").collect()
    want = alone.trials.orderBy("trial", "fold").collect()
    assert all(math.isclose(a.rmse, b.rmse, rel_tol=1e-9) for a, b in zip(got, want, strict=True))
