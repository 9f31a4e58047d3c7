import numpy as np
import pandas as pd
import pytest

from regloom.operators.metrics import METRICS, regression_metrics
from regloom.operators.report import aggregate_runs, box_stats, convergence, histogram


def ref_metrics(y, p):
    """Dense NumPy re-derivation of the nine metrics."""
    y, p = np.asarray(y, float), np.asarray(p, float)
    e = y - p
    sse, sst = (e ** 2).sum(), ((y - y.mean()) ** 2).sum()
    r2 = (1.0 if sse == 0 else 0.0) if sst == 0 else 1 - sse / sst
    ve, vy = e.var(), y.var()
    evs = (1.0 if ve == 0 else 0.0) if vy == 0 else 1 - ve / vy
    nz = y != 0
    mape = np.mean(np.abs(e[nz] / y[nz])) * 100 if nz.any() else None
    m = min(y.min(), p.min())
    s = abs(m) + 1 if m < 0 else 0.0
    yl, pl = np.log1p(np.clip(y + s, 0, None)), np.log1p(np.clip(p + s, 0, None))
    return {"MSE": np.mean(e ** 2), "RMSE": np.sqrt(np.mean(e ** 2)), "MAE": np.mean(np.abs(e)),
            "R2": r2, "MAPE": mape, "MedAE": np.median(np.abs(e)), "MaxError": np.max(np.abs(e)),
            "EVS": evs, "RMSLE": np.sqrt(np.mean((yl - pl) ** 2))}


CASES = {
    "plain": ([3.0, -0.5, 2.0, 7.0, 4.2], [2.5, 0.0, 2.0, 8.0, 4.0]),
    "zeros_in_y": ([0.0, 1.0, 2.0, 0.0], [0.5, 1.0, 1.5, -0.2]),
    "all_zero_y": ([0.0, 0.0, 0.0], [0.1, -0.1, 0.0]),
    "constant_y": ([5.0, 5.0, 5.0], [4.0, 5.0, 6.0]),
    "perfect": ([1.0, 2.0, 3.0], [1.0, 2.0, 3.0]),
    "negative": ([-10.0, -3.0, 4.0, 8.0], [-9.0, -4.5, 3.0, 9.5]),
}


@pytest.mark.parametrize("case", list(CASES))
def test_metrics_match_numpy(spark, case):
    y, p = CASES[case]
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    got = regression_metrics(df).collect()[0].asDict()
    exp = ref_metrics(y, p)
    for m in METRICS:
        if exp[m] is None:
            assert got[m] is None
        else:
            assert got[m] == pytest.approx(exp[m], rel=1e-9, abs=1e-12), m


def test_grouped_metrics_and_run_aggregation(spark):
    rng = np.random.RandomState(1)
    pdf = pd.DataFrame({"model": np.repeat(["a", "b"], 200), "run": np.tile(np.arange(4), 100),
                        "y": rng.rand(400) * 10, "p": rng.rand(400) * 10})
    runs = regression_metrics(spark.createDataFrame(pdf), by=["model", "run"])
    got = runs.toPandas().set_index(["model", "run"])
    for (m, r), part in pdf.groupby(["model", "run"]):
        exp = ref_metrics(part.y, part.p)
        assert got.loc[(m, r), "RMSE"] == pytest.approx(exp["RMSE"])
        assert got.loc[(m, r), "MedAE"] == pytest.approx(exp["MedAE"])
    agg = aggregate_runs(runs).toPandas().set_index(["model", "metric"])
    dist = aggregate_runs(runs, runs_bounded=False).toPandas().set_index(["model", "metric"])
    assert np.allclose(agg.loc[dist.index, "median"], dist["median"], equal_nan=True)
    for m, part in got.reset_index().groupby("model"):
        v = part["MAE"].to_numpy()
        row = agg.loc[(m, "MAE")]
        assert row["mean"] == pytest.approx(v.mean())
        assert row["std"] == pytest.approx(v.std())
        assert row["median"] == pytest.approx(np.median(v))


def test_box_histogram_convergence(spark):
    vals = [1.0, 2.0, 2.5, 3.0, 3.5, 4.0, 30.0]
    df = spark.createDataFrame([("m", v) for v in vals], "model string, v double")
    b = box_stats(df, "v").collect()[0]
    q1, q3 = np.percentile(vals, [25, 75])
    assert (b.q1, b.q3) == pytest.approx((q1, q3))
    assert b.n_outliers == 1 and b.whisker_hi == 4.0 and b.whisker_lo == 1.0
    h = histogram(df, "v", 5).orderBy("bin").toPandas()
    counts, _ = np.histogram(vals, bins=5)
    assert list(h["count"]) == list(counts)
    const = histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 50).toPandas()
    assert const["count"].sum() == 2 and const.loc[const["count"] > 0, "bin"].tolist() == [25]
    tr = spark.createDataFrame([(0, 5.0), (1, None), (2, 7.0), (3, 4.0)], "trial int, value double")
    c = convergence(tr).orderBy("trial").toPandas()
    assert list(c.best_so_far) == [5.0, 5.0, 5.0, 4.0]


def test_null_model_key_kept(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0), (None, 3.0, 3.0), ("a", 1.0, 1.0)],
                               "model string, y double, p double")
    got = {r.model: r.MAE for r in regression_metrics(df, by=["model"]).collect()}
    assert got == {None: 0.5, "a": 0.0}
