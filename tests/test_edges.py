"""Tiny and empty inputs through every operator family (FIXTURES: tiny)."""
import pytest
from pyspark.sql import functions as F

from regloom.operators import encode as N
from regloom.operators import missing as D
from regloom.operators import profile as E
from regloom.operators import split as S
from regloom.operators.metrics import regression_metrics
from regloom.operators.ranking import exact_quantiles, with_position
from regloom.operators.report import aggregate_runs, histogram


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], "k long, s string, x double, y double, p double")


@pytest.fixture()
def one(spark):
    return spark.createDataFrame([(1, "a", 2.0, 3.0, 2.5)], "k long, s string, x double, y double, p double")


def test_empty_tables(spark, empty):
    assert exact_quantiles(empty, "x", [0.5]).count() == 0
    assert with_position(empty, ["k"]).count() == 0
    assert regression_metrics(empty, by=["s"]).count() == 0
    assert histogram(empty, "x", 5).count() == 0
    enc, plan = N.encode(empty)
    assert enc.count() == 0 and plan.onehot == {"s": []}
    assert N.minmax_scale(empty, ["x"]).count() == 0
    assert D.missing_profile(empty).count() == 0
    assert S.holdout(empty, ["k"], n=0).count() == 0
    assert E.describe(empty, ["x"]).where(F.col("count") > 0).count() == 0


def test_one_row(spark, one):
    (q,) = exact_quantiles(one, "x", [0.25, 0.9], names=["a", "b"]).collect()
    assert (q.a, q.b) == (2.0, 2.0)
    m = regression_metrics(one).collect()[0]
    assert m.MSE == 0.25 and m.R2 == 0.0 and m.MedAE == 0.5
    runs = regression_metrics(one, by=["s"]).withColumnRenamed("s", "model")
    agg = aggregate_runs(runs).where("metric = 'MAE'").collect()[0]
    assert agg["median"] == 0.5 and agg["std"] == 0.0
    sp = S.holdout(one, ["k"]).collect()[0]
    assert sp.split == "test"                      # ceil(0.2 * 1) = 1
    assert N.minmax_scale(one, ["x"]).collect()[0].x == 0.0
    with pytest.raises(ValueError):
        S.kfold(one, ["k"], 5)
