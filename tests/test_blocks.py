"""Packed blocks and their sums: contents, repeated rows, order of additions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from regloom.models import numerics as NP
from regloom.models.base import ScaledRegressor
from regloom.models.fcm import FCMNetworkRegressor
from regloom.models.mlp import MLPRegressor, ask_gradient
from regloom.models.rbf import RBFRegressor
from regloom.models.scans import TrainingTable, serve
from regloom.operators import blocks as B


def gather(packed):
    rows = [B.read_block(r.cell, r.data, len(packed.columns)) for r in packed.df.orderBy("cell").collect()]
    return (np.concatenate([b.x for b in rows]), np.concatenate([b.weight for b in rows]),
            np.concatenate([b.uid for b in rows])) if rows else (np.zeros((0, len(packed.columns))),) * 3


def test_repeated_rows_become_weights_and_nulls_nan(spark):
    df = spark.range(50_000).select((F.col("id") % 3).cast("double").alias("a"), F.lit("x").alias("_w"),
                                    F.when(F.col("id") % 3 == 0, None).otherwise(1.5).alias("cell"))
    packed = B.pack(df, ["a", "cell"])
    x, w, uid = gather(packed)
    assert packed.rows == 50_000 and packed.cells == 1 and len(set(uid.tolist())) == 3
    assert sorted(zip(x[:, 0].tolist(), np.nan_to_num(x[:, 1], nan=-1).tolist(), w.tolist())) == [
        (0.0, -1.0, 16667.0), (1.0, 1.5, 16667.0), (2.0, 1.5, 16666.0)]
    packed.release()


def test_blocks_do_not_depend_on_partitions(spark):
    df = spark.range(9000).select(F.sin("id").alias("a"), F.cos("id").alias("b"))
    seen = []
    for parts in (1, 4, 16):
        packed = B.pack(df.repartition(parts), ["a", "b"])
        seen.append({r.cell: bytes(r.data) for r in packed.df.collect()})
        packed.release()
    assert len(seen[0]) == 9 and seen[0] == seen[1] == seen[2]


def test_sums_are_error_free_and_long_vectors_are_merged_in_segments(spark, monkeypatch):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.standard_normal(3000) * 10.0 ** rng.integers(-8, 9, 3000), [1e16, 1.0, -1e16]])
    df = spark.createDataFrame([(float(v),) for v in values], "a double").repartition(5)
    packed = B.pack(df, ["a"], block_rows=100)
    exact = math.fsum(math.fsum(B.read_block(r.cell, r.data, 1).x[:, 0]) for r in packed.df.collect())
    kernel = lambda b, s: np.full(7, math.fsum(b.x[:, 0]))
    direct, _ = B.block_sums(packed, kernel, None, 7)
    monkeypatch.setattr(B, "DIRECT_BYTES", 0)
    monkeypatch.setattr(B, "SEGMENT", 3)
    merged, top = B.block_sums(packed, lambda b, s: (kernel(b, s), b.x.max(axis=0)), None, 7)
    assert np.allclose(direct, exact, rtol=1e-14) and np.array_equal(direct, merged) and top[0] == 1e16
    packed.release()


def test_empty_table(spark):
    packed = B.pack(spark.createDataFrame([], "a double"), ["a"])
    sums, top = B.block_sums(packed, lambda b, s: (np.ones(2), np.ones(1)), None, 2)
    assert packed.rows == 0 and sums.tolist() == [0.0, 0.0] and len(top) == 0
    table = TrainingTable(spark.createDataFrame([], "a double, y double"), ["a"], "y")
    with pytest.raises(ArithmeticError):
        table.view()


def frame(spark, n=5000):
    t = spark.range(n).select(F.sin(F.col("id") * 1.7).alias("a"), F.cos(F.col("id") * 0.3).alias("b"),
                              (F.col("id") % 11).cast("double").alias("c"))
    return t.withColumn("y", 3 * F.col("a") - F.col("b") * F.col("c") + F.sin("c"))


@pytest.mark.parametrize("regressor,numbers", [
    (MLPRegressor(hidden_layer_sizes=(6,), max_iter=3, batch_size=256, learning_rate_init=0.01), lambda m: m.theta),
    (MLPRegressor(hidden_layer_sizes=(4,), max_iter=3, solver="lbfgs"), lambda m: m.theta),
    (RBFRegressor(n_centers=6, sigma_mode="per_center", n_init=2), lambda m: np.append(m.centres.ravel(), m.weights)),
    (FCMNetworkRegressor(n_clusters=3, n_epochs=30, fcm_max_iter=6), lambda m: np.append(m.centres.ravel(), m.theta))])
def test_a_fit_is_a_function_of_data_and_seed(spark, regressor, numbers):
    """The same numbers to the last bit at 1, 4 and 16 partitions."""
    df, fits = frame(spark), []
    for parts in (1, 4, 16):
        model = ScaledRegressor(regressor).fit(df.repartition(parts), ["a", "b", "c"], "y")
        fits.append(numbers(model.inner).tobytes())
    assert fits[0] == fits[1] == fits[2]


def test_moments_by_fold_are_those_of_the_training_rows(spark):
    df = frame(spark, 700).withColumn("fold", (F.xxhash64("a") % 3 + 3) % 3)
    pdf = df.toPandas()
    table = TrainingTable(df, ["a", "b", "c"], "y", "fold", 3)
    for fold in (None, 0, 1, 2):
        own = pdf if fold is None else pdf[pdf.fold != fold]
        v = table.view(fold)
        x = own[["a", "b", "c"]].to_numpy()
        assert v.n == len(own) and v.held_n == len(pdf) - len(own)
        assert np.allclose(v.mean, x.mean(axis=0), rtol=1e-12) and np.allclose(v.std, x.std(axis=0), rtol=1e-12)
        assert np.allclose(v.low, ((x - x.mean(axis=0)) / x.std(axis=0)).min(axis=0), rtol=1e-10)
        assert np.allclose(v.r, [abs(np.corrcoef(x[:, j], own.y)[0, 1]) for j in range(3)], atol=1e-12)
    table.release()


@pytest.mark.parametrize("kind", ["tanh", "logistic", "relu"])
def test_mlp_gradient_by_finite_differences(spark, kind):
    df = frame(spark, 60)
    table = TrainingTable(df, ["a", "b", "c"], "y")
    view, sizes = table.view(), [3, 4, 2, 1]
    theta = np.random.RandomState(1).randn(3 * 4 + 4 + 4 * 2 + 2 + 2 + 1) * 0.7

    def one():
        return (yield ask_gradient(view, theta, sizes, kind, 0, 0.0, None, False))
    (sums,) = serve(table, [one()])
    pdf = df.toPandas()
    x = (pdf[["a", "b", "c"]].to_numpy() - view.mean) / view.std

    def loss(t):
        z = x
        at = 0
        for i, (a, b) in enumerate(zip(sizes, sizes[1:])):
            z = z @ t[at:at + a * b].reshape(a, b) + t[at + a * b:at + a * b + b]
            at += a * b + b
            if i < 2:
                z = {"tanh": np.tanh, "logistic": lambda v: 1 / (1 + np.exp(-v)),
                     "relu": lambda v: np.maximum(v, 0)}[kind](z)
        return 0.5 * ((z[:, 0] - pdf.y.to_numpy()) ** 2).sum()
    assert sums[-5] == 60 and sums[-6] == pytest.approx(loss(theta))
    for j in range(len(theta)):
        e = np.zeros(len(theta))
        e[j] = 1e-6
        assert sums[j] == pytest.approx((loss(theta + e) - loss(theta - e)) / 2e-6, rel=1e-4, abs=1e-4)
    table.release()


def test_memberships_match_the_pairwise_form():
    rng = np.random.default_rng(2)
    x, c = rng.standard_normal((50, 3)), rng.standard_normal((4, 3))
    x[0] = c[1]
    for m in (1.5, 2.0, 3.0):
        d = np.maximum(np.sqrt(((x[:, None] - c) ** 2).sum(axis=2)), 1e-10)
        raw = 1 / (((d[:, :, None] / d[:, None, :]) ** (2 / (m - 1))).sum(axis=2) + 1e-10)
        assert np.allclose(NP.fcm_memberships(x, c, m), raw / (raw.sum(axis=1, keepdims=True) + 1e-10), rtol=1e-9)
