"""What a pass of many fits adds up: compact Grams, equal asks once, coded columns, even dealing."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from regloom.functions import kernels as K
from regloom.models import fcm, numerics as NP, rbf, scans
from regloom.models.anfis import init_premises
from regloom.operators import blocks as B
from regloom.plans import search


@pytest.mark.parametrize("d,m,kind", [(2, 4, "bell"), (3, 3, "triangular"), (5, 2, "gaussian")])
def test_gram_of_the_rules_from_its_different_entries(d, m, kind):
    rng = np.random.default_rng(d)
    x, y, w = rng.standard_normal((70, d)), rng.standard_normal(70), rng.integers(1, 4, 70).astype(float)
    prm, rules = init_premises(x.min(axis=0), x.max(axis=0), m, kind), np.array(K.rule_grid(d, m))
    sums = NP.anfis_gram_sums(x, y, w, kind, prm)
    a = NP.anfis_design(x, kind, prm, rules)
    p = a.shape[1]
    assert len(sums) == NP.anfis_gram_size(d, m) < p * p
    want = np.concatenate([((a * w[:, None]).T @ a).ravel(), a.T @ (w * y), [w @ (y * y), w.sum()]])
    assert np.allclose(NP.anfis_gram(sums, rules, m), want, rtol=1e-10, atol=1e-12)
    theta = rng.standard_normal(p)
    assert np.allclose(NP.anfis_predict(x, kind, prm, theta), a @ theta)


def test_candidates_that_ask_the_same_share_the_sum(spark, monkeypatch):
    df = spark.range(900).select(F.sin("id").alias("a"), F.cos(F.col("id") * 0.3).alias("b"),
                                 (F.col("id") % 3).alias("fold"))
    table = scans.TrainingTable(df.withColumn("y", F.col("a") * F.col("b")), ["a", "b"], "y", "fold", 3)
    sizes, real = [], scans.block_sums
    monkeypatch.setattr(scans, "block_sums", lambda t, k, s, size: sizes.append(size) or real(t, k, s, size))
    made = [search.make_regressor("ANFIS", {"n_mfs": 3, "mf_type": "bell", "lambda_reg": r, "n_epochs": 2}, 1)
            for r in (1e-6, 1e-3, 1e-1)]
    together = search.score_cells(table, made)
    assert sizes[0] == 3 * NP.anfis_gram_size(2, 3)  # a Gram for each fold, not for each candidate and fold
    alone = [search.score_cells(table, [r])[0] for r in made]
    assert together == alone and len({v for v, _ in together[0]}) == 3
    table.release()


def test_blocks_keep_columns_of_few_values_as_codes_and_are_dealt_evenly(spark):
    df = spark.range(40_000).select(F.sin("id").alias("a"), (F.col("id") % 7 - 3).cast("double").alias("b"),
                                    F.when(F.col("id") % 5 > 0, 1.0).alias("c"))
    packed = B.pack(df, ["a", "b", "c"])
    rows = packed.df.collect()
    got = np.concatenate([B.read_block(r.cell, r.data, 3).x for r in rows])
    want = np.array(df.toPandas(), dtype=float)
    assert np.array_equal(got[np.argsort(got[:, 0])], want[np.argsort(want[:, 0])], equal_nan=True)
    assert sum(len(r.data) for r in rows) < 40_000 * 24  # of 40 plain bytes a row
    held = [r.n for r in packed.df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(held) == packed.parts and max(held) - min(held) <= 1
    packed.release()


def test_codes_take_no_byte_a_bit_a_byte_or_two_and_give_the_rows_back(spark):
    df = spark.range(30_000).select(F.sin("id").alias("a"), F.lit(2.5).alias("one"), (F.col("id") % 2).alias("two"),
                                    (F.col("id") % 90).alias("some"), F.sqrt(F.col("id") % 500).alias("many"))
    packed = B.pack(df, df.columns, block_rows=4000)
    rows = packed.df.collect()
    blocks = [B.read_block(r.cell, r.data, 5) for r in rows]
    want = np.array(df.toPandas(), dtype=float)
    got = np.concatenate([b.x for b in blocks])
    assert np.array_equal(got[np.argsort(got[:, 0])], want[np.argsort(want[:, 0])])
    assert all(np.array_equal(b.matrix(5, slice(3, 50)), b.x[3:50]) for b in blocks)
    held = sum(len(r.data) for r in rows) / 30_000
    assert held < 8 + 8 + 1 / 8 + 1 + 2 + 2  # hash, plain column, codes; tables of values
    packed.release()


def test_blocks_grow_with_a_large_table(spark, monkeypatch):
    monkeypatch.setattr(B, "SPREAD", 2)
    packed = B.pack(spark.range(9000).select(F.sin("id").alias("a")), ["a"])
    assert packed.cells == 2
    packed.release()


def plain_view(x):
    d = x.shape[1]
    return scans.View(None, len(x), 0, np.zeros(d), np.ones(d), x.min(axis=0), x.max(axis=0), np.zeros(d), 0.0)


def test_former_memberships_are_formed_only_until_one_has_moved(monkeypatch):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.standard_normal((2000, 2)) + c for c in ([0, 0], [4, 1], [1, 5])])
    rows = scans.Rows(x, x[:, 0], np.ones(6000), np.arange(6000, dtype=np.uint64))
    table = SimpleNamespace(width=2, starts={(None, 3): rows.take(slice(0, 6000, 50))})
    formed, real = [], NP.fcm_memberships
    fit = fcm.cmeans(table, plain_view(x), 3, 2.0, 3)
    ask, passes, before = next(fit), 0, None
    with pytest.raises(StopIteration) as end:
        while True:
            passes += 1
            formed.clear()
            with monkeypatch.context() as m:
                m.setattr(NP, "fcm_memberships", lambda x, c, e: formed.append(len(x)) or real(x, c, e))
                sums, top = ask.compute(rows)
            centres = sums[3:].reshape(3, 2) / (sums[:3, None] + 1e-10)
            if top[0] >= 1e-5 or passes == 1:
                assert sum(formed) <= 6000 + fcm.PROBE
            else:
                assert sum(formed) == 12_000
            ask, before = fit.send((sums, top)), centres
    got, iterations = end.value.value
    assert iterations == passes > 3 and np.allclose(got, before, atol=1e-4)


def test_a_row_between_two_equal_centres_counts_once():
    x = np.random.default_rng(5).standard_normal((300, 3))
    rows = scans.Rows(x, x[:, 0], np.full(300, 2.0), np.arange(300, dtype=np.uint64))
    sums = rbf._assigned([np.vstack([x[:4], x[3]])])(rows)
    at = ((x[:, None] - x[None, :4]) ** 2).sum(axis=2).argmin(axis=1)
    assert np.array_equal(sums[:5], [*np.bincount(at, minlength=4) * 2.0, 0.0])
    assert np.isclose(sums[5], 2.0 * ((x - x[at]) ** 2).sum())
    assert np.allclose(sums[6:].reshape(3, 5).T[:4], [2.0 * x[at == i].sum(axis=0) for i in range(4)])


def test_lloyd_steps_of_several_sets_together_are_those_of_each(monkeypatch):
    rng = np.random.default_rng(6)
    x, w = rng.standard_normal((700, 4)), rng.integers(1, 4, 700).astype(float)
    rows = scans.Rows(x, x[:, 0], w, np.arange(700, dtype=np.uint64))
    sets = [x[rng.choice(700, 5, replace=False)] for _ in range(3)]
    sets[1][4] = sets[1][0]  # a tie in one of them
    monkeypatch.setattr(rbf, "STEP_DISTANCES", 1 << 11)
    got = rbf._assigned(sets)(rows).reshape(3, -1)
    for own, c in zip(got, sets):
        gap = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        at = gap.argmin(axis=1)
        assert np.array_equal(own[:5], np.bincount(at, weights=w, minlength=5))
        assert np.isclose(own[5], w @ gap.min(axis=1))
        assert np.allclose(own[6:].reshape(4, 5), [np.bincount(at, weights=w * column, minlength=5) for column in x.T])


def test_repeated_fits_step_together_and_read_their_starts_in_one_pass(spark, monkeypatch):
    df = spark.range(6000).select(F.sin("id").alias("a"), F.cos(F.col("id") * 0.3).alias("b"))
    table = scans.TrainingTable(df.withColumn("y", F.col("a") * F.col("b")), ["a", "b"], "y")
    made = [search.make_regressor("RBF Network", {"n_centers": 6, "alpha": a, "n_init": 1}, seed)
            for seed in (0, 1) for a in (1e-3, 1e-1)]
    view, reads, asked = table.view(), [], []
    real_starts, real_sums = scans.start_rows, scans.block_sums
    monkeypatch.setattr(scans, "start_rows", lambda t, wanted: reads.append(len(wanted)) or real_starts(t, wanted))
    monkeypatch.setattr(scans, "block_sums", lambda t, k, s, size: asked.append((len(s), size)) or real_sums(t, k, s, size))
    together = scans.serve(table, [r.steps(table, view, []) for r in made])
    assert reads == [2] and len(table.starts) == 2
    assert asked[0] == (1, 2 * (6 * 3 + 1))  # one computation for two seeds, none for the second alpha
    table.starts.clear()
    for r, both in zip(made, together):
        (alone,) = scans.serve(table, [r.steps(table, view, [])])
        assert np.allclose(alone.inner.centres, both.inner.centres, rtol=0, atol=1e-9)
        assert np.allclose(alone.predict_numpy(np.eye(2)), both.predict_numpy(np.eye(2)), atol=1e-7)
    table.release()
