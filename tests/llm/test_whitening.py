"""Whitening against NumPy on the whole table and on odd rows."""

import math

import numpy as np
import pytest

from regloom.llm import whitening
from regloom.llm.eigen import count_below, leading_pairs, tridiagonal
from regloom.llm.queries import QUERIES
from regloom.session import load

SCHEMA = "vec_id long, embedding array<float>, key string, x int, component int"


def symmetric(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    m = (q * values) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("values", [
    [3.0], [2.0, 2.0], [5, 5, 5, 5, 5, 5], [0.0] * 5, [9, 4, 1, 0, 0, 0, 0], [1e8, 1.0, 1e-8, 1e-8],
    list(np.linspace(1, 2, 40)), [7 + 1e-10, 7, 7 - 1e-10, 1, 1, 0.5], [-3, -2, -1], [1e-150, 1e-160]])
def test_leading_pairs(values):
    values = np.array(values, dtype=float)
    m = symmetric(np.random.default_rng(len(values)), values)
    e, v = leading_pairs(m, 4)
    want, scale = np.linalg.eigvalsh(m)[::-1][:4], max(np.abs(m).max(), 1e-300)
    assert np.abs(e - want).max() <= 1e-13 * scale
    assert np.abs(m @ v - v * e).max() <= 1e-12 * scale
    assert np.abs(v.T @ v - np.eye(len(e))).max() <= 1e-12


def test_sturm_counts_and_diagonal_matrices():
    m = np.diag([4.0, 1.0, 4.0, -2.0, 0.0])
    d, off, _ = tridiagonal(m)
    assert count_below(d, off, np.array([-3.0, -1.0, 0.5, 2.0, 5.0])).tolist() == [0, 1, 2, 3, 5]
    e, v = leading_pairs(m, 4)
    assert np.allclose(e, [4, 4, 1, 0]) and np.allclose(m @ v, v * e) and np.allclose(v.T @ v, np.eye(4))


def brute(rows, k=4):
    """Per (id, component): n, deviation, |whitened|, explained, by NumPy."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in kept]
    fit = sorted({tuple(v) for _, v in x})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, dtype=float) - np.array(total) / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    keep = [j for j in range(min(k, len(e))) if e[j] > 1e-9 * max(e[0], 1e-300)]
    return [(i, j + 1, n, sum((n * c - s) ** 2 for c, s in zip(v, total)),
             float((np.array(v) - np.array(total) / n) @ u[:, j] / math.sqrt(e[j])), e[j] / np.trace(cov))
            for i, v in x for j in keep]


def same(got, want):
    got = sorted(got, key=lambda r: (r.vec_id is not None, r.vec_id, r.component, r.deviation))
    want = sorted(want, key=lambda r: (r[0] is not None, r[0], r[1], r[3]))
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in got] == [r[:4] for r in want]
    assert np.allclose([r.explained for r in got], [r[5] for r in want], rtol=1e-9)
    for j in {r.component for r in got}:
        a = np.array([r.whitened for r in got if r.component == j])
        b = np.array([r[4] for r in want if r[1] == j])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
    assert {r.identity_error < 1e-9 for r in got} <= {True}


def test_query_equals_numpy_over_the_whole_table(spark):
    table = load(spark, "/root/testdata/sf0.01", "embeddings")
    got = QUERIES["op11_embedding_whitening"](spark, "/root/testdata/sf0.01").collect()
    same(got, brute([(r.vec_id, r.embedding) for r in table.collect()]))


def odd_rows():
    rng = np.random.default_rng(3)
    base = [(i, [float(c) for c in rng.standard_normal(5) * [9, 5, 3, 2, 1]]) for i in range(60)]
    nan, inf = float("nan"), float("inf")
    return base + [(100 + i, base[0][1]) for i in range(30)] + [
        (7, base[7][1]), (None, [1.0, -2.0, 0.5, 0.0, -0.0]), (200, None), (201, [1.0, None, 0.0, 0.0, 0.0]),
        (202, [nan, 0.0, 0.0, 0.0, 0.0]), (203, [0.0, inf, 0.0, 0.0, 0.0]), (204, [0.0, -inf, 0.0, 0.0, 0.0]),
        (205, []), (206, [1.0, 2.0])]


def test_odd_rows_copies_and_clashing_columns(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(i, v, "k", 1, 2) for i, v in rows], SCHEMA).repartition(5)
    got = whitening.whitening_table(df).collect()
    same(got, brute([(i, v) for i, v in rows if v is None or len(v) == 5]))
    assert len(got) == 4 * 92


def test_few_vectors_and_empty_tables(spark):
    make = lambda rows: spark.createDataFrame([(i, v, "k", 1, 2) for i, v in rows], SCHEMA)
    assert whitening.whitening_table(make([])).count() == 0
    assert whitening.whitening_table(make([(1, None), (2, [])])).count() == 0
    assert whitening.whitening_table(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # one distinct vector
    two = whitening.whitening_table(make([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [1.0, 1.0])])).collect()
    assert [(r.component, r.n, r.deviation, round(abs(r.whitened), 12), round(r.explained, 12)) for r in two] == [
        (1, 2, 2 * 256 ** 2, 1.0, 1.0)] * 3


def test_entries_beyond_the_fast_integers(spark):
    big = [[1e30, 0.0], [0.0, 3e7], [2e7, 1e7], [-5e7, 4e7]]
    df = spark.createDataFrame([(i, v, "k", 1, 2) for i, v in enumerate(big)], SCHEMA)
    got = {(r.vec_id, r.component): r for r in whitening.whitening_table(df).collect()}
    x = [[min(math.floor(256 * float(np.float32(c))), 2 ** 63 - 1) for c in v] for v in big]
    total = [sum(c) for c in zip(*x)]
    for i, v in enumerate(x):
        exact = sum((4 * c - s) ** 2 for c, s in zip(v, total))
        assert got[i, 1].deviation == (exact if exact < 2 ** 63 else None)


def test_fit_does_not_depend_on_partitions(spark):
    df = load(spark, "/root/testdata/sf0.01", "embeddings")
    one, many = (whitening.fit_whitening(whitening.usable_rows(df.repartition(p), "vec_id", "embedding")
                                         .select("x").distinct()) for p in (1, 9))
    assert (one.n, one.sums) == (many.n, many.sums)
    assert np.allclose(one.values, many.values, rtol=1e-12) and np.abs(one.vectors - many.vectors).max() < 1e-9
