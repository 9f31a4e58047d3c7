"""Embedding whitening: distributed centred covariance of fixed-point vectors,
its leading eigenpairs, and a broadcast projection of every row.

Each entry c becomes the whole number x = floor(256 c). The fit takes every
distinct x vector once: column sums are whole numbers and exact, products are
taken of vectors centred on the exact mean, as one dense matrix per task, and
the matrices are added in two levels. The eigenpairs of the matrix, as wide as
a vector, are found on the driver; every row is projected on them.

Nulls and other cases: a row goes whose vector is null or holds a null or
non-finite entry; a null id stays. Vectors must agree in length: rows of
another length than the commonest (ties: the longest; never 0) go. Entries
beyond the range of a long are held at its ends. A component is returned only
where its eigenvalue stands above rounding, so fewer distinct vectors than
that, constant or dependent columns give fewer components, and one distinct
vector gives no row. Repeated rows are projected each and count once in the
fit. An empty table gives an empty table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, share
from .eigen import EPS, leading_pairs
from .vectors import tree_sum

SCALE, COMPONENTS = 256, 4


def fixed_point(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale))


def usable(vector: Column) -> Column:
    c_bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, c_bad)


def usable_rows(table: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(key, x) of the rows that take part, x as array<long>."""
    v = F.col(vector)
    rows = table.select(F.col(key), v.alias("_v")).where(usable(F.col("_v")))
    width = (rows.groupBy(F.size("_v").alias("w")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), F.desc("w")).first())
    kept = rows.where(F.size("_v") == (width.w if width else 0))
    return kept.select(key, fixed_point(F.col("_v"), scale).alias("x"))


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of one length as an int64 matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sums(stream):
    n, total = 0, None
    for part in stream:
        x = _matrix(part.column("x"))
        if not len(x):
            continue
        safe = float(np.max(np.abs(x.astype(np.float64)))) * len(x) < 2.0 ** 62
        own = (x if safe else x.astype(object)).sum(axis=0).tolist()
        n, total = n + len(x), own if total is None else [a + b for a, b in zip(total, own)]
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array([n] * len(total), pa.int64()), pa.array(range(len(total)), pa.int32()),
             pa.array([str(t) for t in total]).cast(pa.decimal128(38, 0))], ["n", "dim", "total"])


def fit_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """(n, S): rows and exact sum of each dimension, as whole numbers."""
    rows = (fit.mapInArrow(_sums, "n long, dim int, total decimal(38,0)")
            .groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("dim").collect())
    return (rows[0].n, [int(r.total) for r in rows]) if rows else (0, [])


def _centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as a whole part and a rest below one: x less the first is exact."""
    whole = [s // n for s in sums]
    rest = [(s - w * n) / n for s, w in zip(sums, whole)]
    return np.array(whole, dtype=np.int64), np.array(rest)


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    near = float(np.max(np.abs(x.astype(np.float64)), initial=0.0)) < 2.0 ** 52
    return ((x - whole).astype(np.float64) if near else x.astype(np.float64) - whole) - rest


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance with divisor n, centred before multiplying: a dense matrix
    per task, cut into its rows, added in two levels."""
    whole, rest = _centre(n, sums)

    def products(stream):
        gram = None
        for part in stream:
            if part.num_rows:
                c = _centred(_matrix(part.column("x")), whole, rest)
                gram = c.T @ c if gram is None else gram + c.T @ c
        if gram is not None:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(gram)), pa.int32()), pa.array([task] * len(gram), pa.int64()),
                 pa.array([row.tobytes() for row in gram], pa.binary())], ["row", "part", "vector"])

    rows = tree_sum(fit.mapInArrow(products, "row int, part long, vector binary"), ["row"], "float64").collect()
    matrix = np.array([np.frombuffer(r.vector) for r in sorted(rows, key=lambda r: r.row)]) / n
    return (matrix + matrix.T) / 2


class Whitening:
    """Fitted whitening: n, sums, components (dimension x k), eigenvalues, their share of the trace."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums, self.values, self.vectors = n, sums, values, vectors
        self.explained = values / trace if len(values) else values
        self.whole, self.rest = _centre(n, sums) if n else (np.zeros(0, np.int64), np.zeros(0))

    def project(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.whole, self.rest) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Exact sum over dimensions of (n x - S)^2; null beyond 38 digits."""
        most = self.n * float(np.max(np.abs(x.astype(np.float64)), initial=0.0)) + max(map(abs, self.sums), default=0)
        if most * most * x.shape[1] < 2.0 ** 62:
            d = x * self.n - np.array(self.sums, dtype=np.int64)
            return pa.array(np.einsum("ij,ij->i", d, d)).cast(pa.decimal128(38, 0))
        d = x.astype(object) * self.n - np.array(self.sums, dtype=object)
        out = (d * d).sum(axis=1).tolist()
        return pa.array([str(v) if v < 10 ** 38 else None for v in out], pa.string()).cast(pa.decimal128(38, 0))


def fit_whitening(fit: DataFrame, k: int = COMPONENTS) -> Whitening:
    """Whitening of a table of distinct vectors ``x``."""
    n, sums = fit_sums(fit)
    if not n:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    matrix = covariance(fit, n, sums)
    values, vectors = leading_pairs(matrix, k)
    sound = values > len(matrix) * EPS * float(np.max(np.abs(matrix)))
    return Whitening(n, sums, values[sound], vectors[:, sound], float(np.trace(matrix)))


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k, held = len(model.values), share(fit.sparkSession, model)
    if not k:
        return None

    def whitened(stream):
        m = held.value
        for part in stream:
            if part.num_rows:
                w = m.project(_matrix(part.column("x")))
                yield pa.RecordBatch.from_arrays(list(map(pa.array, w.T)), [f"w{i}" for i in range(k)])

    columns = fit.mapInArrow(whitened, ", ".join(f"w{i} double" for i in range(k)))
    row = columns.agg(*[(F.covar_pop(f"w{i}", f"w{j}") - (i == j) * 1.0).alias(f"c{i}_{j}")
                        for i in range(k) for j in range(i + 1)]).first()
    return max(abs(v) for v in row)


def project(rows: DataFrame, key: str, model: Whitening) -> DataFrame:
    """(key, component, deviation, whitened, explained) for each row of
    (key, x) and component, components from 1; deviation as decimal(38,0)."""
    held = share(rows.sparkSession, model)

    def projected(stream):
        m = held.value
        k = len(m.values)
        for part in stream:
            if not part.num_rows or not k:
                continue
            x = _matrix(part.column("x"))
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 m.deviations(x).take(each), pa.array(m.project(x).ravel()),
                 pa.array(np.tile(m.explained, len(x)))],
                ["key", "component", "deviation", "whitened", "explained"])

    out = rows.select(F.col(key).alias("key"), "x").mapInArrow(
        projected, f"key {dict(rows.dtypes)[key]}, component int, deviation decimal(38,0), "
        "whitened double, explained double")
    return out.withColumnRenamed("key", key)


def whitening_table(table: DataFrame, key: str = "vec_id", vector: str = "embedding",
                    k: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of
    every row that takes part and component; a deviation beyond a long is null."""
    rows = usable_rows(table, key, vector)
    fit = materialize(rows.select("x").distinct(), "whitening-fit")
    model = fit_whitening(fit, k)
    error = identity_error(fit, model)
    return project(rows, key, model).select(
        key, "component", F.lit(model.n).cast("long").alias("n"),
        F.expr("try_cast(deviation as bigint)").alias("deviation"), "whitened", "explained",
        F.lit(error).cast("double").alias("identity_error"))
