"""Model kernels as Spark column expressions.

Given fitted (driver-side, small) parameters, these build plain arithmetic
expressions over feature columns, so scoring a table stays in the JVM and in
whole-stage codegen. The same formulas are mirrored in ``models.numerics``
for the per-partition training aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Numerical guards used by the fuzzy models
EPS = 1e-10
MU_FLOOR = 1e-10


def _c(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def _sum(cols: Sequence[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def _prod(cols: Sequence[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out * c
    return out


def sq_dist(x: Sequence[str | Column], centre: Sequence[float]) -> Column:
    """Squared Euclidean distance of the row to a literal centre."""
    return _sum([(_c(xi) - F.lit(float(ci))) * (_c(xi) - F.lit(float(ci)))
                 for xi, ci in zip(x, centre)])


def rbf_activations(x: Sequence[str | Column], centres: np.ndarray,
                    sigmas: Sequence[float]) -> list[Column]:
    """``exp(-d^2 / (2 sigma^2))`` per centre plus the constant 1."""
    acts = [F.exp(-sq_dist(x, c) / F.lit(2.0 * float(s) ** 2)) for c, s in zip(centres, sigmas)]
    return acts + [F.lit(1.0)]


def linear(terms: Sequence[Column], weights: Sequence[float]) -> Column:
    return _sum([t * F.lit(float(w)) for t, w in zip(terms, weights)])


def gaussian_mf(x: Column, c: float, s: float) -> Column:
    """A4: ``exp(-(x-c)^2 / (2 s^2 + eps))``."""
    d = x - F.lit(float(c))
    return F.exp(-(d * d) / F.lit(2.0 * float(s) ** 2 + EPS))


def bell_mf(x: Column, c: float, w: float, b: float) -> Column:
    """A5: ``1 / (1 + ((x-c)/(w+eps))^(2b) + eps)``."""
    return F.lit(1.0) / (F.lit(1.0) + F.pow((x - F.lit(float(c))) / F.lit(float(w) + EPS),
                                            F.lit(2.0 * float(b))) + F.lit(EPS))


def triangular_mf(x: Column, left: float, c: float, right: float) -> Column:
    """``max(0, min((x-l)/(c-l+eps), (r-x)/(r-c+eps)))``."""
    return F.greatest(F.lit(0.0), F.least(
        (x - F.lit(float(left))) / F.lit(float(c) - float(left) + EPS),
        (F.lit(float(right)) - x) / F.lit(float(right) - float(c) + EPS)))


def clamp_mf(mu: Column) -> Column:
    """Degrees clipped to [1e-10, 1]."""
    return F.least(F.lit(1.0), F.greatest(F.lit(MU_FLOOR), mu))


def anfis_memberships(x: Sequence[str | Column], mf_type: str, params: dict) -> list[list[Column]]:
    """mu[j][k] for feature j, membership function k (clamped)."""
    out = []
    for j, xj in enumerate(x):
        xj = _c(xj)
        row = []
        for k in range(len(params["centers"][j])):
            c = params["centers"][j][k]
            if mf_type == "gaussian":
                mu = gaussian_mf(xj, c, params["sigmas"][j][k])
            elif mf_type == "bell":
                mu = bell_mf(xj, c, params["widths"][j][k], params["slopes"][j][k])
            else:
                mu = triangular_mf(xj, params["lefts"][j][k], c, params["rights"][j][k])
            row.append(clamp_mf(mu))
        out.append(row)
    return out


def rule_grid(n_features: int, n_mfs: int) -> list[tuple[int, ...]]:
    """A7 rule list: one membership function per feature (Cartesian
    product). Rule order does not change the fitted function: the ridge
    solve and the premise gradients are invariant to permuting rules."""
    return list(product(range(n_mfs), repeat=n_features))


def normalised(ws: Sequence[Column]) -> list[Column]:
    """Divide by ``sum + eps``."""
    total = _sum(list(ws)) + F.lit(EPS)
    return [w / total for w in ws]


def anfis_prediction(x: Sequence[str | Column], mf_type: str, params: dict,
                     theta: np.ndarray) -> Column:
    """A7 + A9: rule firing (product), normalisation, first-order outputs."""
    mu = anfis_memberships(x, mf_type, params)
    rules = rule_grid(len(x), len(params["centers"][0]))
    w = [_prod([mu[j][k] for j, k in enumerate(r)]) for r in rules]
    wn = normalised(w)
    d = len(x)
    xa = [_c(xi) for xi in x] + [F.lit(1.0)]
    th = np.asarray(theta).reshape(len(rules), d + 1)
    return _sum([wn[r] * linear(xa, th[r]) for r in range(len(rules))])


def fcm_memberships(x: Sequence[str | Column], centres: np.ndarray, m: float) -> list[Column]:
    """``u_i = 1 / (sum_j (d_i/d_j)^(2/(m-1)) + eps)``, distances floored at
    1e-10, then rows renormalised by ``sum + eps``."""
    e = 2.0 / (m - 1.0)
    d = [F.greatest(F.sqrt(sq_dist(x, c)), F.lit(1e-10)) for c in centres]
    u = [F.lit(1.0) / (_sum([F.pow(di / dj, F.lit(e)) for dj in d]) + F.lit(EPS)) for di in d]
    return normalised(u)


def fcm_activations(x: Sequence[str | Column], centres: np.ndarray, sigmas: Sequence[float],
                    mf_type: str = "gaussian") -> list[Column]:
    """rule activation from the distance to each cluster centre."""
    out = []
    for c, s in zip(centres, sigmas):
        d2 = sq_dist(x, c)
        if mf_type == "bell":
            ratio = F.sqrt(d2) / F.lit(float(s) + EPS)
            out.append(F.lit(1.0) / (F.lit(1.0) + F.pow(ratio, F.lit(4.0)) + F.lit(EPS)))
        else:
            out.append(F.exp(-d2 / F.lit(2.0 * float(s) ** 2 + EPS)))
    return out


def fcm_prediction(x: Sequence[str | Column], centres: np.ndarray, sigmas: Sequence[float],
                   mf_type: str, theta: np.ndarray) -> Column:
    """normalised activations weighting first-order rule outputs."""
    an = normalised(fcm_activations(x, centres, sigmas, mf_type))
    xa = [_c(xi) for xi in x] + [F.lit(1.0)]
    th = np.asarray(theta).reshape(len(centres), len(x) + 1)
    return _sum([an[i] * linear(xa, th[i]) for i in range(len(centres))])


# ----- staged projections ---------------------------------------------------
# Each stage materialises one layer of intermediate values as columns, so a
# value used by several later terms (a distance, a membership, a firing
# strength) is computed once per row instead of being re-inlined everywhere.

def staged(df, prefix: str, cols: Sequence[Column]):
    """``df`` plus columns ``<prefix>0..n-1``; returns (frame, column refs)."""
    names = [f"{prefix}{i}" for i in range(len(cols))]
    out = df.select("*", *[c.alias(n) for c, n in zip(cols, names)])
    return out, [F.col(n) for n in names]


def normalised_stage(df, prefix: str, refs: Sequence[Column]):
    total = _sum(list(refs)) + F.lit(EPS)
    return staged(df, prefix, [r / total for r in refs])


def temp_columns(df, prefixes: Sequence[str]) -> list[str]:
    return [c for c in df.columns if any(c.startswith(p) for p in prefixes)]


# ----- the same stages as SQL text -----------------------------------------
# Iterative fits rebuild their expressions every iteration with new literal
# parameters; one ``selectExpr`` per stage costs one JVM call instead of one
# per operator node.

def num(v: float) -> str:
    """Double literal in Spark SQL text."""
    return f"{float(v)!r}D"


def q(name: str) -> str:
    return f"`{name}`"


def sq_dist_sql(names: Sequence[str], centre: Sequence[float]) -> str:
    return "(" + " + ".join(f"POWER({q(n)} - {num(c)}, 2)" for n, c in zip(names, centre)) + ")"


def fcm_membership_sql(df, names: Sequence[str], centres: np.ndarray, m: float, prefix: str):
    """F2 as three ``selectExpr`` stages; returns (frame, membership column names)."""
    e = num(2.0 / (m - 1.0))
    k = len(centres)
    d = [f"{prefix}d{i}" for i in range(k)]
    r = [f"{prefix}r{i}" for i in range(k)]
    u = [f"{prefix}u{i}" for i in range(k)]
    df = df.selectExpr("*", *[f"GREATEST(SQRT({sq_dist_sql(names, c)}), 1.0E-10D) AS {d[i]}"
                              for i, c in enumerate(centres)])
    df = df.selectExpr("*", *[
        f"1.0D / ({' + '.join(f'POWER({d[i]} / {d[j]}, {e})' for j in range(k))} + 1.0E-10D) AS {r[i]}"
        for i in range(k)])
    total = "(" + " + ".join(r) + " + 1.0E-10D)"
    df = df.selectExpr("*", *[f"{r[i]} / {total} AS {u[i]}" for i in range(k)])
    return df, u
