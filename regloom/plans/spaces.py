"""Search spaces (H1-H4) as one table of parameters, drawn by counted hashes.

A draw is a function of (seed, model, trial, parameter): the leading 52 bits of
an md5 as a uniform number, through the parameter's inverse distribution. So a
trial's value does not depend on how many other trials or parameters are drawn,
and the same table gives the column expressions and the SQL."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Parameter:
    """A whole number ``low..high`` by ``step``, a real number (``real``), both
    also on a log scale, or one of ``options``. ``when`` (parameter, values)
    limits the draw; elsewhere the value is ``otherwise``."""
    name: str
    low: float = 0
    high: float = 0
    step: int = 1
    real: bool = False
    log: bool = False
    options: tuple = ()
    when: tuple | None = None
    otherwise: object = None


_GRADIENT = ("solver", ("adam", "sgd"))


def _mlp(solvers: tuple, batches: tuple, iterations: tuple) -> list[Parameter]:
    return [
        Parameter("n_layers", 1, 3),
        *[Parameter(f"layer_{i}", 16, 256, log=True) for i in (1, 2, 3)],
        Parameter("activation", options=("relu", "tanh", "logistic")),
        Parameter("solver", options=solvers),
        Parameter("max_iter", iterations[0], iterations[1], step=iterations[2]),
        Parameter("batch_size", options=batches, when=_GRADIENT, otherwise="auto"),
        Parameter("learning_rate_init", 1e-4, 1e-1, real=True, log=True, when=_GRADIENT, otherwise=0.001),
        Parameter("penalty", options=("l2", "none")),
        Parameter("alpha", 1e-5, 1e-1, real=True, log=True, when=("penalty", ("l2",)), otherwise=0.0)]


# The study's search ranges
SPACES: dict[str, list[Parameter]] = {
    "MLP": _mlp(("adam", "sgd", "lbfgs"), ("16", "32", "64", "128"), (200, 1000, 100)),
    "MLP large": _mlp(("adam", "sgd"), ("256", "512", "1024", "2048"), (100, 300, 50)),
    "RBF Network": [
        Parameter("n_centers", 10, 200, log=True), Parameter("sigma_mode", options=("fixed", "per_center")),
        Parameter("sigma", 0.1, 10.0, real=True, log=True, when=("sigma_mode", ("fixed",)), otherwise=1.0),
        Parameter("alpha", 1e-5, 1e1, real=True, log=True)],
    "ANFIS": [
        Parameter("n_mfs", 2, 5), Parameter("mf_type", options=("gaussian", "bell", "triangular")),
        Parameter("learning_rate", 1e-4, 1e-1, real=True, log=True), Parameter("n_epochs", 50, 300, step=50),
        Parameter("lambda_reg", 1e-6, 1e-1, real=True, log=True)],
    "FNN-FCM": [
        Parameter("n_clusters", 2, 10), Parameter("fuzziness", 1.5, 3.0, real=True),
        Parameter("mf_type", options=("gaussian", "bell")),
        Parameter("learning_rate", 1e-4, 1e-1, real=True, log=True), Parameter("n_epochs", 50, 300, step=50),
        Parameter("similarity_threshold", 0.01, 0.5, real=True)],
}
_BITS = 1 << 52


def _inverse(p: Parameter, u: str) -> str:
    """SQL text of a draw, the same in both dialects but for the uniform number ``u``."""
    if p.options:
        cases = " ".join(f"WHEN {u} < {(i + 1) / len(p.options)!r} THEN '{o}'" for i, o in enumerate(p.options[:-1]))
        return f"CASE {cases} ELSE '{p.options[-1]}' END"
    low, high = float(p.low), float(p.high)
    if p.real:
        if p.log:
            return f"exp(CAST({math.log(low)!r} AS DOUBLE) + {u} * CAST({math.log(high) - math.log(low)!r} AS DOUBLE))"
        return f"CAST({low!r} AS DOUBLE) + {u} * CAST({high - low!r} AS DOUBLE)"
    if p.log:
        span = math.log(high + 1) - math.log(low)
        drawn = f"floor(exp(CAST({math.log(low)!r} AS DOUBLE) + {u} * CAST({span!r} AS DOUBLE)))"
        return f"CAST(least({int(high)}, greatest({int(low)}, {drawn})) AS INT)"
    return f"CAST({int(low)} + {p.step} * floor({u} * {(int(high) - int(low)) // p.step + 1}) AS INT)"


def _draw(p: Parameter, u: str) -> str:
    text = _inverse(p, u)
    if p.when:
        values = ", ".join(f"'{v}'" for v in p.when[1])
        other = f"'{p.otherwise}'" if isinstance(p.otherwise, str) else f"CAST({p.otherwise!r} AS DOUBLE)"
        text = f"CASE WHEN {p.when[0]} IN ({values}) THEN {text} ELSE {other} END"
    return text


def draws(trials: DataFrame, model: str, seed: int, trial: str = "trial") -> DataFrame:
    """``trials`` with a column for each parameter of the model's space."""
    out = trials
    for p in SPACES[model]:
        text = F.concat_ws(":", F.lit(str(seed)), F.lit(model), F.col(trial).cast("string"), F.lit(p.name))
        out = out.withColumn("_u", F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
                             / float(_BITS))
        out = out.withColumn(p.name, F.expr(_draw(p, "_u"))).drop("_u")
    return out


def draws_sql(source: str, model: str, seed: int, trial: str = "trial", digits: int = 9) -> str:
    """The same draws as DuckDB SQL over a query that gives the trials."""
    uniform = (f"('0x' || substr(md5('{seed}:{model}:' || CAST({trial} AS VARCHAR) || ':{{0}}'), 1, 13))"
               f"::BIGINT::DOUBLE / {_BITS}.0")
    step = f"SELECT {trial} FROM ({source})"
    for p in SPACES[model]:
        text = _draw(p, f"({uniform.format(p.name)})")
        step = f"SELECT *, {text} AS {p.name} FROM ({step})"
    shown = ", ".join(f"round({p.name}, {digits}) AS {p.name}" if p.real else p.name for p in SPACES[model])
    return f"SELECT {trial}, {shown} FROM ({step})"


def parameters(model: str, row: dict) -> dict:
    """A drawn row as the estimator's arguments."""
    p = {k: v for k, v in row.items() if k in {q.name for q in SPACES[model]}}
    if model.startswith("MLP"):
        layers = [p.pop(f"layer_{i}") for i in (1, 2, 3)]
        p["hidden_layer_sizes"] = tuple(layers[:p.pop("n_layers")])
        p.pop("penalty")
        p["batch_size"] = p["batch_size"] if p["batch_size"] == "auto" else int(p["batch_size"])
    return p


def candidates(spark: SparkSession, model: str, n_trials: int, seed: int, large_batch: bool = False) -> list[dict]:
    """Arguments of trials 0..n_trials-1. ``large_batch`` is the caller's choice
    of the narrower space for tables that first-order solvers should pass over
    in large batches."""
    space = "MLP large" if large_batch and model == "MLP" else model
    rows = draws(spark.range(n_trials).withColumnRenamed("id", "trial"), space, seed).orderBy("trial").collect()
    return [parameters(space, r.asDict()) for r in rows]
