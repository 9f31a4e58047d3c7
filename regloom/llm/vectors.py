"""Sums of dense vectors, computed per task, over the cluster in two levels.

A task adds its rows into dense vectors and emits one row per vector. These
partial vectors are added in groups of at most ``FAN`` parts first and the
groups' sums after that, so no task holds a vector of every task. Parts are
added in the order of their numbers: the sum is the same in every run that
cuts the input alike."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 64


def _adder(keys: list[str], dtype: str):
    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("part").to_numpy(), kind="stable").tolist()
        vectors, total = table.column("vector"), None
        for i in order:
            part = np.frombuffer(vectors[i].as_py(), dtype=dtype)
            total = part.copy() if total is None else total + part
        return pa.table({**{k: table.column(k).slice(order[0], 1) for k in [*keys, "part"]},
                         "vector": pa.array([total.tobytes()], pa.binary())})
    return add


def tree_sum(partials: DataFrame, keys: list[str], dtype: str) -> DataFrame:
    """(keys, part, vector) with one row per key. ``partials`` has the keys, a
    long ``part`` that numbers the task and ``vector``, the bytes of a NumPy
    vector of ``dtype`` with one length per key."""
    columns, kinds = [*keys, "part", "vector"], dict(partials.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns)
    add = _adder(keys, dtype)
    grouped = partials.select(*columns).withColumn("_group", F.floor(F.col("part") / FAN))
    return (grouped.groupBy(*keys, "_group").applyInArrow(add, schema)
            .groupBy(*keys).applyInArrow(add, schema))
