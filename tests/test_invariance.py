"""Results must not depend on how the input is partitioned."""
import numpy as np
import pandas as pd
import pytest

from regloom.models import numerics as NP
from regloom.operators.gram import gram
from regloom.operators.metrics import METRICS, regression_metrics
from regloom.sources import io


@pytest.fixture(scope="module")
def pred(spark):
    rng = np.random.RandomState(11)
    pdf = pd.DataFrame({"model": rng.choice(["a", "b", "c"], 2000), "y": rng.rand(2000) * 50 - 10,
                        "p": rng.rand(2000) * 50 - 10})
    return spark.createDataFrame(pdf)


def test_metrics_partition_invariant(pred):
    outs = []
    for parts in (1, 7, 16):
        df = regression_metrics(pred.repartition(parts), by=["model"]).toPandas()
        outs.append(df.sort_values("model").reset_index(drop=True))
    for o in outs[1:]:
        assert np.allclose(outs[0][METRICS].to_numpy(dtype=float), o[METRICS].to_numpy(dtype=float),
                           rtol=1e-12, atol=1e-12, equal_nan=True)


def test_gram_partition_invariant(pred):
    design = lambda X: NP.augmented(X)
    g1 = gram(pred.repartition(1), ["p"], "y", design, 2)
    g2 = gram(pred.repartition(13), ["p"], "y", design, 2)
    assert np.allclose(g1.ata, g2.ata) and np.allclose(g1.aty, g2.aty) and g1.n == g2.n == 2000


def test_type_inference_precedence(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "True", "x", "NA", "7"), ("2", "2", "false", "3", "", "n/a"), (None, "NaN", "TRUE", "y", None, "8")],
        "i string, f string, b string, s string, allna string, withna string")
    out = io.infer_types(df)
    assert dict(out.dtypes) == {"i": "bigint", "f": "double", "b": "boolean", "s": "string",
                                "allna": "double", "withna": "bigint"}
    rows = out.collect()
    assert rows[1].withna is None and rows[2].f is None and rows[1].b is False
