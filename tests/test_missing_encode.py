import numpy as np
import pandas as pd
import pytest

from regloom.operators import encode as N
from regloom.operators import missing as D


def test_missing_bands(spark):
    n = 100
    idx = np.arange(n)
    pdf = pd.DataFrame({
        "five": np.where(idx < 5, np.nan, idx * 1.0),      # 5 % -> rows dropped
        "six": np.where(idx < 6, np.nan, idx * 2.0),       # 6 % -> median
        "fifty": np.where(idx < 50, np.nan, 1.0),          # 50 % -> kept, median
        "fiftyone": np.where(idx < 51, np.nan, 1.0),       # 51 % -> column dropped
        "txt": np.where(idx % 10 == 0, None, np.where(idx % 2 == 0, "b", "a")),  # 10 % mode (tie -> 'a')
    })
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                               "five double, six double, fifty double, fiftyone double, txt string")
    out, plan = D.handle_missing(df)
    assert plan.drop_columns == ["fiftyone"]
    assert plan.drop_row_columns == ["five"]
    assert plan.fill_values["six"] == pytest.approx(np.nanmedian(pdf.six))
    assert plan.fill_values["txt"] == "a"
    assert out.count() == 95 and "fiftyone" not in out.columns
    assert out.where("six is null or txt is null").count() == 0


def test_dedupe_keeps_null_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert D.dedupe(df).count() == 2


@pytest.mark.parametrize("levels,onehot", [(1, True), (2, True), (100, True), (101, False)])
def test_router_boundaries(spark, levels, onehot):
    df = spark.createDataFrame([(f"v{i % levels:03d}",) for i in range(300)], "c string")
    plan = N.plan_encoding(df)
    assert ("c" in plan.onehot) == onehot
    out = N.apply_encoding(df, plan)
    if onehot:
        assert len(out.columns) == levels - 1      # first level dropped
    else:
        codes = sorted({r[0] for r in out.collect()})
        assert codes == list(map(float, range(levels)))


def test_minmax_constant_and_standardise(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (4.0, 3.0)], "a double, b double")
    out = N.minmax_scale(df, ["a", "b"]).collect()
    assert [r.a for r in out] == [0.0, 1.0 / 3.0, 1.0] and {r.b for r in out} == {0.0}
    st = N.standard_stats(df, ["a", "b"])
    z = N.standardise(df, st).toPandas()
    assert z.a.mean() == pytest.approx(0) and z.a.std(ddof=0) == pytest.approx(1)
    assert set(z.b) == {0.0}
