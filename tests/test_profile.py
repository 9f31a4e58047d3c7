import dataclasses

import numpy as np
import pandas as pd
import pytest

from regloom.operators import profile as E


def test_pairwise_complete_correlation_matches_pandas(spark):
    rng = np.random.RandomState(5)
    n = 300
    a = rng.randn(n) * 1e5 + 1e7          # large offset: needs the shifted-sum form
    b = 0.3 * a + rng.randn(n) * 1e4
    c = rng.randn(n)
    pdf = pd.DataFrame({"a": a, "b": b, "c": c, "k": np.ones(n)})
    pdf.loc[rng.rand(n) < 0.2, "b"] = np.nan
    pdf.loc[rng.rand(n) < 0.1, "c"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                               "a double, b double, c double, k double")
    got = E.correlation_long(df).toPandas().set_index(["col_a", "col_b"])["corr"]
    exp = pdf.corr()
    for x in "abc":
        for y in "abc":
            assert got[(x, y)] == pytest.approx(exp.loc[x, y], abs=1e-9)
    assert got[("k", "a")] is None or np.isnan(got[("k", "a")])
    top = E.top_correlated(df, "a", 2).toPandas()
    assert list(top.feature) == ["b", "c"]


def test_describe_and_target_summary(spark):
    vals = [1.0, 2.0, 4.0, 8.0, None]
    df = spark.createDataFrame([(v, f"${v:,.0f}" if v else None) for v in vals], "x double, t string")
    d = E.describe(df, ["x"]).collect()[0]
    s = pd.Series([1.0, 2.0, 4.0, 8.0]).describe()
    assert (d["count"], d["mean"], d["std"], d["p25"], d["p50"], d["p75"]) == pytest.approx(
        (s["count"], s["mean"], s["std"], s["25%"], s["50%"], s["75%"]))
    t = E.target_summary(df, "t").collect()[0]
    assert (t["min"], t["max"], t["median"]) == (1.0, 8.0, 3.0)
    prof = E.column_profile(df).toPandas().set_index("column")
    assert prof.loc["x", "n_missing"] == 1 and prof.loc["x", "n_distinct"] == 4


def test_distinct_counts_take_a_column_at_a_time(spark):
    df = spark.createDataFrame([(None, 0.0, "a"), (1, -0.0, None), (1, float("nan"), "b"), (2, None, "b")],
                               "k int, v double, `s.t` string")
    prof = E.column_profile(df)
    got = {r.column: (r.position, r.dtype, r.n_rows, r.n_missing, r.n_distinct) for r in prof.collect()}
    assert got == {"k": (0, "int", 4, 1, 2), "v": (1, "double", 4, 2, 1), "s.t": (2, "string", 4, 1, 2)}
    assert [r.n_rows for r in E.column_profile(df.limit(0)).collect()] == [0, 0, 0]
    assert "Expand" not in prof._jdf.queryExecution().executedPlan().toString()  # no row per column of every row


def test_a_profile_reads_the_text_a_fixed_number_of_times(spark, tmp_path, monkeypatch):
    from regloom.plans import eda
    from regloom.sources import catalog, io
    spark.range(50).selectExpr("id AS a", "id * 1.5 AS price", "'x y' AS `b c`").write.option("header", True).csv(
        str(tmp_path / "t.csv"))
    seen, real = [], eda.run_eda
    monkeypatch.setattr(eda, "run_eda", lambda raw, target: seen.append(raw) or real(raw, target))
    spec = next(iter(catalog.default_catalog(str(tmp_path))))
    spec = dataclasses.replace(spec, raw_path=str(tmp_path / "t.csv"), target="price")
    tables, _ = eda.run_all_eda(spark, [spec])
    assert not any(f.endswith(".csv") for f in seen[0].inputFiles())
    assert [(r.column, r.n_distinct) for r in tables[spec.index]["columns"].orderBy("position").collect()] == [
        ("a", 50), ("price", 50), ("b c", 1)]
