from regloom.sources import io


def test_csv_latin1_fallback_quotes_newlines_na(spark, tmp_path):
    raw = ('id,name,price,when,flag\n'
           '1,"Caf\xe9, Ltd",10.5,2020-01-02,True\n'
           '2,"two\nlines",NA,2021-03-04,False\n'
           '3,plain,7,,True\n').encode("latin-1")
    path = tmp_path / "bad_bytes.csv"
    path.write_bytes(raw)
    df = io.read_csv(spark, str(path))
    types = dict(df.dtypes)
    assert types == {"id": "bigint", "name": "string", "price": "double", "when": "string",
                     "flag": "boolean"}
    rows = sorted(df.collect(), key=lambda r: r.id)
    assert rows[0].name == "Café, Ltd"            # re-read as ISO-8859-1
    assert rows[1].name == "two\nlines" and rows[1].price is None
    assert rows[2].when is None and rows[2].price == 7.0


def test_upsert_replaces_only_new_models(spark, tmp_path):
    old = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 2.0)], "model string, run int, MSE double")
    path = str(tmp_path / "all_results")
    old.write.parquet(path)
    new = spark.createDataFrame([("b", 0, 9.0), ("c", 0, 3.0)], "model string, run int, MSE double")
    merged = {r.model: r.MSE for r in io.upsert_runs(spark, new, path).collect()}
    assert merged == {"a": 1.0, "b": 9.0, "c": 3.0}


def test_params_sink_and_results_scan(spark, tmp_path):
    params = {"n_centers": 20, "sigma_mode": "per_center", "alpha": 0.001}
    io.write_params(spark, params, str(tmp_path / "best_params_rbf"))
    back = {r.key: r.value for r in spark.read.parquet(str(tmp_path / "best_params_rbf")).collect()}
    assert back == {k: str(v) for k, v in params.items()}
    runs = spark.createDataFrame([("a", 0, 1.0)], "model string, run int, MSE double")
    runs.write.parquet(str(tmp_path / "res" / "dataset_2" / "all_results"))
    got = io.read_results(spark, str(tmp_path / "res")).collect()
    assert [(r.dataset, r.model) for r in got] == [(2, "a")]
    assert io.read_results(spark, str(tmp_path / "nothing")) is None


def test_two_upserts_keep_both_models(spark, tmp_path):
    from regloom.sources import io

    path = str(tmp_path / "runs")
    io.upsert_runs(spark, spark.createDataFrame([("A", 1.0), ("B", 2.0)], "model string, RMSE double"), path)
    io.upsert_runs(spark, spark.createDataFrame([("B", 3.0)], "model string, RMSE double"), path)
    io.upsert_runs(spark, spark.createDataFrame([("C", 4.0)], "model string, RMSE double"), path)
    assert sorted(map(tuple, io.read_versioned(spark, path).collect())) == [("A", 1.0), ("B", 3.0), ("C", 4.0)]


def test_wide_integers_and_gappy_booleans(spark):
    from regloom.sources import io

    df = spark.createDataFrame([("12345678901234567890", "true", "True"), ("1", None, "false")],
                               "a string, b string, c string")
    out = io.infer_types(df)
    assert dict(out.dtypes) == {"a": "double", "b": "string", "c": "boolean"}
    assert out.where("a is null").count() == 0


def test_an_interrupted_upsert_leaves_the_table_as_it_was(spark, tmp_path):
    import os

    path = str(tmp_path / "runs")
    io.upsert_runs(spark, spark.createDataFrame([("A", 1.0)], "model string, RMSE double"), path)
    os.makedirs(f"{path}/v2")  # what a lost writer leaves: no success mark
    assert [tuple(r) for r in io.read_versioned(spark, path).collect()] == [("A", 1.0)]
    io.upsert_runs(spark, spark.createDataFrame([("B", 2.0)], "model string, RMSE double"), path)
    assert sorted(map(tuple, io.read_versioned(spark, path).collect())) == [("A", 1.0), ("B", 2.0)]


def test_result_files_in_csv_and_unreadable_places(spark, tmp_path):
    for i in (0, 1, 3):
        (tmp_path / f"dataset_{i}").mkdir()
    (tmp_path / "dataset_0" / "all_results.csv").write_text("MSE,model,run\n1.5,MLP,0\n2.5,MLP,1\n")
    (tmp_path / "dataset_1" / "all_results").mkdir()  # an empty folder is no table
    io.upsert_runs(spark, spark.createDataFrame([("A", 0, 9.0)], "model string, run int, MSE double"),
                   str(tmp_path / "dataset_3" / "all_results"))
    got = sorted((r.dataset, r.model, r.MSE) for r in io.read_results(spark, str(tmp_path)).collect())
    assert got == [(0, "MLP", 1.5), (0, "MLP", 2.5), (3, "A", 9.0)]
