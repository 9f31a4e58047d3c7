import pytest
from pyspark.sql import functions as F

from regloom.functions import parse as P
from regloom.operators import clean as C


def test_text_to_number(spark):
    vals = ["$10,300", "25,612", " 7 ", "51,000 mi.", "", "abc", "nan", "inf", "1.0d", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(P.currency_to_number("s")).collect()]
    assert got == [10300.0, 25612.0, 7.0, None, None, None, None, None, None, None]
    got = [r[0] for r in df.select(P.unit_to_number("s")).collect()]
    assert got[3] == 51000.0 and got[1] == 25612.0


def test_used_car_rules(spark):
    rows = [("3.5L V6 300.0HP", "6-Speed A/T", "Black / Tan", None, 2016),
            ("Gas/Electric 2.0 Liter", "M/T", "ebony", "None reported", 2020),
            ("Electric Motor", "Transmission w/Dual Shift Mode", "TAN", "At least 1 accident", 2024),
            (None, None, None, "Damage", 2000)]
    df = spark.createDataFrame(rows, "engine string, transmission string, ext_col string, accident string, model_year int")
    out = C.clean_used_car(df).collect()
    assert [r.engine_hp for r in out] == [300.0, None, None, None]
    assert [r.engine_liters for r in out] == [3.5, 0.0, 0.0, None]
    assert [r.trans_automatic for r in out] == [1.0, 0.0, 1.0, 0.0]
    assert [r.trans_manual for r in out] == [0.0, 1.0, 0.0, 0.0]
    assert [r.ext_col for r in out] == ["black", "black", "brown", "other"]
    assert [(r.accident_reported, r.accident_none) for r in out] == [(0, 0), (0, 1), (1, 0), (1, 0)]
    assert [r.car_age for r in out] == [10, 6, 2, 26]
    assert "engine" not in C.clean_used_car(df).columns


def test_drops_and_target(spark):
    df = spark.createDataFrame([(1, 2.0, "x", None)], "`Unnamed: 0` int, a double, flight string, price string")
    out = C.clean_flight(df)
    assert out.columns == ["a", "price"]
    assert C.drop_missing_target(out, "price").count() == 0
    with pytest.raises(ValueError):
        C.require_target(out, "nope")
