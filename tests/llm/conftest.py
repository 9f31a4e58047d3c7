import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType()), T.StructField("_row", T.StringType()),
                    T.StructField("size", T.StringType())])


def words(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


ROWS = [
    (1, words(40)), (2, words(40)), (3, words(39) + " other"), (4, words(41, 100)), (5, ""), (6, None),
    (7, "one"), (7, "one"), (8, "the " + words(3000, 500)), (None, "no id here"), (None, None),
    (9, "Shared line\n  SHARED LINE \nown nine"), (10, words(10) + "\n" + words(10)),
    *[(20 + i, f"shared LINE\nown {i} of ten\t") for i in range(10)],
    (40, "Licensed under the Apache License, Version 2.0.\nAll rights reserved. cc by cc by"),
    (41, "é ß 😀  two  spaces ▁ mark\n"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Ties, repeats, nulls in every column, empty and long texts, columns with clashing names."""
    rows = [(i, t, None if n % 5 == 0 else "en", None if n % 4 == 0 else f"s{n % 3}",
             None if t is None else len(t), "clash", None) for n, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, DOC).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC)
