"""Sources and sinks.

Raw CSV is read as text and typed by one aggregate pass over the whole file
(not a sample); processed tables and result tables are Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Text read as missing (the usual CSV NA tokens)
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null"]
INT_SHAPE = r"^[+-]?[0-9]+$"
FLOAT_SHAPE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(inf|Infinity)$"
BOOL_VALUES = ["True", "False", "TRUE", "FALSE", "true", "false"]
REPLACEMENT_CHAR = "�"


def _raw_csv(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    return (spark.read.option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("encoding", encoding)
            .option("inferSchema", False).csv(path))


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text. UTF-8 first; if any value holds the U+FFFD
    replacement character (undecodable bytes) the file is re-read as
    ISO-8859-1. The probe stops at the first hit."""
    df = _raw_csv(spark, path, "UTF-8")
    if not df.columns:
        return df
    bad = df.where(F.concat_ws("", *[F.col(f"`{c}`") for c in df.columns]).contains(
        REPLACEMENT_CHAR)).limit(1).count()
    return _raw_csv(spark, path, "ISO-8859-1") if bad else df


def infer_types(df: DataFrame, na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """NA tokens -> NULL, then per column the narrowest of bigint ->
    double -> boolean -> string that fits *every* non-missing value (one
    aggregate over the whole table). Whole numbers beyond bigint are doubles;
    true/false values with some missing stay text, a category of its own."""
    cols = df.columns
    na = F.array(*[F.lit(t) for t in na_tokens])
    clean = df.select(*[F.when(F.array_contains(na, F.col(f"`{c}`")), F.lit(None))
                        .otherwise(F.col(f"`{c}`")).alias(c) for c in cols])
    aggs = []
    for i, c in enumerate(cols):
        s = F.trim(F.col(f"`{c}`"))
        aggs += [F.count(s).alias(f"n{i}"),
                 F.count(F.when(s.rlike(INT_SHAPE) & s.try_cast("bigint").isNotNull(), 1)).alias(f"i{i}"),
                 F.count(F.when(s.rlike(FLOAT_SHAPE) | s.rlike(INT_SHAPE), 1)).alias(f"f{i}"),
                 F.count(F.when(s.isin(BOOL_VALUES), 1)).alias(f"b{i}")]
    r = clean.agg(F.count(F.lit(1)).alias("rows"), *aggs).first() if cols else None
    sel = []
    for i, c in enumerate(cols):
        s = F.trim(F.col(f"`{c}`"))
        n = r[f"n{i}"]
        if n and r[f"i{i}"] == n:
            sel.append(s.try_cast("bigint").alias(c))
        elif n and r[f"f{i}"] == n:
            sel.append(s.try_cast("double").alias(c))
        elif n and r[f"b{i}"] == n == r["rows"]:
            sel.append((F.lower(s) == "true").alias(c))
        elif not n:
            sel.append(F.lit(None).cast("double").alias(c))  # all missing: float column
        else:
            sel.append(F.col(f"`{c}`").alias(c))
    return clean.select(*sel)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """S1 + S2."""
    return infer_types(read_csv_text(spark, path))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option(
        "escape", '"').csv(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (cluster-visible)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/regloom-io/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """S4 presence probe through the Hadoop FileSystem of the path."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def write_processed(df: DataFrame, target: str, path: str) -> None:
    """The columns with the target last, overwrite."""
    cols = [c for c in df.columns if c != target] + [target]
    df.select(*[F.col(f"`{c}`") for c in cols]).write.mode("overwrite").parquet(path)


def read_processed(spark: SparkSession, path: str, target: str,
                   key: str | None = None) -> tuple[DataFrame, list[str]]:
    """Processed table and its ordered feature names (all but target and key)."""
    df = spark.read.parquet(path)
    return df, [c for c in df.columns if c not in (target, key)]


def _folder(spark: SparkSession, path: str):
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    return to, to.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_numbers(spark: SparkSession, root: str, name: str, finished: bool = True) -> list[int]:
    """Numbers n of the folders ``<root>/<name><n>``; ``finished``: those with a success mark."""
    to, fs = _folder(spark, root)
    if not fs.exists(to):
        return []
    out = []
    for status in fs.listStatus(to):
        own = status.getPath().getName()
        if own.startswith(name) and own[len(name):].isdigit() and (
                not finished or path_exists(spark, f"{root}/{own}/_SUCCESS")):
            out.append(int(own[len(name):]))
    return out


def publish(spark: SparkSession, df: DataFrame, root: str, name: str) -> str:
    """Write the next version ``<root>/<name><n>``. Its success mark is the
    pointer that readers follow (the greatest finished number), so a reader sees
    this version whole or the one before it; nothing is renamed, and what a
    lost writer left is passed over. Two writers at once: one takes the number,
    the other fails."""
    path = f"{root}/{name}{max(folder_numbers(spark, root, name, finished=False), default=0) + 1}"
    df.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)
    return path


def versioned_path(spark: SparkSession, path: str) -> str | None:
    """The newest finished version of a versioned table; None without one."""
    last = max(folder_numbers(spark, path.rstrip("/"), "v"), default=0)
    return f"{path.rstrip('/')}/v{last}" if last else None


def upsert_runs(spark: SparkSession, new: DataFrame, path: str, key: str = "model",
                ignore_corrupt: bool = False) -> DataFrame:
    """Rows of the models in ``new`` replace their old rows; other models'
    rows stay. The table at ``path`` is a folder of versions: the merged rows
    are written as the next one, and readers take the newest finished one, so
    a crash leaves the table as it was. A plain table already at ``path`` (one
    that was written without versions) is read as the version before the first."""
    current = versioned_path(spark, path)
    if current is None and path_exists(spark, path):
        current = path
    merged = new
    if current is not None:
        try:
            old = spark.read.parquet(current)
            merged = old.join(new.select(key).distinct(), key, "left_anti").unionByName(
                new, allowMissingColumns=True)
        except AnalysisException:  # not a table
            if not ignore_corrupt:
                raise
    return spark.read.parquet(publish(spark, merged, path.rstrip("/"), "v"))


def read_versioned(spark: SparkSession, path: str) -> DataFrame:
    """A table with versions (its newest) or without."""
    return spark.read.parquet(versioned_path(spark, path) or path)


def write_params(spark: SparkSession, params: dict, path: str) -> DataFrame:
    """Best parameters as ``(key, value)`` text rows."""
    df = spark.createDataFrame([(str(k), str(v)) for k, v in params.items()],
                               "key string, value string")
    df.coalesce(1).write.mode("overwrite").parquet(path)
    return df


def read_results(spark: SparkSession, root: str, datasets: Sequence[int] = range(4),
                 name: str = "all_results") -> DataFrame | None:
    """``<root>/dataset_<i>/<name>`` (a table, with versions or without) or
    ``<name>.csv`` for each i that exists and reads, tagged with ``dataset``;
    None when nothing was found."""
    parts = []
    for i in datasets:
        p = f"{root.rstrip('/')}/dataset_{i}/{name}"
        if not path_exists(spark, p):
            p += ".csv"
        if not path_exists(spark, p):
            continue
        try:
            own = read_csv(spark, p) if p.endswith(".csv") else read_versioned(spark, p)
            parts.append(own.withColumn("dataset", F.lit(int(i))))
        except AnalysisException:  # no table there; a lost job is not that and propagates
            continue
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def write_table(df: DataFrame, path: str) -> None:
    """S11/S12 summary sinks."""
    df.write.mode("overwrite").parquet(path)

