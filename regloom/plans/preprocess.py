"""Full preprocessing pipeline (N6), load-or-build (S4) and build-all."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import encode as N
from ..operators import missing as D
from ..session import materialize
from ..sources import io
from ..sources.catalog import DatasetSpec


@dataclass
class Prepared:
    table: DataFrame          # features (all double, [0,1]) + target last
    features: list[str]
    target: str
    log: dict = field(default_factory=dict)


def prepare(df: DataFrame, target: str, drop: tuple[str, ...] = (), cleaner=None,
            protect_target: bool = False, persist: bool = True, key: str | None = None) -> Prepared:
    """N6 over an already-read raw DataFrame: C1 -> cleaner -> D1 -> D7 ->
    C17 -> C18 -> C19 -> N1-N3 -> N4. Eager points: missing profile and fill
    statistics, category levels, min/max.

    ``key`` adds a first column of that name that tells the rows apart for
    splits: the md5 of the row's values after D1, which are distinct. It is no
    feature and no part of the missing profile."""
    log: dict = {}
    df = C.drop_if_present(df, drop)
    if cleaner is not None:
        df = cleaner(df)
    df = D.dedupe(df)
    keys = [key] if key else []
    if key:
        said = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(df.columns)]))
        df = df.select(F.md5(said.cast("binary")).alias(key), "*")
    if persist:
        # read by the profile, the fill statistics, the level scan and min/max:
        # written once into the shared checkpoint folder, by columns (no cache left behind)
        df = materialize(df, "deduped")
    plan = D.plan_missing(df.drop(*keys), protect=(target,) if protect_target else ())
    df = D.apply_missing(df, plan)
    log["missing"] = plan.report
    C.require_target(df, target)
    df = C.drop_missing_target(df, target)
    # the target rides along its row through encoding, last
    both = df.select(*[F.col(f"`{c}`") for c in df.columns if c != target],
                     F.col(f"`{target}`").cast("double").alias(target))
    enc_plan = N.plan_encoding(both.drop(target, *keys))
    log["onehot"] = list(enc_plan.onehot)
    log["label"] = list(enc_plan.label)
    encoded = N.apply_encoding(both, enc_plan)
    features = [c for c in encoded.columns if c not in (target, *keys)]
    encoded = encoded.select(*keys, *[F.col(f"`{c}`").cast("double").alias(c) for c in features],
                             F.col(f"`{target}`"))
    scaled = N.minmax_scale(encoded, features)
    return Prepared(scaled.select(*keys, *[F.col(f"`{c}`") for c in features], F.col(f"`{target}`")),
                    features, target, log)


#: Key column of stored tables.
ROW_KEY = "row_key"


def preprocess_and_save(spark: SparkSession, spec: DatasetSpec, out_path: str) -> Prepared:
    """S1/S2 read, N6, S5 write; returns the table read back from storage."""
    raw = io.read_csv(spark, spec.raw_path)
    prep = prepare(raw, spec.target, spec.drop, spec.cleaner, key=ROW_KEY)
    io.write_processed(prep.table, spec.target, out_path)
    table, feats = io.read_processed(spark, out_path, spec.target, ROW_KEY)
    return Prepared(table, feats, spec.target, prep.log)


def load_or_build(spark: SparkSession, spec: DatasetSpec, out_path: str,
                  force: bool = False) -> Prepared:
    """Stored table unless missing (its success mark is looked for) or ``force``."""
    if io.path_exists(spark, f"{out_path.rstrip('/')}/_SUCCESS") and not force:
        table, feats = io.read_processed(spark, out_path, spec.target, ROW_KEY)
        return Prepared(table, feats, spec.target)
    return preprocess_and_save(spark, spec, out_path)


def build_all(spark: SparkSession, specs: list[DatasetSpec], out_root: str,
              force: bool = False) -> DataFrame:
    """Build every dataset; one failure does not stop the others.
    Returns ``(dataset, status, error)``."""
    rows = []
    for spec in specs:
        path = f"{out_root.rstrip('/')}/processed_{spec.index}"
        try:
            stored = io.path_exists(spark, f"{path}/_SUCCESS") and not force
            load_or_build(spark, spec, path, force)
            rows.append((spec.index, "exists" if stored else "built", None))
        except (AnalysisException, ValueError) as e:  # absent or unusable data; lost jobs propagate
            rows.append((spec.index, "failed", f"{type(e).__name__}: {e}"))
    return spark.createDataFrame(rows, "dataset int, status string, error string")
