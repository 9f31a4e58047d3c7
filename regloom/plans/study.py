"""The study (H11): datasets x models x stages as a resumable run over stored tables.

A study lives in one folder. What it has finished is a ledger of cells (dataset,
model, stage); the results of a cell and its ledger row are committed together,
by writing a new version of the ledger and then moving the version pointer, a
one-row file that readers follow. A reader therefore sees a cell whole or not at
all, and a run that was interrupted starts again with the cells that the ledger
lacks (an anti-join of the grid with it). A version's file lists the paths of
all committed parts, so nothing is renamed and a lost writer leaves only files
that no version names.

Stages of a model on a dataset: ``search`` (trials, scores, parameters) and
``runs`` (nine metrics per seed, predictions of the last). A dataset that cannot
be loaded, or a model that no candidate fits, fails its own cells, with the
cause, and the others go on; the training rows of a dataset are packed once, with
their folds, for all its stages; errors that are neither numerical nor of missing
data (lost jobs, programming errors) stop the study, which can be resumed."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..models.scans import NUMERICAL
from ..operators import report as R
from ..operators import split as S
from ..session import materialize
from ..sources import io
from ..sources.catalog import DatasetSpec
from . import search
from .preprocess import ROW_KEY, load_or_build

STAGES = ("search", "runs")
LEDGER = "dataset int, model string, stage string, status string, error string, path string"


@dataclass
class Dataset:
    """A table of the study; ``load`` gives (table with the key, features, label)."""
    index: int
    name: str
    load: Callable[[SparkSession], tuple[DataFrame, list[str], str]]
    key: Sequence[str] = ("row_key",)


def stored_dataset(spec: DatasetSpec, store: str) -> Dataset:
    """A catalogue entry as a dataset: its stored table, built when it is missing."""
    def load(spark: SparkSession):
        p = load_or_build(spark, spec, f"{store.rstrip('/')}/processed_{spec.index}")
        return p.table, p.features, p.target
    return Dataset(spec.index, spec.name, load, (ROW_KEY,))


class Ledger:
    """Committed cells of a study folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _pointer(self) -> int:
        """Number of the newest version: versions are written whole and never changed."""
        return max(io.folder_numbers(self.spark, f"{self.root}/_ledger", "v"), default=0)

    def rows(self) -> DataFrame:
        version = self._pointer()
        if not version:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(f"{self.root}/_ledger/v{version}")

    def commit(self, cells: list[tuple]) -> None:
        """Add cells (dataset, model, stage, status, error, path); a cell that is there is replaced."""
        new = self.spark.createDataFrame(cells, LEDGER)
        old = self.rows().join(new.select("dataset", "model", "stage"), ["dataset", "model", "stage"], "left_anti")
        io.publish(self.spark, old.unionByName(new).coalesce(1), f"{self.root}/_ledger", "v")  # a row per cell

    def missing(self, grid: DataFrame) -> DataFrame:
        return grid.join(self.rows().where("status = 'done'"), ["dataset", "model", "stage"], "left_anti")

    def table(self, stage: str, kind: str) -> DataFrame | None:
        """All committed results of a stage, tagged with dataset and model; None without any."""
        cells = self.rows().where((F.col("stage") == stage) & (F.col("status") == "done")).orderBy(
            "dataset", "model").collect()  # a row per dataset and model of the study
        out = None
        for c in cells:
            own = self.spark.read.parquet(f"{self.root}/{c.path}/{kind}").select(
                F.lit(c.dataset).alias("dataset"), F.lit(c.model).alias("model"), "*")
            out = own if out is None else out.unionByName(own, allowMissingColumns=True)
        return out


def grid(spark: SparkSession, datasets: Sequence[int], models: Sequence[str]) -> DataFrame:
    rows = [(d, m, s) for d in datasets for m in models for s in STAGES]
    return spark.createDataFrame(rows, "dataset int, model string, stage string")


def run_study(spark: SparkSession, root: str, datasets: Sequence[Dataset], models: Sequence[str] = tuple(search.MODELS),
              profile: str | None = None, n_trials: int = search.N_TRIALS, n_runs: int = search.N_RUNS,
              n_folds: int = search.N_FOLDS, overrides: dict | None = None, max_cells: int | None = None) -> Ledger:
    """Run the cells that the ledger of ``root`` lacks; ``max_cells`` ends the
    run early, as an interruption would. ``profile`` takes a named subset (H12)."""
    if profile is not None:
        indices, own = search.profile_grid(profile)
        datasets, models = [d for d in datasets if d.index in indices], [m for m in models if m in own]
    ledger = Ledger(spark, root)
    open_ = {(r.dataset, r.model, r.stage) for r in ledger.missing(
        grid(spark, [d.index for d in datasets], models)).collect()}
    left = math.inf if max_cells is None else max_cells
    for d in datasets:
        todo = [(m, s) for m in models for s in STAGES if (d.index, m, s) in open_]
        if not todo or left <= 0:
            continue
        try:
            table, features, label = d.load(spark)
            split = materialize(S.holdout(table, list(d.key), search.TEST_SIZE, search.RANDOM_STATE), "split")
        except (AnalysisException, OSError, ValueError) as error:
            ledger.commit([(d.index, m, s, "failed", f"{type(error).__name__}: {error}"[:500], None) for m, s in todo])
            continue
        parts = {side: split.where(F.col("split") == side).drop("split") for side in ("train", "test")}
        packed = None
        for model, stage in todo:
            if left <= 0:
                break
            left -= 1
            path = f"dataset_{d.index}/{model.lower().replace(' ', '_')}/{stage}-{uuid.uuid4().hex}"
            try:
                if packed is None:
                    packed = search.folded_table(parts["train"], features, label, list(d.key), n_folds)
                _STAGE[stage](spark, ledger, d, model, parts, packed, features, label, f"{ledger.root}/{path}",
                              {"n_trials": n_trials, "n_runs": n_runs, "n_folds": n_folds,
                               "overrides": (overrides or {}).get(model)})
                cell = (d.index, model, stage, "done", None, path)
            except NUMERICAL as error:
                cell = (d.index, model, stage, "failed", f"{type(error).__name__}: {error}"[:500], None)
            ledger.commit([cell])
        if packed is not None:
            packed.release()
    return ledger


def _search_stage(spark, ledger, d, model, parts, packed, features, label, path, size):
    st = search.cross_validate(spark, parts["train"], features, label, list(d.key), model, size["n_trials"],
                               size["n_folds"], overrides=size["overrides"], table=packed)
    if math.isinf(st.best_value):
        raise ArithmeticError("no candidate could be fitted")
    st.trials.write.parquet(f"{path}/trials")
    st.scores.write.parquet(f"{path}/scores")
    io.write_params(spark, {**st.best_params, "_json": json.dumps(st.best_params)}, f"{path}/params")


def _runs_stage(spark, ledger, d, model, parts, packed, features, label, path, size):
    found = ledger.table("search", "params")
    row = None if found is None else found.where(
        (F.col("dataset") == d.index) & (F.col("model") == model) & (F.col("key") == "_json")).first()
    if row is None:
        raise ArithmeticError("its search has not succeeded")
    params = json.loads(row.value)
    if "hidden_layer_sizes" in params:
        params["hidden_layer_sizes"] = tuple(params["hidden_layer_sizes"])
    runs = search.repeated_runs(spark, model, params, parts["train"], parts["test"], features, label,
                                size["n_runs"], size["overrides"], packed)
    runs = materialize(runs, "runs")
    if runs.isEmpty():
        raise ArithmeticError("no run ended")
    runs.drop("model").write.parquet(f"{path}/metrics")


_STAGE = {"search": _search_stage, "runs": _runs_stage}


# ---------------------------------------------------------------------------
# results: S10-S12, R9, R10 over the committed cells
# ---------------------------------------------------------------------------

def study_results(ledger: Ledger) -> dict[str, DataFrame]:
    """Tables of a study: ``runs`` of all cells, ``summary`` per dataset and
    model (S11), ``convergence`` of the searches (H8), and the report set (R9)
    with its dataset column. Empty where nothing is committed."""
    out: dict[str, DataFrame] = {}
    runs, trials = ledger.table("runs", "metrics"), ledger.table("search", "scores")
    if runs is not None:
        out |= consolidate(runs)
        out["runs"] = runs
    if trials is not None:
        out["convergence"] = R.convergence(trials.select("dataset", "model", "trial", "value"), by=["dataset", "model"])
    return out


def consolidate(runs: DataFrame, names: dict[int, str] | None = None) -> dict[str, DataFrame]:
    """The report set (R9) and the summary (R3) of run tables tagged with
    their dataset, whose names the summary shows where they are given."""
    by = ["dataset", "model"]
    out = R.report_set(runs, by=by)
    summary = R.summarise(runs, by=by)
    if names:
        shown = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
        summary = summary.withColumn("dataset_name", shown[F.col("dataset")])
    out["summary"] = summary
    return out


def consolidate_folders(spark: SparkSession, root: str, datasets: Sequence[int] = range(4),
                        names: dict[int, str] | None = None) -> dict[str, DataFrame]:
    """S10 then R10 over result folders; a location that is absent or no table
    is skipped, and nothing found is an empty set of tables."""
    runs = io.read_results(spark, root, datasets)
    return {} if runs is None else consolidate(runs, names)


def write_results(ledger: Ledger, root: str | None = None) -> list[str]:
    """Run tables and summaries as tables under ``root`` (the
    study's folder): ``dataset_<i>/all_results``, ``dataset_<i>/summary`` and
    ``global_summary``. Models run again replace their old rows."""
    spark, root = ledger.spark, (root or ledger.root).rstrip("/")
    results = study_results(ledger)
    if "runs" not in results:
        return []
    written = []
    for (i,) in results["runs"].select("dataset").distinct().orderBy("dataset").collect():  # a row per dataset
        own = F.col("dataset") == i
        merged = io.upsert_runs(spark, results["runs"].where(own).drop("dataset"), f"{root}/dataset_{i}/all_results")
        io.write_table(R.summarise(merged, by=["model"]), f"{root}/dataset_{i}/summary")
        written += [f"{root}/dataset_{i}/all_results", f"{root}/dataset_{i}/summary"]
    io.write_table(results["summary"], f"{root}/global_summary")
    return [*written, f"{root}/global_summary"]
