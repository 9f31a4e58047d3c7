"""Line deduplication over levelled runs of line hashes.

Each batch of documents adds a run: its distinct line hashes, sorted, with the
number of documents that hold them. Runs sit on levels; when a level has
``fanout`` runs they are aggregated into one run of the next level, so a corpus
of n batches keeps O(log n) runs. Documents are cleaned by looking their line
hashes up in the sorted hashes of the lines to drop, or by a join where these
are too many to broadcast.

A line's key is the line without ASCII white space at both ends, A-Z lowered.
Nulls: a null text is one empty line and stays null. Empty keys are never
dropped. Every row counts as a document of its own, repeated rows too. All
columns of the input pass through untouched. Keys are compared by 64-bit
hash. An empty table gives an empty table."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize

#: Up to so many line hashes (8 bytes each) reach the tasks as one broadcast array; more are joined.
BROADCAST_LINES = 2_000_000
#: Distinct hashes that one task holds before it passes its partial counts on.
HELD = 1_000_000


def line_keys(text: str | None) -> list[bytes]:
    return [line.strip().lower() for line in (text or "").encode().split(b"\n")]


def _hash(key: bytes) -> int:
    """Signed 64-bit hash; the empty key is 0 and no other key is."""
    if not key:
        return 0
    return _signed(xxhash.xxh3_64_intdigest(key) or 1)


def _signed(h: int) -> int:
    return h - (h >> 63 << 64)


def _own(hashes: np.ndarray) -> int:
    """Hash of a text's line keys in order: copies share it, whatever their case and outer white space."""
    return _signed(xxhash.xxh3_64_intdigest(hashes.tobytes()))


def _hashes(texts) -> tuple[list[int], np.ndarray]:
    """Lines per text, and the hashes of all their lines in order."""
    lengths, hashes = [], []
    for text in texts:
        keys = line_keys(text)
        lengths.append(len(keys))
        hashes += map(_hash, keys)
    return lengths, np.array(hashes, dtype=np.int64)


def _partial_counts(column: str, batches: int):
    """Per task: (batch, hash, documents that hold it). A task's input split fixes its batch."""
    def count(stream):
        batch = TaskContext.get().partitionId() % batches
        held: dict[int, int] = {}

        def out():
            n = len(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([batch] * n, pa.int32()), pa.array(held.keys(), pa.int64()),
                 pa.array(held.values(), pa.int64())], ["batch", "h", "docs"])
        for part in stream:
            for text in part.column(column).to_pylist():
                for h in {_hash(k) for k in line_keys(text)}:
                    held[h] = held.get(h, 0) + 1
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()
    return count


class LineRuns:
    """The runs of one corpus, in a folder of the shared checkpoint folder."""

    def __init__(self, spark, fanout: int = 4, path: str | None = None):
        self.spark, self.fanout = spark, fanout
        self.path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/line-runs-{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []

    def add(self, docs: DataFrame, text: str = "text", batches: int = 1) -> None:
        """One run per batch; with ``batches`` over 1 one scan of ``docs``
        makes them all, its input splits dealt to batches in turn."""
        counts = docs.select(F.col(text).alias("text")).mapInArrow(
            _partial_counts("text", batches), "batch int, h long, docs long")
        path = f"{self.path}/L0-{uuid.uuid4().hex}"
        (counts.where("h != 0").groupBy("batch", "h").agg(F.sum("docs").alias("docs"))
         .repartition("batch", "h").sortWithinPartitions("batch", "h")
         .write.partitionBy("batch").parquet(path))
        there = {r["batch"] for r in self.spark.read.schema("h long, docs long, batch int")
                 .parquet(path).select("batch").distinct().collect()}
        for b in sorted(there):
            self._push(0, f"{path}/batch={b}")

    def _push(self, level: int, path: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            merged = f"{self.path}/L{level + 1}-{uuid.uuid4().hex}"
            self._merged(runs).sortWithinPartitions("h").write.parquet(merged)
            self._push(level + 1, merged)

    def _merged(self, runs: list[str]) -> DataFrame:
        return (self.spark.read.schema("h long, docs long").parquet(*runs)
                .groupBy("h").agg(F.sum("docs").alias("docs")))

    def counts(self) -> DataFrame:
        """(h, docs) over all runs."""
        runs = [r for level in self.levels for r in level]
        if not runs:
            return self.spark.createDataFrame([], "h long, docs long")
        return self._merged(runs)

    def frequent(self, least: int) -> DataFrame:
        """Sorted hashes of lines held by at least ``least`` documents."""
        return self.counts().where(F.col("docs") >= least).select("h")


def _sorted_drop(column: str, drop) -> object:
    """Clean a batch: its line hashes are matched against the sorted array of
    ``drop()``; lines stay in texts whose hash stands beside them (None: in none)."""
    def clean(stream):
        gone, owner = drop()
        for part in stream:
            texts = part.column(column).to_pylist()
            lengths, hashes = _hashes(texts)
            at = np.searchsorted(gone, hashes)
            hit = np.zeros(len(hashes), dtype=bool)
            inside = at < len(gone)
            hit[inside] = gone[at[inside]] == hashes[inside]
            if owner is not None:
                hit[hit] = owner[at[hit]] != np.repeat(_owns(lengths, hashes), lengths)[hit]
            yield _rewritten(part, column, texts, lengths, hit)
    return clean


def _owns(lengths: list[int], hashes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths, dtype=np.int64)
    return np.array([_own(hashes[e - n:e]) for n, e in zip(lengths, ends)], dtype=np.int64)


def _listed_drop(column: str):
    """Clean a batch whose rows carry the hashes to drop in ``_gone``."""
    def clean(stream):
        for part in stream:
            texts, gone = part.column(column).to_pylist(), part.column("_gone").to_pylist()
            lengths, hashes = _hashes(texts)
            hit, start = np.zeros(len(hashes), dtype=bool), 0
            for n, g in zip(lengths, gone):
                if g:
                    hit[start:start + n] = np.isin(hashes[start:start + n], np.array(g, dtype=np.int64))
                start += n
            yield _rewritten(part.drop_columns(["_gone"]), column, texts, lengths, hit)
    return clean


def _rewritten(part, column, texts, lengths, hit):
    kept, dropped, start = [], [], 0
    for text, n in zip(texts, lengths):
        gone = hit[start:start + n]
        start += n
        dropped.append(int(gone.sum()))
        if dropped[-1]:
            text = "\n".join(x for x, g in zip(text.split("\n"), gone) if not g)
        kept.append(text)
    part = part.set_column(part.schema.get_field_index(column), column, pa.array(kept, pa.string()))
    return pa.RecordBatch.from_arrays(
        [*part.columns, pa.array(lengths, pa.int64()), pa.array(dropped, pa.int64())],
        [*part.schema.names, "_n_lines", "_n_dropped"])


def _row_lines(stream):
    """(row key, hash of the row's text, line hash) of each distinct line of each row."""
    for part in stream:
        ids, out = part.column("_id").to_pylist(), ([], [], [])
        for i, text in zip(ids, part.column("text").to_pylist()):
            _, hashes = _hashes([text])
            lines = set(hashes.tolist()) - {0}
            out[0].extend([i] * len(lines))
            out[1].extend([_own(hashes)] * len(lines))
            out[2].extend(lines)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())],
            ["_id", "own", "h"])


def drop_lines(docs: DataFrame, frequent: DataFrame, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """``docs`` (with a string column ``text``) without the lines whose hash is
    in ``frequent``, plus ``_n_lines`` and ``_n_dropped``. Where ``frequent``
    has a column ``owner``, a line stays in the texts with that hash.

    ``frequent`` is broadcast only when counted to hold at most
    ``broadcast_lines`` hashes. A larger one is semi-joined with the line
    hashes, and the hits come back to their document by a hash of its text."""
    spark = docs.sparkSession
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    plain = docs.toDF(*names)
    schema = ", ".join(f"{n} {t}" for n, t in plain.dtypes) + ", _n_lines long, _n_dropped long"
    owned = "owner" in frequent.columns
    if frequent.count() <= broadcast_lines:
        rows = frequent.toPandas().sort_values("h")
        gone = rows["h"].to_numpy(dtype=np.int64)
        shared = spark.sparkContext.broadcast((gone, rows["owner"].to_numpy(dtype=np.int64) if owned else None))
        out = plain.mapInArrow(_sorted_drop(text, lambda: shared.value), schema)
    else:
        keyed = plain.withColumn("_id", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
        lines = keyed.select("_id", F.col(text).alias("text")).mapInArrow(
            _row_lines, "_id string, own long, h long")
        met = (lines.join(frequent, "h").where("own != owner") if owned
               else lines.join(frequent, "h", "left_semi"))
        hits = (met.groupBy("_id")
                .agg(F.collect_set("h").alias("_gone")))
        out = (keyed.join(hits, "_id", "left").drop("_id")
               .mapInArrow(_listed_drop(text), schema))
    return out.toDF(*docs.columns, "_n_lines", "_n_dropped")


def dedup_lines(docs: DataFrame, least: int = 10, batches: int = 8, fanout: int = 4,
                broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """All rows of ``docs`` without lines found in at least ``least`` documents."""
    runs = LineRuns(docs.sparkSession, fanout)
    runs.add(docs, batches=batches)
    return drop_lines(docs, runs.frequent(least), broadcast_lines)


def _first_holders(frequent):
    """Per task: (line hash, least doc_id with the line, hash of that text), for
    the lines in the sorted array ``frequent()`` (None: all lines)."""
    def run(stream):
        wanted = frequent()
        held: dict[int, tuple] = {}

        def out(kind):
            firsts = held.values()
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.int64()), pa.array([f[1] for f in firsts], kind),
                 pa.array([f[2] for f in firsts], pa.int64())], ["h", "doc_id", "own"])
        for part in stream:
            kind = part.schema.field("doc_id").type
            for i, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                _, hashes = _hashes([text])
                lines = np.unique(hashes[hashes != 0])
                if wanted is not None:
                    at = np.searchsorted(wanted, lines)
                    inside = at < len(wanted)
                    lines = lines[inside][wanted[at[inside]] == lines[inside]]
                if len(lines):
                    first = (i is not None, i, _own(hashes))
                    for h in lines.tolist():
                        if h not in held or first < held[h]:
                            held[h] = first
                if len(held) >= HELD:
                    yield out(kind)
                    held.clear()
        if held:
            yield out(kind)
    return run


def keep_first(docs: DataFrame, least: int = 10, batches: int = 8, fanout: int = 4,
               broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """All rows of ``docs``; a line found in at least ``least`` documents stays
    in one text only, the first by doc_id (null first, then by text hash) that
    holds it. Copies of that text are treated alike and all keep the line, so
    they are still copies of each other afterwards."""
    spark = docs.sparkSession
    runs = LineRuns(spark, fanout)
    runs.add(docs, batches=batches)
    frequent = materialize(runs.frequent(least), "frequent")
    few = frequent.count() <= broadcast_lines
    shared = spark.sparkContext.broadcast(
        np.sort(frequent.toPandas()["h"].to_numpy(dtype=np.int64)) if few else None)
    lines = docs.select("doc_id", "text").mapInArrow(
        _first_holders(lambda: shared.value), f"h long, doc_id {dict(docs.dtypes)['doc_id']}, own long")
    if not few:
        lines = lines.join(frequent, "h", "left_semi")
    owners = lines.groupBy("h").agg(F.min(F.struct("doc_id", "own"))["own"].alias("owner"))
    return drop_lines(docs, materialize(owners, "owners"), broadcast_lines)


def unseen_lines(runs: LineRuns, batch: DataFrame, least: int = 1) -> DataFrame:
    """Incremental use: ``batch`` without the lines that the runs hold already
    (in at least ``least`` documents); the batch's own run is then added."""
    out = materialize(drop_lines(batch, runs.frequent(least)), "unseen")
    runs.add(batch)
    return out


def line_table(docs: DataFrame, least: int = 10) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row."""
    out = dedup_lines(docs.select("doc_id", "text"), least)
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
