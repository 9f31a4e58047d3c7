"""A table of doubles as dense blocks, and sums over them.

Iterative fits read the same numbers many times. ``pack`` writes them once as
blocks of ``BLOCK_ROWS`` to ``MOST_ROWS`` rows (more in a larger table), each
one binary value, so a pass hands NumPy whole matrices and no row is converted
again. A column with few values in a block is kept as codes (no bytes for one
value, a bit for two, one byte for up to 256, else two) and the values, and is
read when a kernel asks for it: a pass is mostly the transport of these bytes. Rows that agree in every
column become one row with a weight first (partial aggregation, so a row
repeated a billion times costs one), the rest is dealt to blocks by a hash of
its values and sorted inside its block: what a block holds is a function of the
data alone, not of the partitioning.

``block_sums`` adds a kernel's vectors over all blocks. Every task keeps its sum
as a pair of doubles (value and error, by error-free additions), and so do the
merges, so the sums do not depend on the order beyond the last bit and a fit
gives the same numbers on any cluster. Vectors of many tasks or great length
are cut into segments and merged in two levels on the cluster; short ones go
straight to the driver."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import share

#: Rows of a block: the least that is meant, the most, and the blocks a table is cut into before they grow.
BLOCK_ROWS, MOST_ROWS, SPREAD = 1024, 8192, 128
#: Values of a column that are kept as codes.
CODES = 1 << 16
#: Doubles added up at a time, few enough to stay in a processor's cache.
STEP = 1 << 14
#: Bytes of partial vectors that may go to the driver unmerged, and doubles of a segment beyond that.
DIRECT_BYTES, SEGMENT = 128 << 20, 1 << 16
FAN = 64
#: Blocks that a partition is meant for.
PART_BLOCKS = 64


@dataclass
class Block:
    """One block: ``columns`` of values, or of (values, codes); row weights; a hash of each row."""
    cell: int
    columns: list
    weight: np.ndarray
    uid: np.ndarray

    @cached_property
    def x(self) -> np.ndarray:
        """All columns (rows x columns)."""
        return self.matrix(len(self.columns))

    def column(self, j: int) -> np.ndarray:
        own = self.columns[j]
        return own[0][own[1].all] if isinstance(own, tuple) else own

    def matrix(self, width: int, at=slice(None), mean=None, std=None) -> np.ndarray:
        """The first ``width`` columns of the rows ``at``, scaled where ``mean`` and ``std`` are given."""
        out = np.empty((len(self.uid[at]), width))
        for j, own in enumerate(self.columns[:width]):
            values, codes = own if isinstance(own, tuple) else (own[at], None)
            if mean is not None:
                values = (values - mean[j]) / std[j]
            out[:, j] = values if codes is None else values[codes.all[at]]
        return out


class Codes:
    """Codes of ``n`` rows for ``m`` values, unpacked when they are asked for."""

    def __init__(self, data: bytes, at: int, n: int, m: int):
        self.data, self.at, self.n, self.m = data, at, n, m

    @staticmethod
    def size(n: int, m: int) -> int:
        return 0 if m == 1 else -(-n // 8) if m == 2 else n if m <= 256 else 2 * n

    @staticmethod
    def pack(codes: np.ndarray, m: int) -> bytes:
        if m == 1:
            return b""
        return (np.packbits(codes.astype(bool)) if m == 2 else codes.astype(np.uint8 if m <= 256 else "<u2")).tobytes()

    @cached_property
    def all(self) -> np.ndarray:
        if self.m == 1:
            return np.zeros(self.n, dtype=np.uint8)
        held = np.frombuffer(self.data, dtype=np.uint8, count=self.size(self.n, self.m), offset=self.at)
        return np.unpackbits(held, count=self.n) if self.m == 2 else held if self.m <= 256 else held.view("<u2")


@dataclass
class Blocks:
    df: DataFrame                # cell long, data binary
    columns: list[str]
    cells: int
    parts: int
    rows: int

    def release(self) -> None:
        self.df.unpersist()


def read_block(cell: int, data: bytes, width: int) -> Block:
    """Layout: rows and per column (the weight is the last) the number of coded
    values, 0 for a plain one; the hashes; the columns' values; the codes."""
    head = np.frombuffer(data, dtype=np.int64, count=width + 2)
    n, coded = int(head[0]), head[1:].tolist()
    place, codes_at = 8 * (width + 2 + n), 8 * (width + 2 + n + sum(m or n for m in coded))
    columns = []
    for m in coded:
        values = np.frombuffer(data, dtype=np.float64, count=m or n, offset=place)
        place += 8 * (m or n)
        if m:
            values = values, Codes(data, codes_at, n, m)
            codes_at += Codes.size(n, m)
        columns.append(values)
    block = Block(cell, columns, None, np.frombuffer(data, dtype=np.uint64, count=n, offset=8 * (width + 2)))
    block.weight = block.column(width)
    del columns[width:]
    return block


def _coded(column: np.ndarray):
    """(values, codes) of a column of few values, to the bit, where that takes
    less than half the bytes; else (column, None)."""
    bits = np.ascontiguousarray(column).view(np.int64)
    n, head = len(bits), bits[:1024]
    if n <= 256 or (n > 2 * len(head) and len(np.unique(head)) > 0.9 * len(head)):
        return column, None
    values, codes = np.unique(bits, return_inverse=True)
    m = len(values)
    if m > CODES or 8 * m + Codes.size(n, m) >= 4 * n:
        return column, None
    return values.view(np.float64), Codes.pack(codes, m)


def _packer(width: int):
    def run(table: pa.Table) -> pa.Table:
        columns = [table.column(f"x{i}").to_numpy() for i in range(width)]
        columns.append(table.column("w").to_numpy().astype(np.float64))
        uid = table.column("u").to_numpy().astype(np.int64)
        order = np.argsort(uid, kind="stable")
        if (np.diff(uid[order]) == 0).any():
            order = np.lexsort((*columns[::-1], uid))
        coded = [_coded(c[order]) for c in columns]
        head = np.array([len(uid), *[0 if codes is None else len(values) for values, codes in coded]], dtype=np.int64)
        data = b"".join([head.tobytes(), uid[order].tobytes(), *[values.tobytes() for values, _ in coded],
                         *[codes for _, codes in coded if codes is not None]])
        return pa.table({"cell": table.column("cell").slice(0, 1), "data": pa.array([data], pa.binary())})
    return run


def pack(df: DataFrame, columns: Sequence[str], block_rows: int | None = None,
         hashed: int | None = None) -> Blocks:
    """``columns`` of ``df`` as cached blocks; a row's hash is of the first
    ``hashed`` columns (all). Nulls become NaN. The caller releases the blocks.
    An empty table has no block. ``block_rows``: by the number of distinct rows."""
    width = len(columns)
    plain = df.select(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(f"x{i}")
                        for i, c in enumerate(columns)])
    names = plain.columns
    distinct = plain.groupBy(*names).agg(F.count(F.lit(1)).alias("w"))
    distinct = distinct.withColumn("u", F.xxhash64(*names[:hashed])).persist(StorageLevel.MEMORY_AND_DISK)
    found = distinct.agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("rows")).first()
    if block_rows is None:
        block_rows = min(MOST_ROWS, max(BLOCK_ROWS, -(-found.n // SPREAD)))
    cells = max(1, -(-found.n // block_rows))
    dealt = distinct.withColumn("cell", F.pmod(F.xxhash64("u", F.lit(1)), F.lit(cells)))
    # a partition count of its own: the small table would be coalesced to one task, and every pass with it
    spark = df.sparkSession
    width_of_cluster = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")),
                           spark.sparkContext.defaultParallelism)
    parts = min(cells, max(spark.sparkContext.defaultParallelism, min(width_of_cluster, cells // PART_BLOCKS)))
    # dealt in turn: by a hash of the cell some tasks would have twice the blocks of others
    dealt = dealt.withColumn("part", (F.col("cell") % parts).cast("int"))
    blocks = (dealt.repartitionById(parts, F.col("part")).groupBy("part", "cell")
              .applyInArrow(_packer(width), "cell long, data binary").persist(StorageLevel.MEMORY_AND_DISK))
    blocks.count()
    distinct.unpersist()
    return Blocks(blocks, list(columns), cells, parts, found.rows or 0)


def two_sum(hi: np.ndarray, lo: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hi, lo) + value without losing what the addition rounds off."""
    total = hi + value
    back = total - hi
    return total, lo + ((hi - (total - back)) + (value - back))


def accumulate(hi: np.ndarray, lo: np.ndarray, value: np.ndarray) -> None:
    """:func:`two_sum` in place, a part at a time."""
    for at in range(0, len(hi), STEP):
        own = slice(at, at + STEP)
        total, low = two_sum(hi[own], lo[own], value[own])
        hi[own], lo[own] = total, low


def _merge(vectors) -> np.ndarray:
    """Sum of (hi, lo) vectors laid end to end, in the same form."""
    hi = lo = None
    for v in vectors:
        half = len(v) // 2
        if hi is None:
            hi, lo = v[:half].copy(), v[half:].copy()
        else:
            lo += v[half:]
            accumulate(hi, lo, v[:half])
    return np.concatenate([hi, lo])


def _merger(table: pa.Table) -> pa.Table:
    vectors = (np.frombuffer(v.as_py(), dtype=np.float64) for v in table.column("vector"))
    return pa.table({"segment": table.column("segment").slice(0, 1), "part": table.column("part").slice(0, 1),
                     "vector": pa.array([_merge(vectors).tobytes()], pa.binary()),
                     "top": pa.array([None], pa.binary())})


#: Schema of partial vectors: (hi, lo) of a segment of the sums, and maxima.
PARTIAL = "segment int, part long, vector binary, top binary"


def tree_merge(partial: DataFrame) -> DataFrame:
    """One row per segment: partial vectors added in groups of ``FAN`` tasks, then the groups' sums."""
    return (partial.withColumn("_group", F.floor(F.col("part") / FAN)).groupBy("segment", "_group")
            .applyInArrow(_merger, PARTIAL).groupBy("segment").applyInArrow(_merger, PARTIAL))


def block_sums(blocks: Blocks, kernel: Callable, state, size: int, where=None) -> tuple[np.ndarray, np.ndarray]:
    """(sums, maxima) of ``kernel(block, state)`` over all blocks, or those with
    ``where(cell)``: the kernel returns a vector of ``size`` doubles, or that
    and a short vector of which the maximum counts. ``state`` is broadcast.
    Without a block the sums are 0 and there are no maxima."""
    spark, width = blocks.df.sparkSession, len(blocks.columns)
    held = share(spark, state)
    direct = blocks.parts * size * 16 <= DIRECT_BYTES

    def run(stream):
        hi, lo, top, met, own = np.zeros(size), np.zeros(size), None, False, held.value
        for part in stream:
            for cell, data in zip(part.column("cell").to_pylist(), part.column("data")):
                if where is not None and not where(cell):
                    continue
                out = kernel(read_block(cell, data.as_buffer(), width), own)
                if isinstance(out, tuple):
                    out, most = out
                    top = most if top is None else np.maximum(top, most)
                accumulate(hi, lo, out)
                met = True
        if met:
            step = size if direct else SEGMENT
            task = TaskContext.get().partitionId()
            for s, low in enumerate(range(0, max(size, 1), step)):
                vector = np.concatenate([hi[low:low + step], lo[low:low + step]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int32()), pa.array([task], pa.int64()), pa.array([vector.tobytes()], pa.binary()),
                     pa.array([top.tobytes() if top is not None and s == 0 else None], pa.binary())],
                    ["segment", "part", "vector", "top"])

    partial = blocks.df.mapInArrow(run, PARTIAL)
    if direct:
        rows = partial.toArrow().to_pylist()
    else:
        partial = partial.persist(StorageLevel.MEMORY_AND_DISK)
        tops = partial.where("top is not null").select("top").toArrow().to_pylist()
        rows = tree_merge(partial).toArrow().to_pylist()
        partial.unpersist()
    held.release()
    tops = [np.frombuffer(r["top"], dtype=np.float64) for r in (rows if direct else tops) if r["top"] is not None]
    top = np.maximum.reduce(tops) if tops else np.zeros(0)
    out = np.zeros(size)
    for s in sorted({r["segment"] for r in rows}):
        own = _merge(np.frombuffer(r["vector"], dtype=np.float64)
                     for r in sorted((r for r in rows if r["segment"] == s), key=lambda r: r["part"]))
        half = len(own) // 2
        low = 0 if direct else s * SEGMENT
        out[low:low + half] = own[:half] + own[half:]
    return out, top


def uniforms(uid: np.ndarray, *seeds: int) -> np.ndarray:
    """A uniform number in (0, 1) for each row hash, the same for the same seeds."""
    with np.errstate(over="ignore"):
        x = uid.copy()
        for s in seeds:
            x = x + np.uint64((int(s) * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2 ** 64 - 1))
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(31))
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)
