"""Jump consistent hashing: stable keys to numbered shards without a ring table.

A key's shard depends on the key and the number of shards only. With one more
shard, the rows that move all move into the new one, a fraction 1/(n+1).

Null keys hash as the text ``null`` and so share a shard. Repeated rows get
the same shard and different slots. An empty table gives an empty table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import hash60
from .ranks import packed_positions, unpack

#: Fixed value: multiplier of the 64-bit linear congruential generator that the published method names.
LCG = np.uint64(2862933555777941757)
SUB_BITS = 12


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard in ``[0, shards)`` of each 64-bit key, all keys at once: every key
    jumps ahead until its next jump would leave the table."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), dtype=np.int64)
    ahead = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(live):
            at[live] = ahead[live]
            state[live] = state[live] * LCG + np.uint64(1)
            draw = ((state[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
            ahead[live] = ((at[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
            live = live[ahead[live] < shards]
    return at


def shard_of(key_hash: Column, shards: int) -> Column:
    """Column form of :func:`jump` over a 64-bit hash column (Arrow batches)."""
    @pandas_udf("int")
    def assign(k: pd.Series) -> pd.Series:
        return pd.Series(jump(k.to_numpy(dtype=np.int64).astype(np.uint64), shards), dtype="int32")
    return assign(key_hash)


def assign_shards(df: DataFrame, key: str, shards: int, into: str = "shard") -> DataFrame:
    """``df`` with the shard of each row's key; no shuffle, other columns untouched."""
    return df.withColumn(into, shard_of(hash60(F.col(key)), shards))


def write_shards(df: DataFrame, key: str, shards: int, path: str) -> None:
    """Write ``df`` as one folder per shard (``shard=<n>``); each task appends
    its own files, so a large shard is many files and no task holds a shard."""
    assign_shards(df, key, shards).write.partitionBy("shard").mode("overwrite").parquet(path)


def shard_table(df: DataFrame, shards: int, key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    ``slot`` numbers a shard's rows from 0 without gaps, ordered by a hash of
    (key, crc, size): the same for any file layout. A null text has no bytes."""
    body = F.coalesce(F.col(text), F.lit(""))
    thin = df.select(F.col(key).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
                     F.crc32(body).cast("long").alias("text_crc32"))
    thin = thin.select("*", shard_of(hash60(F.col("doc_id")), shards).alias("shard"),
                       shard_of(hash60(F.col("doc_id")), shards + 1).alias("grown_shard"),
                       hash60(F.col("doc_id"), F.col("text_crc32"), F.col("size")).alias("_mix"))
    packed = packed_positions(
        thin, ["shard"], [F.shiftrightunsigned(F.col("_mix"), 60 - SUB_BITS)],
        ["_mix", "doc_id", "text_crc32", "size"])
    return unpack(packed, "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
