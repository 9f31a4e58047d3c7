"""Minimal perfect hashing of distinct 64-bit keys, built in shards.

A key's bucket (leading bits of its hash) puts it into a shard. Inside a shard
each level hashes the keys that are left into ``SPARE`` places a key; a place
that one key hits is that key's, keys that meet go on to the next level. The
key's number is the count of taken places before its own, so n keys have the
numbers 0 to n-1 and the function takes some bits a key. A key that was not
built in also gets a number: the keys are held in the order of their numbers
and tell."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 12
#: Keys a shard is meant for, and places a key at each level.
SHARD_KEYS, SPARE = 1 << 16, 2


def scatter(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of uint64 keys: distinct keys have distinct hashes under a seed."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64((seed * 0x9E3779B97F4A7C15 + 1) & (2 ** 64 - 1))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return (scatter(keys, 0) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


class ShardHash:
    """Function of one shard: ``sizes`` of the levels and the ``words`` of their bits."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        taken = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(taken) - taken

    @classmethod
    def build(cls, keys: np.ndarray) -> "ShardHash":
        left, sizes, bits = keys, [], []
        while len(left):
            size = 64 * (-(-SPARE * len(left) // 64))
            at = (scatter(left, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[at]]
        packed = np.packbits(np.concatenate(bits), bitorder="little") if bits else np.zeros(0, np.uint8)
        return cls(sizes, packed.view("<u8"))

    def number(self, keys: np.ndarray) -> np.ndarray:
        out, open_, base = np.zeros(len(keys), dtype=np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = (scatter(keys[open_], level + 1) % np.uint64(size)).astype(np.int64) + base
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            lower = self.words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = self.before[word[hit]] + np.bitwise_count(lower)
            open_, base = open_[~hit], base + size
            if not len(open_):
                break
        return out


def shard_of(bucket, shards: int):
    """Shard of a bucket, an array or a column."""
    return (bucket * shards) // (1 << BUCKET_BITS) if isinstance(bucket, np.ndarray) else F.floor(
        bucket.cast("long") * shards / (1 << BUCKET_BITS)).cast("int")


def _build(table: pa.Table) -> pa.Table:
    keys = table.column("key").to_numpy().view(np.uint64)
    made = ShardHash.build(keys)
    ordered = np.empty(len(keys), dtype=np.uint64)
    ordered[made.number(keys)] = keys
    return pa.table({"shard": table.column("shard").slice(0, 1),
                     "sizes": pa.array([made.sizes], pa.list_(pa.int32())),
                     "words": pa.array([made.words.tobytes()], pa.binary()),
                     "keys": pa.array([ordered.tobytes()], pa.binary())})


def build_shards(keys: DataFrame, n_keys: int) -> tuple[int, DataFrame]:
    """The number of shards and (shard, sizes, words, keys) of each: ``keys``
    has distinct rows (bucket, key). Buckets are hashes, so shards are even."""
    shards = max(1, min(1 << BUCKET_BITS, -(-n_keys // SHARD_KEYS)))
    dealt = keys.select(shard_of(F.col("bucket"), shards).alias("shard"), "key")
    return shards, dealt.groupBy("shard").applyInArrow(
        _build, "shard int, sizes array<int>, words binary, keys binary")


class KeyTable:
    """Shards brought together: numbers keys and verifies which of them were built in."""

    def __init__(self, shards: int, rows):
        self.shards = shards
        self.parts = {r.shard: (list(r.sizes), bytes(r.words), bytes(r.keys)) for r in rows}
        self._open: dict = {}

    def __getstate__(self):
        return {"shards": self.shards, "parts": self.parts, "_open": {}}

    def size(self, shard: int) -> int:
        return len(self.parts[shard][2]) // 8

    def numbered(self, keys: np.ndarray):
        """(shard, positions in ``keys``, numbers inside the shard) for each
        shard met, of those keys that were built in."""
        of = shard_of(bucket_of(keys).astype(np.int64), self.shards)
        order = np.argsort(of, kind="stable")
        cuts = np.flatnonzero(np.diff(of[order])) + 1
        for own in np.split(order, cuts) if len(order) else []:
            shard = int(of[own[0]])
            if shard not in self.parts:
                continue
            if shard not in self._open:
                sizes, words, held = self.parts[shard]
                self._open[shard] = (ShardHash(sizes, np.frombuffer(words, "<u8")), np.frombuffer(held, "<u8"))
            made, held = self._open[shard]
            at = made.number(keys[own])
            verified = held[at] == keys[own]
            yield shard, own[verified], at[verified]
