"""Near-duplicates: one-permutation MinHash with optimal densification, banded
buckets, star-shaped candidate edges, exact confirmation.

Documents with the same shingle set are one class. One hash of each shingle is
split into ``BANDS * ROWS`` bins by its leading bits; a bin keeps its least
hash, an empty bin takes the value of the first filled bin on its own fixed
probe sequence. Each band of bins is a bucket key. In a bucket, candidates are
the edges from one centre to the other members (a star), not all pairs; they
are confirmed on the full shingle sets. The centre is the member that meets
most others over all its buckets: of texts edited from one, the least edited.
Where a bucket still spans several components, the members outside its largest
one meet those of other components, in one join that passes a pair only when
it can be linked: a class carries the parity of its hashes in ``MARK_BITS``
bits, two sets differ in at least as many shingles as their marks in bits, and
the threshold bounds the shingles in which linked sets differ. The members of
a bucket are dealt by size (linked sets are alike in size) and, past ``CHUNK``,
by salt. So no pair that shares a bucket is lost, groups of true copies cost
one edge per member, and full sets are read for pairs that pass only. A pair at
the threshold 0.85 shares no bucket with probability (1 - 0.85^5)^30 < 3e-8;
at 0.8 as little takes 44 bands, (1 - 0.8^5)^44 < 3e-8.

Nulls: a null or wordless text has an empty set, is linked with nothing and
kept. The component of documents whose ids are all null is null. Rows of one
component are kept when their id is the component's; rows with equal text are
one class. An empty table gives an empty table."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .graph import components

BANDS, ROWS = 30, 5
SHINGLE = 3
PERCENT = 85
#: Bits of the parity mark of a set; wide sets differ in more and pass to the full comparison.
MARK_BITS = 1024
#: Members of a bucket that one task compares with a member outside the largest component.
CHUNK = 512
#: Words whose hash a task remembers; past that it starts anew.
HELD = 1 << 20
PROBES = 1024


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _blend(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (multiply and shift), element by element."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: dict, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles. With fewer
    words the whole sequence is the one shingle; without words the set is empty."""
    tokens = (text or "").encode().lower().split()
    n = len(tokens)
    if not n:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(words.__getitem__, tokens), dtype=np.uint64, count=n)
    width = min(width, n)
    with np.errstate(over="ignore"):
        out = _blend(h[:n - width + 1] + np.uint64(width))
        for k in range(1, width):
            out = _blend(out + h[k:n - width + 1 + k])
    return np.unique(out)


def _probes(bins: int) -> np.ndarray:
    """Fixed probe sequence of each bin: row i lists the bins that bin i tries."""
    i, t = np.meshgrid(np.arange(bins, dtype=np.uint64), np.arange(PROBES, dtype=np.uint64), indexing="ij")
    return (_blend(i * np.uint64(PROBES) + t + np.uint64(1)) % np.uint64(bins)).astype(np.int64)


def signature(hashes: np.ndarray, bins: int, probes: np.ndarray) -> np.ndarray:
    """One-permutation MinHash of a sorted, non-empty hash set, densified."""
    of = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    first = np.searchsorted(of, np.arange(bins, dtype=np.uint64))
    filled = np.zeros(bins, dtype=bool)
    filled[of.astype(np.int64)] = True
    least = hashes[np.minimum(first, len(hashes) - 1)]
    empty = np.flatnonzero(~filled)
    if len(empty):
        tries = filled[probes[empty]]
        at = tries.argmax(axis=1)
        donor = probes[empty, at]
        lost = ~tries[np.arange(len(empty)), at]  # no filled bin among the probes: the first filled one
        donor[lost] = np.flatnonzero(filled)[0]
        least = least.copy()
        least[empty] = least[donor]
    return least


def bands(hashes: np.ndarray, n_bands: int, rows: int, probes: np.ndarray) -> np.ndarray:
    parts = signature(hashes, n_bands * rows, probes).reshape(n_bands, rows)
    with np.errstate(over="ignore"):
        key = _blend(np.arange(1, n_bands + 1, dtype=np.uint64))
        for k in range(rows):
            key = _blend(key + parts[:, k])
    return key.view(np.int64)


def mark(hashes: np.ndarray) -> np.ndarray:
    """Parity of the number of hashes at each of ``MARK_BITS`` places, as 64-bit words."""
    at = (hashes % np.uint64(MARK_BITS)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=MARK_BITS).astype(np.uint8) & 1).view(np.int64)


def _sketches(n_bands: int, rows: int, width: int):
    def run(stream):
        words, probes = _WordHash(), _probes(n_bands * rows)
        for part in stream:
            size, key, keys, marks = [], [], [], []
            for text in part.column("text").to_pylist():
                s = shingle_set(text, words, width)
                size.append(len(s))
                key.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(bands(s, n_bands, rows, probes) if len(s) else None)
                marks.append(mark(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("_id"), pa.array(size, pa.int64()),
                 pa.array(key, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(marks, pa.list_(pa.int64()))],
                ["doc_id", "_id", "n_shingles", "set_key", "bands", "mark"])
    return run


def _sets(width: int):
    def run(stream):
        words = _WordHash()
        for part in stream:
            sets = [shingle_set(t, words, width).view(np.int64) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("cls"), pa.array(sets, pa.list_(pa.int64()))], ["cls", "hashes"])
    return run


def _with_id(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``_id``, which rows share when both agree."""
    d = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    t = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("-"))
    return docs.withColumn("_id", F.md5(F.concat_ws("|", d, t).cast("binary")))


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether sets of ``{a}n`` and ``{b}n`` shingles with marks ``{a}m`` and
    ``{b}m`` can reach the threshold: their sizes allow it, and their marks
    differ in no more bits than linked sets in shingles."""
    bits = " + ".join(f"bit_count({a}m[{i}] ^ {b}m[{i}])" for i in range(MARK_BITS // 64))
    return F.expr(f"least({a}n, {b}n) * 100 >= greatest({a}n, {b}n) * {percent} "
                  f"and ({bits}) * {100 + percent} <= ({a}n + {b}n) * {100 - percent}")


def _confirmed(pairs: DataFrame, texts: DataFrame, reps: DataFrame, percent: int, width: int) -> DataFrame:
    """The (u, v) of ``pairs`` whose full sets reach the threshold. ``reps``
    names a row of ``texts`` for each class."""
    pairs = materialize(pairs, "pairs")
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("cls")).distinct()
    sets = materialize(texts.join(reps.join(wanted, "cls"), "_id").select("cls", "text")
                       .mapInArrow(_sets(width), "cls long, hashes array<long>")
                       .dropDuplicates(["cls"]), "sets")
    both = pairs.join(sets.toDF("u", "hu"), "u").join(sets.toDF("v", "hv"), "v")
    common = F.size(F.array_intersect("hu", "hv"))
    return (both.select("u", "v", (F.size("hu") + F.size("hv")).alias("total"), common.alias("common"))
            .where(F.col("common") * 100 >= (F.col("total") - F.col("common")) * percent)
            .select("u", "v"))


def _members(classes: DataFrame) -> DataFrame:
    """(key, cls, centre) of the buckets with several members."""
    keyed = classes.select("cls", F.explode("bands").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = materialize(keyed.join(sizes, "key"), "members")
    met = members.groupBy("cls").agg(F.sum("n").alias("met"))
    centres = (members.select("key", "cls").join(met, "cls").groupBy("key")
               .agg(F.min_by("cls", F.struct(-F.col("met"), F.col("cls"))).alias("centre")))
    return members.select("key", "cls").join(centres, "key")


def _across(members: DataFrame, labels: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The (u, v) of different components that share a bucket and may be linked."""
    parted = (members.select("key", "cls").join(labels.toDF("cls", "comp"), "cls", "left")
              .withColumn("comp", F.coalesce("comp", "cls")))
    sizes = parted.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    split = (sizes.groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"),
                                      F.sum("n").alias("held"), F.count(F.lit(1)).alias("comps"))
             .where("comps > 1").drop("comps"))
    # a shade wider than the threshold's ratio, so that sizes that allow a link are at most one step apart
    step = F.floor(F.ln("n") / (1.001 * max(math.log(100 / percent), 1e-6)))
    salts = F.ceil(F.col("held") / CHUNK)
    dealt = materialize(parted.join(split, "key").join(marks.toDF("cls", "n", "m"), "cls")
                        .withColumn("step", step).withColumn("salts", salts), "open")
    ours = dealt.select("key", "step", F.pmod(F.xxhash64("cls"), "salts").alias("salt"),
                        F.col("cls").alias("a"), F.col("comp").alias("ac"), F.col("n").alias("an"),
                        F.col("m").alias("am"), (F.col("comp") == F.col("main")).alias("inside"))
    outside = (dealt.where("comp != main")
               .select("key", F.explode(F.sequence(F.col("step") - 1, F.col("step") + 1)).alias("step"), "salts",
                       F.col("cls").alias("b"), F.col("comp").alias("bc"), F.col("n").alias("bn"),
                       F.col("m").alias("bm"))
               .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts"))
    return (ours.join(outside, ["key", "step", "salt"])
            .where((F.col("ac") != F.col("bc")) & (F.col("inside") | (F.col("a") < F.col("b")))
                   & _may_link("a", "b", percent))
            .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())


def near_duplicates(docs: DataFrame, percent: int = PERCENT, n_bands: int = BANDS,
                    rows: int = ROWS, width: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``, with
    ``_id`` (shared by rows that agree in id and text) and ``_comp`` (the
    component's own number; null for wordless rows)."""
    tagged = _with_id(docs.select("doc_id", "text"))
    sketched = materialize(tagged.mapInArrow(
        _sketches(n_bands, rows, width),
        f"doc_id {dict(docs.dtypes)['doc_id']}, _id string, n_shingles long, set_key binary, "
        "bands array<long>, mark array<long>"), "sketch")
    classes = materialize(
        sketched.where("n_shingles > 0").drop("doc_id").dropDuplicates(["set_key"])
        .withColumn("cls", F.monotonically_increasing_id()), "classes")

    marks = classes.select("cls", "n_shingles", "mark")
    reps = classes.select("cls", "_id")
    texts = tagged.select("_id", "text")
    members = materialize(_members(classes), "members")

    stars = (members.where("cls != centre")
             .select(F.greatest("cls", "centre").alias("u"), F.least("cls", "centre").alias("v")).distinct()
             .join(marks.toDF("u", "an", "am"), "u").join(marks.toDF("v", "bn", "bm"), "v")
             .where(_may_link("a", "b", percent)).select("u", "v"))
    edges = components(_confirmed(stars, texts, reps, percent, width))
    across = _confirmed(_across(members, edges, marks, percent), texts, reps, percent, width)
    edges = components(edges.union(across))

    labels = (classes.select("set_key", "cls").join(edges.toDF("cls", "comp"), "cls", "left")
              .select("set_key", F.coalesce("comp", "cls").alias("comp")))
    labelled = (sketched.select("doc_id", "_id", "n_shingles", "set_key")
                .join(labels, "set_key", "left"))
    least = labelled.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least"))
    out = labelled.join(least, "comp", "left")
    component = F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return (out.withColumn("component_id", component)
            .select("doc_id", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
                    "_id", F.col("comp").alias("_comp")))


def keep_one(docs: DataFrame, percent: int = PERCENT, n_bands: int = BANDS, rows: int = ROWS,
             width: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, one of each group of near-duplicates, all columns
    kept. Of rows that repeat the same id and words only one stays; documents
    without words all stay."""
    kept = near_duplicates(docs, percent, n_bands, rows, width).where("kept")
    ids = (kept.where("n_shingles > 0").groupBy("_comp").agg(F.min("_id").alias("_id"))
           .select("_id", F.lit(True).alias("_single"))
           .union(kept.where("n_shingles = 0").select("_id", F.lit(False)).distinct()))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text")
    joined = _with_id(row).select("_row", "_id").join(ids, "_id")
    nth = F.row_number().over(Window.partitionBy("_id").orderBy("_id"))
    return (joined.withColumn("_n", nth)
            .where((F.col("_n") == 1) | ~F.col("_single")).select("_row.*"))


def near_table(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).drop("_id", "_comp")
