"""Cross-tokenizer alignment: the tokens of two tokenizers on the same bytes,
cut into groups where both end, with corpus counts of the linked id pairs.

A is a byte-level BPE, read from its tokenizers file and encoded by ranks
(tiktoken), B a SentencePiece model; A reads a space
and the text, B the text, to which it adds the space itself. Both tokenizers
begin a new token at a space between two characters that are not white space
(checked for B when its pieces are read), so a text is cut there and each
distinct chunk is encoded and aligned once per task. The table of chunks is
bounded and starts anew when it is full.

First pass: each task counts the linked pairs of its chunks and writes its
distinct pairs with their counts. A minimal perfect hash of all distinct pairs
numbers them; every task of the count adds its pairs into dense vectors by
those numbers, and the vectors are summed in two levels. Second pass: the
documents are aligned again and look up the counts, each key verified. The
function, its keys and the counts are broadcast where the distinct pairs were
counted to be at most ``MOST_PAIRS`` (16 bytes each); where there are more, the
documents' pairs are counted per document and joined with the counts instead,
with the same rows.

Nulls and other cases: a text that is null or empty, or whose tokens' bytes are
not the space and the text (B reads U+2581 as a space), has no tokens: zeros
and an empty string. Repeated rows are documents of their own and each counts.
An empty table gives an empty table."""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, share
from .mph import KeyTable, bucket_of, build_shards
from .vectors import tree_sum

MARK = "▁"
#: Places where both tokenizers begin a token.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Distinct chunks, and characters of them, that a task remembers; past that it starts anew.
HELD, HELD_CHARS = 600_000, 24_000_000
#: Characters of text that are aligned together.
STEP = 1 << 20
#: Distinct pairs up to which the counts are broadcast.
MOST_PAIRS = 4_000_000
B_BITS = 32
#: Fixed value: the published pattern that cuts a text for the byte-level BPE before its merges.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class Aligner:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken

        with open(a_path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = {chr(x): x for x in (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))}
        letters |= {chr(0x100 + i): x for i, x in enumerate(x for x in range(256) if chr(x) not in letters)}
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()
                 if all(c in letters for c in token)}
        merges = model["merges"] if isinstance(model["merges"][0], list) else [m.split(" ") for m in model["merges"]]
        made = [model["vocab"][x + y] for x, y in merges]
        if made != sorted(made):  # a rank encoder merges in the order of the ids
            raise ValueError("the ids of A do not follow its merges")
        last = made[-1]
        for token in [b for b, i in ranks.items() if i > last]:
            del ranks[token]  # a special token: its string in a text is plain text
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b = b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        if re.search(f"[^{MARK}\n]{MARK}", "\n".join(pieces)):
            raise ValueError("pieces of B cross white-space markers")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else
                        b"" if b.is_unknown(i) or b.is_control(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.array([len(t) for t in side]) for side in (self.a_bytes, self.b_bytes))
        self.a_said, self.b_said = (np.array([f"{i}{end}" for i in range(len(side)) for end in ends], dtype=object)
                                    for side, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")))

    def encode_a(self, chunks: list[str], loose: list[bool]) -> np.ndarray:
        """Ids of A on a space and each chunk, one after the other. Chunks
        without white space at their ends are encoded together."""
        out, run = [], []

        def close():
            if run:
                out.append(self.a.encode_to_numpy(" " + " ".join(run), disallowed_special=()))
                run.clear()
        for chunk, alone in zip(chunks, loose):
            if alone:
                close()
                out.append(self.a.encode_to_numpy(" " + chunk, disallowed_special=()))
            else:
                run.append(chunk)
        close()
        return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)

    def tokens(self, chunks: list[str], loose: list[bool]):
        """(sound, a_ids, a_n, b_ids, b_n): whether the bytes of a chunk's
        tokens are its own, the ids of the sound chunks and how many each has."""
        raw = [b" " + c.encode() for c in chunks]
        ends = np.cumsum([len(r) for r in raw])
        a_ids = self.encode_a(chunks, loose)
        if b"".join([self.a_bytes[i] for i in a_ids.tolist()]) != b"".join(raw):
            raise ValueError("A does not give back the bytes of a text")
        a_n = np.diff(np.searchsorted(np.cumsum(self.a_len[a_ids]), ends, side="right"), prepend=0)
        b_lists = self.b.encode(chunks, num_threads=1)
        b_n = np.array([len(x) for x in b_lists])
        b_ids = np.fromiter(chain.from_iterable(b_lists), dtype=np.int64, count=int(b_n.sum()))
        sound = np.ones(len(chunks), dtype=bool)
        if b"".join([self.b_bytes[i] for i in b_ids.tolist()]) != b"".join(raw) or not self.b_len[b_ids].all():
            sound[:] = [b"".join([self.b_bytes[i] for i in x]) == r and all(self.b_len[x])
                        for x, r in zip(b_lists, raw)]
        return (sound, a_ids[np.repeat(sound, a_n)], np.where(sound, a_n, 0),
                b_ids[np.repeat(sound, b_n)], np.where(sound, b_n, 0))

    def align(self, a_ids, a_n, b_ids, b_n, say: bool):
        """(links, n_links, n_groups, groups) of chunks that stand one after the
        other. A byte where a token of A or B ends closes a link: between two
        such bytes one token of A and one of B overlap, and a pair that
        overlaps does so in one such stretch."""
        a_end, b_end = np.cumsum(self.a_len[a_ids]), np.cumsum(self.b_len[b_ids])
        ends = np.concatenate([[0], a_end])[np.cumsum(a_n)]
        cuts = np.union1d(a_end, b_end)
        i, j = np.searchsorted(a_end, cuts), np.searchsorted(b_end, cuts)
        links = a_ids[i] << B_BITS | b_ids[j]
        both = (a_end[i] == cuts) & (b_end[j] == cuts)
        n_links, n_groups = (np.diff(np.searchsorted(c, ends, side="right"), prepend=0) for c in (cuts, cuts[both]))
        if not say:
            return links, n_links, n_groups, [""] * len(a_n)
        last_a, last_b = i[both], j[both]  # last tokens of the groups
        at_a, at_b = np.arange(len(a_ids)), np.arange(len(b_ids))
        of_a, of_b = np.searchsorted(last_a, at_a), np.searchsorted(last_b, at_b)
        said = np.empty(len(a_ids) + len(b_ids), dtype=object)
        said[at_a + np.concatenate([[0], last_b + 1])[of_a]] = self.a_said[2 * a_ids + (last_a[of_a] == at_a)]
        said[at_b + last_a[of_b] + 1] = self.b_said[2 * b_ids + (last_b[of_b] == at_b)]
        said, to = said.tolist(), np.cumsum(a_n + b_n).tolist()
        return links, n_links, n_groups, ["".join(said[x:y])[:-1] for x, y in zip([0, *to], to)]


class ChunkTable(dict):
    """Distinct chunk -> number, with what its alignment gives under that number."""

    def __init__(self, aligner: Aligner, say: bool):
        super().__init__()
        self.aligner, self.say = aligner, say
        self.reset()

    def reset(self):
        self.clear()
        self.new: list[str] = []
        self.chars = 0
        self.texts: list[str] = []
        self.sound = self.loose = np.zeros(0, dtype=bool)
        self.sizes, self.links = np.zeros((0, 4), dtype=np.int64), np.zeros(0, dtype=np.int64)

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number

    def full(self) -> bool:
        return len(self) > HELD or self.chars > HELD_CHARS

    def _settle(self):
        """Aligns the chunks that are new."""
        chunks, self.new = self.new, []
        if not chunks:
            return
        loose = [not c or c[0].isspace() or c[-1].isspace() for c in chunks]
        sound, a_ids, a_n, b_ids, b_n = self.aligner.tokens(chunks, loose)
        links, n_links, n_groups, texts = self.aligner.align(a_ids, a_n, b_ids, b_n, self.say)
        self.chars += sum(map(len, chunks))
        self.texts += texts
        self.sound, self.loose = np.append(self.sound, sound), np.append(self.loose, loose)
        self.sizes = np.concatenate([self.sizes, np.stack([a_n, b_n, n_groups, n_links], axis=1)])
        self.links = np.append(self.links, links)

    def starts(self) -> np.ndarray:
        """Place of each chunk's first link, and of their end."""
        return np.concatenate([[0], np.cumsum(self.sizes[:, 3])])

    def numbers(self, texts: list) -> list[np.ndarray | None]:
        """The chunk numbers of each text, None where it has no tokens. Texts
        are cut at every space first; where that leaves a chunk with white
        space at an end, the text is cut again with care."""
        out = [np.array([*map(self.__getitem__, t.split(" "))], dtype=np.int32) if t else None for t in texts]
        self._settle()
        again = [k for k, ids in enumerate(out) if ids is not None and self.loose[ids].any()]
        for k in again:
            out[k] = np.array([*map(self.__getitem__, CUT.split(texts[k]))], dtype=np.int32)
        self._settle()
        return [ids if ids is not None and self.sound[ids].all() else None for ids in out]


def _steps(texts):
    """Texts in groups of about ``STEP`` characters."""
    group, held = [], 0
    for text in texts:
        group.append(text)
        held += len(text or "")
        if held >= STEP:
            yield group
            group, held = [], 0
    if group:
        yield group


def _pair_counts(a_path: str, b_path: str):
    """Task of the first pass: its distinct pairs with their counts, in order of
    the key, each time its table is full."""
    def run(stream):
        table = ChunkTable(Aligner(a_path, b_path), say=False)
        times = np.zeros(0, dtype=np.int64)

        def counted():
            keys, at = np.unique(table.links, return_inverse=True)
            n = np.zeros(len(keys), dtype=np.int64)
            np.add.at(n, at, np.repeat(times, table.sizes[:, 3]))
            met = n > 0
            for low in range(0, int(met.sum()), 1 << 16):
                k = keys[met][low:low + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket_of(k.view(np.uint64))), pa.array(k), pa.array(n[met][low:low + (1 << 16)])],
                    ["bucket", "key", "n"])

        for part in stream:
            for texts in _steps(part.column("text").to_pylist()):
                if table.full():
                    yield from counted()
                    table.reset()
                    times = np.zeros(0, dtype=np.int64)
                own = [ids for ids in table.numbers(texts) if ids is not None]
                grown = np.bincount(np.concatenate(own) if own else np.zeros(0, np.int64), minlength=len(table))
                grown[:len(times)] += times
                times = grown
        if len(table):
            yield from counted()
    return run


class PairCounts:
    """Counts of all pairs behind the perfect hash, and the highest count of each B id."""

    def __init__(self, keys: KeyTable, counts: dict[int, bytes], best: np.ndarray):
        self.keys, self.counts, self.best = keys, counts, best

    def look_up(self, pairs: np.ndarray) -> np.ndarray:
        """Counts of pairs; 0 for a pair that no document with tokens links."""
        out = np.zeros(len(pairs), dtype=np.int64)
        for shard, own, at in self.keys.numbered(pairs.view(np.uint64)):
            out[own] = np.frombuffer(self.counts[shard], dtype=np.int64)[at]
        return out


def _summed(chunks: np.ndarray, values: np.ndarray) -> list[int]:
    return values[chunks].sum(axis=0).tolist()


def _looked_up(a_path: str, b_path: str, held):
    """Task of the second pass: aligns again and looks the counts up, once per chunk."""
    def run(stream):
        table, counts = ChunkTable(Aligner(a_path, b_path), say=True), held.value
        values = np.zeros((0, 6), dtype=np.int64)

        def valued(done: int) -> np.ndarray:
            """n_a, n_b, n_groups, n_links, n_best, count_sum of the chunks from number ``done`` on."""
            sizes, starts = table.sizes[done:], table.starts()[done:]
            links = table.links[starts[0]:]
            pairs, at = np.unique(links, return_inverse=True)
            count = counts.look_up(pairs)
            best = count == counts.best[pairs & ((1 << B_BITS) - 1)]
            total = np.zeros((len(links) + 1, 2), dtype=np.int64)
            np.cumsum(np.stack([best[at], count[at]], axis=1), axis=0, out=total[1:])
            ends = total[starts - starts[0]]
            return np.concatenate([sizes, ends[1:] - ends[:-1]], axis=1)

        for part in stream:
            rows, digests = [], []
            for texts in _steps(part.column("text").to_pylist()):
                if table.full():
                    table.reset()
                    values = values[:0]
                numbers = table.numbers(texts)
                if len(table) > len(values):
                    values = np.concatenate([values, valued(len(values))])
                for ids in numbers:
                    if ids is None:
                        rows.append([0] * 6)
                        digests.append("")
                    else:
                        rows.append(_summed(ids, values))
                        digests.append(hashlib.sha256(
                            ";".join([table.texts[i] for i in ids.tolist()]).encode()).hexdigest())
            figures = np.array(rows, dtype=np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *map(pa.array, figures.T), pa.array(digests, pa.string())],
                ["doc_id", *FIGURES, "groups_sha256"])
    return run


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _per_document(a_path: str, b_path: str):
    """Task of the second pass beyond ``MOST_PAIRS``: each document's sizes and its pairs with their number."""
    def run(stream):
        table, row = ChunkTable(Aligner(a_path, b_path), say=True), TaskContext.get().partitionId() << 40
        for part in stream:
            out = []
            for texts in _steps(part.column("text").to_pylist()):
                if table.full():
                    table.reset()
                numbers = table.numbers(texts)
                starts, sizes, links = table.starts(), table.sizes, table.links
                for ids in numbers:
                    if ids is None:
                        out.append(([0] * 4, "", [], []))
                        continue
                    pairs, n = np.unique(np.concatenate([links[starts[i]:starts[i + 1]] for i in ids]),
                                         return_counts=True)
                    out.append((_summed(ids, sizes), hashlib.sha256(
                        ";".join([table.texts[i] for i in ids.tolist()]).encode()).hexdigest(), pairs, n))
            figures = np.array([o[0] for o in out], dtype=np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(range(row, row + len(out)), pa.int64()), *map(pa.array, figures.T),
                 pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.list_(pa.int64())),
                 pa.array([o[3] for o in out], pa.list_(pa.int64()))],
                ["doc_id", "_row", *FIGURES[:4], "groups_sha256", "pairs", "times"])
            row += len(out)
    return run


def pair_table(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(bucket, key, n): each task's distinct pairs with their counts; key is a << 32 | b."""
    return materialize(docs.select("text").mapInArrow(
        _pair_counts(a_path, b_path), "bucket int, key long, n long"), "pairs")


def hashed_counts(pairs: DataFrame, keys: DataFrame, n_keys: int) -> PairCounts:
    """Counts of all distinct pairs: dense vectors by perfect hash, one per task and shard, tree-summed."""
    spark = pairs.sparkSession
    shards, built = build_shards(keys, n_keys)
    table = KeyTable(shards, built.collect())
    held = share(spark, table)

    def dense(stream):
        t, vectors, task = held.value, {}, TaskContext.get().partitionId()
        for part in stream:
            keys_, n = part.column("key").to_numpy().view(np.uint64), part.column("n").to_numpy()
            for shard, own, at in t.numbered(keys_):
                vector = vectors.setdefault(shard, np.zeros(t.size(shard), dtype=np.int64))
                np.add.at(vector, at, n[own])
        for shard, vector in vectors.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([task], pa.int64()), pa.array([vector.tobytes()])],
                ["shard", "part", "vector"])

    rows = tree_sum(pairs.select("key", "n").mapInArrow(dense, "shard int, part long, vector binary"),
                    ["shard"], "int64").collect()
    held.release()
    counts = {r.shard: bytes(r.vector) for r in rows}
    best = np.zeros(0, dtype=np.int64)
    for shard, vector in counts.items():
        b = (np.frombuffer(table.parts[shard][2], "<u8") & np.uint64((1 << B_BITS) - 1)).astype(np.int64)
        if len(b):
            top = np.zeros(max(len(best), int(b.max()) + 1), dtype=np.int64)
            top[:len(best)] = best
            np.maximum.at(top, b, np.frombuffer(vector, dtype=np.int64))
            best = top
    return PairCounts(table, counts, best)


def _joined(docs: DataFrame, pairs: DataFrame, kind: str, a_path: str, b_path: str) -> DataFrame:
    """The second pass by a join of the documents' pairs with the counts."""
    sizes = ", ".join(f"{c} long" for c in FIGURES[:4])
    each = materialize(docs.mapInArrow(
        _per_document(a_path, b_path), f"doc_id {kind}, _row long, {sizes}, groups_sha256 string, "
        "pairs array<long>, times array<long>"), "aligned")
    counts = pairs.groupBy("key").agg(F.sum("n").alias("count")).withColumn(
        "b", F.col("key").bitwiseAND(F.lit((1 << B_BITS) - 1)))
    counts = materialize(counts, "pair-counts")
    best = counts.groupBy("b").agg(F.max("count").alias("best"))  # one row per piece of the vocabulary
    links = each.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "_row", F.col("l.pairs").alias("key"), F.col("l.times").alias("times"))
    held = links.join(counts.join(best, "b"), "key").groupBy("_row").agg(
        F.sum(F.when(F.col("count") == F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    return (each.drop("pairs", "times").join(held, "_row", "left").na.fill(0, ["n_best", "count_sum"])
            .select("doc_id", *FIGURES, "groups_sha256"))


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def alignment_table(docs: DataFrame, paths: tuple[str, str] | None = None,
                    most_pairs: int = MOST_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    a_path, b_path = paths or default_paths()
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", "text")
    pairs = pair_table(rows, a_path, b_path)
    keys = materialize(pairs.select("bucket", "key").distinct(), "pair-keys")
    n_keys = keys.count()
    if n_keys > most_pairs:
        return _joined(rows, pairs, kind, a_path, b_path)
    held = share(docs.sparkSession, hashed_counts(pairs, keys, n_keys))
    figures = ", ".join(f"{c} long" for c in FIGURES)
    return rows.mapInArrow(_looked_up(a_path, b_path, held), f"doc_id {kind}, {figures}, groups_sha256 string")
