"""SentencePiece encoding and decoding through a table of distinct chunks.

The model's pieces never cross from a word into the next white-space marker
(checked when the model is loaded). So a normalised text is cut before each
marker that follows a word, every distinct chunk is segmented once by the
library itself, and the ids are joined back by position; the text's ids are
exactly the library's. The table lives in the task that reads the texts and is
bounded: shuffling every chunk of a corpus to one global table and back would
move several times the corpus.

Nulls: a null text is empty and has no ids. An empty table gives an empty table."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+$")
#: Distinct chunks that a task remembers, and the longest it remembers; past that the table starts anew.
HELD, LONGEST = 600_000, 64
#: Characters of text whose new chunks are segmented in one call.
STEP = 1 << 20


class ChunkTable:
    """Distinct chunk -> (number of ids, ids as text, decoded text) of one
    model. Chunks are kept without their first marker."""

    def __init__(self, model: str):
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=model)
        inside = re.compile(f"[^{MARK}]{MARK}")
        if any(inside.search(m.id_to_piece(i)) for i in range(m.get_piece_size())):
            raise ValueError("pieces of this model cross white-space markers")
        if not m.normalize("a").startswith(MARK):
            raise ValueError("this model does not mark the first word")
        self.table: dict[str, tuple[int, str, str]] = {}
        self.lead = m.encode("\n")  # ids that can stand before a chunk and be cut off again

    def _segment(self, chunks: list[str]) -> dict:
        """Entries of distinct chunks. A bare marker is encoded behind the
        lead, as the library takes an empty text to have no marker; every
        chunk is decoded behind it, so that its own marker is not taken for
        the marker of the whole text."""
        m, cut = self.model, len(self.lead)
        ids = m.encode([c.replace(MARK, " ") for c in chunks], num_threads=1)
        ids = [i if c else m.encode("\n" + MARK)[cut:] for c, i in zip(chunks, ids)]
        texts = m.decode([self.lead + i for i in ids], num_threads=1)
        return {c: (len(i), ",".join(map(str, i)), t[1:]) for c, i, t in zip(chunks, ids, texts)}

    def _chunks(self, text: str) -> list[str]:
        if not text:
            return []
        normal = self.model.normalize(text)
        plain = normal[1:].replace(MARK, " ")
        if "  " in plain or plain.startswith(" ") or plain.endswith(" "):
            return [c[1:] for c in CHUNK.findall(normal)]
        return plain.split(" ")  # single markers only

    def entries(self, texts):
        """For each text the entries of its chunks in order; new chunks are
        segmented together for every ``STEP`` characters of text."""
        group, held = [], 0
        for text in texts:
            group.append(text)
            held += len(text)
            if held >= STEP:
                yield from self._grouped(group)
                group, held = [], 0
        yield from self._grouped(group)

    def _grouped(self, texts):
        cut = [self._chunks(t) for t in texts]
        table = self.table
        new = set().union(*cut).difference(table)
        if len(table) + len(new) > HELD:
            table.clear()
            new = set().union(*cut)
        found = self._segment(list(new)) if new else {}
        table.update((c, e) for c, e in found.items() if len(c) <= LONGEST)
        for chunks in cut:
            yield [table[c] if c in table else found[c] for c in chunks]

    def encode(self, text: str) -> list[int]:
        found = next(self._grouped([text]))
        return [int(i) for i in ",".join([e[1] for e in found]).split(",")] if found else []

    def decode(self, entries) -> str:
        """Text of the whole sequence; the first marker is the library's own."""
        return "".join([e[2] for e in entries])[1:]


def _digests(model: str):
    def run(stream):
        table = ChunkTable(model)
        for part in stream:
            n, ids_sha, back_sha = [], [], []
            for found in table.entries(t or "" for t in part.column("text").to_pylist()):
                n.append(sum([e[0] for e in found]))
                ids_sha.append(hashlib.sha256(",".join([e[1] for e in found]).encode()).hexdigest())
                back_sha.append(hashlib.sha256(table.decode(found).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(back_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _ids(model: str):
    def run(stream):
        table = ChunkTable(model)
        for part in stream:
            ids = [table.encode(t or "") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(ids, pa.list_(pa.int32()))], [*part.schema.names, "ids"])
    return run


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, model: str | None = None, into: str = "ids") -> DataFrame:
    """``docs`` (with a string column ``text``) plus the ids of the whole text."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")
    names[at] = "text"
    plain = docs.toDF(*names)
    schema = ", ".join(f"{n} {t}" for n, t in plain.dtypes) + ", ids array<int>"
    return plain.mapInArrow(_ids(model or default_model()), schema).toDF(*docs.columns, into)


def piece_table(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text")).mapInArrow(
        _digests(model or default_model()),
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
