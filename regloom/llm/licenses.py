"""Licence scan: an exact set-similarity join of text blocks with licence templates.

Blocks are the lines of a text, sets are their words. The words of all
templates are counted over the whole corpus, and every template lists its
words from the globally rarest on. A block that holds at least ``percent`` of
a template's words must hold one of the template's first
``size - needed + 1``: only those words are indexed (prefix filter). A block
with fewer distinct words than needed is passed over (length filter), and so
is a meeting from whose places on too few words can still follow on either
side (positional filter). What is left is confirmed on the full sets, so every
block at or over the threshold is found and no other.

Beside it, base phrases are looked up over the words of the whole text.
Nulls: a null text is empty, has no words and no labels. Repeated rows give
repeated results; an empty table gives an empty table."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Licence statements as their publishers word them, and labels.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("reserved", "all rights reserved"),
)
PERCENT = 90

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
              for c in range(256))
_FOLD_LINES = bytes(10 if c == 10 else f for c, f in enumerate(_FOLD))


def words(text: str | None) -> list[bytes]:
    """Lowered words: runs of ASCII letters and digits and of anything beyond ASCII."""
    return (text or "").encode().translate(_FOLD).split()


def _lines(text: str | None) -> list[list[bytes]]:
    return [x.split() for x in (text or "").encode().translate(_FOLD_LINES).split(b"\n")]


def _counts(vocabulary: frozenset):
    def run(stream):
        total: Counter = Counter()
        for part in stream:
            for text in part.column("text").to_pylist():
                total.update(filter(vocabulary.__contains__, words(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in total], pa.string()), pa.array(total.values(), pa.int64())],
            ["word", "n"])
    return run


def word_counts(docs: DataFrame, templates=TEMPLATES) -> dict[bytes, int]:
    """Occurrences over all of ``docs`` of each word of the templates: as many
    rows as the templates have words reach the driver."""
    vocabulary = frozenset(w for _, t in templates for w in words(t))
    rows = (docs.select("text").mapInArrow(_counts(vocabulary), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())
    return dict.fromkeys(sorted(vocabulary), 0) | {r["word"].encode(): r["n"] for r in rows}


class TemplateIndex:
    """Templates ordered by global word frequency, their prefixes indexed."""

    def __init__(self, templates, counts: dict[bytes, int], percent: int = PERCENT):
        rank = {w: i for i, w in enumerate(sorted(counts, key=lambda w: (counts[w], w)))}
        self.rank, self.templates = rank, []
        self.index: dict[bytes, list[tuple[int, int]]] = {}
        for label, text in templates:
            ordered = sorted(set(words(text)), key=rank.__getitem__)
            need = -(-len(ordered) * percent // 100)
            self.templates.append((label, frozenset(ordered), len(ordered), need))
            for at, w in enumerate(ordered[:len(ordered) - need + 1]):
                self.index.setdefault(w, []).append((len(self.templates) - 1, at))

    def joined(self, block: list[bytes]) -> dict[int, float]:
        """Template number -> containment, of the templates that ``block`` meets."""
        own = set(block)
        if self.index.keys().isdisjoint(own):
            return {}
        known = sorted(own & self.rank.keys(), key=self.rank.__getitem__)
        out: dict[int, float] = {}
        passed: set[int] = set()
        for j, w in enumerate(known):
            for number, at in self.index.get(w, ()):
                if number in passed:
                    continue
                passed.add(number)  # its rarest common word: nothing of it lies before
                _, full, size, need = self.templates[number]
                if len(own) < need or 1 + min(size - at - 1, len(known) - j - 1) < need:
                    continue
                common = len(full & own)
                if common >= need:
                    out[number] = common / size
        return out


def _places(text_words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase."""
    line = b" " + b" ".join(text_words) + b" "
    out = []
    for phrase, label in PHRASES.items():
        wanted, at = b" " + phrase.encode() + b" ", -1
        while (at := line.find(wanted, at + 1)) >= 0:
            out.append((line.count(b" ", 0, at), label))
    return out


def _scan(templates, counts, percent):
    def run(stream):
        index = TemplateIndex(templates, counts, percent)
        first = frozenset(index.index)
        for part in stream:
            out = []
            for text in part.column("text").to_pylist():
                w = words(text)
                places = _places(w)
                found, blocks = {}, []
                if not first.isdisjoint(w):
                    for number, block in enumerate(_lines(text)):
                        if met := index.joined(block):
                            blocks.append(number)
                            for t, c in met.items():
                                found[t] = max(c, found.get(t, 0.0))
                base = {label for _, label in places}
                starts = [p for p, _ in places]
                out.append((len(w), len(places), min(starts, default=None), max(starts, default=None),
                            ",".join(sorted(base)),
                            ",".join(sorted(base | {index.templates[t][0] for t in found})),
                            1.0 if places else max(found.values(), default=0.0), blocks))
            cols = list(zip(*out)) or [()] * 8
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                     pa.float64(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                 "score", "blocks"])
    return run


def scan(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, blocks) of every row; ``blocks`` lists the lines that meet a
    template. The score is the largest containment found, 1 with a base phrase."""
    counts = word_counts(docs, templates)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        _scan(templates, counts, percent),
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, blocks array<int>")
