"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only documents are labelled. A sentence's
probability is a logistic score of its distinct words; a document's is their
noisy-or, ``1 - prod(1 - p)``. The weights are trained from the document labels
through the noisy-or, and afterwards point at the offending sentences.

Training uses a bounded sample: the ``train_docs`` labelled documents with the
least hash of their id among those not held out (``crc32(doc_id) % 3 != 1``).
Scores see the text only.

Nulls: a null text is empty; its score is that of a bag without sentences, 0.
A null label or doc_id is not learnt from; of labels that disagree the larger
counts. Without labels of both kinds the weights are zero and the score is the
prior. Repeated rows get equal scores; an empty table gives an empty table."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

TRAIN_DOCS = 6_000
BITS = 18
EPOCHS = 200
STEP = 0.1
SHRINK = 1e-5
#: Standard deviations by which toxic documents must be over-represented among a word's documents.
LEAST_Z = 5.5
HELD_WORDS = 1 << 20
LIMIT = 0.7

_FOLD = bytes(10 if c in b".!?\n" else c + 32 if 65 <= c <= 90
              else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def sentences(text: str | None) -> list[list[bytes]]:
    """Lowered words of each sentence that has any; sentences end at . ! ? and line ends."""
    return [w for x in (text or "").encode().translate(_FOLD).split(b"\n") if (w := x.split())]


def feature(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> (64 - BITS)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _bags(stream):
    """Features of each sentence: distinct hashed words, flattened, with sentence ends."""
    for part in stream:
        feats, ends = [], []
        for text in part.column("text").to_pylist():
            f, e = [], []
            for s in sentences(text):
                f += {feature(w) for w in s}
                e.append(len(f))
            feats.append(f)
            ends.append(e)
        yield pa.RecordBatch.from_arrays(
            [part.column("toxic"), pa.array(feats, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))],
            ["toxic", "feats", "ends"])


def training_sample(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(toxic, feats, ends) of at most ``train_docs`` labelled documents."""
    known = (labels.where("toxic is not null and doc_id is not null")
             .where(~held_out(F.col("doc_id"))).groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("toxic")))
    ids = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    # bounded by train_docs, so this side may be broadcast; rows that repeat an id count once
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
    return rows.orderBy("doc_id").select("toxic", "text").mapInArrow(
        _bags, "toxic int, feats array<int>, ends array<int>")


class NoisyOr:
    """Sentence weights and bias, trained through the noisy-or of the bags."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    @classmethod
    def fit(cls, bags, epochs: int = EPOCHS, step: float = STEP, shrink: float = SHRINK) -> NoisyOr:
        """``bags``: rows (toxic, feats, ends). Full-batch descent with
        per-weight step sizes on the mean log loss plus an L2 penalty. Only
        words found in toxic documents clearly more often than chance get a
        weight, and weights are not negative: a word can offend, not atone."""
        bags = [(y, f, e) for y, f, e in bags if len(e)]
        y = np.array([b[0] for b in bags], dtype=float)
        weights = np.zeros(1 << BITS)
        prior = min(max(float(y.mean()) if len(y) else 0.0, 1e-4), 1 - 1e-4)
        size = float(np.mean([len(b[2]) for b in bags])) if bags else 1.0
        bias = math.log(math.expm1(-math.log1p(-prior) / size))
        if not len(y) or y.min() == y.max():
            return cls(weights, bias)
        feats = np.concatenate([b[1] for b in bags]).astype(np.int64)
        per_doc = np.array([len(b[2]) for b in bags])
        ends = np.concatenate([np.asarray(b[2], dtype=np.int64) for b in bags])
        starts = np.concatenate([np.concatenate([[0], b[2][:-1]]) for b in bags])
        of_sentence = np.repeat(np.arange(len(ends)), (ends - starts).astype(np.int64))
        doc = np.repeat(np.arange(len(bags)), per_doc)
        seen = np.unique(doc[of_sentence] << BITS | feats)
        with_it = np.bincount(seen & ((1 << BITS) - 1), minlength=1 << BITS)
        toxic = np.bincount(seen & ((1 << BITS) - 1), y[seen >> BITS], 1 << BITS)
        expected = with_it * prior
        telling = (toxic - expected) >= LEAST_Z * np.sqrt(expected * (1 - prior) + 1)
        use = telling[feats]
        feats, of_sentence = feats[use], of_sentence[use]
        used, feats = np.unique(feats, return_inverse=True)
        w, b = np.zeros(len(used)), bias
        m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
        for t in range(1, epochs + 1):
            s = b + np.bincount(of_sentence, w[feats], len(ends))
            total = np.bincount(doc, np.logaddexp(0, s), len(bags))
            pull = np.where(y == 1, -1 / np.expm1(np.maximum(total, 1e-9)), 1.0)
            g_s = pull[doc] / (1 + np.exp(-s)) / len(bags)
            g = np.append(np.bincount(feats, g_s[of_sentence], len(used)) + shrink * w, g_s.sum())
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            move = step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
            w, b = np.maximum(w - move[:-1], 0), b - move[-1]
        weights[used] = w
        return cls(weights.astype(np.float32), float(b))


class _Weights(dict):
    def __init__(self, weights):
        self.by_feature = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= HELD_WORDS:
            self.clear()
        out = self[word] = float(self.by_feature[feature(word)])
        return out


def bag_score(text: str | None, weight: _Weights, bias: float):
    """(document score, sentence scores): the noisy-or and its parts."""
    scores = []
    for s in sentences(text):
        scores.append(bias + sum(map(weight.__getitem__, set(s))))
    if not scores:
        return 0.0, scores
    s = np.array(scores)
    return float(-np.expm1(-np.logaddexp(0, s).sum())), 1 / (1 + np.exp(-s))


def _score(shared):
    def run(stream):
        weights, bias = shared.value
        weight = _Weights(weights)
        for part in stream:
            out = []
            for text in part.column("text").to_pylist():
                score, each = bag_score(text, weight, bias)
                worst = int(np.argmax(each)) if len(each) else None
                out.append((score, len(each), worst, float(each[worst]) if len(each) else None,
                            [int(i) for i in np.flatnonzero(np.asarray(each) >= 0.5)]))
            cols = list(zip(*out)) or [()] * 5
            kinds = (pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                ["doc_id", "score", "n_sentences", "worst_sentence", "worst_score", "offending"])
    return run


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> NoisyOr:
    sample = materialize(training_sample(docs, labels, train_docs), "toxic-train").toPandas()
    return NoisyOr.fit(sample[["toxic", "feats", "ends"]].itertuples(index=False, name=None))


def toxicity_table(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_sentences, worst_sentence,
    worst_score, offending) of every row. ``offending`` lists the sentences,
    from 0, whose own probability is at least one half."""
    model = train(docs, labels, train_docs)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # 2**BITS weights
    kind = dict(docs.dtypes)["doc_id"]
    out = docs.select("doc_id", "text").mapInArrow(
        _score(shared), f"doc_id {kind}, score double, n_sentences long, worst_sentence long, "
        "worst_score double, offending array<int>")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= LIMIT).cast("int").alias("predicted"),
                      "n_sentences", "worst_sentence", "worst_score", "offending")
