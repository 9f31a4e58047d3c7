"""Tokenizer alignment against whole-text encodings by the libraries."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import types as T
from tokenizers import Tokenizer

from regloom.llm import alignment, mph
from regloom.llm.queries import QUERIES
from regloom.session import load

ODD = ["", None, " ", "  ", "\n", "a", "a b", "a  b", " lead", "trail ", "a \n b", "a\n b", "a\tb \r\n c", "x y",
       "don't  stop\n\n\nit's 1,234.5 o'clock", "<s> </s> <unk> <0x0A> <|endoftext|>", "mark ▁ inside", "▁", "é 😀👩‍👩‍👧 ßtraße",
       "日本語のテキスト 中文 한국어", "a b   c d  e", "\x00 \x01\x1c \x1d x", "y" * 3000, "word " * 2000,
       "naïve café ́combining", "ﬁ ligature ① ½", "﻿bom", "العربية हिन्दी ไทย", "    indented = {'a': 1}\n\treturn\n"]
DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("bucket", T.StringType()), T.StructField("n_a", T.StringType()),
                    T.StructField("_row", T.LongType())])


class Plain:
    """The contract, from whole-text encodings."""

    def __init__(self):
        a_path, b_path = alignment.default_paths()
        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        letters = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        extra = [x for x in range(256) if x not in letters]
        self.letters = {chr(x): x for x in letters} | {chr(0x100 + i): x for i, x in enumerate(extra)}

    def tokens(self, text):
        e = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.letters[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        return a, b

    def document(self, text):
        """(n_a, n_b, groups, links) or None."""
        if not text:
            return None
        a, b = self.tokens(text)
        raw = b" " + text.encode()
        if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
            return None
        spans = []
        for side in (a, b):
            ends = np.cumsum([len(t) for _, t in side]).tolist()
            spans.append([(i, e - len(t), e) for (i, t), e in zip(side, ends)])
        both = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, low = [], 0
        place = [{e: k + 1 for k, (_, _, e) in enumerate(side)} for side in spans]
        last = (0, 0)
        for e in both:
            now = (place[0][e], place[1][e])
            groups.append(tuple([i for i, _, _ in spans[s][last[s]:now[s]]] for s in (0, 1)))
            last = now
        links, start = [], 0
        for i, s, e in spans[0]:
            while spans[1][start][2] <= s:
                start += 1
            k = start
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        return len(a), len(b), groups, links


@pytest.fixture(scope="module")
def plain():
    return Plain()


def expected(plain, rows):
    docs = [(i, plain.document(t)) for i, t in rows]
    count = Counter(p for _, d in docs if d for p in d[3])
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = Counter()
    for i, d in docs:
        if d is None:
            out[i, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        n_a, n_b, groups, links = d
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out[i, n_a, n_b, len(groups), len(links), sum(count[p] == best[p[1]] for p in links),
            sum(count[p] for p in links), hashlib.sha256(said.encode()).hexdigest()] += 1
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows_of(df):
    assert df.columns == COLUMNS
    return Counter(tuple(r) for r in df.collect())


def test_query_equals_the_libraries_over_the_whole_table(spark, plain):
    docs = [(r.doc_id, r.text) for r in load(spark, "/root/testdata/sf0.01", "documents").collect()]
    got = rows_of(QUERIES["op13_tokenizer_alignment"](spark, "/root/testdata/sf0.01"))
    assert got == expected(plain, docs)


@pytest.mark.parametrize("most_pairs", [alignment.MOST_PAIRS, 0])
def test_odd_rows_by_both_ways(spark, plain, most_pairs):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(6, "a b"), (6, "a b"), (None, "no id"), (None, None)]
    df = spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in rows], DOC).repartition(3)
    assert rows_of(alignment.alignment_table(df, most_pairs=most_pairs)) == expected(plain, rows)


@pytest.mark.parametrize("most_pairs", [alignment.MOST_PAIRS, 0])
def test_empty_and_wordless_tables(spark, most_pairs):
    for rows in ([], [(1, None, "c", "c", 1), (2, "", "c", "c", 1)]):
        got = rows_of(alignment.alignment_table(spark.createDataFrame(rows, DOC), most_pairs=most_pairs))
        assert got == Counter({(r[0], 0, 0, 0, 0, 0, 0, ""): 1 for r in rows})


def test_a_full_chunk_table_starts_anew(plain, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(alignment, "HELD", 20)
    monkeypatch.setattr(alignment, "STEP", 50)
    texts = [" ".join(f"w{i * 7 + k}" for k in range(9)) for i in range(30)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    count = Counter()
    for part in alignment._pair_counts(*alignment.default_paths())(iter([batch])):
        count.update(dict(zip(part.column("key").to_pylist(), part.column("n").to_pylist())))
    want = Counter(a << 32 | b for t in texts for a, b in plain.document(t)[3])
    assert count == want


def test_perfect_hash_is_minimal_and_verified(spark):
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 64, 65, 5000):
        keys = np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64))
        made = mph.ShardHash.build(keys)
        assert sorted(made.number(keys).tolist()) == list(range(len(keys)))
    keys = np.unique(rng.integers(0, 2 ** 60, 200_000, dtype=np.uint64))
    df = spark.createDataFrame(list(zip(mph.bucket_of(keys).tolist(), keys.astype(np.int64).tolist())),
                               "bucket int, key long").repartition(6)
    shards, built = mph.build_shards(df, len(keys))
    table = mph.KeyTable(shards, built.collect())
    assert shards == 4 and sum(table.size(s) for s in range(4)) == len(keys)
    seen = np.zeros(len(keys), dtype=bool)
    for shard, own, at in table.numbered(keys):
        assert sorted(at.tolist()) == list(range(table.size(shard)))
        seen[own] = True
    assert seen.all()
    strange = np.array([2 ** 61 + 5, keys[7]], dtype=np.uint64)
    assert sorted(i for _, own, _ in table.numbered(strange) for i in own.tolist()) == [1]
