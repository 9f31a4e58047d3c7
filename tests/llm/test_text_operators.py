"""Each operator against a brute-force version on rows with ties, repeats,
nulls, empty and long texts, clashing extra columns, and on an empty table."""

import base64
import hashlib
import io
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from regloom.llm import iblt, licenses, linededup, mixing, neardup, pieces, quality, sharding, toxicity, warc
from regloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_shards(docs, none):
    rows = sharding.shard_table(docs, 8).collect()
    assert len(rows) == docs.count()
    for r in rows:
        key = int(hashlib.md5(("null" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16)
        assert (r.shard, r.grown_shard) == (plain_jump(key, 8), plain_jump(key, 9))
        assert r.grown_shard in (r.shard, 8)
    texts = Counter((d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode()))
                    for d in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == texts
    for s in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard_table(none, 8).count() == 0


def test_positions_of_many_equal_rows(spark):
    df = spark.range(250_000).select(F.lit(0).alias("g"), F.lit(5).alias("v"))
    pos = sharding.unpack(sharding.packed_positions(df, ["g"], [F.col("v")], ["v"]))
    assert pos.agg(F.count("_pos"), F.countDistinct("_pos"), F.max("_pos")).first()[:] == (250_000, 250_000, 249_999)


def test_quality(docs, none):
    got = {(r.doc_id, r.n_words): r for r in quality.quality_table(docs).collect()}
    for d in docs.collect():
        t = d.text or ""
        w = WORD.findall(t)
        r = got[(d.doc_id, len(w))]
        seen, hit = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7)), set()
        for i in range(len(w) - 7):
            if seen[tuple(w[i:i + 8])] > 1:
                hit |= set(range(i, i + 8))
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))
        assert r.base_failed == (len(w) < 20 or 100 * len(hit) > 30 * len(w))
        assert not (r.kept and r.base_failed)
    assert quality.quality_table(none).count() == 0
    assert quality.keep_good(docs).columns == docs.columns


def test_repeated_words_overlap(spark):
    text = " ".join(f"a{i}" for i in range(10)) + " x " + " ".join(f"a{i}" for i in range(10))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality.quality_table(df).first().n_repeat_words == 20


def shingles(t):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(a):
        while comp[a] != a:
            a = comp[a]
        return a
    for a in range(len(rows)):
        for b in range(a):
            k = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * k >= 85 * (len(sets[a]) + len(sets[b]) - k):
                comp[root(a)] = root(b)
    groups = {}
    for a in range(len(rows)):
        groups.setdefault(root(a), []).append(rows[a][0])
    return Counter((rows[a][0], len(sets[a]), min((i for i in groups[root(a)] if i is not None), default=None))
                   for a in range(len(rows)))


def test_near_duplicates(docs, none):
    rows = [(d.doc_id, d.text) for d in docs.collect()]
    got = neardup.near_table(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert neardup.near_table(none).count() == 0
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.where("text = 'one'").count() == 1 and kept.where("coalesce(text, '') = ''").count() == 3


def test_chain_of_near_duplicates_is_one_component(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[i * 4:i * 4 + 90])) for i in range(8)]  # neighbours alike, ends not
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_table(df).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows)
    assert {r.component_id for r in got} == {0}


def test_edited_copies_around_the_threshold(spark, monkeypatch):
    """Copies of one text with 0 to 12 changed words of 150: many share a bucket
    without a link, some are linked with a member that is not the centre only."""
    rng, base = random.Random(5), [f"w{i}" for i in range(150)]
    rows = []
    for i in range(160):
        words = list(base[:150 - rng.choice((0, 0, 10, 25))])
        for at in rng.sample(range(len(words)), rng.randrange(13)):
            words[at] = f"x{rng.randrange(60)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_components(rows)
    assert 5 < len({c for _, _, c in expected}) < 155
    for chunk in (512, 7):
        monkeypatch.setattr(neardup, "CHUNK", chunk)
        got = neardup.near_table(df).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected


def test_marks_differ_in_no_more_bits_than_sets():
    rng = np.random.default_rng(3)
    for size in (1, 40, 900, 5000):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        b = np.unique(np.r_[a[size // 5:], rng.integers(0, 1 << 63, size // 7, dtype=np.uint64)])
        bits = sum(int(x).bit_count() for x in (neardup.mark(a) ^ neardup.mark(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b)) and neardup.mark(a).size == neardup.MARK_BITS // 64


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, target = float(sum(sizes.values())), set(names), {}
    while True:
        level = left / max(sum(weight[s] for s in free), 1)
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over


def test_mixing(docs, none):
    rows = mixing.mix_table(docs).collect()
    sizes = Counter()
    for d in docs.collect():
        sizes[d.source] += len(WORD.findall(d.text or ""))
    want = brute_targets(dict(sizes))
    for r in rows:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken == r.copies * r["size"] <= 3 * r["size"]
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.mix_table(docs.repartition(7)).collect()))
    out = mixing.mix(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in rows)
    assert mixing.mix_table(none).count() == 0 and mixing.mix(none).count() == 0


def test_copies_cross_whole_boundaries(spark):
    """Against integers of any size: the highest offset, rates up to the most, far positions."""
    one, top = mixing.ONE, 3 * mixing.ONE
    rows = [(u, rate, pos) for u in (0, 1, one // 3, one - 1) for rate in (0, 1, one - 1, one, 2 * one + 77, top - 1, top)
            for pos in (0, 1, 699050, (1 << 31) - 1, 1 << 31, 10 ** 12 + 7)]
    df = spark.createDataFrame(rows, "_u long, _rate long, pos long")
    for r in df.withColumn("n", mixing._copies(F.col("pos"))).collect():
        u, rate, pos, n = r
        assert n == (u + rate * (pos + 1)) // one - (u + rate * pos) // one <= 3


def test_warc(spark):
    pages = [(1, "u", "<a>"), (2, "v", "<a>"), (2, "v", "<a>"), (3, None, None), (4, "u\r\nx", ""),
             (None, "n", "<b>"), (5, "w", "é" * 300_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = Counter(map(tuple, warc.round_trip(df).collect()))
    want = Counter()
    for n, (i, _, h) in enumerate(pages):
        b = (h or "").encode()
        best = max((p[0] for p in pages if (p[2] or "") == (h or "")), key=lambda x: -1 if x is None else x)
        first = best == i and pages.index((i, pages[n][1], h)) == n
        want[(i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
              "response" if first else "revisit", None if first else best)] += 1
    assert got == want
    full = warc.read_archives(warc.write_archives(warc.plan_records(df))).where("record_type = 'response'")
    assert {bytes(r.payload) for r in full.collect()} == {(p[2] or "").encode() for p in pages}
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_reader_finds_damage():
    raw = warc.record("response", "urn:page:1", "u", b"body", 4, hashlib.sha1(b"body").hexdigest(), None)
    assert next(warc.read_records(io.BytesIO(warc.member(raw))))["payload"] == b"body"
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(io.BytesIO(warc.member(raw.replace(b"body", b"bodY")))))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(warc.member(raw)[:-12])))


SPACES = re.compile(r"[\x20\x09-\x0D]+")


def plain_units(text):
    """Distinct units of a text, character by character."""
    marks, wide, quotes = set(".!?…‼⁇⁈⁉؟۔।॥։።፧။៕᙮"), set("。！？．｡"), set("\"'”’»›)]」』")
    space, sentences, now, i = set(" \t\n\x0b\x0c\r"), [], "", 0
    while i < len(text):
        c = text[i]
        if c == "\n":
            sentences.append(now)
            now, i = "", i + 1
            continue
        last, before = text[i - 1] if i else "", text[i - 2] if i > 1 else ""
        ended = (last in wide and c not in quotes) or (before in wide and last in quotes)
        spaced = c in space and (last in marks or (before in marks and last in quotes))
        if (ended or spaced) and now:
            sentences.append(now)
            now = ""
            while i < len(text) and text[i] in space:
                i += 1
            if i < len(text):
                now, i = text[i], i + 1
            continue
        now, i = now + c, i + 1
    return {u for s in [*sentences, now] for u in (cut_long(s) if len(s) > 240 else [s]) if u}


def signed(text):
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def cut_long(sentence):
    out = []
    for w in SPACES.split(sentence):
        if len(w) > 120:
            out.append("".join(c + "\n" * (signed(b + c) % 32 == 0) for b, c in zip(["", *w], w)))
        else:
            out.append(w + "\n" * (signed(w) % 8 == 0))
    return re.split("\n ?", " ".join(out))


def test_sketches(docs, none):
    got = iblt.fingerprint_table(docs).collect()
    rows = sorted({(-1 if d.doc_id is None else d.doc_id, d.text or "") for d in docs.collect()},
                  key=lambda x: (-x[0], hashlib.md5(x[1].encode()).hexdigest()))
    seen = {}

    def like(a, b):
        a, b = plain_units(a), plain_units(b)
        return 1.0 if not a | b else 1 - len(a ^ b) / (len(a) + len(b))
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        k = len(t) // 3
        e = t[:len(t) - k] + nxt[:k]
        seen[(i, len(t), sha(e))] = (like(t, e), like(t, nxt))
    assert len(got) == docs.count()
    for r in got:
        near = seen[(-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256)]
        assert (r.near_edited, r.near_next) == pytest.approx(near)
    assert iblt.fingerprint_table(none).count() == 0


def test_pieces_match_the_library(docs, none):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    want = Counter()
    for d in docs.collect():
        ids = sp.encode(d.text or "")
        want[(d.doc_id, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))] += 1
    assert Counter(map(tuple, pieces.piece_table(docs).collect())) == want
    assert pieces.piece_table(none).count() == 0
    assert pieces.encode(docs).columns == [*docs.columns, "ids"]


def test_toxicity_learns_from_bags(spark, none):
    rng = np.random.RandomState(1)
    rows = []
    for i in range(400):
        w = [[f"v{rng.randint(50)}" for _ in range(8)] for _ in range(4)]
        if i % 4 == 0:
            w[i % 3][2] = "vile"
        rows.append((i, ". ".join(" ".join(s) for s in w), int(i % 4 == 0)))
    df = spark.createDataFrame([*rows, (None, None, None), (1000, "", 0)], "doc_id long, text string, toxic int")
    out = {r.doc_id: r for r in toxicity.toxicity_table(df, df.select("doc_id", "toxic")).collect()}
    assert len(out) == 402 and out[None].score == out[1000].score == 0.0
    for i, _, y in rows:
        r = out[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == y
        if y:
            assert r.worst_sentence == i % 3 and r.offending == [i % 3]
    unlabelled = toxicity.toxicity_table(df, df.select("doc_id", "toxic").limit(0))
    assert unlabelled.where("predicted = 1").count() == 0 and toxicity.toxicity_table(none, df).count() == 0


def test_licences(docs, none):
    got = {(r.doc_id, r.n_words): r for r in licenses.scan(docs).collect()}
    r = next(r for (i, _), r in got.items() if i == 40)
    assert (r.n_base, r.first_word, r.last_word) == (3, 8, 13)
    assert r.base_labels == "cc-by,reserved" and r.labels == "apache-2.0,cc-by,reserved" and r.score == 1.0
    assert got[(6, 0)].labels == "" and got[(6, 0)].first_word is None
    assert licenses.scan(none).count() == 0


def test_template_join_is_exact():
    rng = np.random.RandomState(3)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in licenses.words(t)})
    index = licenses.TemplateIndex(licenses.TEMPLATES, {w: int(rng.randint(9)) for w in vocabulary}, 60)
    for _ in range(3000):
        block = [vocabulary[i] for i in rng.randint(len(vocabulary), size=rng.randint(30))]
        want = {n: len(full & set(block)) / size for n, (_, full, size, need) in enumerate(index.templates)
                if len(full & set(block)) >= need}
        assert index.joined(block) == want


def brute_lines(rows, least=10):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    held = Counter(k for t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    return [[x for x in (t or "").split("\n") if held[key(x)] < least or not key(x)] for t in rows]


@pytest.mark.parametrize("broadcast_lines", [10, 0])
def test_line_dedup(docs, none, broadcast_lines):
    rows = docs.collect()
    want = Counter((d.doc_id, len((d.text or "").split("\n")), "\n".join(k))
                   for d, k in zip(rows, brute_lines([d.text for d in rows])))
    out = linededup.dedup_lines(docs, 10, broadcast_lines=broadcast_lines)
    assert Counter((r.doc_id, r._n_lines, r.text or "") for r in out.collect()) == want
    assert linededup.dedup_lines(none, broadcast_lines=broadcast_lines).count() == 0


def test_runs_compact_and_drop_what_is_known(spark):
    runs = linededup.LineRuns(spark, fanout=2)
    for i in range(5):
        batch = spark.createDataFrame([(i, f"common\nown {i}")], "doc_id long, text string")
        out = linededup.unseen_lines(runs, batch).first()
        assert out.text == (f"common\nown {i}" if i == 0 else f"own {i}")
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert sorted(r.docs for r in runs.counts().collect()) == [1, 1, 1, 1, 1, 5]


def test_pipeline_stages(spark, docs):
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, None)
        assert out.columns == docs.columns
        rows = out.collect()
        now = spark.createDataFrame(rows, docs.schema)
        if name == "quality_rules":
            assert {r.doc_id for r in rows} <= {d.doc_id for d in docs.collect()} and len(rows) < docs.count()
    assert "ids_sha256" in corpus_pipeline.STAGES[-1][1](spark, now, None).columns
    assert len(QUERIES) == 13


def brute_first(rows, least=10):
    """Texts after line dedup that leaves each frequent line to the copies of the first text, by id, that holds it."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    keys = [[key(x) for x in (t or "").split("\n")] for _, t in rows]
    held = Counter(k for ks in keys for k in set(ks) if k)
    first = {}
    for n in sorted(range(len(rows)), key=lambda n: -1 if rows[n][0] is None else rows[n][0]):
        for k in keys[n]:
            first.setdefault(k, keys[n])
    return [(i, None if t is None else "\n".join(
        x for x, k in zip(t.split("\n"), ks) if held[k] < least or not k or first[k] == ks))
        for (i, t), ks in zip(rows, keys)]


def copied_rows():
    prose = [" ".join(f"{g}{i}" for i in range(60)) + "\n" + " ".join(f"{g}{i}" for i in range(60, 140))
             for g in "pqr"]
    return [*[(100 + i, prose[0]) for i in range(12)],                             # copies
            *[(200 + i, prose[1].upper() if i % 2 else prose[1] + " ") for i in range(14)],  # copies but for case and ends
            *[(300 + i, f"{prose[2]}\nlast {i}") for i in range(11)],              # near copies
            *[(400 + i, f"common\nown {i} of these") for i in range(10)], (500, "common"), (501, "Common "),
            (99, "before\ncommon"), (None, "no words lost"), (502, None), (503, ""), (504, "\n"), (505, " \nx\nx")]


@pytest.mark.parametrize("broadcast_lines", [1000, 0])
def test_frequent_lines_stay_in_their_first_text(spark, none, broadcast_lines):
    rows = copied_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = linededup.keep_first(df, broadcast_lines=broadcast_lines).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter(brute_first(rows))
    assert linededup.keep_first(none, broadcast_lines=broadcast_lines).count() == 0


def test_line_stage_keeps_the_text_of_ten_copies(spark):
    rows = copied_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(map(tuple, dict(corpus_pipeline.STAGES)["line_dedup"](spark, df, None).collect()))
    want = [(i, t) for (i, t), (_, old) in zip(brute_first(rows), rows) if t == old or WORD.search(t)]
    assert got == Counter(want) and {i for i, _ in rows} - {i for i, _ in want} == {500, 501}
    assert all(got[r] == 1 for r in rows[:26]) and got[rows[26]] == 1


def brute_kept(rows, percent=80, width=5):
    """Ids that near-dedup keeps, of rows with distinct ids and words: the least of each component."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    comp = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            k = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
                comp = [comp[b] if c == comp[a] else c for c in comp]
    return {min(rows[b][0] for b in range(len(rows)) if comp[b] == c) for c in set(comp)}


def borderline_rows():
    """Pairs on either side of 0.8 in five-word shingles."""
    rows = []
    for g, added in enumerate((40, 45, 48, 49, 50, 60)):  # appended words: at 45 three-word 0.815, five-word 0.813
        w = [f"g{g}x{i}" for i in range(200)]
        rows += [(10 * g, " ".join(w)), (10 * g + 1, " ".join(w + [f"g{g}y{i}" for i in range(added)]))]
    for g, changed in enumerate((15, 20, 22, 25, 30), 10):  # scattered words: at 25 three-word 0.860, five-word 0.777
        w = [f"g{g}x{i}" for i in range(1000)]
        v = [f"g{g}y{i}" if i % 30 == 10 and i // 30 < changed else x for i, x in enumerate(w)]
        rows += [(10 * g, " ".join(w)), (10 * g + 1, " ".join(v))]
    rows += [(900, "one two three four"), (901, "One two  three four"), (902, "one two three five")]
    return rows


def test_near_stage_takes_five_words_and_eighty_percent(spark):
    rows = borderline_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = dict(corpus_pipeline.STAGES)["minhash_near_dedup"](spark, df, None).collect()
    assert sorted(map(tuple, got)) == sorted(r for r in rows if r[0] in brute_kept(rows))
    ids = {r.doc_id for r in got}
    assert {11, 131} & ids == {131}  # 45 appended: one group; 25 scattered: two documents


def test_units_end_in_every_script(spark):
    rng = np.random.RandomState(5)

    def line(letters, end, gap=" ", n=60, long=9):
        word = lambda: "".join(letters[i] for i in rng.randint(len(letters), size=rng.randint(2, 8)))
        return "".join(gap.join(word() for _ in range(long)) + end for _ in range(n))
    latin, cjk = "abcdefghijklmnopqrstuvwxyz", [chr(c) for c in range(0x4e00, 0x9f00, 7)]
    texts = [line("bcdfhjmnpqtuvwxyz", ". "), line(latin.upper(), "! "), line("0123456789", "? "), line(latin, '." '),
             line("абвгдежзиклмнопрстуфхцчшэюя", ". "), line("ابتثجحخدذرزسشصضطظعغ", "؟ "), line("कखगघचछजझटठडढतथदधन", "। "),
             line(cjk, "。", ""), line(cjk, "」。「", ""), line(latin, " "), line(cjk, " "), line(latin, "", "", long=20),
             line("абвгдежзиклмнопрстуфхцчшэюя", " "), "a " + line("0123456789", " ")]
    # as each text is followed by an empty one, its edited text is its first two thirds
    df = spark.createDataFrame([(2 * i + d, t if d else "") for i, t in enumerate(texts) for d in (0, 1)],
                               "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in iblt.fingerprint_table(df).collect()}
    for i, t in enumerate(texts):
        a, b = plain_units(t), plain_units(t[:len(t) - len(t) // 3])
        r = got[2 * i + 1]
        assert r.n_units == len(a) > 10 and r.near_edited == pytest.approx(1 - len(a ^ b) / (len(a) + len(b)))
        assert r.near_edited > 0.5, (i, r.near_edited)


def test_peeling_ends_with_its_last_pure_cell_and_gives_exact_counts(spark):
    rows = [([1 << 20, 5 << 33, 7 << 47], [5 << 33]), ([], []), ([i << 40 for i in range(1, 60)], [i << 21 for i in range(1, 60)])]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>").select(
        *[F.transform(c, iblt._digest).alias(c) for c in ("a", "b")])
    for width in (4, 256):
        got = df.select(iblt.peel(iblt.subtract(iblt.sketch(F.col("a"), width), iblt.sketch(F.col("b"), width)), width,
                                  iblt._most(F.col("a"), F.col("b"), width)).alias("f")).select("f.*").collect()
        assert [tuple(r) for r in got[:2]] == [(2, True), (0, True)]
        assert tuple(got[2]) == (118, True) if width == 256 else not got[2].clear or got[2].n == 118


def test_small_sketches_compare_bits_in_place_and_hold_the_same_cells(spark):
    digs = [-(1 << 62) + 977 * (i << 31) + i * 0x1234567 for i in range(-20, 20)]
    df = spark.createDataFrame([(digs,), ([],)], "d array<long>")
    cells = iblt.sketch(F.col("d"), iblt.WIDTH)
    assert "shiftrightunsigned" not in str(cells).lower()  # a fold's step has no shift, mask and sum for each cell
    want = [[0, 0] for _ in range(3 * iblt.WIDTH)]
    for d in digs:
        for row in range(3):
            cell = want[row * iblt.WIDTH + ((d & (1 << 64) - 1) >> 16 + 12 * row) % iblt.WIDTH]
            cell[0], cell[1] = cell[0] + 1, cell[1] ^ d
    got = df.select(cells.alias("s")).collect()
    assert [list(c) for c in got[0].s] == want and all(tuple(c) == (0, 0) for c in got[1].s)
