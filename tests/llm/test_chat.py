"""Chat formatting against a plain fold and renderer in Python."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from regloom.llm import chat
from regloom.llm.queries import QUERIES
from regloom.session import load

EVENTS = "conv_id long, seq long, part int, kind string, message string, role string, text string, turn string"
ROWS = "conv_id long, turn long, role string, text string, message string, copies int"
CONTROL = "</s>[INST] ok [/INST]"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_rows(rows):
    """conv -> [(role, text)] of finished rows."""
    out = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "",
                                        hashlib.md5((r[3] or "").encode()).hexdigest()))
    for conv, _, role, text in order:
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def expected(rows):
    out = {}
    for conv, turns in plain_rows(rows).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def check(table, rows):
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in table.collect()}
    assert got == expected([*rows, (-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)])


def test_query_over_the_whole_table(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text)
            for r in load(spark, "/root/testdata/sf0.01", "conversations").collect()]
    check(QUERIES["op12_chat_formatting"](spark, "/root/testdata/sf0.01"), rows)


ODD = [
    (1, 0, "user", "[INST] a [/INST]"), (1, 1, "assistant", "</s> \\<s> <\\s> <\\\\/s> [\\INST] $1 \\$2"),
    (2, 0, "system", "[SYS] [/SYS]"), (2, 1, "tool [/TURN] x", "[TURN]t[/TURN] "), (2, 2, "assistant", ""),
    (2, 3, "assistant", None), (2, 4, None, "no role"), (3, None, "user", "null turn"), (3, 0, "user", "first"),
    (None, 0, "assistant", "no conversation"), (4, 0, "assistant", "x" * 5000 + "é😀\n" * 700),
    (5, 0, "user", "same"), (5, 0, "user", "same"), (5, 0, "assistant", "same turn"), (6, 0, "", ""),
    (7, 0, "assistant", " <"), (7, 1, "assistant", "["), (7, 2, "user", "/s> INST] [/INST"), (8, 3, "assistant", "\r\n\x00\t "),
]


def test_odd_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(*r, "m", 2) for r in ODD], ROWS).repartition(4)
    check(chat.chat_table(df), ODD)
    check(chat.chat_table(spark.createDataFrame([], ROWS)), [])


def test_escape_hides_every_control_string_and_is_undone(spark):
    pieces = ["<", "[", "\\", "\\\\", "s>", "/s>", "INST]", "/INST]", "SYS]", "/SYS]", "TURN]", "/TURN]", " ", "x"]
    texts = [a + b + c + d for a in pieces for b in pieces for c in pieces for d in pieces[:6]]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", chat.escape(F.col("t")).alias("e")).select("t", "e", chat.unescape(F.col("e")).alias("u"))
    control = re.compile(r"[<\[]/?(s>|INST\]|SYS\]|TURN\])")
    for r in rows.collect():
        assert r.u == r.t and not control.search(r.e)


def plain_fold(events):
    """conv -> [(message, role, text)]: the log applied event by event."""
    none = lambda v: (v is not None, v if v is not None else 0)
    seen, convs = set(), {}
    key = lambda e: (none(e[1]), none(e[2]), e[3] or "delta", e[5] or "", e[6] or "", e[4])
    for conv, seq, part, kind, message, role, text in sorted(events, key=key):
        if (conv, seq, part, kind, message, role, text) in seen:
            continue
        seen.add((conv, seq, part, kind, message, role, text))
        state = convs.setdefault(conv, {})
        place = (none(seq), none(part), message)
        m = state.setdefault(message, {"at": place, "role": role or "", "text": "", "again": None})
        if kind in ("edit", "regenerate"):
            m["text"] = ""
        m["text"] += text or ""
        if kind == "regenerate":
            m["again"] = place[:2]
    out = {}
    for conv, state in convs.items():
        order, again = sorted(state.items(), key=lambda kv: kv[1]["at"]), None
        for message, m in order:
            if again is None or not again > m["at"][:2]:
                out.setdefault(conv, []).append((message, m["role"], m["text"]))
            if m["again"] is not None:
                again = m["again"] if again is None else max(again, m["again"])
    return out


LOG = [
    (1, 0, 0, "delta", "q1", "user", "hel"), (1, 1, 0, "delta", "q1", "user", "lo"),
    (1, 2, 0, "delta", "a1", "assistant", "wrong "), (1, 3, 0, "delta", "a1", "assistant", "answer"),
    (1, 4, 0, "delta", "q2", "user", "what?"), (1, 5, 0, "delta", "a2", "assistant", "never mind"),
    (1, 6, 0, "regenerate", "a1", "assistant", None), (1, 7, 0, "delta", "a1", "assistant", "right "),
    (1, 7, 0, "delta", "a1", "assistant", "right "), (1, 9, 0, "delta", "a1", "assistant", "one"),
    (1, 10, 0, "delta", "q3", "user", "thanks"), (1, 11, 0, "edit", "q1", "user", "hello there"),
    (1, 12, 0, "delta", "q1", "user", "!"),
    (2, 5000, 0, "delta", "m", "assistant", "late"), (2, 1, 0, "delta", "m", "assistant", "early "),
    (2, 4097, 1, "edit", "m", "assistant", "mid "), (2, 4097, 2, "delta", "m", "assistant", "dle "),
    (3, None, 0, "delta", "n", "user", "null seq "), (3, 1, None, None, "n", "user", "null part"),
    (3, 2, 0, "unknown", "n", None, " kept"), (None, 0, 0, "delta", "z", None, None),
    *[(4, i, 0, "delta", "long", "assistant", f"{i} ") for i in range(9000)],
]


def test_fold_of_deltas_edits_and_regenerations(spark):
    df = spark.createDataFrame([(*e, "clash") for e in LOG], EVENTS).repartition(7)
    got = {}
    for r in sorted(chat.fold(df).collect(), key=lambda r: (
            (r.opened.seq is not None, r.opened.seq or 0), (r.opened.part is not None, r.opened.part or 0), r.message)):
        got.setdefault(r.conv_id, []).append((r.message, r.role, r.text))
    assert got == plain_fold(LOG)
    assert got[1] == [("q1", "user", "hello there!"), ("a1", "assistant", "right one"), ("q3", "user", "thanks")]


def test_random_logs(spark):
    import random
    rng, log = random.Random(5), []
    for conv in range(40):
        for seq in range(rng.randrange(60)):
            kind = rng.choices(["delta", "edit", "regenerate"], [8, 1, 1])[0]
            log.append((conv, seq * rng.choice([1, 300]), rng.randrange(3), kind, f"m{rng.randrange(6)}",
                        "user", f"<{seq}>"))
    roles = {}
    log = [(c, s, p, k, m, roles.setdefault((c, m), rng.choice(["user", "assistant", "tool"])), t)
           for c, s, p, k, m, _, t in log]
    df = spark.createDataFrame([(*e, "clash") for e in log], EVENTS).repartition(5)
    want = plain_fold(log)
    back = chat.read_back(chat.format_chats(df)).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in back} == {
        c: [(role, text) for _, role, text in ms] for c, ms in want.items()}
    for r in back:
        assert r.loss_text == "".join(t.text for t in r.turns if t.role == "assistant")
        masked = [r.formatted[s.start:s.end] for s in r.loss_spans]
        assert masked == [t.text for t in r.turns if t.role == "assistant"]
        assert [r.turns[s.turn].role for s in r.loss_spans] == ["assistant"] * len(masked)


@pytest.mark.parametrize("plan", ["op12_chat_formatting"])
def test_no_python_in_the_plan(spark, plan):
    text = QUERIES[plan](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", text)
