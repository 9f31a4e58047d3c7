"""Chat formatting from an event log, in DataFrame operations only.

A log holds, for each conversation, events in the order of their sequence
numbers: a ``delta`` appends a piece to a message, an ``edit`` replaces what the
message holds, a ``regenerate`` empties it and withdraws the messages that were
opened after it until then, since they followed a text that is gone. A message
stands where its first event stands. The fold takes the events of one message
in chunks of ``CHUNK`` sequence numbers (each chunk gives the text after its
last replacement) and then the chunks of the message, so a message that is
streamed in very many pieces is added up before its pieces meet.

The final messages are rendered by a template that marks each turn and escapes
its control strings inside texts by a backslash after their first character
(and one more where backslashes stand there already), which ``read_back``
undoes. The loss mask is a list of (turn, start, end): code points of the
formatted text, from 0, that hold the texts of the trained roles.

A conversation's formatted text is one value, so its rendered turns meet in one
row at the end; up to there a hot conversation is spread by message.

Nulls and other cases: a null conv_id is a conversation of its own; a null seq
comes first; a null role or text is empty; a kind that is neither ``edit`` nor
``regenerate``, null too, is a delta. Events that agree in every column are one
event delivered twice. Events that share a sequence number follow by part,
kind, role and text, messages that share their place by their name. In a table
of finished rows, which is replayed as a log, rows of the same turn follow by
role and a hash of their text, and repeated rows are turns of their own. An
empty log has no conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Opening and closing strings of the turns of each role; any other role's turn names it.
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": ("<s> ", " </s>")}
OTHER = ("[TURN]", "[/TURN] ", " [/TURN]")
#: A control string is one of the first characters and one of these endings.
_HEAD, _TAIL = r"([<\[])", r"(/?(?:s>|INST\]|SYS\]|TURN\]))"
TURN = (r"(?s)\[INST\] .*? \[/INST\]|\[SYS\] .*? \[/SYS\]|<s> .*? </s>"
        r"|\[TURN\].*?\[/TURN\] .*? \[/TURN\]")
LOSS_ROLES = ("assistant",)
#: Sequence numbers, and parts of one number, of a message that are folded in one row first.
CHUNK = 4096
#: Code points of a delta when finished rows are replayed as a log.
DELTA = 512


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _HEAD + r"(\\*)" + _TAIL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _HEAD + r"(\\*)\\" + _TAIL, r"$1$2$3")


def replay(rows: DataFrame) -> DataFrame:
    """The log that a table of finished turns (conv_id, turn, role, text) would
    have left: each text streamed as deltas under its turn's number."""
    whole = rows.select("conv_id", F.col("turn").cast("long").alias("seq"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    counted = whole.groupBy(*whole.columns).agg(F.count(F.lit(1)).alias("copies"))
    each = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    message = F.concat_ws("|", "role", F.md5(F.col("text").cast("binary")), F.col("copy").cast("string"),
                          F.coalesce(F.col("seq").cast("string"), F.lit("null")))
    pieces = F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA}}}"), F.lit(0)))
    return each.select("conv_id", "seq", F.lit("delta").alias("kind"), message.alias("message"), "role",
                       F.posexplode(pieces).alias("part", "text"))


def _after(items: Column, replaces, text) -> Column:
    """Joined texts of a sorted array from its last replacing item on."""
    last = F.array_max(F.transform(items, lambda x, i: F.when(replaces(x), i)))
    rest = F.slice(items, F.coalesce(last, F.lit(0)) + 1, F.size(items))
    return F.array_join(F.transform(rest, text), "")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, opened, message, role, text): the final messages of a log with
    columns conv_id, seq (long), part (int), kind, message, role, text."""
    kind = F.lower(F.coalesce("kind", F.lit("delta")))
    event = F.struct(F.col("seq"), F.col("part"), kind.alias("kind"), F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    chunks = (events.select("conv_id", "message", F.floor(F.col("seq") / CHUNK).alias("a"),
                            F.floor(F.col("part") / CHUNK).alias("b"), event.alias("e"))
              .groupBy("conv_id", "message", "a", "b").agg(F.sort_array(F.collect_set("e")).alias("es")))

    def replaced(e):
        return e["kind"].isin("edit", "regenerate")
    again = F.array_max(F.transform("es", lambda e: F.when(
        e["kind"] == "regenerate", F.struct(e["seq"].alias("seq"), e["part"].alias("part")))))
    first = F.element_at("es", 1)
    chunk = F.struct(F.struct(first["seq"].alias("seq"), first["part"].alias("part")).alias("opened"),
                     first["role"].alias("role"), F.exists("es", replaced).alias("replaced"),
                     _after(F.col("es"), replaced, lambda e: e["text"]).alias("text"), again.alias("again"))
    messages = (chunks.select("conv_id", "message", chunk.alias("c"))
                .groupBy("conv_id", "message").agg(F.sort_array(F.collect_list("c")).alias("cs")))
    whole = messages.select(
        "conv_id", "message", F.element_at("cs", 1)["opened"].alias("opened"),
        F.element_at("cs", 1)["role"].alias("role"),
        _after(F.col("cs"), lambda c: c["replaced"], lambda c: c["text"]).alias("text"),
        F.array_max(F.transform("cs", lambda c: c["again"])).alias("again"))
    before = (Window.partitionBy("conv_id").orderBy("opened", "message")
              .rowsBetween(Window.unboundedPreceding, -1))
    withdrawn = F.coalesce(F.max("again").over(before) > F.col("opened"), F.lit(False))
    return (whole.withColumn("_gone", withdrawn).where(~F.col("_gone"))
            .select("conv_id", "opened", "message", "role", "text"))


def _opening(role: Column) -> Column:
    mark = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]))
    for name, (start, _) in MARKS.items():
        mark = F.when(role == name, F.lit(start)).otherwise(mark)
    return mark


def _closing(role: Column) -> Column:
    mark = F.lit(OTHER[2])
    for name, (_, end) in MARKS.items():
        mark = F.when(role == name, F.lit(end)).otherwise(mark)
    return mark


def render(messages: DataFrame, loss_roles=LOSS_ROLES) -> DataFrame:
    """(conv_id, formatted, loss_spans) of each conversation of :func:`fold`'s messages."""
    role = F.col("role")
    turns = messages.select("conv_id", "opened", "message", role.isin(*loss_roles).alias("trained"),
                            _opening(role).alias("start"), escape(F.col("text")).alias("body"),
                            _closing(role).alias("end"))
    turns = turns.select("conv_id", "opened", "message", "trained", F.char_length("start").cast("long").alias("lead"),
                         F.char_length("body").cast("long").alias("size"),
                         F.concat("start", "body", "end").alias("turn"))
    order = Window.partitionBy("conv_id").orderBy("opened", "message")
    placed = turns.withColumn("at", F.coalesce(F.sum(F.char_length("turn").cast("long")).over(
        order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    placed = placed.withColumn("nth", F.row_number().over(order) - 1)
    low = F.col("at") + F.col("lead")
    span = F.when(F.col("trained"), F.struct(F.col("nth").alias("turn"), low.alias("start"),
                                             (low + F.col("size")).alias("end")))
    rows = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("nth", "turn"))).alias("turns"),
                                         F.sort_array(F.collect_list(span)).alias("loss_spans"))
    return rows.select("conv_id", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
                       "loss_spans")


def format_chats(events: DataFrame, loss_roles=LOSS_ROLES) -> DataFrame:
    """(conv_id, formatted, loss_spans) of each conversation of an event log."""
    return render(fold(events), loss_roles)


def _parsed(turn: Column) -> Column:
    """Role and text of one rendered turn."""
    name = F.regexp_extract(turn, r"(?s)\A\[TURN\](.*?)\[/TURN\] ", 1)
    role, lead, tail = unescape(name), F.char_length(name) + sum(map(len, OTHER[:2])), F.lit(len(OTHER[2]))
    for known, (start, end) in MARKS.items():
        here = turn.startswith(start)
        role = F.when(here, F.lit(known)).otherwise(role)
        lead = F.when(here, F.lit(len(start))).otherwise(lead)
        tail = F.when(here, F.lit(len(end))).otherwise(tail)
    body = F.substr(turn, lead + 1, F.char_length(turn) - lead - tail)
    return F.struct(role.alias("role"), unescape(body).alias("text"), lead.alias("lead"))


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with ``turns``, the (role, text) that the formatted text holds,
    and ``loss_text``, all text under the mask, both without escapes."""
    cut = chats.withColumn("_cut", F.regexp_extract_all("formatted", F.lit(TURN), F.lit(0)))
    cut = cut.withColumn("_turns", F.transform("_cut", _parsed))

    def masked(span):
        lead = F.get("_turns", span["turn"])["lead"]
        return F.substr(F.get("_cut", span["turn"]), lead + 1, (span["end"] - span["start"]).cast("int"))
    return (cut.withColumn("turns", F.transform("_turns", lambda t: F.struct(
                t["role"].alias("role"), t["text"].alias("text"))))
            .withColumn("loss_text", F.array_join(F.transform(
                "loss_spans", lambda s: unescape(masked(s))), ""))
            .drop("_cut", "_turns"))


def chat_table(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)
    of every conversation and of conversation -1, read back from the formatted
    texts. Rows of the table that have the id -1 belong to that conversation."""
    control = "</s>[INST] ok [/INST]"
    kind = dict(conversations.dtypes)["conv_id"]
    extra = conversations.sparkSession.range(2).select(
        F.lit(-1).cast(kind).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(control).alias("text"))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").union(extra)
    back = read_back(format_chats(replay(rows)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
