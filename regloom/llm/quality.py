"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a column expression over the whole text, every rule a row of
``RULES`` (name, numerator, denominator, least percent, most percent); the
table compiles into boolean columns that are evaluated where the text lies,
without user functions and without a shuffle.

Nulls: a null text is empty, has no words and fails the base rule. A null
percentage bound leaves that side open; a rule over a zero denominator holds.
Repeated rows are judged alike; an empty table gives an empty table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text

SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30

# Frequent function words of the four languages of the table.
STOP_WORDS = (
    "the of and to in a is that for it was on are as with be by this from or an at have not but he you "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden "
    "de la que el en y a los del se las por un para con no una su al lo como más "
    "le les et des est du que dans qui sur au avec ce il sont elle un une pas pour").split()

#: As written in running text, at the start of a sentence, and in capitals.
STOP_FORMS = sorted({f for w in STOP_WORDS for f in (w, w.capitalize(), w.upper())})

#: name, numerator, denominator, least percent, most percent
RULES = (
    ("word_length", "word_chars", "n_words", 150, 1500),
    ("symbols", "n_symbols", "n_words", None, 10),
    ("stop_words", "n_stop_words", "n_words", 2, 90),
    ("duplicate_lines", "n_dup_lines", "n_lines", None, 40),
    ("repeated_words", "n_repeat_words", "n_words", None, MOST_REPEATED),
    ("line_length", "n_words", "n_lines", 150, None),
)


def compiled(rules=RULES) -> Column:
    """Names of the rules that a row of measures breaks (null: none)."""
    broken = []
    for name, top, bottom, least, most in rules:
        terms = []
        if least is not None:
            terms.append(F.col(top) * 100 < F.col(bottom) * least)
        if most is not None:
            terms.append(F.col(top) * 100 > F.col(bottom) * most)
        test = terms[0] if len(terms) == 1 else terms[0] | terms[1]
        broken.append(F.when(test & (F.col(bottom) > 0), F.lit(name)))
    return F.nullif(F.concat_ws(",", *broken), F.lit(""))


def _window_hashes() -> Column:
    """Hash of the ``WINDOW`` word hashes of ``_h`` from each place on."""
    places = F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int"))
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(WINDOW)]))
    return F.when(F.col("n_words") >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def _repeated(windows: Column) -> Column:
    """Words covered by windows found twice or more, from the array of window
    hashes by start. Sorting (hash, start) brings equal windows together in
    n log n; the starts of those, in order, cover the words."""
    runs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), runs)


def measures(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``df`` plus the measures of the whole text, all
    prefixed columns dropped. Each step is a projection; the text is split once."""
    kept = [F.col(f"`{c}`") for c in (df.columns if keep is None else keep)]
    body = df.select(F.struct(*kept).alias("_row"), whole_text(text).alias("_t"))
    split = body.select(
        "_row", (F.char_length("_t") - F.char_length(F.regexp_replace("_t", SYMBOL, "")))
        .cast("long").alias("n_symbols"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.filter(F.split(F.regexp_replace("_t", r"[\x09-\x0D]", " "), " "), lambda w: w != "").alias("_words"))
    hashed = split.select(
        "*", F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_words").cast("long").alias("n_words"), F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_words", lambda w: w.isin(*STOP_FORMS))).cast("long").alias("n_stop_words"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"))
    windows = hashed.select(
        "*", (F.col("n_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _window_hashes().alias("_wh")).drop("_words", "_lines", "_h")
    runs = windows.select("*", _repeated(F.col("_wh")).alias("_runs")).drop("_wh")

    def twin(x: Column, k: Column) -> Column:
        last = F.size("_runs") - 1
        return (((k > 0) & (F.col("_runs")[F.greatest(k - 1, F.lit(0))]["h"] == x["h"]))
                | ((k < last) & (F.col("_runs")[F.least(k + 1, last)]["h"] == x["h"])))

    starts = runs.select("*", F.sort_array(
        F.transform(F.filter("_runs", twin), lambda x: x["i"])).alias("_starts")).drop("_runs")
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "_starts", zero,
        lambda a, s: F.struct((a["n"] + s + WINDOW - F.greatest(s, a["end"])).alias("n"),
                              (s + WINDOW).alias("end")),
        lambda a: a["n"])
    return starts.select("*", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).drop("_starts")


def judged(df: DataFrame, text: str = "text", keep: list[str] | None = None, rules=RULES) -> DataFrame:
    """Struct ``_row`` of the kept columns, the measures, ``base_failed``,
    ``broken`` (rule names) and ``kept``."""
    m = measures(df, text, keep)
    base = ((F.col("n_words") < LEAST_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED))
    return (m.withColumn("base_failed", base).withColumn("broken", compiled(rules))
            .withColumn("kept", ~F.col("base_failed") & F.col("broken").isNull()))


def quality_table(df: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, n_stop_words, n_lines, broken) of every row."""
    return judged(df, keep=["doc_id"]).select(
        F.col("_row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "n_stop_words", "n_lines", "broken")


def keep_good(df: DataFrame) -> DataFrame:
    """The rows of ``df`` that the rules keep, with their own columns only.

    The partition number stands beside the verdict because a filter is not
    pushed below a projection that is not deterministic; pushed down, it would
    carry a copy of every measure's expression at every level."""
    return (judged(df).withColumn("_part", F.spark_partition_id())
            .where("kept AND _part >= 0").select("_row.*"))
