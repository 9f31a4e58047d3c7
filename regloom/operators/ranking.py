"""Exact positional operators without a single-partition window.

A global ``row_number() OVER (ORDER BY ...)`` or an exact ``percentile``
aggregate funnels a whole table (or a whole hot group) through one task.
Everything here instead:

1. range-partitions on ``(group keys, order keys)`` - a hot group is spread
   over many partitions by its order key;
2. numbers rows inside each sorted partition (``monotonically_increasing_id``
   carries the partition id in its upper 31 bits and the in-partition ordinal
   in the lower 33);
3. writes that numbered table once to the shared checkpoint folder as Parquet
   (range bounds are sampled per job, so the numbering must be pinned before
   it is used twice); every file holds exactly one partition id, so a later
   read of "the partitions that hold rank r" skips all other files by their
   row-group statistics;
4. builds a small ``(group, partition) -> offset`` table whose size is bounded
   by ``#groups x #partitions``, never by the row count.

A row's exact position inside its group is then ``offset + local ordinal``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import SMALL_ROWS, cut_lineage, materialize, partitions_for

_LOW33 = (1 << 33) - 1
#: Accuracy of the sketch that brackets a wanted rank: a bracket spans about 4 / 10,000 of its group's rows.
BRACKET_ACCURACY = 10_000
#: Rows of a bracket up to which one sort ranks them; wider ones are ranked by position.
WINDOW_ROWS = 200_000


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def indexed(df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (),
            num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns ``(rows, offsets)``.

    ``rows`` is ``df`` plus ``_pid`` and ``_loc`` (partition id, in-partition
    ordinal), checkpointed. ``offsets`` has ``by + [_pid, _off, _first, _cnt]``:
    rows of group ``g`` in partition ``pid`` occupy group positions
    ``_off .. _off + _cnt - 1`` and their ``_loc`` starts at ``_first``."""
    by = list(by)
    n = num_partitions or partitions_for(df)
    keys = _cols(by) + _cols(order)
    rows = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_mid"), 33).cast("int"))
        .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
        .drop("_mid")
    )
    rows = materialize(rows, "ranked")
    stats = rows.groupBy(*by, "_pid").agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_loc").alias("_first"))
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    # small (groups x partitions) but read several times below: compute it once
    return rows, cut_lineage(offsets)


def with_position(df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (),
                  name: str = "pos", num_partitions: int | None = None) -> DataFrame:
    """``df`` plus the exact 0-based position of each row in ``order`` within
    its ``by`` group (what ``row_number() - 1`` would give, ties broken by the
    order keys; make the order keys unique for a deterministic answer)."""
    grouped = bool(by)
    by = list(by) if grouped else ["_g"]
    src = df if grouped else df.withColumn("_g", F.lit(0))
    rows, offsets = indexed(src, order, by, num_partitions)
    joined = rows.join(offsets.select(*by, "_pid", "_off", "_first"), by + ["_pid"])
    out = joined.withColumn(
        name, F.col("_off") + F.col("_loc") - F.col("_first")
    ).drop("_pid", "_loc", "_off", "_first")
    return out if grouped else out.drop("_g")


def rows_at(df: DataFrame, order: Sequence[str | Column], positions: Sequence[int],
            num_partitions: int | None = None) -> DataFrame:
    """The rows at the given global 0-based positions of ``order`` (no groups),
    with a ``pos`` column. Only the partitions that hold a wanted position are
    scanned in the second pass; the result size is ``len(positions)``."""
    rows, offsets = indexed(df.withColumn("_g", F.lit(0)), order, ["_g"], num_partitions)
    wanted = F.array(*[F.lit(int(p)) for p in positions]) if positions else F.array().cast("array<bigint>")
    hit = offsets.where(
        F.exists(wanted, lambda p: (p >= F.col("_off")) & (p < F.col("_off") + F.col("_cnt"))))
    pids = sorted({r["_pid"] for r in hit.select("_pid").distinct().collect()})
    out = rows.where(F.col("_pid").isin(pids)).join(
        hit.select("_g", "_pid", "_off", "_first"), ["_g", "_pid"])
    out = out.withColumn("pos", F.col("_off") + F.col("_loc") - F.col("_first"))
    return out.where(F.array_contains(wanted, F.col("pos"))).drop(
        "_pid", "_loc", "_off", "_first", "_g")


def exact_quantiles(df: DataFrame, value: str | Column, probs: Sequence[float],
                    by: Sequence[str] = (), names: Sequence[str] | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (numpy/pandas ``linear``,
    DuckDB ``quantile_cont``) of ``value`` per ``by`` group, NULL/NaN skipped.

    One output row per group; one column per probability (``names`` or
    ``q_<p>``). A group whose values are all missing is absent unless it is
    re-joined by the caller."""
    names = list(names) if names else [f"q_{str(p).replace('.', '_')}" for p in probs]
    v = F.col(value) if isinstance(value, str) else value
    grouped = bool(by)
    out_keys = list(by)
    # one struct key: joins on it keep groups whose key fields are NULL;
    # a constant key replaces a cross join when there are no groups
    by = ["_grp"] if grouped else ["_g"]
    base = df.select((F.struct(*[F.col(b) for b in out_keys]) if grouped else F.lit(0)).alias(by[0]),
                     v.cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v"))
    key = by[0]
    out = _by_brackets(base, key, probs, num_partitions)
    if out is None:
        out = _by_index(base, key, probs, num_partitions)
    keys = [F.col(f"_grp.`{b}`").alias(b) for b in out_keys] if grouped else []
    return out.select(*keys, *[F.get("_q", F.lit(i)).alias(name) for i, name in enumerate(names)])


def _place(n: str, p: float) -> tuple[Column, Column, Column]:
    """Fractional position of a quantile, and the ranks below and above it."""
    h = (F.col(n) - 1) * F.lit(float(p))
    return h, F.floor(h), F.ceil(h)


def _by_brackets(base: DataFrame, key: str, probs: Sequence[float], parts: int | None) -> DataFrame | None:
    """(key, _q): the quantiles of each group from narrow value brackets.

    A sketch gives two values around each wanted rank; counting the rows below,
    at and between them proves that they hold it. A rank at either value is
    that value; otherwise only the rows strictly between are ranked. None when
    there are too many groups to send out or a bracket misses its rank."""
    half = 2.0 / BRACKET_ACCURACY
    cuts = [F.lit(x) for p in probs for x in (max(0.0, p - half), min(1.0, p + half))]
    sketch = materialize(base.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", F.array(*cuts), F.lit(BRACKET_ACCURACY)).alias("_c")), "brackets")
    if sketch.count() > SMALL_ROWS:
        return None
    v, ks = F.col("_v"), range(len(probs))
    low, high = [F.get("_c", F.lit(2 * k)) for k in ks], [F.get("_c", F.lit(2 * k + 1)) for k in ks]
    counts = []
    for k in ks:
        counts += [F.count(F.when(v < low[k], 1)).alias(f"_below{k}"),
                   F.count(F.when(v <= low[k], 1)).alias(f"_from{k}"),
                   F.count(F.when((v <= low[k]) | (v < high[k]), 1)).alias(f"_to{k}"),
                   F.count(F.when(v <= high[k], 1)).alias(f"_end{k}")]
    placed = materialize(sketch.join(
        base.join(F.broadcast(sketch), key).groupBy(key).agg(*counts), key), "brackets")

    def inside(k, r):
        return (r >= F.col(f"_from{k}")) & (r < F.col(f"_to{k}"))

    held, open_ = [], []
    for k, p in zip(ks, probs):
        _, r0, r1 = _place("_n", p)
        held.append((r0 >= F.col(f"_below{k}")) & (r1 < F.col(f"_end{k}")))
        open_.append(inside(k, r0) | inside(k, r1))
    widths = [F.when(o, F.col(f"_to{k}") - F.col(f"_from{k}")).otherwise(F.lit(0)) for k, o in zip(ks, open_)]
    state = placed.agg(F.min(F.forall(F.array(*held), lambda x: x)).alias("held"),
                       F.max(F.array_max(F.array(*widths))).alias("widest")).first()
    if state["held"] is False:
        return None
    marks = F.array(*[F.struct(
        F.lit(k).alias("k"), low[k].alias("low"), high[k].alias("high"), o.alias("open"),
        (_place("_n", p)[1] - F.col(f"_from{k}")).alias("a"),
        (_place("_n", p)[2] - F.col(f"_from{k}")).alias("b")) for k, p, o in zip(ks, probs, open_)])
    rows = (base.join(F.broadcast(placed.select(key, marks.alias("_marks"))), key)
            .select(key, "_v", F.explode(F.filter(
                "_marks", lambda m: m["open"] & (v > m["low"]) & (v < m["high"]))).alias("_m"))
            .select(key, "_v", F.col("_m.k").alias("_k"), "_m.a", "_m.b"))
    if (state["widest"] or 0) <= WINDOW_ROWS:
        ordered = Window.partitionBy(key, "_k").orderBy("_v")
        ranked = rows.withColumn("_at", F.row_number().over(ordered) - 1)
    else:
        ranked = with_position(rows.withColumn("_tb", F.monotonically_increasing_id()),
                               ["_v", "_tb"], [key, "_k"], "_at", parts)
    found = ranked.groupBy(key).agg(*[
        F.max(F.when((F.col("_k") == k) & (F.col("_at") == F.col(end)), v)).alias(f"_{end}{k}")
        for k in ks for end in ("a", "b")])
    out, cols = placed.join(found, key, "left"), []

    def value(k, r, end):
        return (F.when(r < F.col(f"_from{k}"), low[k]).when(r >= F.col(f"_to{k}"), high[k])
                .otherwise(F.col(f"_{end}{k}")))
    for k, p in zip(ks, probs):
        h, r0, r1 = _place("_n", p)
        first, last = value(k, r0, "a"), value(k, r1, "b")
        cols.append(first + (last - first) * (h - r0))
    return out.select(key, F.array(*cols).alias("_q"))


def _by_index(base: DataFrame, key: str, probs: Sequence[float], parts: int | None) -> DataFrame:
    """(key, _q): the quantiles of each group from the positions of all its rows."""
    by = [key]
    # tie-breaker: a value shared by a third of the rows must not land in one
    # range partition; equal values are interchangeable for a quantile
    base = base.withColumn("_tb", F.monotonically_increasing_id())
    rows, offsets = indexed(base, ["_v", "_tb"], by, parts)
    totals = offsets.groupBy(*by).agg(F.sum("_cnt").alias("_n"))
    # needed ranks per group: floor/ceil of (n-1)*p for every p
    needed = []
    for p in probs:
        h = (F.col("_n") - 1) * F.lit(float(p))
        needed += [F.floor(h), F.ceil(h)]
    targets = totals.select(*by, "_n", F.array_distinct(F.array(*needed)).alias("_want"))
    hit = offsets.join(targets, by)
    hit = hit.where(F.exists("_want", lambda r: (r >= F.col("_off")) & (r < F.col("_off") + F.col("_cnt"))))
    # the partitions holding a wanted rank: at most the partition count, so a
    # literal IN-list that the Parquet scan uses to skip every other file
    pids = sorted({r["_pid"] for r in hit.select("_pid").distinct().collect()})
    picked = rows.where(F.col("_pid").isin(pids)).join(
        hit.select(*by, "_pid", "_off", "_first", "_want"), by + ["_pid"])
    picked = picked.withColumn("_r", F.col("_off") + F.col("_loc") - F.col("_first")).where(
        F.array_contains(F.col("_want"), F.col("_r")))
    # at most 2*len(probs) rows per group reach this aggregate
    vals = picked.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("_r", "_v"))).alias("_m"))
    out = vals.join(totals, by)
    cols = []
    for p in probs:
        h, r0, r1 = _place("_n", p)
        lo, hi = F.element_at("_m", r0), F.element_at("_m", r1)
        cols.append(lo + (hi - lo) * (h - r0))
    return out.select(key, F.array(*cols).alias("_q"))
