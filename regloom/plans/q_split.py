"""Registered queries for the hash splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import split as S
from ..session import load
from .registry import register

_H = "md5(concat_ws(':', '{seed}', {keys}))"


def _h(keys: list[str], seed) -> str:
    return _H.format(seed=seed, keys=", ".join(f"CAST({k} AS STRING)" for k in keys))


@register("p1_holdout_split", f"""WITH r AS (
  SELECT o_orderkey, row_number() OVER (ORDER BY {_h(['o_orderkey'], 42)}, o_orderkey) - 1 AS pos,
         count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN pos < ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM r""")
def q_holdout(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey")
    return S.holdout(o, ["o_orderkey"], 0.2, 42)


@register("p2_kfold_assignment", f"""WITH r AS (
  SELECT o_orderkey, row_number() OVER (ORDER BY {_h(['o_orderkey'], 42)}, o_orderkey) - 1 AS pos,
         count(*) OVER () AS n FROM orders),
tr AS (SELECT o_orderkey FROM r WHERE pos >= ceil(0.2 * n))
SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY {_h(['o_orderkey'], 'kfold:42')}, o_orderkey) - 1 AS INTEGER) AS fold
FROM tr""")
def q_kfold(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey")
    train = S.holdout(o, ["o_orderkey"], 0.2, 42).where(F.col("split") == "train").drop("split")
    return S.kfold(train, ["o_orderkey"], 5, "kfold:42")


_LK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@register("p3_exact_subset", f"""WITH r AS (
  SELECT {", ".join(_LK)}, row_number() OVER (ORDER BY {_h(_LK, 42)}, {", ".join(_LK)}) AS rn FROM lineitem)
SELECT {", ".join(_LK)} FROM r WHERE rn <= 50000""")
def q_subset(spark, sf):
    li = load(spark, sf, "lineitem").select(*_LK)
    return S.exact_subset(li, _LK, 50000, 42)


@register("p5_bernoulli_subset", f"""SELECT event_id, event_type FROM events
WHERE CAST(('0x' || substr({_h(['event_id'], 'epoch:3')}, 1, 13)) AS UBIGINT) / 4503599627370496.0 < 0.1""")
def q_bernoulli(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "event_type")
    return S.bernoulli_subset(ev, ["event_id"], 0.1, "epoch:3")
