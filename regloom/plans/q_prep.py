"""Registered queries for cleaning, missing values, encoding, profiling and
the CSV/Parquet sources (C*, D*, N*, E*, S*).

The fixture that shapes a test table (text to parse, injected missing
values, duplicates) is one SQL text run by both Spark and DuckDB; the
operator under test then runs in Spark over the whole fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse as P
from ..operators import clean as C
from ..operators import encode as N
from ..operators import missing as D
from ..operators import profile as E
from ..session import load
from ..sources import io
from . import preprocess
from .registry import fixture, register, rounded


# ---------------------------------------------------------------------------
# used-car style text derived from part
# ---------------------------------------------------------------------------

CAR_SQL = """SELECT p_partkey AS id, p_brand AS brand, 'M' || CAST(p_partkey AS STRING) AS model,
  CAST(1990 + p_partkey % 30 AS INTEGER) AS model_year,
  CAST(p_size AS STRING) || ',' || lpad(CAST(p_partkey % 1000 AS STRING), 3, '0') || ' mi.' AS milage,
  CASE WHEN p_partkey % 9 = 0 THEN 'n/a'
       ELSE '$' || CAST(CAST(floor(p_retailprice / 1000) AS BIGINT) AS STRING) || ','
            || lpad(CAST(CAST(floor(p_retailprice) AS BIGINT) % 1000 AS STRING), 3, '0') END AS price,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE ' Yes ' END AS clean_title,
  CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'None reported'
       WHEN 2 THEN 'At least 1 accident or damage reported' ELSE 'Minor Damage' END AS accident,
  CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN 'Black / Tan' WHEN 2 THEN 'Ebony Charcoal'
       WHEN 3 THEN NULL WHEN 4 THEN 'Metallic GREY' ELSE 'Bronze Gold' END AS ext_col,
  CASE p_partkey % 3 WHEN 0 THEN 'Beige' WHEN 1 THEN upper(p_name) ELSE '-' END AS int_col,
  CASE p_partkey % 5
       WHEN 0 THEN CAST(p_size * 10 AS STRING) || '.0HP 3.5L V6 Cylinder Engine Gasoline Fuel'
       WHEN 1 THEN 'Electric Motor Electric Fuel System'
       WHEN 2 THEN CAST(p_size AS STRING) || '0HP ' || CAST(p_size % 5 + 1 AS STRING) || '.'
                   || CAST(p_size % 10 AS STRING) || ' Liter Gas/Electric Hybrid'
       WHEN 3 THEN NULL ELSE '2.0L I4 16V GDI DOHC Turbo' END AS engine,
  CASE p_partkey % 6 WHEN 0 THEN '6-Speed A/T' WHEN 1 THEN 'M/T' WHEN 2 THEN 'Transmission w/Dual Shift Mode'
       WHEN 3 THEN '-' WHEN 4 THEN NULL ELSE 'CVT Transmission' END AS transmission,
  p_retailprice AS `Unnamed: 0`
FROM part"""

_NUM = "'^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def _num_sql(s: str) -> str:
    return f"CASE WHEN regexp_matches(trim({s}), {_NUM}) THEN TRY_CAST(trim({s}) AS DOUBLE) END"


def _colour_sql(c: str) -> str:
    whens = " ".join(f"WHEN contains(lower(coalesce({c}, 'other')), '{k}') THEN '{v}'"
                     for k, v in P.COLOUR_KEYWORDS)
    return f"CASE {whens} ELSE 'other' END"


def _flag_sql(c: str, pattern: str, missing: str) -> str:
    return f"CAST(regexp_matches(lower(coalesce({c}, '{missing}')), '{pattern}') AS DOUBLE)"


CAR_ORACLE = f"""WITH car AS ({CAR_SQL.replace('`Unnamed: 0`', '"Unnamed: 0"')})
SELECT id, brand,
  {_num_sql("replace(replace(milage, 'mi.', ''), ',', '')")} AS milage,
  {_num_sql("replace(replace(price, '$', ''), ',', '')")} AS price,
  trim(coalesce(clean_title, 'No')) AS clean_title,
  {_colour_sql('ext_col')} AS ext_col,
  {_colour_sql('int_col')} AS int_col,
  {_flag_sql('accident', P.ACCIDENT_REPORTED, 'unknown')} AS accident_reported,
  {_flag_sql('accident', P.ACCIDENT_NONE, 'unknown')} AS accident_none,
  {_num_sql("nullif(regexp_extract(engine, '(\\d+\\.?\\d*)\\s*HP', 1), '')")} AS engine_hp,
  CASE WHEN contains(lower(engine), 'electric') THEN 0.0
       ELSE {_num_sql("nullif(regexp_extract(engine, '(\\d+\\.?\\d*)\\s*(?:L|Liter)', 1), '')")} END AS engine_liters,
  {_flag_sql('transmission', P.TRANS_AUTOMATIC, 'other')} AS trans_automatic,
  {_flag_sql('transmission', P.TRANS_MANUAL, 'other')} AS trans_manual,
  2026 - model_year AS car_age
FROM car"""


@register("c16_used_car_clean", CAR_ORACLE)
def q_used_car(spark, sf):
    return C.clean_used_car(fixture(spark, sf, CAR_SQL))


@register("c11_colour_map", f"""WITH car AS ({CAR_SQL.replace('`Unnamed: 0`', '"Unnamed: 0"')})
SELECT id, {_colour_sql('ext_col')} AS ext_colour, {_colour_sql('int_col')} AS int_colour FROM car""")
def q_colour(spark, sf):
    car = fixture(spark, sf, CAR_SQL)
    return car.select("id", P.simplify_colour("ext_col").alias("ext_colour"),
                      P.simplify_colour("int_col").alias("int_colour"))


FLIGHT_SQL = """SELECT o_orderkey AS `Unnamed: 0`, 'AI-' || CAST(o_custkey AS STRING) AS flight,
  o_orderpriority AS class, o_orderstatus AS stops,
  CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING) || ','
    || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS STRING), 3, '0') AS price
FROM orders"""


@register("c4_flight_clean", f"""WITH f AS ({FLIGHT_SQL.replace('`Unnamed: 0`', '"Unnamed: 0"')})
SELECT class, stops, {_num_sql("replace(price, ',', '')")} AS price FROM f""")
def q_flight(spark, sf):
    return C.clean_flight(fixture(spark, sf, FLIGHT_SQL))


RETAIL_SQL = """SELECT l_orderkey AS `Row ID`, 'CA-' || CAST(l_orderkey AS STRING) AS `Order ID`,
  'United States' AS Country, 'C' || CAST(l_suppkey AS STRING) AS `Customer Name`,
  'P' || CAST(l_partkey AS STRING) AS `Product Name`, l_returnflag AS Segment,
  l_extendedprice AS Sales, l_quantity AS Quantity, l_discount AS Discount,
  l_extendedprice * (0.2 - l_discount) AS Profit
FROM lineitem"""


@register("c1_c3_retail_drop", """SELECT l_returnflag AS "Segment", l_extendedprice AS "Sales",
  l_quantity AS "Quantity", l_discount AS "Discount",
  round(l_extendedprice * (0.2 - l_discount), 6) AS "Profit" FROM lineitem""")
def q_retail(spark, sf):
    from ..sources.catalog import RETAIL_DROP
    df = C.clean_retail(C.drop_if_present(fixture(spark, sf, RETAIL_SQL), RETAIL_DROP))
    return rounded(df)


@register("c5_obesity_drop", """SELECT c_custkey, c_acctbal AS "Weight" FROM customer""")
def q_obesity(spark, sf):
    df = load(spark, sf, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("NObeyesdad"), F.col("c_acctbal").alias("Weight"))
    return C.clean_obesity(df)


@register("e3_text_target_coerce", """SELECT o_orderkey,
  TRY_CAST(regexp_replace('$' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING), '[$,]', '', 'g') AS DOUBLE) AS price
FROM orders""")
def q_coerce(spark, sf):
    o = load(spark, sf, "orders")
    txt = F.concat(F.lit("$"), F.floor("o_totalprice").cast("bigint").cast("string"))
    return o.select("o_orderkey", P.regex_strip_to_number(txt).alias("price"))


# ---------------------------------------------------------------------------
# duplicates and missing values (D1-D7) on customer with injected NULLs
# ---------------------------------------------------------------------------

@register("d1_dedupe", """SELECT DISTINCT o_orderstatus, o_orderpriority,
  CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders""")
def q_dedupe(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderstatus", "o_orderpriority", F.year("o_orderdate").cast("int").alias("yr"))
    return D.dedupe(o)


MISS_SQL = """SELECT c_custkey, c_name,
  CASE WHEN c_custkey % 100 < 60 THEN NULL ELSE c_acctbal END AS sparse_bal,
  CASE WHEN c_custkey % 100 < 3 THEN NULL ELSE c_nationkey END AS nation,
  CASE WHEN c_custkey % 100 BETWEEN 10 AND 24 THEN NULL ELSE c_acctbal END AS bal,
  CASE WHEN c_custkey % 100 BETWEEN 30 AND 49 THEN NULL ELSE c_mktsegment END AS segment,
  c_acctbal AS target
FROM customer"""
MISS_DUP_SQL = f"{MISS_SQL} UNION ALL {MISS_SQL}"


@register("d2_missing_profile", f"""WITH t AS ({MISS_SQL}), c AS (SELECT count(*) AS n FROM t),
m AS (
  SELECT 'sparse_bal' AS "column", count(*) - count(sparse_bal) AS n_missing FROM t
  UNION ALL SELECT 'nation', count(*) - count(nation) FROM t
  UNION ALL SELECT 'bal', count(*) - count(bal) FROM t
  UNION ALL SELECT 'segment', count(*) - count(segment) FROM t)
SELECT "column", n_missing, round(n_missing / n, 6) AS pct FROM m, c WHERE n_missing > 0""")
def q_missing_profile(spark, sf):
    prof = D.missing_profile(fixture(spark, sf, MISS_SQL)).select("column", "n_missing", "pct")
    return rounded(prof)


MISS_ORACLE = f"""WITH t AS (SELECT DISTINCT * FROM ({MISS_DUP_SQL})),
med AS (SELECT median(bal) AS m FROM t),
md AS (SELECT segment AS s FROM t WHERE segment IS NOT NULL GROUP BY segment
         ORDER BY count(*) DESC, segment LIMIT 1)
SELECT c_custkey, c_name, nation, round(coalesce(bal, med.m), 6) AS bal,
       coalesce(segment, md.s) AS segment, round(target, 6) AS target
FROM t, med, md WHERE nation IS NOT NULL"""


@register("d7_missing_policy", MISS_ORACLE)
def q_missing_policy(spark, sf):
    t = D.dedupe(fixture(spark, sf, MISS_DUP_SQL))
    out, _ = D.handle_missing(t)
    return rounded(out)


# ---------------------------------------------------------------------------
# encoding and scaling
# ---------------------------------------------------------------------------

ENC_SQL = """SELECT c_custkey, c_name, c_mktsegment, 'n' || CAST(c_nationkey AS STRING) AS nation,
  c_acctbal FROM customer"""
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
NATIONS = sorted(f"n{i}" for i in range(25))


def _onehot_sql(col: str, levels: list[str]) -> str:
    return ", ".join(f"CAST(coalesce({col} = '{v}', false) AS DOUBLE) AS \"{col}_{v}\""
                     for v in levels[1:])


@register("n3_encode_onehot_label", f"""WITH t AS ({ENC_SQL})
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS DOUBLE) AS c_name, c_acctbal,
  {_onehot_sql('c_mktsegment', SEGMENTS)}, {_onehot_sql('nation', NATIONS)}
FROM t""")
def q_encode(spark, sf):
    out, _ = N.encode(fixture(spark, sf, ENC_SQL))
    return out


@register("n4_minmax_scale", """SELECT c_custkey,
  round((c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()), 6) AS c_acctbal,
  round((c_nationkey - min(c_nationkey) OVER ()) / (max(c_nationkey) OVER () - min(c_nationkey) OVER ()), 6) AS c_nationkey,
  0.0 AS one
FROM customer""")
def q_minmax(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey",
                                          F.lit(1.0).alias("one"))
    return rounded(N.minmax_scale(c, ["c_acctbal", "c_nationkey", "one"]))


@register("n5_standardise", """SELECT c_custkey,
  round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal,
  round((c_nationkey - avg(c_nationkey) OVER ()) / stddev_pop(c_nationkey) OVER (), 6) AS c_nationkey,
  0.0 AS one
FROM customer""")
def q_standardise(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey",
                                          F.lit(1.0).alias("one"))
    return rounded(N.standardise(c, N.standard_stats(c, ["c_acctbal", "c_nationkey", "one"])))


@register("n7_target_summary", """SELECT count(*) AS n_rows, round(min(o_totalprice), 6) AS min,
  round(max(o_totalprice), 6) AS max, round(avg(o_totalprice), 6) AS mean,
  round(stddev_pop(o_totalprice), 6) AS std FROM orders""")
def q_n7(spark, sf):
    return rounded(N.target_summary(load(spark, sf, "orders"), "o_totalprice"))


N6_ORACLE = f"""WITH t AS (SELECT DISTINCT * FROM ({MISS_DUP_SQL})),
med AS (SELECT median(bal) AS m FROM t),
md AS (SELECT segment AS s FROM t WHERE segment IS NOT NULL GROUP BY segment
         ORDER BY count(*) DESC, segment LIMIT 1),
f AS (SELECT c_custkey, c_name, nation, coalesce(bal, med.m) AS bal, coalesce(segment, md.s) AS segment,
             target FROM t, med, md WHERE nation IS NOT NULL),
e AS (SELECT CAST(c_custkey AS DOUBLE) AS c_custkey,
             CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS DOUBLE) AS c_name,
             CAST(nation AS DOUBLE) AS nation, bal, target,
             {_onehot_sql('segment', SEGMENTS)} FROM f)
SELECT {", ".join(f'round((("{c}") - min("{c}") OVER ()) / nullif(max("{c}") OVER () - min("{c}") OVER (), 0), 6) AS "{c}"'
                  for c in ["c_custkey", "c_name", "nation", "bal"] + [f"segment_{v}" for v in SEGMENTS[1:]])},
       round(target, 6) AS target
FROM e"""


@register("n6_full_preprocess", N6_ORACLE)
def q_n6(spark, sf):
    raw = fixture(spark, sf, MISS_DUP_SQL)
    prep = preprocess.prepare(raw, "target", persist=False)
    return rounded(prep.table)


# ---------------------------------------------------------------------------
# profile (E1, E2, E4, E6, E7)
# ---------------------------------------------------------------------------

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@register("e1_column_profile", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_missing, "
    f"count(DISTINCT {c}) AS n_distinct FROM lineitem"
    for i, c in enumerate(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                           "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                           "l_linestatus", "l_shipdate"])))
def q_profile(spark, sf):
    return E.column_profile(load(spark, sf, "lineitem")).drop("dtype")


@register("e2_describe", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, "
    f"round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, "
    f"round(max({c}), 6) AS max FROM lineitem" for c in LI_NUM))
def q_describe(spark, sf):
    return rounded(E.describe(load(spark, sf, "lineitem"), LI_NUM))


@register("e4_target_summary", """SELECT round(min(o_totalprice), 6) AS min, round(max(o_totalprice), 6) AS max,
  round(avg(o_totalprice), 6) AS mean, round(median(o_totalprice), 6) AS median,
  round(stddev_samp(o_totalprice), 6) AS std FROM orders""")
def q_target_summary(spark, sf):
    return rounded(E.target_summary(load(spark, sf, "orders"), "o_totalprice"))


def _corr_sql(cols: list[str], src: str) -> str:
    parts = []
    for a in cols:
        for b in cols:
            parts.append(
                f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(covar_pop({a}, {b}) / "
                f"nullif(stddev_pop({a}) * stddev_pop({b}), 0), 6) AS corr FROM {src}")
    return " UNION ALL ".join(parts)


CORR_SRC = """(SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber, 1.0 AS constant,
  l_quantity * 10 * (1 - l_discount) * (1 + l_tax) AS target FROM lineitem)"""
CORR_COLS = LI_NUM + ["constant", "target"]


@register("e6_correlation_matrix", _corr_sql(CORR_COLS, CORR_SRC))
def q_corr(spark, sf):
    df = fixture(spark, sf, CORR_SRC[1:-1])
    return rounded(E.correlation_long(df, CORR_COLS))


@register("e7_top_correlated", f"""WITH c AS ({_corr_sql(CORR_COLS, CORR_SRC)})
SELECT col_b AS feature, corr FROM c WHERE col_a = 'target' AND col_b <> 'target'
ORDER BY abs(corr) DESC NULLS LAST, feature LIMIT 10""")
def q_topcorr(spark, sf):
    df = fixture(spark, sf, CORR_SRC[1:-1])
    return rounded(E.top_correlated(df, "target", 10, CORR_COLS))


# ---------------------------------------------------------------------------
# sources and sinks (S1, S2, S5, S6, S8, S10) - round trips through storage
# ---------------------------------------------------------------------------

CSV_SQL = """SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  CASE WHEN c_custkey % 7 = 0 THEN 'NA' ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_custkey % 2 = 0 THEN 'True' ELSE 'False' END AS even
FROM customer"""


@register("s1_s2_csv_roundtrip", """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
  c_acctbal, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
  c_custkey % 2 = 0 AS even FROM customer""")
def q_csv(spark, sf):
    path = io.scratch_path(spark, "csv")
    io.write_csv(fixture(spark, sf, CSV_SQL), path)
    return io.read_csv(spark, path)


@register("s5_s6_processed_roundtrip", N6_ORACLE)
def q_processed(spark, sf):
    prep = preprocess.prepare(fixture(spark, sf, MISS_DUP_SQL), "target", persist=False)
    path = io.scratch_path(spark, "processed")
    io.write_processed(prep.table, "target", path)
    table, _ = io.read_processed(spark, path, "target")
    return rounded(table)
