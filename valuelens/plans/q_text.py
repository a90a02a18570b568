"""Driver queries for scalar parsing functions (F1-F8, W9) on strings built from the test tables.

The input strings are built by the same expressions on both sides, so the
check exercises only the parsing rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.functions import text as tx
from valuelens.plans.registry import register, round_doubles, table

SQL_STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"
SQL_CLEAN = r"TRY_CAST(regexp_replace(" + SQL_STRIP + r", '[,%]', '', 'g') AS DOUBLE)"


def sql_clean(x: str) -> str:
    return SQL_CLEAN.format(x=x)


def _lpad(col, n):
    return F.lpad(col.cast("string"), n, "0")


def number_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.concat(F.col("o_custkey").cast("string"), F.lit(","), _lpad(F.col("o_orderkey") % 1000, 3)).alias("s_thousands"),
        F.concat(F.lit(" "), (F.col("o_orderkey") % 97).cast("string"), F.lit(".5%")).alias("s_pct"),
        F.when(F.col("o_orderstatus") == "P", F.lit(""))
        .when(F.col("o_orderstatus") == "O", F.lit("n/a"))
        .otherwise(F.concat(F.lit("-"), F.col("o_custkey").cast("string"))).alias("s_mixed"),
    )


NUMBER_STRINGS_SQL = """
s AS (
  SELECT o_orderkey,
    concat(CAST(o_custkey AS VARCHAR), ',', lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')) AS s_thousands,
    concat(' ', CAST(o_orderkey % 97 AS VARCHAR), '.5%') AS s_pct,
    CASE o_orderstatus WHEN 'P' THEN '' WHEN 'O' THEN 'n/a' ELSE concat('-', CAST(o_custkey AS VARCHAR)) END AS s_mixed
  FROM orders)
"""


@register(
    "clean_number",
    "WITH " + NUMBER_STRINGS_SQL + f"""
SELECT o_orderkey, s_thousands, s_pct, s_mixed,
  {sql_clean('s_thousands')} AS n_thousands,
  {sql_clean('s_pct')} AS n_pct,
  {sql_clean('s_mixed')} AS n_mixed,
  TRY_CAST(trunc({sql_clean('s_pct')}) AS BIGINT) AS i_pct
FROM s
""",
)
def clean_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = number_strings(spark, sf_dir)
    return round_doubles(s.select(
        "o_orderkey", "s_thousands", "s_pct", "s_mixed",
        tx.clean_number("s_thousands").alias("n_thousands"),
        tx.clean_number("s_pct").alias("n_pct"),
        tx.clean_number("s_mixed").alias("n_mixed"),
        tx.clean_number("s_pct", allow_float=False).alias("i_pct"),
    ))


@register(
    "signed_number",
    f"""
WITH s AS (
  SELECT o_orderkey,
    concat(CASE o_orderstatus WHEN 'F' THEN '+' WHEN 'O' THEN '-' ELSE '' END,
           CAST(o_orderkey % 7 AS VARCHAR), '.', lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0')) AS s_signed
  FROM orders)
SELECT o_orderkey, s_signed,
  CASE WHEN starts_with(s_signed, '+') THEN {sql_clean('substr(s_signed, 2)')}
       WHEN starts_with(s_signed, '-') THEN -nullif({sql_clean('substr(s_signed, 2)')}, 0)
       ELSE {sql_clean('s_signed')} END AS value
FROM s
""",
)
def signed_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    sign = F.when(F.col("o_orderstatus") == "F", "+").when(F.col("o_orderstatus") == "O", "-").otherwise("")
    s = o.select(
        "o_orderkey",
        F.concat(sign, (F.col("o_orderkey") % 7).cast("string"), F.lit("."), _lpad(F.col("o_custkey") % 100, 2)).alias("s_signed"),
    )
    return round_doubles(s.withColumn("value", tx.signed_number("s_signed")))


@register(
    "parse_currency",
    r"""
WITH s AS (
  SELECT o_orderkey,
    CASE o_orderkey % 5
      WHEN 0 THEN concat('€', CAST(o_custkey AS VARCHAR), 'k')
      WHEN 1 THEN concat('€', CAST(o_custkey % 50 AS VARCHAR), ',', CAST(o_orderkey % 10 AS VARCHAR), 'm')
      WHEN 2 THEN concat('€', CAST(o_orderkey AS VARCHAR), '.000')
      WHEN 3 THEN '-'
      ELSE concat('€ ', CAST(o_custkey % 30 AS VARCHAR), '.', CAST(o_orderkey % 10 AS VARCHAR), 'M') END AS s_value
  FROM orders),
t AS (SELECT o_orderkey, s_value, lower(regexp_replace(replace(s_value, '€', ''), '^\s+|\s+$', '', 'g')) AS v FROM s)
SELECT o_orderkey, s_value,
  round(CASE WHEN v = '' THEN NULL
       WHEN ends_with(v, 'k') THEN TRY_CAST(replace(replace(left(v, length(v) - 1), '.', ''), ',', '.') AS DOUBLE) / 1000
       WHEN ends_with(v, 'm') THEN TRY_CAST(replace(left(v, length(v) - 1), ',', '.') AS DOUBLE)
       ELSE TRY_CAST(replace(replace(v, '.', ''), ',', '.') AS DOUBLE) / 1000000 END, 6) AS value_m
FROM t
""",
)
def parse_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    s = (
        F.when(k % 5 == 0, F.concat(F.lit("€"), c.cast("string"), F.lit("k")))
        .when(k % 5 == 1, F.concat(F.lit("€"), (c % 50).cast("string"), F.lit(","), (k % 10).cast("string"), F.lit("m")))
        .when(k % 5 == 2, F.concat(F.lit("€"), k.cast("string"), F.lit(".000")))
        .when(k % 5 == 3, F.lit("-"))
        .otherwise(F.concat(F.lit("€ "), (c % 30).cast("string"), F.lit("."), (k % 10).cast("string"), F.lit("M")))
    )
    out = o.select("o_orderkey", s.alias("s_value"))
    return out.withColumn("value_m", F.round(tx.parse_currency("s_value"), 6))


@register(
    "parse_height",
    r"""
WITH s AS (
  SELECT p_partkey,
    concat(CAST(1 + CAST(p_size > 25 AS INTEGER) AS VARCHAR), ',', lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0'), ' m') AS s_m,
    concat(CAST(150 + p_size AS VARCHAR), 'cm') AS s_cm
  FROM part)
SELECT p_partkey, s_m, s_cm,
  CAST(trunc(TRY_CAST(replace(regexp_extract(s_m, '([\d,]+)\s*m', 1), ',', '.') AS DOUBLE) * 100) AS INTEGER) AS height_from_m,
  TRY_CAST(regexp_replace(replace(s_cm, 'cm', ''), '^\s+|\s+$', '', 'g') AS DOUBLE) AS height_from_cm
FROM s
""",
)
def parse_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    s = p.select(
        "p_partkey",
        F.concat((1 + (F.col("p_size") > 25).cast("int")).cast("string"), F.lit(","),
                 _lpad(F.col("p_partkey") % 100, 2), F.lit(" m")).alias("s_m"),
        F.concat((150 + F.col("p_size")).cast("string"), F.lit("cm")).alias("s_cm"),
    )
    return s.select("*", tx.parse_height_m("s_m").alias("height_from_m"), tx.parse_height_cm("s_cm").alias("height_from_cm"))


AS_OF = "2025-03-01"


@register(
    "age_asof",
    f"""
SELECT o_orderkey,
  CAST(year(DATE '{AS_OF}') - year(o_orderdate)
       - CASE WHEN strftime(DATE '{AS_OF}', '%m%d') < strftime(o_orderdate, '%m%d') THEN 1 ELSE 0 END AS INTEGER) AS age
FROM orders
""",
)
def age_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", tx.age_asof("o_orderdate", AS_OF).alias("age"))


@register(
    "slug_id",
    r"""
WITH s AS (
  SELECT page_id, regexp_extract(html, '<h1>(.*?)</h1>', 1) AS name, regexp_extract(html, 'lang="([a-z]+)"', 1) AS nat
  FROM pages)
SELECT page_id,
  concat(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(name)), '[^\w\s-]', '', 'g'), '[-\s]+', '-', 'g'), '^-+|-+$', '', 'g'),
         '-', substr(md5(concat(name, ':', '', ':', nat)), 1, 6)) AS player_id
FROM s
""",
)
def slug_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    pg = table(spark, sf_dir, "pages")
    s = pg.select(
        "page_id",
        F.regexp_extract("html", r"<h1>(.*?)</h1>", 1).alias("name"),
        F.regexp_extract("html", r'lang="([a-z]+)"', 1).alias("nat"),
    )
    return s.select("page_id", tx.stable_id("name", None, "nat").alias("player_id"))


@register(
    "collision_suffix",
    """
WITH b AS (
  SELECT c_custkey, c_nationkey, lower(c_mktsegment) AS base_id,
         row_number() OVER (PARTITION BY c_nationkey, lower(c_mktsegment) ORDER BY c_custkey) - 1 AS k
  FROM customer)
SELECT c_custkey, c_nationkey, base_id, CASE WHEN k = 0 THEN base_id ELSE concat(base_id, '-', CAST(k AS VARCHAR)) END AS player_id
FROM b
""",
)
def collision_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from valuelens.operators.dedupe import collision_suffix as cs

    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.lower("c_mktsegment").alias("base_id"))
    return cs(c, "base_id", scope=["c_nationkey"], order=["c_custkey"], out="player_id")


@register(
    "first_valid_price",
    r"""
WITH s AS (
  SELECT o_custkey, o_orderdate, o_orderkey,
    CASE WHEN o_orderstatus = 'P' THEN '€-' WHEN o_orderpriority = '5-LOW' THEN 'n/a'
         ELSE concat('€', CAST(o_orderkey % 90 AS VARCHAR), ',', CAST(o_custkey % 10 AS VARCHAR), 'm') END AS cell
  FROM orders),
t AS (SELECT *, lower(regexp_replace(replace(cell, '€', ''), '^\s+|\s+$', '', 'g')) AS v FROM s WHERE contains(cell, '€')),
p AS (SELECT o_custkey, o_orderdate, o_orderkey,
        CASE WHEN v = '' THEN NULL
             WHEN ends_with(v, 'k') THEN TRY_CAST(replace(replace(left(v, length(v) - 1), '.', ''), ',', '.') AS DOUBLE) / 1000
             WHEN ends_with(v, 'm') THEN TRY_CAST(replace(left(v, length(v) - 1), ',', '.') AS DOUBLE)
             ELSE TRY_CAST(replace(replace(v, '.', ''), ',', '.') AS DOUBLE) / 1000000 END AS value_m FROM t)
SELECT o_custkey, arg_min(value_m, (o_orderdate, o_orderkey)) AS value_m FROM p WHERE value_m IS NOT NULL GROUP BY o_custkey""",
)
def first_valid_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer, the first cell (by date, key) holding a '€' amount that parses."""
    from valuelens.sources.html import first_valid_price as fvp

    o = table(spark, sf_dir, "orders")
    cell = (F.when(F.col("o_orderstatus") == "P", F.lit("€-")).when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a"))
            .otherwise(F.concat(F.lit("€"), (F.col("o_orderkey") % 90).cast("string"), F.lit(","),
                                (F.col("o_custkey") % 10).cast("string"), F.lit("m"))))
    cells = o.select("o_custkey", F.struct("o_orderdate", "o_orderkey").alias("pos"), cell.alias("cell"))
    return fvp(cells, "o_custkey", "pos", "cell")
