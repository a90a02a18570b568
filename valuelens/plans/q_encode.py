"""Driver queries for encoding, splitting, imputation, pruning, dedupe and set operations
(M1-M10, P20, A1, A2, U1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.operators import dedupe as dd
from valuelens.operators import features as fe
from valuelens.operators import split as sp
from valuelens.plans.q_profile import SPARSE_LINEITEM_SQL, sparse_lineitem
from valuelens.plans.registry import register, round_doubles, table


def _sql_hash(key: str, salt: str, buckets: int) -> str:
    return f"(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '{salt}'), 1, 8)) AS BIGINT) % {buckets})"


SPLIT_SQL = f"CASE WHEN {_sql_hash('o_orderkey', 'split', 100)} < 20 THEN 'test' WHEN {_sql_hash('o_orderkey', 'split', 100)} < 36 THEN 'val' ELSE 'train' END"


def _cust_nation(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return c.join(n, c.c_nationkey == n.n_nationkey)


CN_SQL = "cn AS (SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal, n_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey)"


@register(
    "frequency_encode",
    f"WITH {CN_SQL}, f AS (SELECT n_name, count(*) AS n_name_freq FROM cn WHERE n_name IS NOT NULL GROUP BY 1)\n"
    "SELECT c_custkey, n_name, n_name_freq FROM cn LEFT JOIN f USING (n_name)",
)
def frequency_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    cn = _cust_nation(spark, sf_dir).select("c_custkey", "n_name")
    return fe.transform_frequency(cn, "n_name", fe.fit_frequency(cn, "n_name"))


@register(
    "label_encode",
    """
WITH v AS (SELECT DISTINCT coalesce(CAST(c_mktsegment AS VARCHAR), 'nan') AS c_mktsegment FROM customer),
codes AS (SELECT c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS c_mktsegment_label_enc FROM v)
SELECT c_custkey, c.c_mktsegment, CAST(codes.c_mktsegment_label_enc AS INTEGER) AS c_mktsegment_label_enc
FROM customer c LEFT JOIN codes ON coalesce(CAST(c.c_mktsegment AS VARCHAR), 'nan') = codes.c_mktsegment""",
)
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    out = fe.transform_label_codes(c, "c_mktsegment", fe.fit_label_codes(c, "c_mktsegment"))
    return out.select("c_custkey", "c_mktsegment", F.col("c_mktsegment_label_enc").cast("int"))


def encoded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    base = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", F.col("c_nationkey").alias("cat"), F.log1p("o_totalprice").alias("y")
    )
    base = sp.hash_folds(sp.hash_split(base, "o_orderkey"), "o_orderkey")
    return base


@register(
    "target_encode_oof",
    f"""
WITH base AS (
  SELECT o_orderkey, c_nationkey AS cat, ln(1 + o_totalprice) AS y, {SPLIT_SQL} AS split,
         CAST({_sql_hash('o_orderkey', 'fold', 5)} AS INTEGER) AS fold
  FROM orders JOIN customer ON o_custkey = c_custkey),
tr AS (SELECT * FROM base WHERE split = 'train'),
cf AS (SELECT cat, fold, sum(y) AS s_cf, count(y) AS n_cf FROM tr WHERE cat IS NOT NULL GROUP BY 1, 2),
c AS (SELECT cat, sum(s_cf) AS s_c, sum(n_cf) AS n_c FROM cf GROUP BY 1),
oof AS (SELECT cf.cat, fold, (s_c - s_cf) / nullif(n_c - n_cf, 0) AS code FROM cf JOIN c USING (cat)),
om AS (SELECT avg(y) AS m FROM tr)
SELECT b.o_orderkey, b.split, b.fold,
  round(coalesce(CASE WHEN b.split = 'train' THEN oof.code ELSE c.s_c / c.n_c END, om.m), 6) AS cat_target_enc
FROM base b LEFT JOIN oof ON b.cat = oof.cat AND b.fold = oof.fold LEFT JOIN c ON b.cat = c.cat, om""",
)
def target_encode_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = encoded_orders(spark, sf_dir)
    oof, full, overall = fe.fit_target_codes(base.filter(F.col("split") == "train"), "cat", "y", "fold")
    out = fe.transform_target_by_split(base, "cat", "fold", "split", oof, full, overall)
    return round_doubles(out.select("o_orderkey", "split", "fold", "cat_target_enc"), 6)


@register("hash_split", f"SELECT o_orderkey, {SPLIT_SQL} AS split FROM orders")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@register("hash_folds", f"SELECT o_orderkey, CAST({_sql_hash('o_orderkey', 'fold', 5)} AS INTEGER) AS fold FROM orders")
def hash_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.hash_folds(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@register(
    "standardize_pop",
    """
WITH o AS (SELECT o_orderkey, coalesce(o_totalprice, 0) AS a, coalesce(CAST(nullif(o_custkey % 10, 0) AS DOUBLE), 0) AS b FROM orders)
SELECT o_orderkey, round((a - avg(a) OVER ()) / nullif(stddev_pop(a) OVER (), 0), 6) AS o_totalprice_z,
       round((b - avg(b) OVER ()) / nullif(stddev_pop(b) OVER (), 0), 6) AS k_z
FROM o""",
)
def standardize_pop(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.nullif(F.col("o_custkey") % 10, F.lit(0)).cast("double").alias("k")
    )
    z = fe.standardize_pop(o, ["o_totalprice", "k"])
    return round_doubles(z.select("o_orderkey", "o_totalprice_z", "k_z"), 6)


@register(
    "percentile_trim",
    """
WITH b AS (SELECT quantile_cont(o_totalprice, 0.01) AS lo, quantile_cont(o_totalprice, 0.99) AS hi FROM orders)
SELECT o_orderkey, o_totalprice FROM orders, b WHERE o_totalprice BETWEEN lo AND hi""",
)
def percentile_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return fe.percentile_trim(o, "o_totalprice", 0.01, 0.99)


_LOG_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@register(
    "auto_log_features",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, round(skewness({c}), 4) AS skew, CAST(coalesce(abs(skewness({c})) > 1.0, false) AS INTEGER) AS selected FROM lineitem"
        for c in _LOG_COLS
    ),
)
def auto_log_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*_LOG_COLS)
    return round_doubles(fe.fit_auto_log(li))


@register(
    "impute_median_mode",
    "WITH " + SPARSE_LINEITEM_SQL + """,
m AS (SELECT median(l_discount) AS md, median(l_tax) AS mt FROM sparse),
fr AS (SELECT l_returnflag AS v FROM sparse WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1),
fs AS (SELECT l_linestatus AS v FROM sparse WHERE l_linestatus IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1)
SELECT l_orderkey, l_linenumber, round(coalesce(l_discount, md), 4) AS l_discount, round(coalesce(l_tax, mt), 4) AS l_tax,
       coalesce(l_returnflag, (SELECT v FROM fr), 'Unknown') AS l_returnflag, coalesce(l_linestatus, (SELECT v FROM fs), 'Unknown') AS l_linestatus
FROM sparse, m""",
)
def impute_median_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sparse_lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    plan = fe.fit_impute(s, ["l_discount", "l_tax"], ["l_returnflag", "l_linestatus"])
    return round_doubles(fe.transform_impute(s, plan))


@register(
    "prune_sparse_columns",
    "WITH " + SPARSE_LINEITEM_SQL + """,
sp2 AS (SELECT *, CASE WHEN l_linenumber > 2 THEN NULL ELSE l_quantity END AS l_sparse_qty FROM sparse)
""" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, round((count(*) - count({c})) * 100.0 / count(*), 4) AS null_pct, "
        f"CAST((count(*) - count({c})) * 100.0 / count(*) > 50 AS INTEGER) AS dropped FROM sp2"
        for c in ["l_orderkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_sparse_qty"]
    ),
)
def prune_sparse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sparse_lineitem(spark, sf_dir).withColumn(
        "l_sparse_qty", F.when(F.col("l_linenumber") > 2, F.lit(None)).otherwise(F.col("l_quantity"))
    ).select("l_orderkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_sparse_qty")
    return round_doubles(fe.fit_prune_sparse(s, 50.0))


@register(
    "dedupe_keep_last",
    """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def dedupe_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return dd.dedupe_keep_last(ev, "user_id", ["ts", "event_id"])


@register(
    "dedupe_audit",
    """
SELECT 'dedupe_user' AS step, (SELECT count(*) FROM events) AS rows_in, count(*) AS rows_out,
       (SELECT count(*) FROM events) - count(*) AS removed, round(count(*) * 100.0 / (SELECT count(*) FROM events), 4) AS kept_pct
FROM (SELECT DISTINCT user_id FROM events)""",
)
def dedupe_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return round_doubles(dd.step_audit(ev, dd.dedupe_keep_last(ev, "user_id", ["ts", "event_id"]), "dedupe_user"))


@register(
    "union_by_name",
    """
SELECT 'customer' AS source, c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""",
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"),
    )
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"),
        F.col("s_nationkey").alias("nationkey"), F.lit("supplier").alias("source"),
    )
    return dd.union_by_name([c, s])
