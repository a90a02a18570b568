"""Driver queries for join-shaped operators, facets and top/bottom unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.operators import dedupe as dd
from valuelens.operators import groupstats as gs
from valuelens.operators import joins as jn
from valuelens.plans.registry import register, round_doubles, table


@register(
    "lookup_default",
    """
SELECT c_custkey, coalesce(n.n_name, 'Unknown') AS n_name
FROM customer LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 0) n ON c_nationkey = n.n_nationkey""",
)
def lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") != 0)
    return jn.lookup_default(c, "c_nationkey", n, "n_nationkey", "n_name", "Unknown").select("c_custkey", "n_name")


@register(
    "overlay_join",
    """
SELECT c_custkey, coalesce(CASE WHEN s_acctbal >= 0 THEN s_acctbal END, c_acctbal) AS c_acctbal
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""",
)
def overlay_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("c_acctbal")
    )
    return jn.overlay(c, s, "c_custkey", ["c_acctbal"])


@register(
    "fallback_join",
    """
SELECT c_custkey, coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, s_acctbal) AS acctbal
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""",
)
def fallback_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acctbal"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), "s_acctbal")
    return jn.fallback(c, s, "c_custkey", "acctbal", "s_acctbal")


@register(
    "first_valid_match",
    """
WITH f AS (SELECT user_id, arg_min(value, (ts, event_id)) AS first_value FROM events
           WHERE event_type = 'purchase' AND value > 50 GROUP BY user_id)
SELECT c_custkey, first_value FROM customer LEFT JOIN f ON c_custkey = f.user_id""",
)
def first_valid_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    ev = table(spark, sf_dir, "events")
    valid = (F.col("event_type") == "purchase") & (F.col("value") > 50)
    return jn.enrich_first_valid(c, "c_custkey", ev, "user_id", ["ts", "event_id"], "value", valid)


@register(
    "semi_join_topk",
    """
WITH t AS (SELECT c_nationkey, avg(c_acctbal) AS m FROM customer GROUP BY 1 ORDER BY m DESC, c_nationkey LIMIT 5)
SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT c_nationkey FROM t)""",
)
def semi_join_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    top = gs.top_k(c.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("m")), "m", 5, ["c_nationkey"])
    return jn.semi_join(c.select("c_custkey", "c_nationkey"), top, "c_nationkey")


# Event label -> output field (unmatched labels are dropped).
EVENT_FIELDS = [("purchase", "purchase_value"), ("signup", "signup_value"), ("click", "click_value")]


@register(
    "label_to_wide",
    """
WITH m AS (SELECT * FROM (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in EVENT_FIELDS) + """) t(event_type, field)),
j AS (SELECT e.user_id, e.value, e.ts, e.event_id, m.field FROM events e JOIN m USING (event_type))
SELECT user_id, """ + ", ".join(
        f"arg_max(value, (ts, event_id)) FILTER (WHERE field = '{b}') AS {b}" for _, b in EVENT_FIELDS
    ) + " FROM j GROUP BY user_id",
)
def label_to_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "value", "ts", "event_id")
    mapping = spark.createDataFrame(EVENT_FIELDS, "event_type string, field string")
    return jn.label_to_wide(ev, "user_id", "event_type", "value", ["ts", "event_id"], mapping, [b for _, b in EVENT_FIELDS])


@register(
    "facet_values",
    """
SELECT DISTINCT n_name AS value FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name IS NOT NULL
UNION ALL SELECT 'All'""",
)
def facet_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return gs.facet_values(c.join(n, c.c_nationkey == n.n_nationkey), "n_name")


@register(
    "facet_options",
    """
WITH j AS (SELECT r_name, n_name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT 'r_name' AS facet, 0 AS ord, r_name AS value, count(*) AS n FROM j GROUP BY r_name
UNION ALL SELECT 'r_name', 0, 'All', count(*) FROM j
UNION ALL SELECT 'n_name', 1, n_name, count(*) FROM j WHERE r_name = 'EUROPE' GROUP BY n_name
UNION ALL SELECT 'n_name', 1, 'All', count(*) FROM j WHERE r_name = 'EUROPE'
UNION ALL SELECT 'c_mktsegment', 2, c_mktsegment, count(*) FROM j WHERE r_name = 'EUROPE' AND n_name = 'FRANCE' GROUP BY c_mktsegment
UNION ALL SELECT 'c_mktsegment', 2, 'All', count(*) FROM j WHERE r_name = 'EUROPE' AND n_name = 'FRANCE' HAVING count(*) > 0""",
)
def facet_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: regions, the nations of Europe, and the market segments of France, each with its customers."""
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return gs.facet_options(j, {"r_name": "EUROPE", "n_name": "FRANCE", "c_mktsegment": "All"})


@register(
    "facet_filter",
    """
SELECT c_custkey, n_name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'EUROPE' AND c_mktsegment = 'BUILDING'""",
)
def facet_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    facets = {"r_name": "EUROPE", "n_name": "All", "c_mktsegment": "BUILDING"}
    return gs.facet_filter(j, facets).select("c_custkey", "n_name", "c_mktsegment")


@register(
    "top_bottom_union",
    """
WITH m AS (SELECT n_name, avg(c_acctbal) AS mean_bal FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)
SELECT * FROM (SELECT n_name, round(mean_bal, 4) AS mean_bal, 'top' AS side FROM m ORDER BY mean_bal DESC, n_name LIMIT 3)
UNION ALL
SELECT * FROM (SELECT n_name, round(mean_bal, 4) AS mean_bal, 'bottom' AS side FROM m ORDER BY mean_bal ASC, n_name LIMIT 3)""",
)
def top_bottom_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    m = c.join(n, c.c_nationkey == n.n_nationkey).groupBy("n_name").agg(F.avg("c_acctbal").alias("mean_bal"))
    return round_doubles(dd.top_bottom_union(m, "mean_bal", 3, ["n_name"]))


@register(
    "parent_child_expand",
    """
SELECT r_name, n_name, c_custkey FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
)
def parent_child_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region -> nations -> customers, keeping children that have a report (a finished order)."""
    from valuelens.sources.html import expand_children

    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    reports = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    nations = expand_children(r, n, "r_regionkey", "n_regionkey", "n_nationkey")
    out = expand_children(nations, c, "n_nationkey", "c_nationkey", "c_custkey", has_report=reports)
    return out.select("r_name", "n_name", "c_custkey")
