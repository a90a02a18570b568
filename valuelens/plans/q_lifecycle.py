"""Driver queries for the value curve (C6): lineitem joined to part, key = p_size, value = l_extendedprice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from valuelens.operators import lifecycle as lc
from valuelens.plans.registry import register, round_doubles, table


def priced_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x part on the part key. The part side is a dimension: AQE
    broadcasts it only when its measured size is under the broadcast threshold,
    otherwise the join stays a sort-merge join."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_extendedprice", "l_returnflag")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type")
    return li.join(pt, li.l_partkey == pt.p_partkey)


_STATS_CTE = """
stats AS (
  SELECT p_size, avg(l_extendedprice) AS mean, median(l_extendedprice) AS median,
         stddev_samp(l_extendedprice) AS std, count(*) AS "count"
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY p_size),
win AS (
  SELECT *,
    (lag(mean) OVER o + mean + lead(mean) OVER o) / 3 AS mean_smooth,
    (lag(median) OVER o + median + lead(median) OVER o) / 3 AS median_smooth,
    std / mean * 100 AS cv,
    mean - lag(mean) OVER o AS value_change,
    (mean / lag(mean) OVER o - 1) * 100 AS value_change_pct
  FROM stats
  WINDOW o AS (ORDER BY p_size)),
curve AS (
  SELECT *, value_change_pct - lag(value_change_pct) OVER (ORDER BY p_size) AS acceleration FROM win)
"""


def _curve(spark, sf_dir, min_count=None):
    return lc.value_curve(priced_parts(spark, sf_dir), "p_size", "l_extendedprice", min_count=min_count)


@register(
    "lifecycle_curve",
    "WITH " + _STATS_CTE + """
SELECT p_size, round(mean, 4) AS mean, round(median, 4) AS median, round(std, 4) AS std, "count",
       round(mean_smooth, 4) AS mean_smooth, round(median_smooth, 4) AS median_smooth, round(cv, 4) AS cv,
       round(value_change, 4) AS value_change, round(value_change_pct, 4) AS value_change_pct,
       round(acceleration, 4) AS acceleration
FROM curve WHERE "count" >= 20
""",
)
def lifecycle_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(_curve(spark, sf_dir, min_count=20))


@register(
    "prime_key",
    "WITH " + _STATS_CTE + """
SELECT
  (SELECT p_size FROM stats ORDER BY mean DESC, p_size LIMIT 1) AS prime_by_mean,
  (SELECT p_size FROM stats ORDER BY median DESC, p_size LIMIT 1) AS prime_by_median,
  (SELECT p_size FROM stats WHERE "count" >= 20 ORDER BY mean DESC, p_size LIMIT 1) AS prime_reliable
""",
)
def prime_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lc.prime_key(_curve(spark, sf_dir), "p_size", min_count=20)


@register(
    "prime_key_by_group",
    """
WITH cells AS (
  SELECT p_type, p_size, avg(l_extendedprice) AS mean, count(*) AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type, p_size HAVING count(*) >= 10),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY mean DESC, p_size) AS rn FROM cells)
SELECT p_type, p_size AS prime_key, round(mean, 4) AS prime_value FROM ranked WHERE rn = 1
""",
)
def prime_key_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(lc.prime_key_by_group(priced_parts(spark, sf_dir), "p_type", "p_size", "l_extendedprice", 10))


@register(
    "decline_start",
    "WITH " + _STATS_CTE + """,
rel AS (
  SELECT p_size, value_change_pct,
         row_number() OVER (ORDER BY p_size) AS rn, count(*) OVER () AS n_rows,
         lead(value_change_pct) OVER (ORDER BY p_size) AS next_pct
  FROM curve WHERE "count" >= 20)
SELECT
  (SELECT min(p_size) FROM rel WHERE value_change_pct < 0 AND next_pct < 0 AND rn <= n_rows - 2) AS decline_start,
  (SELECT p_size FROM rel WHERE value_change_pct > 0 ORDER BY value_change_pct DESC, p_size LIMIT 1) AS max_growth_key,
  (SELECT round(max(value_change_pct), 4) FROM rel WHERE value_change_pct > 0) AS max_growth_pct,
  (SELECT p_size FROM rel WHERE value_change_pct < 0 ORDER BY value_change_pct, p_size LIMIT 1) AS max_decline_key,
  (SELECT round(min(value_change_pct), 4) FROM rel WHERE value_change_pct < 0) AS max_decline_pct
""",
)
def decline_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(lc.decline_start(_curve(spark, sf_dir, min_count=20), "p_size"))


@register(
    "stability_rank",
    "WITH " + _STATS_CTE + """,
rel AS (SELECT p_size, cv FROM curve WHERE "count" >= 30 AND cv IS NOT NULL)
SELECT
  (SELECT p_size FROM rel ORDER BY cv, p_size LIMIT 1) AS most_stable_key,
  (SELECT round(min(cv), 4) FROM rel) AS most_stable_cv,
  (SELECT p_size FROM rel ORDER BY cv DESC, p_size DESC LIMIT 1) AS most_volatile_key,
  (SELECT round(max(cv), 4) FROM rel) AS most_volatile_cv,
  (SELECT round(avg(cv), 4) FROM rel) AS mean_cv,
  (SELECT round(median(cv), 4) FROM rel) AS median_cv
""",
)
def stability_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(lc.stability_rank(_curve(spark, sf_dir), "p_size", min_count=30))


@register(
    "phase_roi",
    "WITH " + _STATS_CTE + """,
phased AS (
  SELECT mean, median, "count",
    CASE WHEN p_size > 0 AND p_size <= 21 THEN 'Developing (≤21)'
         WHEN p_size > 21 AND p_size <= 25 THEN 'Peak Entry (22-25)'
         WHEN p_size > 25 AND p_size <= 29 THEN 'Prime Peak (26-29)'
         WHEN p_size > 29 AND p_size <= 100 THEN 'Decline (30+)' END AS phase,
    CASE WHEN p_size > 0 AND p_size <= 21 THEN 0
         WHEN p_size > 21 AND p_size <= 25 THEN 1
         WHEN p_size > 25 AND p_size <= 29 THEN 2
         WHEN p_size > 29 AND p_size <= 100 THEN 3 END AS phase_ord
  FROM stats),
summ AS (
  SELECT phase, phase_ord, round(avg(mean), 2) AS avg_value FROM phased WHERE phase IS NOT NULL GROUP BY phase, phase_ord),
pairs AS (
  SELECT phase AS buy_phase, lead(phase) OVER (ORDER BY phase_ord) AS sell_phase,
         avg_value AS buy_value, lead(avg_value) OVER (ORDER BY phase_ord) AS sell_value FROM summ)
SELECT buy_phase, sell_phase, buy_value, sell_value, round((sell_value - buy_value) / buy_value * 100, 4) AS roi_pct
FROM pairs WHERE sell_phase IS NOT NULL
""",
)
def phase_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = lc.phase_summary(_curve(spark, sf_dir), "p_size")
    return round_doubles(lc.phase_roi(summary))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle_curve(spark, sf_dir)


@register(
    "top_keys",
    "WITH " + _STATS_CTE + """
SELECT p_size, round(mean, 4) AS mean, round(median, 4) AS median, "count" FROM stats ORDER BY mean DESC, p_size LIMIT 10""",
)
def top_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 on the curve: the 10 keys with the highest mean value."""
    from valuelens.operators.groupstats import top_k

    curve = _curve(spark, sf_dir).select("p_size", "mean", "median", "count")
    return round_doubles(top_k(curve, "mean", 10, ["p_size"]))


@register(
    "phase_summary",
    "WITH " + _STATS_CTE + """,
phased AS (
  SELECT mean, median, "count",
    CASE WHEN p_size > 0 AND p_size <= 21 THEN 'Developing (≤21)' WHEN p_size > 21 AND p_size <= 25 THEN 'Peak Entry (22-25)'
         WHEN p_size > 25 AND p_size <= 29 THEN 'Prime Peak (26-29)' WHEN p_size > 29 AND p_size <= 100 THEN 'Decline (30+)' END AS phase,
    CASE WHEN p_size > 0 AND p_size <= 21 THEN 0 WHEN p_size > 21 AND p_size <= 25 THEN 1
         WHEN p_size > 25 AND p_size <= 29 THEN 2 WHEN p_size > 29 AND p_size <= 100 THEN 3 END AS phase_ord
  FROM stats)
SELECT phase, phase_ord, round(avg(mean), 2) AS avg_value, round(avg(median), 2) AS median, CAST(sum("count") AS BIGINT) AS "count"
FROM phased WHERE phase IS NOT NULL GROUP BY phase, phase_ord""",
)
def phase_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F26 + A17: mean of key means / medians and total count per life-cycle phase."""
    return lc.phase_summary(_curve(spark, sf_dir), "p_size")


@register(
    "group_curve_smooth",
    """
WITH cells AS (
  SELECT p_type, p_size, avg(l_extendedprice) AS mean, count(*) AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type, p_size)
SELECT p_type, p_size, round(mean, 4) AS mean, n,
  round((lag(mean) OVER w + mean + lead(mean) OVER w) / 3, 4) AS mean_smooth
FROM cells WINDOW w AS (PARTITION BY p_type ORDER BY p_size)""",
)
def group_curve_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centred 3-row moving mean of the per-group curve (window partitioned by group)."""
    from pyspark.sql import functions as F

    cells = priced_parts(spark, sf_dir).groupBy("p_type", "p_size").agg(
        F.avg("l_extendedprice").alias("mean"), F.count(F.lit(1)).alias("n"))
    return round_doubles(cells.withColumn("mean_smooth", lc.centered_mean("mean", "p_size", ["p_type"])))
