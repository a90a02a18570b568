"""Driver queries for profiling (C3): A3-A6, A9, A11-A14, A41, F12, F13."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.operators import profile as pr
from valuelens.plans.registry import register, round_doubles, table


def sparse_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with NULLs introduced by the same expressions the SQL side uses."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"),
        F.nullif("l_linestatus", F.lit("O")).alias("l_linestatus"),
    )


SPARSE_LINEITEM_SQL = """
sparse AS (
  SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice,
         nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax,
         nullif(l_returnflag, 'R') AS l_returnflag, nullif(l_linestatus, 'O') AS l_linestatus
  FROM lineitem)
"""
SPARSE_COLS = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
NUM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(template: str, cols: list[str], **kw) -> str:
    return "\nUNION ALL\n".join(template.format(c=c, **kw) for c in cols)


@register("table_shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols, count(*) * 11 AS n_cells FROM lineitem")
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.shape(table(spark, sf_dir, "lineitem"))


@register(
    "null_profile",
    "WITH " + SPARSE_LINEITEM_SQL + "\n"
    + _union("SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
             "round((count(*) - count({c})) * 100.0 / count(*), 4) AS null_pct FROM sparse", SPARSE_COLS),
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(pr.null_profile(sparse_lineitem(spark, sf_dir)))


@register(
    "null_total",
    "WITH " + SPARSE_LINEITEM_SQL + """,
per AS (""" + _union("SELECT count(*) - count({c}) AS nulls, count(*) AS n FROM sparse", SPARSE_COLS) + """)
SELECT CAST(sum(nulls) AS BIGINT) AS null_cells, CAST(max(n) * 9 AS BIGINT) AS total_cells,
       round(sum(nulls) * 100.0 / (max(n) * 9), 4) AS null_pct FROM per
""",
)
def null_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(pr.null_total(sparse_lineitem(spark, sf_dir)))


_PROFILE_COLS = {"l_orderkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
                 "l_discount": "double", "l_returnflag": "string", "l_linestatus": "string"}


@register(
    "column_profile",
    "WITH " + SPARSE_LINEITEM_SQL + "\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls, "
        f"round((count(*) - count({c})) * 100.0 / count(*), 4) AS null_pct, count(DISTINCT {c}) AS n_distinct, "
        f"substr(CAST(min({c}) AS VARCHAR), 1, 30) AS sample FROM sparse"
        for c, t in _PROFILE_COLS.items()
    ),
)
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(pr.column_profile(sparse_lineitem(spark, sf_dir), list(_PROFILE_COLS)))


_CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@register(
    "constant_columns",
    _union("SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, "
           "CAST(count(DISTINCT {c}) = 1 AS INTEGER) AS is_constant FROM customer", _CUST_COLS),
)
def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.constant_columns(table(spark, sf_dir, "customer"))


@register(
    "value_counts_pct",
    """
SELECT event_type, count(*) AS "count", round(count(*) * 100.0 / (SELECT count(*) FROM events), 4) AS pct
FROM events WHERE event_type IS NOT NULL GROUP BY event_type
""",
)
def value_counts_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(pr.value_counts_pct(table(spark, sf_dir, "events"), "event_type"))


@register(
    "describe_numeric",
    _union(
        "SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        "round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, "
        "round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM lineitem",
        NUM_COLS,
    ),
)
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(pr.describe_numeric(table(spark, sf_dir, "lineitem"), NUM_COLS))


# population moments from central sums; DuckDB's skewness / kurtosis are the sample-adjusted G1 / G2
_MOMENTS_SQL = """
WITH m AS (SELECT {cols_mean} FROM lineitem),
per AS (""" + _union(
    "SELECT '{c}' AS column_name, count({c}) AS n, avg(power({c} - m.{c}_mean, 2)) AS m2, "
    "avg(power({c} - m.{c}_mean, 3)) AS m3, avg(power({c} - m.{c}_mean, 4)) AS m4, "
    "skewness({c}) AS g1s, kurtosis({c}) AS g2s FROM lineitem, m", NUM_COLS) + ")"


def _moments_prefix() -> str:
    return _MOMENTS_SQL.replace("{cols_mean}", ", ".join(f"avg({c}) AS {c}_mean" for c in NUM_COLS))


@register(
    "moments_population",
    _moments_prefix() + """
SELECT column_name, n, round(m3 / power(m2, 1.5), 4) AS skew_pop, round(m4 / power(m2, 2) - 3, 4) AS kurt_pop FROM per
""",
)
def moments_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = pr.moments(table(spark, sf_dir, "lineitem"), NUM_COLS)
    return round_doubles(m.select("column_name", "n", "skew_pop", "kurt_pop"))


@register(
    "moments_sample",
    _moments_prefix() + """
SELECT column_name, n, round(g1s, 4) AS skew, round(g2s, 4) AS kurt,
  CASE WHEN abs(g1s) > 2 THEN 'high' WHEN abs(g1s) > 0.5 THEN 'moderate' WHEN g1s IS NOT NULL THEN 'symmetric' END AS skew_band
FROM per
""",
)
def moments_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = pr.skew_bands(pr.moments(table(spark, sf_dir, "lineitem"), NUM_COLS))
    return round_doubles(m.select("column_name", "n", "skew", "kurt", "skew_band"))


@register(
    "quality_rules",
    "WITH r AS (\n"
    + _union("SELECT '{c}' AS column_name, 'range[0,100]' AS rule, count({c}) AS n_checked, "
             "CAST(count_if({c} < 0 OR {c} > 100) AS BIGINT) AS n_violations FROM lineitem", NUM_COLS)
    + "\nUNION ALL\nSELECT 'l_returnflag', 'in{A,N}', count(l_returnflag), CAST(count_if(l_returnflag NOT IN ('A', 'N')) AS BIGINT) FROM lineitem"
    + "\nUNION ALL\nSELECT 'l_linestatus', 'in{O,F}', count(l_linestatus), CAST(count_if(l_linestatus NOT IN ('O', 'F')) AS BIGINT) FROM lineitem"
    + ")\nSELECT *, CAST(n_violations = 0 AS INTEGER) AS passed FROM r",
)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    rules = pr.range_rules(li, NUM_COLS, 0, 100) + pr.set_rules(li, ["l_returnflag"], ["A", "N"]) + pr.set_rules(
        li, ["l_linestatus"], ["O", "F"]
    )
    return pr.quality_rules(li, rules)


@register(
    "text_number_detect",
    r"""
WITH t AS (
  SELECT event_type, props, CAST(event_id AS VARCHAR) AS id_text, regexp_extract(props, '\d+') AS props_k FROM events)
""" + "\n" + _union(
        "SELECT '{c}' AS column_name, count({c}) AS non_null, count(TRY_CAST(trim({c}) AS DOUBLE)) AS n_numeric, "
        "round(count(TRY_CAST(trim({c}) AS DOUBLE)) / count({c}), 4) AS numeric_rate, "
        "CAST(coalesce(count(TRY_CAST(trim({c}) AS DOUBLE)) / count({c}) > 0.9, false) AS INTEGER) AS is_numeric_text FROM t",
        ["event_type", "props", "id_text", "props_k"],
    ),
)
def text_number_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    t = ev.select(
        "event_type", "props", F.col("event_id").cast("string").alias("id_text"),
        F.regexp_extract("props", r"\d+", 0).alias("props_k"),
    )
    return round_doubles(pr.text_number_detect(t))


@register(
    "global_summary",
    """SELECT round(min(o_totalprice), 4) AS min, round(max(o_totalprice), 4) AS max, round(avg(o_totalprice), 4) AS mean,
       round(median(o_totalprice), 4) AS median, round(stddev_samp(o_totalprice), 4) AS std FROM orders""",
)
def global_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: min / max / mean / median / std of one column."""
    return round_doubles(pr.global_summary(table(spark, sf_dir, "orders"), "o_totalprice"))


@register(
    "null_bands",
    "WITH " + SPARSE_LINEITEM_SQL + ",\nnp AS (\n"
    + _union("SELECT '{c}' AS column_name, (count(*) - count({c})) * 100.0 / count(*) AS null_pct FROM sparse", SPARSE_COLS)
    + """)
SELECT column_name, round(null_pct, 4) AS null_pct,
  CASE WHEN null_pct > 80 THEN 'critical' WHEN null_pct > 50 THEN 'high' WHEN null_pct > 20 THEN 'moderate' ELSE 'low' END AS status
FROM np WHERE null_pct > 0""",
)
def null_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + P24: columns with missing values and a status band of their null %."""
    from valuelens.functions.segment import band

    p = pr.null_profile(sparse_lineitem(spark, sf_dir), min_pct=0.0)
    p = p.select("column_name", "null_pct", band("null_pct", [80, 50, 20], ["critical", "high", "moderate", "low"]).alias("status"))
    return round_doubles(p)


_STATS_ORDER = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]


@register(
    "describe_long",
    "WITH d AS (\n" + _union(
        "SELECT '{c}' AS column_name, CAST(count({c}) AS DOUBLE) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
        "min({c}) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, "
        "max({c}) AS max FROM lineitem", NUM_COLS)
    + ")\n" + "\nUNION ALL\n".join(
        f"SELECT column_name, '{s}' AS stat, round({s}, 4) AS value FROM d" for s in _STATS_ORDER),
)
def describe_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The describe table transposed to (column, stat, value)."""
    d = pr.describe_numeric(table(spark, sf_dir, "lineitem"), NUM_COLS).withColumn("count", F.col("count").cast("double"))
    long = d.unpivot(["column_name"], _STATS_ORDER, "stat", "value")
    return round_doubles(long)


@register(
    "preview",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem\n"
    "ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice LIMIT 5",
)
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First rows under an explicit order (head)."""
    li = table(spark, sf_dir, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return li.orderBy(*order).limit(5).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


_SKEW_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@register(
    "skew_report",
    "WITH b AS (\n" + _union(
        "SELECT '{c}' AS column_name, skewness({c}) AS skew FROM lineitem", _SKEW_COLS) + """),
c AS (SELECT *, CASE WHEN abs(skew) > 2 THEN 'high' WHEN abs(skew) > 0.5 THEN 'moderate' ELSE 'symmetric' END AS skew_band
      FROM b WHERE skew IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY skew_band ORDER BY abs(skew) DESC, column_name) AS band_rank FROM c)
SELECT column_name, round(skew, 4) AS skew, skew_band, band_rank FROM r
WHERE band_rank <= CASE skew_band WHEN 'high' THEN 10 WHEN 'moderate' THEN 10 ELSE 5 END""",
)
def skew_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skew bands with the most skewed columns of each band."""
    m = pr.moments(table(spark, sf_dir, "lineitem"), _SKEW_COLS)
    return round_doubles(pr.skew_report(m))
