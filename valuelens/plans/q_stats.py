"""Driver queries for statistics (A18-A36) on lineitem / part / orders."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuelens.operators import stats as st
from valuelens.plans.registry import register, round_doubles, table

FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_gross", "l_net"]
TARGET = "l_extendedprice"


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_quantity",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        "l_tax",
        F.col("l_linenumber").cast("double").alias("l_linenumber"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("l_gross"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("l_net"),
        "l_extendedprice",
    )


FEAT_SQL = """
feat AS (
  SELECT l_orderkey, l_quantity, nullif(l_discount, 0) AS l_discount, l_tax, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
         l_extendedprice * (1 + l_tax) AS l_gross, l_extendedprice * (1 - l_discount) AS l_net, l_extendedprice
  FROM lineitem)
"""


def sql_n(a: str, b: str) -> str:
    return f"CAST(count_if({a} IS NOT NULL AND {b} IS NOT NULL) AS BIGINT)"


def sql_corr(a: str, b: str) -> str:
    return (
        f"covar_samp({a}, {b}) / nullif(stddev_samp(CASE WHEN {b} IS NOT NULL THEN {a} END)"
        f" * stddev_samp(CASE WHEN {a} IS NOT NULL THEN {b} END), 0)"
    )


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


TARGET_SQL = "tc AS (\n" + _union(
    [f"SELECT '{c}' AS feature, {sql_n(c, TARGET)} AS n, {sql_corr(c, TARGET)} AS corr FROM feat" for c in FEATURES]
) + ")"


def _target_corr(spark, sf_dir):
    return st.target_correlations(features(spark, sf_dir), FEATURES, TARGET)


@register("corr_pair", f"WITH {FEAT_SQL} SELECT {sql_n('l_quantity', TARGET)} AS n, round({sql_corr('l_quantity', TARGET)}, 4) AS corr FROM feat")
def corr_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(st.corr_pair(features(spark, sf_dir), "l_quantity", TARGET))


_MATRIX_COLS = FEATURES + [TARGET]
MATRIX_SQL = "m AS (\n" + _union(
    [f"SELECT '{a}' AS col_1, '{b}' AS col_2, {sql_n(a, b)} AS n, {sql_corr(a, b)} AS corr FROM feat"
     for a, b in combinations(_MATRIX_COLS, 2)]
) + ")"


@register("corr_matrix_long", f"WITH {FEAT_SQL}, {MATRIX_SQL} SELECT col_1, col_2, n, round(corr, 4) AS corr FROM m")
def corr_matrix_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(st.corr_matrix_long(features(spark, sf_dir), _MATRIX_COLS))


@register(
    "corr_top",
    f"""WITH {FEAT_SQL}, {TARGET_SQL}
SELECT feature, n, round(corr, 4) AS corr, round(abs(corr), 4) AS abs_corr, round(corr * corr, 4) AS r2,
  CASE WHEN corr > 0 THEN 'positive' WHEN corr < 0 THEN 'negative' END AS direction,
  CASE WHEN abs(corr) >= 0.2 THEN 'strong' WHEN abs(corr) >= 0.1 THEN 'medium' ELSE 'weak' END AS strength,
  row_number() OVER (ORDER BY abs(corr) DESC NULLS LAST, feature) AS rank
FROM tc""",
)
def corr_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    tc = _target_corr(spark, sf_dir)
    w = Window.orderBy(F.col("abs_corr").desc_nulls_last(), F.col("feature"))
    return round_doubles(tc.withColumn("rank", F.row_number().over(w)))


_FEAT_MATRIX_SQL = "fm AS (\n" + _union(
    [f"SELECT '{a}' AS col_1, '{b}' AS col_2, {sql_n(a, b)} AS n, {sql_corr(a, b)} AS corr FROM feat"
     for a, b in combinations(FEATURES, 2)]
) + ")"


def _high_pairs(spark, sf_dir):
    return st.high_corr_pairs(st.corr_matrix_long(features(spark, sf_dir), FEATURES), 0.95)


@register("high_corr_pairs", f"WITH {FEAT_SQL}, {_FEAT_MATRIX_SQL} SELECT col_1, col_2, n, round(corr, 4) AS corr FROM fm WHERE abs(corr) > 0.95")
def high_corr_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(_high_pairs(spark, sf_dir))


@register(
    "redundant_drop_list",
    f"""WITH {FEAT_SQL}, {_FEAT_MATRIX_SQL}, {TARGET_SQL},
tcm AS (SELECT feature, CASE WHEN n > 30 THEN abs(corr) ELSE 0 END AS a, n > 30 AS ok FROM tc),
p AS (SELECT col_1, col_2 FROM fm WHERE abs(corr) > 0.95)
SELECT DISTINCT CASE WHEN coalesce(CASE WHEN t1.ok THEN t1.a ELSE 0 END, NULL) < coalesce(CASE WHEN t2.ok THEN t2.a ELSE 0 END, NULL)
                     THEN p.col_1 ELSE p.col_2 END AS feature
FROM p LEFT JOIN tcm t1 ON p.col_1 = t1.feature LEFT JOIN tcm t2 ON p.col_2 = t2.feature""",
)
def redundant_drop_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    tc = st.target_correlations(features(spark, sf_dir), FEATURES, TARGET, min_n=30)
    return st.redundant_drop_list(_high_pairs(spark, sf_dir), tc)


@register("low_corr_drop_list", f"WITH {FEAT_SQL}, {TARGET_SQL} SELECT feature, round(corr, 4) AS corr FROM tc WHERE abs(corr) < 0.03")
def low_corr_drop_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(st.low_corr_drop_list(_target_corr(spark, sf_dir), 0.03))


@register("select_features", f"WITH {FEAT_SQL}, {TARGET_SQL} SELECT feature, round(corr, 4) AS corr FROM tc WHERE coalesce(abs(corr), 0) > 0.05")
def select_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(st.select_features(_target_corr(spark, sf_dir), 0.05))


@register(
    "derived_column_check",
    f"""WITH j AS (SELECT l_extendedprice, l_quantity * p_retailprice AS recomputed, l_tax, l_discount
              FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT 'l_extendedprice' AS column_name, {sql_n('l_extendedprice', 'recomputed')} AS n,
       round({sql_corr('l_extendedprice', 'recomputed')}, 4) AS corr, 0.95 AS threshold,
       CAST(coalesce({sql_corr('l_extendedprice', 'recomputed')} > 0.95 AND {sql_n('l_extendedprice', 'recomputed')} > 10, false) AS INTEGER) AS is_derived
FROM j
UNION ALL
SELECT 'l_tax', {sql_n('l_tax', 'l_discount')}, round({sql_corr('l_tax', 'l_discount')}, 4), 0.99,
       CAST(coalesce({sql_corr('l_tax', 'l_discount')} > 0.99 AND {sql_n('l_tax', 'l_discount')} > 10, false) AS INTEGER)
FROM j""",
)
def derived_column_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_extendedprice", "l_quantity", "l_tax", "l_discount")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    j = li.join(pt, li.l_partkey == pt.p_partkey)
    checks = [
        ("l_extendedprice", F.col("l_quantity") * F.col("p_retailprice"), 0.95),
        ("l_tax", F.col("l_discount"), 0.99),
    ]
    return round_doubles(st.derived_column_check(j, checks))


def _vif_sql() -> str:
    cols = ["l_quantity", "l_discount", "l_tax"]
    sums = ", ".join(f"sum({a} * {b}) AS g{i}{j}" for i, a in enumerate(cols) for j, b in enumerate(cols) if j >= i)
    # cofactor of the diagonal over the determinant (symmetric 3 x 3)
    det = "(g00 * (g11 * g22 - g12 * g12) - g01 * (g01 * g22 - g12 * g02) + g02 * (g01 * g12 - g11 * g02))"
    return f"""
WITH c AS (SELECT l_quantity, l_discount, l_tax FROM lineitem WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL AND l_tax IS NOT NULL),
g AS (SELECT {sums} FROM c),
v AS (
  SELECT 'l_quantity' AS column_name, g00 * (g11 * g22 - g12 * g12) / {det} AS vif FROM g
  UNION ALL SELECT 'l_discount', g11 * (g00 * g22 - g02 * g02) / {det} FROM g
  UNION ALL SELECT 'l_tax', g22 * (g00 * g11 - g01 * g01) / {det} FROM g)
SELECT column_name, round(vif, 4) AS vif,
  CASE WHEN vif > 100 THEN 'severe' WHEN vif > 50 THEN 'high' WHEN vif > 10 THEN 'moderate' ELSE 'ok' END AS band
FROM v"""


@register("vif", _vif_sql())
def vif(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return round_doubles(st.vif(li, ["l_quantity", "l_discount", "l_tax"]))


@register(
    "corr_significance",
    f"""WITH {FEAT_SQL}, {TARGET_SQL}
SELECT feature, n, round(corr, 4) AS corr, round(corr * sqrt((n - 2) / (1 - corr * corr)), 4) AS t_stat FROM tc""",
)
def corr_significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(st.corr_significance(features(spark, sf_dir), FEATURES, TARGET, with_p=False))


@register("corr_pvalues")
def corr_pvalues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A27 with p-values (incomplete beta in an Arrow UDF over the k summary rows): rows-only check."""
    return round_doubles(st.corr_significance(features(spark, sf_dir), FEATURES, TARGET, with_p=True), 6)


@register(
    "anova_groups",
    """
WITH g AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS mean, var_pop(o_totalprice) * count(*) AS ss
           FROM orders WHERE o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL GROUP BY o_orderpriority),
t AS (SELECT count(*) AS k, sum(n) AS n_total, sum(n * mean) / sum(n) AS grand, sum(ss) AS ssw FROM g),
s AS (SELECT max(k) AS k, max(n_total) AS n_total, max(ssw) AS ssw, sum(n * (mean - grand) * (mean - grand)) AS ssb FROM g, t)
SELECT CAST(k - 1 AS BIGINT) AS df_between, CAST(n_total - k AS BIGINT) AS df_within,
       round((ssb / (k - 1)) / (ssw / (n_total - k)), 4) AS f_stat, round(ssb / (ssb + ssw), 6) AS eta_sq
FROM s""",
)
def anova_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = st.anova_oneway(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", with_p=False)
    a = a.select(
        F.col("df_between").cast("bigint").alias("df_between"), F.col("df_within").cast("bigint").alias("df_within"),
        F.round(F.col("f_stat") * 1e4) / 1e4, (F.round(F.col("ssb") / (F.col("ssb") + F.col("ssw")) * 1e6) / 1e6).alias("eta_sq"),
    )
    return a.withColumnRenamed(a.columns[2], "f_stat")


@register("anova_pvalue")
def anova_pvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A28 with p-value and decision: rows-only check (p from the F distribution)."""
    return round_doubles(st.anova_oneway(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice"), 6)


@register(
    "linear_fit_residual",
    """
WITH c AS (SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity,
       round(intercept + slope * l_quantity, 4) AS fitted, round(l_extendedprice - (intercept + slope * l_quantity), 4) AS residual
FROM lineitem, c""",
)
def linear_fit_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return round_doubles(st.linear_residuals(li, "l_extendedprice", "l_quantity", keep=["l_orderkey", "l_linenumber"]))


def _quad_ctes() -> str:
    """CTEs d, s, q: power sums and the Cramer's-rule solution (c0, c1, c2, n)."""
    a = [["s0", "s1", "s2"], ["s1", "s2", "s3"], ["s2", "s3", "s4"]]
    t = ["t0", "t1", "t2"]

    def det(m):
        return (f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]})"
                f" - {m[0][1]} * ({m[1][0]} * {m[2][2]} - {m[1][2]} * {m[2][0]})"
                f" + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))")

    def repl(k):
        return [[t[r] if cc == k else a[r][cc] for cc in range(3)] for r in range(3)]

    return f"""d AS (SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem
       WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
s AS (SELECT CAST(count(*) AS DOUBLE) AS s0, sum(x) AS s1, sum(power(x, 2)) AS s2, sum(power(x, 3)) AS s3, sum(power(x, 4)) AS s4,
             sum(y) AS t0, sum(x * y) AS t1, sum(power(x, 2) * y) AS t2 FROM d),
q AS (SELECT {det(repl(0))} / {det(a)} AS c0, {det(repl(1))} / {det(a)} AS c1, {det(repl(2))} / {det(a)} AS c2,
             CAST(s0 AS BIGINT) AS n FROM s)"""


@register("quadratic_fit", f"WITH {_quad_ctes()} SELECT round(c0, 4) AS c0, round(c1, 4) AS c1, round(c2, 4) AS c2, n FROM q")
def quadratic_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(st.quadratic_fit(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity"))


@register(
    "fit_grid",
    f"""WITH {_quad_ctes()},
l AS (SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept,
             CAST(min(l_quantity) AS DOUBLE) AS lo, CAST(max(l_quantity) AS DOUBLE) AS hi FROM lineitem),
g AS (SELECT CAST(r.i AS INTEGER) AS i, lo + r.i * (hi - lo) / 99 AS x, slope, intercept, c0, c1, c2 FROM range(100) r(i), l, q)
SELECT i, round(x, 4) AS x, round(intercept + slope * x, 4) AS y_linear, round(c0 + c1 * x + c2 * x * x, 4) AS y_quadratic FROM g""",
)
def fit_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(st.fit_grid(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity", 100))


@register(
    "regression_metrics",
    """
WITH j AS (SELECT l_extendedprice AS y, l_quantity * p_retailprice AS yhat FROM lineitem JOIN part ON l_partkey = p_partkey),
m AS (SELECT count(*) AS n, sum((y - yhat) * (y - yhat)) AS sse, var_pop(y) * count(*) AS sst, avg(abs(y - yhat)) AS mae,
             avg(CASE WHEN y > 0.1 THEN abs(y - yhat) / abs(y) END) * 100 AS mape FROM j WHERE y IS NOT NULL AND yhat IS NOT NULL)
SELECT n, round(1 - sse / sst, 4) AS r2, round(sse / n, 4) AS mse, round(sqrt(sse / n), 4) AS rmse, round(mae, 4) AS mae, round(mape, 4) AS mape FROM m""",
)
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_extendedprice").alias("y"), "l_quantity")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    j = li.join(pt, li.l_partkey == pt.p_partkey).select("y", (F.col("l_quantity") * F.col("p_retailprice")).alias("yhat"))
    return round_doubles(st.regression_metrics(j, "y", "yhat"))


def _hist_sql(expr: str, name: str) -> str:
    return f"""
SELECT '{name}' AS series, b.bucket, round(lo + (b.bucket - 1) * (hi - lo) / 50, 4) AS bin_lo, round(lo + b.bucket * (hi - lo) / 50, 4) AS bin_hi,
       coalesce(c.cnt, 0) AS count
FROM (SELECT min(v) AS lo, max(v) AS hi FROM (SELECT {expr} AS v FROM orders) WHERE v IS NOT NULL) r
CROSS JOIN (SELECT CAST(i AS INTEGER) AS bucket FROM range(1, 51) t(i)) b
LEFT JOIN (
  SELECT CAST(coalesce(least(floor((v - lo) / nullif(hi - lo, 0) * 50) + 1, 50), 1) AS INTEGER) AS bucket, count(*) AS cnt
  FROM (SELECT {expr} AS v FROM orders) d, (SELECT min({expr}) AS lo, max({expr}) AS hi FROM orders) rr
  WHERE v IS NOT NULL GROUP BY 1) c ON c.bucket = b.bucket"""


@register("histogram_50", _hist_sql("o_totalprice", "raw") + "\nUNION ALL\n" + _hist_sql("ln(1 + o_totalprice)", "log1p"))
def histogram_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    raw = st.histogram(o, "o_totalprice", 50, "raw")
    logged = st.histogram(o, F.log1p("o_totalprice"), 50, "log1p")
    return round_doubles(raw.unionByName(logged))


@register(
    "boxplot_summary",
    """
WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders WHERE o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL GROUP BY 1)
SELECT o.o_orderpriority, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr, count(*) AS n,
  round(min(CASE WHEN o_totalprice >= q1 - 1.5 * (q3 - q1) THEN o_totalprice END), 4) AS whisker_lo,
  round(max(CASE WHEN o_totalprice <= q3 + 1.5 * (q3 - q1) THEN o_totalprice END), 4) AS whisker_hi,
  CAST(count_if(o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers
FROM orders o JOIN q ON o.o_orderpriority = q.o_orderpriority
WHERE o_totalprice IS NOT NULL
GROUP BY o.o_orderpriority, q1, median, q3""",
)
def boxplot_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(st.boxplot_summary(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice"))


@register(
    "sign_counts",
    f"""WITH {FEAT_SQL}, {TARGET_SQL}
SELECT CAST(count_if(corr > 0.2) AS BIGINT) AS n_positive, CAST(count_if(corr < -0.2) AS BIGINT) AS n_negative FROM tc""",
)
def sign_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of features with r > 0.2 and with r < -0.2."""
    from valuelens.operators.themes import sign_counts as sc

    return sc(_target_corr(spark, sf_dir))


@register(
    "value_by_segment",
    """
WITH s AS (
  SELECT o_custkey, count(*) AS appearances, CAST(sum(floor(o_totalprice / 1000)) AS BIGINT) AS minutes_played,
         avg(o_totalprice) / 100000 AS market_value FROM orders GROUP BY o_custkey),
c AS (SELECT regr_slope(market_value, appearances) AS b, regr_intercept(market_value, appearances) AS a FROM s),
r AS (SELECT market_value - (a + b * appearances) AS residual, market_value,
        CASE WHEN minutes_played / 10 > 0 AND minutes_played / 10 <= 900 THEN 'Low (<900 min)'
             WHEN minutes_played / 10 > 900 AND minutes_played / 10 <= 2000 THEN 'Medium (900-2000 min)'
             WHEN minutes_played / 10 > 2000 THEN 'High (>2000 min)' END AS minutes_band FROM s, c),
g AS (SELECT minutes_band, count(*) AS n, avg(market_value) AS mean_value, avg(residual) AS mean_residual FROM r GROUP BY 1),
d AS (SELECT 'Low (<900 min)' AS minutes_band UNION ALL SELECT 'Medium (900-2000 min)' UNION ALL SELECT 'High (>2000 min)')
SELECT d.minutes_band, coalesce(g.n, 0) AS n, round(g.mean_value, 4) AS mean_value, round(g.mean_residual, 4) AS mean_residual
FROM d LEFT JOIN g USING (minutes_band)""",
)
def value_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M24 (+ A29, F26, A40): value and value net of a linear control per playing-time band, all bands listed."""
    from valuelens.functions.segment import right_closed_bins
    from valuelens.operators.groupstats import domain_complete
    from valuelens.plans.q_segment import MINUTE_EDGES, MINUTE_LABELS

    o = table(spark, sf_dir, "orders")
    s = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("appearances"), F.sum(F.floor(F.col("o_totalprice") / 1000)).cast("bigint").alias("minutes_played"),
        (F.avg("o_totalprice") / 100000).alias("market_value"))
    r = st.linear_residuals(s.withColumn("appearances", F.col("appearances").cast("double")), "market_value", "appearances",
                            keep=["minutes_played"])
    r = r.withColumn("minutes_band", right_closed_bins(F.col("minutes_played") / 10, MINUTE_EDGES, MINUTE_LABELS))
    g = r.groupBy("minutes_band").agg(F.count(F.lit(1)).alias("n"), F.avg("market_value").alias("mean_value"),
                                      F.avg("residual").alias("mean_residual"))
    labels = spark.createDataFrame([(lab,) for lab in MINUTE_LABELS], "minutes_band string")
    return round_doubles(domain_complete(labels, "minutes_band", g, {"n": 0}))
