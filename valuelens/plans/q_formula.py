"""Driver queries for what follows a model (M16, M17, M20 - M23), on predictions that a formula makes: the
operators are those of the trained models' queries, and SQL can say what they must give."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.operators import learn as ml
from valuelens.plans.q_encode import _sql_hash
from valuelens.plans.q_learn import LABEL, model_table
from valuelens.plans.registry import register, round_doubles

#: Stand-ins for trained models: log-scale predictions as expressions that Spark and DuckDB read alike.
FORMULAS = {
    "by_price": "ln(1 + l_quantity * p_retailprice)",
    "by_quantity": "ln(1 + l_quantity * 1400)",
    "net": "ln(1 + l_quantity * p_retailprice * (1 - l_discount))",
}

_KEY = "l_orderkey || '-' || l_linenumber"
_SPLIT = f"CASE WHEN {_sql_hash(_KEY, 'split', 100)} < 20 THEN 'test' WHEN {_sql_hash(_KEY, 'split', 100)} < 36 THEN 'val' ELSE 'train' END"
_ROWS = f"""
WITH j AS (SELECT {_KEY} AS row_key, {_SPLIT} AS split, c_nationkey, l_quantity, l_discount, p_retailprice, l_extendedprice, ln(1 + l_extendedprice) AS y
           FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
p AS (""" + "\nUNION ALL ".join(f"SELECT j.*, '{n}' AS model, {f} AS prediction, greatest(exp({f}) - 1, 0) AS value FROM j" for n, f in FORMULAS.items()) + ")"


class Formula:
    """A model that predicts by an expression."""

    def __init__(self, expression: str):
        self.expression = expression

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.expr(self.expression).cast("double"))


@register("metrics_by_formula", _ROWS + """,
r AS (SELECT model, split, 1 - sum((y - prediction) ** 2) / (var_pop(y) * count(*)) AS r2 FROM p GROUP BY model, split),
t AS (SELECT model, avg((l_extendedprice - (exp(prediction) - 1)) ** 2) AS mse, avg(abs(l_extendedprice - (exp(prediction) - 1))) AS mae,
        avg(CASE WHEN l_extendedprice > 0.1 THEN abs(l_extendedprice - (exp(prediction) - 1)) / abs(l_extendedprice) END) * 100 AS mape FROM p WHERE split = 'test' GROUP BY model),
w AS (SELECT model, max(r2) FILTER (split = 'train') AS train_r2, max(r2) FILTER (split = 'val') AS val_r2, max(r2) FILTER (split = 'test') AS test_r2 FROM r GROUP BY model)
SELECT model, round(train_r2, 4) AS train_r2, round(val_r2, 4) AS val_r2, round(test_r2, 4) AS test_r2, round(mse, 2) AS test_mse, round(sqrt(mse), 4) AS test_rmse,
       round(mae, 4) AS test_mae, round(mape, 4) AS test_mape, round(train_r2 - test_r2, 4) AS train_test_gap,
       CAST(row_number() OVER (ORDER BY test_r2 DESC, model) AS INTEGER) AS rank FROM w JOIN t USING (model)""")
def metrics_by_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M16 + M17: R^2 by split, errors on the original scale, and the ranking of three models."""
    data = model_table(spark, sf_dir)
    tables = [ml.model_metrics(n, {s: Formula(f).transform(data.filter(F.col("split") == s)) for s in ("train", "val", "test")}, LABEL, "l_extendedprice")
              for n, f in FORMULAS.items()]
    out = ml.best_model(reduce(DataFrame.unionByName, tables), "test_r2")
    return round_doubles(out.withColumn("test_mse", F.round("test_mse", 2)))


@register("ensemble_by_formula", _ROWS + """,
e AS (SELECT *, avg(value) OVER w AS m, min(value) OVER w AS lo, max(value) OVER w AS hi, stddev_pop(value) OVER w AS sd FROM p WHERE split = 'test' WINDOW w AS (PARTITION BY row_key))
SELECT row_key, model, round(value, 6) AS prediction, l_extendedprice, round(m, 6) AS ens_mean, round(lo, 6) AS ens_min, round(hi, 6) AS ens_max, round(sd, 2) AS ens_std,
       round(value - m, 6) AS diff_from_avg, round(value - l_extendedprice, 6) AS error, round(abs(value - l_extendedprice), 6) AS abs_error FROM e""")
def ensemble_by_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M20 + M22: predicted values of three models on the test split, with the ensemble's mean, range and spread."""
    test = model_table(spark, sf_dir).filter(F.col("split") == "test")
    parts = [ml.predict_value(Formula(f), test).select("row_key", F.lit(n).alias("model"), F.col("predicted_value").alias("prediction"), "l_extendedprice") for n, f in FORMULAS.items()]
    out = ml.ensemble(reduce(DataFrame.unionByName, parts), "row_key", "l_extendedprice").drop("diff_pct", "error_pct")
    # values come from exp(ln(x)), so they are rounded where no exact tie can fall
    return round_doubles(out.withColumn("ens_std", F.round("ens_std", 2)), 6)


@register("mispricing_by_formula", _ROWS + """,
r AS (SELECT c_nationkey, l_extendedprice - value AS d, (l_extendedprice - value) / nullif(value, 0) * 100 AS pct FROM p WHERE model = 'net')
SELECT c_nationkey, round(avg(d), 2) AS mean_residual, round(median(d), 2) AS median_residual, count(d) AS count, round(avg(pct), 2) AS mean_residual_pct
FROM r GROUP BY c_nationkey HAVING count(d) >= 10""")
def mispricing_by_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residuals of one model per nation."""
    scored = ml.predict_value(Formula(FORMULAS["net"]), model_table(spark, sf_dir))
    return ml.group_mispricing(scored, "c_nationkey", "l_extendedprice", "predicted_value", 10)


@register("score_summary_by_formula", _ROWS + """
SELECT round(avg(value), 2) AS mean, round(median(value), 2) AS median, round(max(value), 2) AS max, round(min(value), 2) AS min, count(value) AS n FROM p
WHERE model = 'by_price' AND split <> 'train'""")
def score_summary_by_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a scored batch."""
    scored = ml.predict_value(Formula(FORMULAS["by_price"]), model_table(spark, sf_dir).filter(F.col("split") != "train"))
    return round_doubles(ml.score_summary(scored), 2)
