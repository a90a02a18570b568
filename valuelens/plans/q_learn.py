"""Driver queries for model training, validation and scoring (M11-M24): rows-only checks.

The model table joins lineitem, part, orders and customer (whole tables); the
label is log1p(extended price); split and folds are md5-hash columns. The
query-level model sizes (trees / depth / iterations) are set for the check
runs; the library defaults carry the reference's values.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from valuelens.operators import learn as ml
from valuelens.operators import split as sp
from valuelens.plans.registry import register, round_doubles, table
from valuelens.session import settled

FEATURES = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice", "o_totalprice", "c_acctbal"]
LABEL = "label"
RF_QUERY = dict(numTrees=20, maxDepth=8, minInstancesPerNode=5, minWeightFractionPerNode=0.0)
GBT_QUERY = dict(maxIter=20, maxDepth=5)

_MODELS: dict = {}


def model_table(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Model rows; ``lineitem`` may be a stream (stream-static joins to the dimension tables)."""
    li = (lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_returnflag")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    j = (li.join(pt, li.l_partkey == pt.p_partkey).join(od, li.l_orderkey == od.o_orderkey)
         .join(cu, od.o_custkey == cu.c_custkey))
    j = j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_key"), *FEATURES, "c_nationkey", "l_returnflag",
        "l_extendedprice", F.log1p("l_extendedprice").alias(LABEL),
    )
    return sp.hash_folds(sp.hash_split(j, "row_key"), "row_key")


def _models(spark: SparkSession, sf_dir: str, names: list[str], data: DataFrame | None = None) -> dict:
    """The named models, fitted if they are not yet on the training rows of ``data`` (the model table, if not given)."""
    keys = {n: (spark.sparkContext.applicationId, sf_dir, n) for n in names}
    missing = [n for n in names if keys[n] not in _MODELS]
    if missing:
        train = (data if data is not None else model_table(spark, sf_dir)).filter(F.col("split") == "train")
        # the tree learner scans its input several times (metadata, split candidates, one pass per
        # level): keep the joined training rows, for all models, instead of recomputing the 4-way join each time
        cached = ml.training_input(train, [*FEATURES, LABEL])
        for name in missing:
            if name == "rf":
                pipe = ml.random_forest(FEATURES, LABEL, **RF_QUERY)
            elif name == "gbt_x":
                pipe = ml.gbt_x(FEATURES, LABEL, **GBT_QUERY)
            else:
                pipe = ml.gbt_l(FEATURES, LABEL, **GBT_QUERY)
            _MODELS[keys[name]] = pipe.fit(cached)
        cached.unpersist()
    return {n: _MODELS[k] for n, k in keys.items()}


def _fitted(spark: SparkSession, sf_dir: str, name: str, data: DataFrame | None = None):
    return _models(spark, sf_dir, [name], data)[name]


def _joined(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """These columns of the model table with features, label and split, joined once and kept on disk for a query that scans it for
    several models or splits."""
    return settled(model_table(spark, sf_dir).select(*cols, *FEATURES, LABEL, "split"))


def _test_scores(spark, sf_dir, name, data: DataFrame | None = None):
    test = (data if data is not None else model_table(spark, sf_dir)).filter(F.col("split") == "test")
    return ml.predict_value(_fitted(spark, sf_dir, name, data), test)


@register("rf_scores")
def rf_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 + M20: random forest predictions on the hash test split."""
    s = _test_scores(spark, sf_dir, "rf")
    return round_doubles(s.select("row_key", LABEL, "prediction", "l_extendedprice", "predicted_value"))


@register("gbt_scores")
def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 + M13: both boosted variants on the test split."""
    data = _joined(spark, sf_dir, "row_key")
    _models(spark, sf_dir, ["gbt_x", "gbt_l"], data)
    a = _test_scores(spark, sf_dir, "gbt_x", data).select("row_key", F.lit("gbt_x").alias("model"), "prediction", "predicted_value")
    b = _test_scores(spark, sf_dir, "gbt_l", data).select("row_key", F.lit("gbt_l").alias("model"), "prediction", "predicted_value")
    return round_doubles(a.unionByName(b))


@register("cv_scores")
def cv_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-fold R^2 of the forest on the training split (hash folds), with mean / std / stability."""
    train = ml.training_input(model_table(spark, sf_dir).filter(F.col("split") == "train"), [*FEATURES, LABEL, "fold"])
    folds = ml.cv_fold_scores(ml.random_forest(FEATURES, LABEL, **{**RF_QUERY, "numTrees": 10}), train, LABEL, "fold", 5)
    train.unpersist()
    return round_doubles(folds.crossJoin(ml.cv_summary(folds)), 6)


@register("grid_best")
def grid_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validated grid over depth and trees on the training split; ranked grid table."""
    train = ml.training_input(model_table(spark, sf_dir).filter(F.col("split") == "train"), [*FEATURES, LABEL, "fold"])
    _, tbl = ml.grid_search(ml.random_forest(FEATURES, LABEL, **{**RF_QUERY, "numTrees": 10}),
                            {"maxDepth": [4, 8], "numTrees": [5, 10]}, train, LABEL, "fold", parallelism=2)
    train.unpersist()
    return round_doubles(tbl, 6)


@register("model_comparison")
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M16 + M17: train / val / test R^2 (log scale), test MSE / RMSE / MAE / MAPE (original scale), ranked."""
    data = _joined(spark, sf_dir, "l_extendedprice")
    models = _models(spark, sf_dir, ["rf", "gbt_x", "gbt_l"], data)
    parts = {s: data.filter(F.col("split") == s) for s in ["train", "val", "test"]}
    tables = []
    for name, m in models.items():
        scored = {s: m.transform(df) for s, df in parts.items()}
        tables.append(ml.model_metrics(name, scored, LABEL, "l_extendedprice"))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return round_doubles(ml.best_model(out, "test_r2"), 6)


@register("ensemble_rows")
def ensemble_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per test row, the three models' predictions with ensemble mean / min / max / std and errors."""
    data = _joined(spark, sf_dir, "row_key", "l_extendedprice")
    _models(spark, sf_dir, ["rf", "gbt_x", "gbt_l"], data)
    parts = [
        _test_scores(spark, sf_dir, n, data).select("row_key", F.lit(n).alias("model"), F.col("predicted_value").alias("prediction"), "l_extendedprice")
        for n in ["rf", "gbt_x", "gbt_l"]
    ]
    long = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return round_doubles(ml.ensemble(long, "row_key", "l_extendedprice"))


@register("group_mispricing")
def group_mispricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model without the group column -> residual per row -> per nation mean / median / count / mean %."""
    data = _joined(spark, sf_dir, "c_nationkey", "l_extendedprice")
    s = ml.predict_value(_fitted(spark, sf_dir, "rf", data), data, log_target=True)
    return ml.group_mispricing(s, "c_nationkey", "l_extendedprice", "predicted_value", 10)


@register("score_batch")
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch scoring with a 2-decimal prediction and the batch summary."""
    data = model_table(spark, sf_dir).filter(F.col("split") != "train")
    s = ml.predict_value(_fitted(spark, sf_dir, "rf"), data).withColumn("predicted_value", F.round("predicted_value", 2))
    return round_doubles(ml.score_summary(s))


@register("feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance of each input feature in the fitted forest, ranked."""
    return round_doubles(ml.feature_importance(_fitted(spark, sf_dir, "rf"), FEATURES, spark), 6)


@register("boosted_scores")
def boosted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 + M13: both boosted variants of ``operators.boost`` (leaf cap, L1 / L2, row and column sampling per tree), trained on
    all training rows with the reference's settings, scored on the test split."""
    from valuelens.operators import boost

    data = _joined(spark, sf_dir, "row_key")
    train, test = data.filter(F.col("split") == "train").select(*FEATURES, LABEL), data.filter(F.col("split") == "test")

    def one(variant: tuple[str, dict]) -> DataFrame:
        model = boost.fit(train, FEATURES, LABEL, **variant[1])
        return model.transform(test.select("row_key", *FEATURES)).select("row_key", F.lit(variant[0]).alias("model"), "prediction")

    with ThreadPoolExecutor(ml.side_by_side(train, 2)) as pool:
        out = list(pool.map(inheritable_thread_target(spark)(one), [("depth", boost.DEPTH_PARAMS), ("leaf", boost.LEAF_PARAMS)]))
    return round_doubles(out[0].unionByName(out[1]), 6)


@register("pruned_forest_scores")
def pruned_forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest after weakest-link pruning (ccp_alpha 0.0001, at least 10 rows to split), on the test split."""
    from valuelens.operators.prune import pruned

    model = pruned(_fitted(spark, sf_dir, "rf"), alpha=0.0001, min_split=10)
    data = model_table(spark, sf_dir).filter(F.col("split") == "test")
    return round_doubles(ml.predict_value(model, data).select("row_key", LABEL, "prediction", "l_extendedprice", "predicted_value"))


@register("tuning_ledger")
def tuning_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14 + M15: a grid of forests over hash folds, by way of the ledger: the first run does half of the grid, the second one what is
    missing; the ranked table. Every point has a fit of its own on every fold."""
    from valuelens.operators import tuning
    from valuelens.streaming.jobs import scratch

    train = ml.training_input(model_table(spark, sf_dir).filter(F.col("split") == "train"), [*FEATURES, LABEL, "fold"])
    make = lambda params: ml.random_forest(FEATURES, LABEL, **{**RF_QUERY, "numTrees": 5, **params})
    path = f"{scratch(spark, 'ledger')}/grid"
    grid = {"maxDepth": [4, 6]}
    tuning.tune(make, {"maxDepth": [4]}, train, LABEL, path, k=3, own_fits=True)
    table = tuning.tune(make, grid, train, LABEL, path, k=3, own_fits=True).drop("seconds")
    out = spark.createDataFrame(table.collect(), table.schema)
    train.unpersist()
    return round_doubles(out, 6)
