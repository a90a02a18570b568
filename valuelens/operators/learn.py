"""Tree-ensemble regression, validation, comparison and scoring (M11-M24) on Spark ML.

Training is Spark ML's distributed tree induction (one pass over the data per
tree level); folds and splits are hash columns (operators.split), so every
fit sees the same rows on any cluster. Nothing collects the training data.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from valuelens.operators.gbt import BlockGBTRegressor
from valuelens.operators.stats import regression_metrics
from valuelens.session import settled

# Default hyper-parameters per model family (reference values mapped to Spark ML names;
# min_samples_split, ccp_alpha, num_leaves and L1/L2 have no Spark counterpart).
RF_PARAMS = dict(numTrees=200, maxDepth=20, minInstancesPerNode=5, minWeightFractionPerNode=0.01,
                 featureSubsetStrategy="0.5", seed=42)
GBT_X_PARAMS = dict(maxIter=200, stepSize=0.05, maxDepth=6, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42)
GBT_L_PARAMS = dict(maxIter=200, stepSize=0.05, maxDepth=5, minInstancesPerNode=20, seed=42)


# The reference's search grids, mapped to Spark ML parameter names. Grid axes
# without a Spark ML counterpart (min samples per split, number of leaves) are left out; the
# full grids are large (hundreds of points x 5 folds), the driver queries use a 4-point grid.
RF_GRID = {
    "numTrees": [150, 200, 250],
    "maxDepth": [15, 20, 25],
    "minInstancesPerNode": [3, 5, 7],
    "featureSubsetStrategy": ["0.5", "0.6", "0.7"],
}
GBT_X_GRID = {
    "maxIter": [200, 300, 400],
    "stepSize": [0.03, 0.05, 0.07],
    "maxDepth": [5, 6, 7],
    "minInstancesPerNode": [2, 3, 4],
    "subsamplingRate": [0.7, 0.8, 0.9],
    "featureSubsetStrategy": ["0.7", "0.8", "0.9"],
}
GBT_L_GRID = {
    "maxIter": [100, 200, 300],
    "stepSize": [0.01, 0.05, 0.1],
    "maxDepth": [3, 6, 9],
    "minInstancesPerNode": [10, 20, 30],
}


def _pipeline(features: Sequence[str], label: str, regressor) -> Pipeline:
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    regressor.setFeaturesCol("features").setLabelCol(label).setPredictionCol("prediction")
    return Pipeline(stages=[va, regressor])


#: Files read per training partition, at most about this many bytes: as points of 20 bagged trees the learner holds some 12 times as many.
PARTITION_BYTES = 8 << 20

#: Training partitions of which a core holds the points at once, in all fits that run side by side: beyond, fits wait for each other.
PARTITIONS_PER_CORE = 16


def random_forest(features: Sequence[str], label: str, **params) -> Pipeline:
    """M11."""
    p = {**RF_PARAMS, **params}
    return _pipeline(features, label, RandomForestRegressor(**p))


def gbt_x(features: Sequence[str], label: str, **params) -> Pipeline:
    """Row and column subsampling variant."""
    p = {**GBT_X_PARAMS, **params}
    return _pipeline(features, label, BlockGBTRegressor(**p))


def gbt_l(features: Sequence[str], label: str, **params) -> Pipeline:
    """Leaf-limited variant (leaf cap approximated by depth, min rows per leaf)."""
    p = {**GBT_L_PARAMS, **params}
    return _pipeline(features, label, BlockGBTRegressor(**p))


def training_input(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Persisted, evenly partitioned training rows.

    Tree induction scans its input once per level; after a join, AQE sizes
    partitions for SQL (128 MB advisory) and can leave fewer partitions than
    cores, so the learner would run on a few tasks. The rows are spread over
    2 x default parallelism partitions, or more if the files they come from
    hold more than PARTITION_BYTES for each, and kept (memory, spilling to disk)
    for the passes of one fit. Callers unpersist them.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    read = sum(x for x in sizes if x < 1 << 60)  # a checkpoint's size is not known to the plan
    n = max(2 * df.sparkSession.sparkContext.defaultParallelism, min(read // PARTITION_BYTES, 1 << 20))
    from pyspark import StorageLevel

    return df.select(*cols).repartition(n).persist(StorageLevel.MEMORY_AND_DISK)


def fit_timed(pipeline: Pipeline, train: DataFrame) -> tuple[PipelineModel, float]:
    t0 = time.time()
    m = pipeline.fit(train)
    return m, time.time() - t0


def predict_value(model: PipelineModel, df: DataFrame, log_target: bool = True, out: str = "predicted_value") -> DataFrame:
    """Predict, back-transform with expm1 when the model is on log scale, floor at 0 (a NULL stays NULL)."""
    p = model.transform(df)
    v = F.expm1("prediction") if log_target else F.col("prediction")
    return p.withColumn(out, F.when(v.isNotNull(), F.greatest(v, F.lit(0.0))))


def side_by_side(df: DataFrame, most: int) -> int:
    """How many fits on ``df`` run at once, at most ``most``: small inputs leave cores idle between a fit's jobs, large ones fill
    them by themselves, and the points of several fits would only drive each other out of memory."""
    return max(1, min(most, PARTITIONS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism // max(df.rdd.getNumPartitions(), 1)))


def cv_fold_scores(pipeline: Pipeline, df: DataFrame, label: str, fold_col: str = "fold", k: int = 5,
                   parallelism: int = 4) -> DataFrame:
    """R^2 of each fold when trained on the other folds, as a (fold, r2, n) table."""
    spark = df.sparkSession

    def one(f: int):
        m = pipeline.fit(df.filter(F.col(fold_col) != f))
        met = regression_metrics(m.transform(df.filter(F.col(fold_col) == f)), label, "prediction").select("r2", "n").first()
        return f, None if met is None else met["r2"], 0 if met is None else met["n"]

    # the folds' jobs run side by side; Spark shares the cluster between them
    with ThreadPoolExecutor(side_by_side(df, parallelism)) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(one), range(k)))
    return spark.createDataFrame(rows, "fold int, r2 double, n long")


def cv_summary(fold_scores: DataFrame) -> DataFrame:
    """Mean and population std of fold R^2 with a stability band (< .02 stable, < .05 moderate)."""
    s = fold_scores.agg(F.avg("r2").alias("cv_r2_mean"), F.stddev_pop("r2").alias("cv_r2_std"))
    return s.withColumn(
        "stability", F.when(F.col("cv_r2_std") < 0.02, "stable").when(F.col("cv_r2_std") < 0.05, "moderate").otherwise("unstable")
    )


def _one_pass(model: PipelineModel, depth: int) -> bool:
    """Whether all nodes of any level of the forest above ``depth`` fit into one pass: a histogram of three doubles for every node, feature and bin."""
    m = model.stages[-1] if isinstance(model, PipelineModel) else model
    return m.getNumTrees * 2 ** max(depth - 1, 0) * m.numFeatures * m.getMaxBins() * 24 <= m.getMaxMemoryInMB() << 20


def _families(reg, maps: Sequence[dict]) -> list[list[int]]:
    """Places in ``maps`` of forests that differ in depth only, the deepest first; other learners stand alone."""
    if not isinstance(reg, RandomForestRegressor):
        return [[i] for i in range(len(maps))]
    family: dict[tuple, list[int]] = {}
    for i, pm in enumerate(maps):
        family.setdefault(tuple((p.name, str(v)) for p, v in pm.items() if p.name != "maxDepth"), []).append(i)
    return [sorted(f, key=lambda i: (-reg.copy(maps[i]).getMaxDepth(), i)) for f in family.values()]


def grid_search(pipeline: Pipeline, grid: dict, df: DataFrame, label: str, fold_col: str = "fold", parallelism: int = 2,
                k: int = 5):
    """Cross-validated grid search on R^2 with the hash fold column; returns (best model, table of
    (params, avg_r2, std_r2, rank)).

    A forest grows level by level, and its depth only says where that ends: grid points that differ in depth only take one
    fit a fold, the deepest, whose trees cut at a smaller depth are those of the fit with that depth. Where a level may take
    several passes (``maxMemoryInMB``) the draws of features differ, and each depth is fitted by itself.
    """
    from valuelens.operators.prune import cut

    spark = df.sparkSession
    reg = pipeline.getStages()[-1]
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(reg.getParam(name), list(values))
    maps = b.build()
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="r2")
    fold = F.col(fold_col).cast("int")
    beyond = F.raise_error(F.printf(F.lit(f"Fold number must be in range [0, {k}), but got %s"), fold))
    rows = df.withColumn(fold_col, F.when((fold >= 0) & (fold < k), fold).otherwise(beyond))
    if not df.is_cached:
        rows.persist()
    for f in range(k):
        for part, held in (("training", F.col(fold_col) != f), ("validation", F.col(fold_col) == f)):
            if rows.filter(held).isEmpty():
                raise ValueError(f"The {part} data at fold {f} is empty.")
    r2 = [[0.0] * len(maps) for _ in range(k)]

    def one(task: tuple[int, list[int]]) -> None:
        f, points = task
        train, held = rows.filter(F.col(fold_col) != f), rows.filter(F.col(fold_col) == f)
        deepest = None
        for i in points:
            depth = reg.copy(maps[i]).getMaxDepth() if len(points) > 1 else 0
            if deepest is not None and _one_pass(deepest, depth):
                model = cut(deepest, depth, spark)
            else:
                model = pipeline.fit(train, maps[i])
                deepest = deepest or model
            r2[f][i] = ev.evaluate(model.transform(held))

    with ThreadPoolExecutor(side_by_side(rows, parallelism)) as pool:
        list(pool.map(inheritable_thread_target(spark)(one), [(f, points) for f in range(k) for points in _families(reg, maps)]))
    mean, std = np.mean(r2, axis=0), np.std(r2, axis=0)
    best = pipeline.fit(rows, maps[int(np.argmax(mean))])
    if not df.is_cached:
        rows.unpersist()
    points = []
    for i, pm in enumerate(maps):
        desc = ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))
        points.append((i, desc, float(mean[i]), float(std[i])))
    table = spark.createDataFrame(points, "grid_point int, params string, avg_r2 double, std_r2 double")
    from pyspark.sql import Window

    table = table.withColumn("rank", F.row_number().over(Window.orderBy(F.col("avg_r2").desc(), "grid_point")))
    return best, table


def model_metrics(model_name: str, scored: dict[str, DataFrame], label_log: str, label_raw: str | None = None) -> DataFrame:
    """R^2 on log scale for each split, and MSE, RMSE, MAE, MAPE on the original scale for test.

    ``scored`` maps split name -> predictions (column ``prediction`` on log scale)."""
    parts = []
    for split, df in scored.items():
        r2 = regression_metrics(df, label_log, "prediction").select(F.lit(split).alias("split"), "r2")
        parts.append(r2)
    r2s = parts[0]
    for p in parts[1:]:
        r2s = r2s.unionByName(p)
    wide = r2s.groupBy().pivot("split", list(scored)).agg(F.first("r2"))
    wide = wide.select(*[F.col(s).alias(f"{s}_r2") for s in scored])
    test = scored.get("test")
    if test is not None:
        raw = test.withColumn("__y", F.expm1(label_log) if label_raw is None else F.col(label_raw)).withColumn(
            "__p", F.expm1("prediction"))
        m = regression_metrics(raw, "__y", "__p").select(
            F.col("mse").alias("test_mse"), F.col("rmse").alias("test_rmse"), F.col("mae").alias("test_mae"), F.col("mape").alias("test_mape"))
        wide = wide.crossJoin(m)
        if "train" in scored:
            wide = wide.withColumn("train_test_gap", F.col("train_r2") - F.col("test_r2"))
    return wide.select(F.lit(model_name).alias("model"), "*")


def best_model(metrics: DataFrame, metric: str = "test_r2") -> DataFrame:
    """Models ranked by a metric (1 = best)."""
    from pyspark.sql import Window

    return metrics.withColumn("rank", F.row_number().over(Window.orderBy(F.col(metric).desc_nulls_last(), "model")))


def ensemble(predictions: DataFrame, key: str, actual: str | None = None) -> DataFrame:
    """Long (key, model, prediction) -> per row: mean, min, max, population std over models, and
    each model's difference and % difference from the mean; error vs actual when given."""
    cells = F.struct("model", "prediction", *([actual] if actual else []))
    stats = predictions.groupBy(key).agg(
        F.avg("prediction").alias("ens_mean"), F.min("prediction").alias("ens_min"),
        F.max("prediction").alias("ens_max"), F.stddev_pop("prediction").alias("ens_std"),
        F.collect_list(cells).alias("__c"),  # a row per model
    )
    out = stats.withColumn("__c", F.explode("__c")).select(
        key, "__c.model", "__c.prediction", *([F.col(f"__c.{actual}")] if actual else []), "ens_mean", "ens_min", "ens_max", "ens_std")
    out = out.withColumn("diff_from_avg", F.col("prediction") - F.col("ens_mean")).withColumn(
        "diff_pct", F.try_divide(F.col("diff_from_avg"), F.col("ens_mean")) * 100)
    if actual:
        out = out.withColumn("error", F.col("prediction") - F.col(actual)).withColumn(
            "error_pct", F.when(F.col(actual) > 0, F.col("error") / F.col(actual) * 100)).withColumn(
            "abs_error", F.abs("error"))
    return out


def group_mispricing(scored: DataFrame, group: str, actual: str, predicted: str, min_count: int = 10, round_first: int = 2) -> DataFrame:
    """residual = actual - predicted, residual % of predicted; per group mean, median, count and
    mean %, rounded to 2 BEFORE the count >= min_count filter."""
    r = scored.withColumn("residual", F.col(actual) - F.col(predicted)).withColumn(
        "residual_pct", F.try_divide(F.col("residual"), F.col(predicted)) * 100)
    r = settled(r.select(group, "residual", "residual_pct"))  # a median takes passes: rows are scored once
    m = float(10 ** round_first)
    from valuelens.operators.quantiles import with_quantiles

    g = r.groupBy(group).agg(
        (F.round(F.avg("residual") * m) / m).alias("mean_residual"),
        F.count("residual").alias("count"),
        (F.round(F.avg("residual_pct") * m) / m).alias("mean_residual_pct"),
    )
    g = with_quantiles(g, r, [group], "residual", {"__median": 0.5}).filter(F.col("count") >= min_count)
    return g.select(group, "mean_residual", (F.round(F.col("__median") * m) / m).alias("median_residual"), "count", "mean_residual_pct")


def score_summary(scored: DataFrame, col: str = "predicted_value") -> DataFrame:
    """Mean, median, max, min of the predictions of a batch."""
    from valuelens.operators.quantiles import with_quantiles

    scored = settled(scored.select(col))  # a median takes passes: rows are scored once
    stats = scored.agg(F.avg(col).alias("mean"), F.max(col).alias("max"), F.min(col).alias("min"), F.count(col).alias("n"))
    return with_quantiles(stats, scored, [], col, {"median": 0.5}).select("mean", "median", "max", "min", "n")


def feature_importance(model: PipelineModel, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """Feature importances of the fitted tree model as a table (feature, importance, rank)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(features, imp), key=lambda x: -x[1])
    return spark.createDataFrame([(f, float(v), i + 1) for i, (f, v) in enumerate(rows)], "feature string, importance double, rank int")
