"""Grid tuning that survives a lost driver (M14, M15): every (grid point, fold) that is done stands in a ledger table.

The ledger is a folder of one-row Parquet tables, ``entry=<digest of study and parameters>/fold=<f>``, in the shared folder that the caller names.
An entry is written when its fit has been scored, into a folder of its own, so that fits running side by side never touch
each other's files and a write that was cut short is simply done again. A run first reads the ledger and fits only
what is missing; a restart after a kill ends with the table that an undisturbed run gives. Forests that serve several grid
points are kept beside it, in ``<path>.forests/<digest>/fold=<f>``.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from valuelens.operators import learn
from valuelens.operators.prune import cut
from valuelens.operators.stats import regression_metrics

_ENTRY = "entry string, fold int, params string, r2 double, n long, seconds double"


def grid_points(grid: dict[str, list]) -> list[dict]:
    """All combinations, the last name's values changing fastest."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def _digest(study: str, params: dict) -> str:
    return hashlib.md5(json.dumps([study, params], sort_keys=True, default=str).encode()).hexdigest()


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(entry, fold, params, r2, n, seconds) of what has been done; empty if nothing has."""
    try:
        return spark.read.schema(_ENTRY).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ENTRY)


def _family(estimator: object, params: dict) -> str | None:
    """What the estimators of grid points have in common that differ in the depth of their forests only; None for other estimators."""
    forest = estimator.getStages()[-1] if isinstance(estimator, Pipeline) else estimator
    if not isinstance(forest, RandomForestRegressor) or params.get("maxDepth") != forest.getMaxDepth():
        return None
    own = {p.name: str(v) for p, v in forest.extractParamMap().items() if p.name != "maxDepth"}
    return json.dumps([{n: v for n, v in params.items() if n != "maxDepth"}, own], sort_keys=True, default=str)


def _kept(spark: SparkSession, at: str, fit: Callable[[], object]):
    """The forest kept in the folder ``at``, grown and kept there if it is not yet; ``done`` is written last, so a write cut short does not count."""
    try:
        spark.read.parquet(f"{at}/done")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        model = fit()
        model.write().overwrite().save(f"{at}/forest")
        spark.createDataFrame([(isinstance(model, PipelineModel),)], "pipeline boolean").coalesce(1).write.mode("overwrite").parquet(f"{at}/done")
        return model
    whole = spark.read.parquet(f"{at}/done").first()["pipeline"]
    return (PipelineModel if whole else RandomForestRegressionModel).load(f"{at}/forest")


def tune(make: Callable[[dict], object], grid: dict[str, list], df: DataFrame, label: str, path: str, study: str = "", fold_col: str = "fold",
         k: int = 5, parallelism: int = 4, whole: dict[str, list] | None = None, own_fits: bool = False) -> DataFrame:
    """(grid_point, params, avg_r2, std_r2, seconds, rank), cross-validated over ``fold_col`` = 0 .. k - 1.

    ``whole`` is the study's grid, where this run does a part of it. Forests that differ in depth only are grown once a fold, to the
    deepest depth of ``whole`` or ``grid``, and kept: the trees of the others are the same trees cut (``learn.grid_search``), in this
    run and in later ones. A point's seconds hold the fit only where it was made for it. With ``own_fits`` nothing is shared or kept:
    every point is fitted by itself on every fold.

    ``make(params)`` gives an object with ``fit(rows)``, whose result has ``transform(rows)`` that adds ``prediction``: a Spark ML
    pipeline, or ``boosted``. ``df`` should be kept (``learn.training_input``). ``study`` names data and settings
    outside the grid: entries of another study are not taken over. A failing fit is raised when those running beside it
    have ended; what they have written stays done. A fold without rows has a null R^2 and is left out of the mean.
    """
    spark = df.sparkSession
    points = grid_points(grid)
    names = [_digest(study, p) for p in points]
    done = {(r.entry, r.fold) for r in ledger(spark, path).select("entry", "fold").collect()}
    family = [None if own_fits else _family(make(p), p) for p in points]
    deepest: dict[str, int] = {}
    several = set()
    for p, x in [*zip(points, family), *((p, _family(make(p), p)) for p in grid_points(whole or {}) if not own_fits)]:
        if x is not None:
            if deepest.setdefault(x, p["maxDepth"]) != p["maxDepth"]:
                several.add(x)
            deepest[x] = max(deepest[x], p["maxDepth"])
    todo: dict[tuple, list[tuple[dict, str]]] = {}  # points of a fold that share its forest stand together
    for p, e, x in zip(points, names, family):
        for f in range(k):
            if (e, f) not in done:
                todo.setdefault((f, x if x in several else None, None if x in several else e), []).append((p, e))

    def one(fold: int, shared: str | None, some: list[tuple[dict, str]]) -> None:
        train, forest = df.filter(F.col(fold_col) != fold), None
        for params, entry in some:
            began, model = time.time(), None
            if shared is not None:
                deep = {**params, "maxDepth": deepest[shared]}
                if forest is None:
                    forest = _kept(spark, f"{path}.forests/{_digest(study, deep)}/fold={fold}", lambda p=deep: make(p).fit(train))
                if params == deep:
                    model = forest
                elif learn._one_pass(forest, params["maxDepth"]):
                    model = cut(forest, params["maxDepth"], spark)
            score(model or make(params).fit(train), params, entry, fold, began)

    def score(model, params: dict, entry: str, fold: int, began: float) -> None:
        r = regression_metrics(model.transform(df.filter(F.col(fold_col) == fold)), label, "prediction").select("r2", "n").first()
        row = (json.dumps(params, sort_keys=True, default=str), None if r is None else r["r2"], 0 if r is None else r["n"], time.time() - began)
        spark.createDataFrame([row], "params string, r2 double, n long, seconds double").coalesce(1).write.mode("overwrite").parquet(f"{path}/entry={entry}/fold={fold}")

    with ThreadPoolExecutor(learn.side_by_side(df, parallelism)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(one), f, x, some) for (f, x, _), some in todo.items()]
        failed = next((x for x in (r.exception() for r in running) if x is not None), None)
    if failed is not None:
        raise failed
    order = spark.createDataFrame([(i, e) for i, e in enumerate(names)], "grid_point int, entry string")
    scores = ledger(spark, path).join(F.broadcast(order), "entry").where(F.col("fold") < k)
    table = scores.groupBy("grid_point", "params").agg(F.avg("r2").alias("avg_r2"), F.stddev_pop("r2").alias("std_r2"), F.sum("seconds").alias("seconds"))
    return table.withColumn("rank", F.row_number().over(Window.orderBy(F.col("avg_r2").desc_nulls_last(), "grid_point")))  # a row per grid point


def best_params(table: DataFrame) -> dict:
    return json.loads(table.where("rank = 1").select("params").first()[0])


class boosted:  # noqa: N801  an estimator for ``tune``
    """Boosted trees (``operators.boost``) with the given parameters, as an estimator."""

    def __init__(self, features: list[str], label: str, **params):
        self.features, self.label, self.params = features, label, params

    def fit(self, rows: DataFrame):
        from valuelens.operators import boost

        return boost.fit(rows, self.features, self.label, **self.params)
