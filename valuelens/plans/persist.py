"""Fitted plans and trained models as folders (C2, C10, C11, M18, M19): saved in one session, served in another.

A folder holds ``meta.json`` (names and settings, one line), one Parquet table per fitted
code table and one Spark ML folder per model. Everything is read and written by Spark, so the
path may be on any store Spark knows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.plans.flows import CleanPlan, FeaturePlan


def _put_meta(spark: SparkSession, meta: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta.json")


def _get_meta(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/meta.json").first()[0])


def _put(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_clean_plan(plan: CleanPlan, path: str) -> None:
    lists = ("sparse_dropped", "redundant_dropped", "low_corr_dropped", "derived_dropped", "columns")
    _put_meta(plan.fills.sparkSession, {k: getattr(plan, k) for k in lists} | {"vif": plan.vif_report is not None, "audit": plan.audit is not None}, path)
    _put(plan.fills, f"{path}/fills")
    if plan.vif_report is not None:
        _put(plan.vif_report, f"{path}/vif_report")
    if plan.audit is not None:
        _put(plan.audit, f"{path}/audit")


def load_clean_plan(spark: SparkSession, path: str) -> CleanPlan:
    meta = _get_meta(spark, path)
    vif, audit = meta.pop("vif"), meta.pop("audit")
    return CleanPlan(**meta, fills=spark.read.parquet(f"{path}/fills"), vif_report=spark.read.parquet(f"{path}/vif_report") if vif else None,
                     audit=spark.read.parquet(f"{path}/audit") if audit else None)


def save_trained(trained: dict, path: str) -> None:
    """The result of ``flows.train``: feature plan, feature list, models and metrics."""
    plan: FeaturePlan = trained["plan"]
    meta = {"log_columns": plan.log_columns, "selected": plan.selected, "freq": sorted(plan.freq), "labels": sorted(plan.labels),
            "target_codes": sorted(plan.target_codes), "features": trained["features"], "models": sorted(trained["models"])}
    _put_meta(trained["metrics"].sparkSession, meta, path)
    for c, t in plan.freq.items():
        _put(t, f"{path}/freq/{c}")
    for c, t in plan.labels.items():
        _put(t, f"{path}/labels/{c}")
    for c, parts in plan.target_codes.items():
        for name, t in zip(("oof", "full", "overall"), parts):
            _put(t, f"{path}/target_codes/{c}/{name}")
    _put(trained["metrics"], f"{path}/metrics")
    for name, model in trained["models"].items():
        model.write().overwrite().save(f"{path}/models/{name}")


def load_trained(spark: SparkSession, path: str) -> dict:
    meta, read = _get_meta(spark, path), spark.read.parquet
    plan = FeaturePlan(
        log_columns=meta["log_columns"], selected=meta["selected"],
        freq={c: read(f"{path}/freq/{c}") for c in meta["freq"]}, labels={c: read(f"{path}/labels/{c}") for c in meta["labels"]},
        target_codes={c: tuple(read(f"{path}/target_codes/{c}/{n}") for n in ("oof", "full", "overall")) for c in meta["target_codes"]})
    return {"plan": plan, "features": meta["features"], "metrics": read(f"{path}/metrics"),
            "models": {m: PipelineModel.load(f"{path}/models/{m}") for m in meta["models"]}}


# --- a registry of versions -----------------------------------------------------------------------------

def publish(spark: SparkSession, trained: dict, root: str, ledger: DataFrame | None = None) -> int:
    """Save a trained result as a new version below ``root`` and publish it; returns its number.

    Everything (plan, feature list, models, metrics, the tuning ledger if given) goes into a folder of its own. Only then is
    the manifest ``published/<number>`` written, one row in one step, so a reader sees a version whole or not at all, and
    a save that fails leaves nothing visible behind. Nothing published is ever overwritten; of two publishers of the
    same number, one takes the next.
    """
    version = uuid.uuid4().hex
    save_trained(trained, f"{root}/versions/{version}")
    if ledger is not None:
        _put(ledger, f"{root}/versions/{version}/ledger")
    best = trained["metrics"].where("rank = 1").first()
    number = max((r.number for r in versions(spark, root).select("number").collect()), default=0) + 1
    row = spark.createDataFrame([(version, best["model"], best["test_r2"], ledger is not None)], "version string, best_model string, test_r2 double, has_ledger boolean").coalesce(1)
    while True:
        try:
            row.write.mode("errorifexists").parquet(f"{root}/published/number={number}")
            return number
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            number += 1


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(number, version, best_model, test_r2, has_ledger) of what is published."""
    schema = "version string, best_model string, test_r2 double, has_ledger boolean, number int"
    try:
        return spark.read.schema(schema).parquet(f"{root}/published")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def load_published(spark: SparkSession, root: str, number: int | None = None, best: bool = False) -> dict:
    """The published version of that number, else the newest (or the one with the highest test R^2), with ``ledger`` if it has one."""
    table = versions(spark, root)
    order = [F.col("test_r2").desc_nulls_last(), F.col("number").desc()] if best else [F.col("number").desc()]
    row = (table.where(F.col("number") == number) if number is not None else table).orderBy(*order).first()
    if row is None:
        raise LookupError(f"nothing published below {root}")
    path = f"{root}/versions/{row.version}"
    return load_trained(spark, path) | {"number": row.number} | ({"ledger": spark.read.parquet(f"{path}/ledger")} if row.has_ledger else {})
