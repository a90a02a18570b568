"""Spark session helpers.

Every operator in the library takes and returns DataFrames; this module only
builds a session with the settings the library relies on (AQE, UTC, no UI) and
resolves the shared checkpoint folder used to cut long lineages.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()

# Settings the library assumes. AQE re-plans joins from runtime sizes (so a
# dimension is broadcast only when it is measured small) and splits skewed
# shuffle partitions; UTC keeps timestamps comparable with the SQL oracle.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    app: str = "valuelens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it to a path that all executors share; a session without it
    is refused unless it runs in one process (``local`` masters: tests, benches), where a fresh
    scratch folder is taken and removed at exit.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="valuelens-ckpt-")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once per session, so that Python functions run on executors
    whose search path does not hold the repository."""
    sc = spark.sparkContext
    with _SHIPPING:  # fits side by side may come here together
        if sc.applicationId in _SHIPPED:
            return
        here = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="valuelens-ship-"), "valuelens_package.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(here):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(here)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settled(df: DataFrame) -> DataFrame:
    """The rows written once as Parquet into the shared checkpoint folder and read back: what follows plans one
    scan of them, however often it uses them."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"settled-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
