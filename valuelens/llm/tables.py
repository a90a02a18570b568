"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from valuelens.session import ensure_checkpoint_dir, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Add a driver query (and its SQL twin, if SQL can express it)."""

    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


#: Bytes of an Arrow batch: a worker holds one batch, and what it makes of it, per task.
BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    """Cut Arrow batches at BATCH_BYTES in this session, unless the session has a size of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, "67108864b") in ("67108864b", "64m", "67108864"):  # Spark's default
        spark.conf.set(key, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    small_batches(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder of ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The rows written once as Parquet into the shared checkpoint folder, and read back.

    Cheaper on disk than ``checkpoint()`` (columnar, compressed); survives a lost executor alike.
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"llm-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def filtered_shuffles(spark: SparkSession):
    """Let Spark put a Bloom filter of a join's small side before the large side's shuffle, at any scan size.

    The small side must carry a comparison (Spark takes it for selective then). A filter too full only
    lets more rows through. For jobs that run inside the block.
    """
    keys = {"applicationSideScanSizeThreshold": "1MB", "creationSideThreshold": "64GB"}
    names = {f"spark.sql.optimizer.runtime.bloomFilter.{k}": v for k, v in keys.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def position_in(df: DataFrame, group: list[str], order: list[str], out: str, derive: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None) -> DataFrame:
    """0-based place of each row in its group by ``order``, safe for a group of any size.

    Rows are dealt by range over (group, order, row number of the scan), so a hot group,
    even one of equal rows, spreads over many tasks. Each range numbers its own rows as they
    stream by and is written once (a second evaluation could draw other bounds); groups that
    began in earlier ranges, at most one per range, get those ranges' counts added by a broadcast.
    Null groups are groups like others. All columns of ``df`` are kept. With ``derive``, the group columns are filled by it, batch by batch
    in the numbering pass; they must not fall as ``order`` rises.
    """
    keys = [*([] if derive else group), *order, "__tie"]
    ranged = df.withColumn("__tie", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
    ranged = ranged.drop("__tie").withColumn("__pid", F.spark_partition_id()).withColumn("__rn", F.lit(0).cast("long"))
    schema = ranged.schema

    def number(batches):
        last, seen = None, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            b = derive(b) if derive else b
            new = np.zeros(n, dtype=bool)
            for g in group:
                x = b.column(g)
                one, two = x.slice(1), x.slice(0, n - 1)
                differ = pc.fill_null(pc.not_equal(one, two), True)
                both = pc.and_(pc.is_null(one), pc.is_null(two))
                new[1:] |= np.asarray(pc.and_not(differ, both))
            first = tuple(b.column(g)[0].as_py() for g in group)
            new[0] = last is None or first != last
            at = np.arange(n)
            begin = np.maximum.accumulate(np.where(new, at, -1))
            rn = np.where(begin < 0, at + seen, at - begin)
            last, seen = tuple(b.column(g)[n - 1].as_py() for g in group), int(rn[-1]) + 1
            yield b.set_column(b.schema.get_field_index("__rn"), "__rn", pa.array(rn, pa.int64()))

    local = written(ranged.mapInArrow(number, schema))
    counts = local.groupBy("__pid", *group).agg(F.count(F.lit(1)).alias("__n"))
    spread = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("__off", F.coalesce(F.sum("__n").over(spread), F.lit(0))).where("__off > 0")
    before = before.select(F.col("__pid").alias("__p2"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], "__off")
    same = F.col("__pid") == F.col("__p2")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    joined = local.join(F.broadcast(before), same, "left")  # at most one row per range
    return joined.withColumn(out, F.coalesce("__off", F.lit(0)) + F.col("__rn")).drop(
        "__pid", "__p2", "__rn", "__off", *[f"__g{i}" for i in range(len(group))])


def grouped(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal (integer, not null) keys, for rows that come sorted by key. Groups must be of bounded size."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [np.asarray(b.column(k)) for k in key]
        edge = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1 if b.num_rows > 1 else np.zeros(0, np.int64)
        begin = np.concatenate([[0], edge, [b.num_rows]]).tolist()
        first = tuple(c[0] for c in cols)
        if held and first != last:
            yield _joined(held)
            held = []
        for i, (a, e) in enumerate(zip(begin[:-1], begin[1:])):
            if i:
                yield _joined(held)
                held = []
            held.append(b.slice(a, e - a))
        last = tuple(c[-1] for c in cols)
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.concat_batches(held)
