"""Registry of driver queries: name -> (builder(spark, sf_dir) -> DataFrame, oracle SQL or None)."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from valuelens.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)  # Python functions of the operators run on the workers
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def scaled_round(c, digits: int):
    """round(x * 10^d) / 10^d: the rounding of the scaled binary value, as numpy and DuckDB do."""
    m = float(10**digits)
    r = F.round(c * m, 0)
    # a value that rounds to zero keeps its sign (-0.0), as C's round() does
    return F.when(r == 0, c * 0.0).otherwise(r / m)


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating column last, so both engines compare at fixed precision."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(scaled_round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
