"""Sinks (K1-K10). Writers are plain DataFrameWriter calls; every one overwrites atomically
per output folder, so a rerun after a lost executor or a failed job replaces partial output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from valuelens.schema import RAW_DEFAULTS, RAW_PLAYER, conform


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """K1: overwrite a whole table (Parquet by default, CSV with header on request)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def write_conformed_csv(df: DataFrame, path: str, schema: StructType = RAW_PLAYER, defaults: dict | None = None,
                        skip_empty: bool = True) -> bool:
    """K2 + K6: project to the fixed schema, fill defaults, write CSV; nothing is written when empty."""
    out = conform(df, schema, RAW_DEFAULTS if defaults is None else defaults)
    if skip_empty and out.isEmpty():
        return False
    write_table(out, path, "csv")
    return True


def write_json_lines(df: DataFrame, path: str, skip_empty: bool = True) -> bool:
    """K3 + K6: JSON Lines (one object per line, UTF-8 kept)."""
    if skip_empty and df.isEmpty():
        return False
    df.write.mode("overwrite").json(path)
    return True


def write_by_league(df: DataFrame, path: str, col: str = "league", fmt: str = "parquet") -> None:
    """K5: one folder per league, names with spaces turned into '_' (enables partition pruning)."""
    part = f"{col}_part"
    out = df.withColumn(part, F.regexp_replace(F.col(col), " ", "_"))
    write_table(out, path, fmt, [part])


def save_model(model, path: str) -> None:
    """K7: Spark ML persistence (PipelineModel / fitted estimators)."""
    model.write().overwrite().save(path)


def template(df: DataFrame, order_by: str, target: str, n: int = 3) -> DataFrame:
    """K9: first ``n`` rows by a key, without the target column."""
    return df.orderBy(order_by).limit(n).drop(target)


def feature_table(spark, features: Sequence[str], categoricals: Sequence[str] = ()) -> DataFrame:
    """The model's input features as a table (position, feature, is_categorical)."""
    rows = [(i, f, f in set(categoricals)) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "position int, feature string, is_categorical boolean")
