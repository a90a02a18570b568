"""Reproducible splits and folds.

A row's part is a pure function of its key: the first 32 bits of md5(key +
salt) modulo 100 (or k). It does not depend on partitioning or on the order
rows arrive in, so it is identical across runs, clusters and engines, and it
needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(key: Column | str, buckets: int, salt: str = "") -> Column:
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(F.concat(k.cast("string"), F.lit(salt))), 1, 8), 16, 10).cast("bigint")
    return (h % buckets).cast("int")


def hash_split(df: DataFrame, key: str, test_pct: int = 20, val_pct: int = 16, salt: str = "split", out: str = "split") -> DataFrame:
    """M9: 'test' for buckets < test_pct, 'val' for the next val_pct, else 'train' (64/16/20 by default)."""
    # the part stands in a constant array, so that a row's hash is taken once, in filters too
    parts = F.array(*[F.lit("test" if b < test_pct else "val" if b < test_pct + val_pct else "train") for b in range(100)])
    return df.withColumn(out, F.coalesce(F.element_at(parts, hash_bucket(key, 100, salt) + 1), F.lit("train")))


def hash_folds(df: DataFrame, key: str, k: int = 5, salt: str = "fold", out: str = "fold") -> DataFrame:
    """Fold id 0..k-1."""
    return df.withColumn(out, hash_bucket(key, k, salt))
