"""Join-shaped operators.

Dimension-side tables (lookups, mappings, code tables) are left to the
optimizer: with AQE on, Spark broadcasts a side only when its measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise keeps a
sort-merge / shuffle-hash join, so nothing here assumes a side is small unless
it is a fixed literal table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_default(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str, value: str, default, out: str | None = None) -> DataFrame:
    """``df[key].map(lookup).fillna(default)`` as a left join + coalesce."""
    out = out or value
    lk = lookup.select(F.col(lookup_key).alias("__lk"), F.col(value).alias("__lv"))
    j = df.join(lk, df[key] == lk["__lk"], "left")
    return j.withColumn(out, F.coalesce(F.col("__lv"), F.lit(default))).drop("__lk", "__lv")


def overlay(left: DataFrame, right: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Right-side values replace left ones where the right value is not NULL (0 does replace)."""
    r = right.select(F.col(key).alias("__rk"), *[F.col(c).alias(f"__r_{c}") for c in cols])
    j = left.join(r, left[key] == r["__rk"], "left")
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(f"__r_{c}"), F.col(c)))
    return j.drop("__rk", *[f"__r_{c}" for c in cols])


def fallback(left: DataFrame, right: DataFrame, key: str, col: str, right_col: str | None = None) -> DataFrame:
    """Keep the left value; only where it is NULL take the right one."""
    rc = right_col or col
    r = right.select(F.col(key).alias("__rk"), F.col(rc).alias("__fb"))
    j = left.join(r, left[key] == r["__rk"], "left")
    return j.withColumn(col, F.coalesce(F.col(col), F.col("__fb"))).drop("__rk", "__fb")


def first_valid(candidates: DataFrame, key: str, pos: Sequence[str], value: Column | str, valid: Column) -> DataFrame:
    """J3 (reduce side): per key, the value of the first candidate (by ``pos``) that is valid.

    ``min_by`` combines map-side, so a key with very many candidates is
    reduced before the shuffle.
    """
    v = F.col(value) if isinstance(value, str) else value
    ordering = F.struct(*[F.col(p) for p in pos])
    return candidates.filter(valid).groupBy(key).agg(F.min_by(v, ordering).alias("first_value"))


def enrich_first_valid(df: DataFrame, key: str, candidates: DataFrame, cand_key: str, pos: Sequence[str], value, valid: Column) -> DataFrame:
    """Left join each row to the first valid candidate value of its key."""
    best = first_valid(candidates, cand_key, pos, value, valid).withColumnRenamed(cand_key, "__ck")
    return df.join(best, df[key] == best["__ck"], "left").drop("__ck")


def semi_join(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key appears in ``other`` (``isin`` a list from another table)."""
    ok = other_key or key
    o = other.select(F.col(ok).alias("__ok")).distinct()
    return df.join(o, df[key] == o["__ok"], "left_semi")


def label_to_wide(long: DataFrame, id_col: str, label_col: str, value_col: str, order: Sequence[str],
                  mapping: DataFrame, fields: Sequence[str], kind_col: str | None = None) -> DataFrame:
    """Map (kind, label) -> field with an inner join (unmatched labels drop out), then pivot
    to one column per field keeping the LAST value by ``order`` when a field repeats.

    ``fields`` is the known output schema, so the pivot needs no extra job to
    discover values. The mapping is a fixed dimension (tens of rows): broadcast.
    """
    keys = [label_col] if kind_col is None else [kind_col, label_col]
    j = long.join(F.broadcast(mapping), keys, "inner")
    ordering = F.struct(*[F.col(o) for o in order])
    return j.groupBy(id_col).pivot("field", list(fields)).agg(F.max_by(F.col(value_col), ordering))


def column_pairs(cols: Sequence[str]) -> list[tuple[str, str]]:
    """All i < j pairs of a column list (metadata-sized)."""
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def with_scalar(df: DataFrame, scalar_row: DataFrame) -> DataFrame:
    """Attach a one-row aggregate to every row (broadcast nested loop of one row)."""
    return df.crossJoin(F.broadcast(scalar_row))
