"""Multi-label keyword themes (A37) and sign / threshold counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def theme_counts(df: DataFrame, text_col: str, themes: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Per theme, how many rows contain any of its keywords (case-insensitive substring).

    A row may count in several themes; themes matching nothing are dropped;
    ``share_pct`` is the theme's share of all theme hits. One projection of
    boolean flags over the whole text (lower-cased once) and one aggregate:
    no keyword x row expansion.
    """
    t = F.lower(F.col(text_col))
    lowered = df.select(t.alias("__t"))
    flags = []
    for name, kws in themes:
        cond = None
        for k in kws:
            c = F.col("__t").contains(k)
            cond = c if cond is None else (cond | c)
        flags.append(F.count_if(cond).alias(f"__n_{name}"))
    summary = lowered.agg(*flags)
    structs = [
        F.struct(F.lit(name).alias("theme"), F.lit(i).alias("theme_ord"), F.col(f"__n_{name}").alias("n_items"))
        for i, (name, _) in enumerate(themes)
    ]
    long = summary.select(F.inline(F.array(*structs))).filter(F.col("n_items") > 0)
    return long.withColumn("share_pct", F.col("n_items") * 100.0 / F.sum("n_items").over(Window.partitionBy()))


def sign_counts(target_corr: DataFrame, pos: float = 0.2, neg: float = -0.2) -> DataFrame:
    """Number of features with r > pos and with r < neg."""
    return target_corr.agg(
        F.count_if(F.col("corr") > pos).alias("n_positive"), F.count_if(F.col("corr") < neg).alias("n_negative")
    )


def head_and_tail(ranked: DataFrame, rank_col: str = "rank", top: int = 20, k: int = 3) -> DataFrame:
    """The first ``k`` and the last ``k`` of the top ``top`` ranked features, labelled
    'head' / 'tail' (the tail is the weakest of the top list, not the most negative r)."""
    top_rows = ranked.filter(F.col(rank_col) <= top)
    n = top_rows.agg(F.max(rank_col).alias("__m"))
    j = top_rows.crossJoin(F.broadcast(n))
    head = j.filter(F.col(rank_col) <= k).withColumn("part", F.lit("head"))
    tail = j.filter(F.col(rank_col) > F.col("__m") - k).withColumn("part", F.lit("tail"))
    return head.unionByName(tail).drop("__m")
