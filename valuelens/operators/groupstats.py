"""Group comparison.

Grouped statistics are one ``groupBy().agg()`` each (partial aggregation
map-side); the follow-up window functions run on the per-group result, whose
size is the number of groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuelens.operators.quantiles import with_quantiles

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def np_round(c: Column, digits: int) -> Column:
    """Round the scaled binary value (numpy / pandas ``.round`` semantics; exact .5 ties go up)."""
    m = float(10**digits)
    r = F.round(c * m, 0)
    return F.when(r == 0, c * 0.0).otherwise(r / m)


def py_round(c: Column, digits: int) -> Column:
    """Python ``round``: half-to-even on the scaled value."""
    m = float(10**digits)
    return F.bround(c * m, 0) / m


def group_stats_quartiles(df: DataFrame, group: str, value: str, round_inputs: int | None = 2, approx: bool = False) -> DataFrame:
    """Size, min, Q1, median, mean, Q3, max, std (n-1) per group; IQR and CV % derived.

    With ``round_inputs`` the eight statistics are rounded first and IQR / CV
    are computed from the rounded values (the reference's order of
    operations). ``size`` counts rows, including those whose value is NULL.
    """
    aggs = [F.count(F.lit(1)).alias("size"), F.min(value).cast("double").alias("min"),
            F.avg(value).alias("mean"), F.max(value).cast("double").alias("max"), F.stddev_samp(value).alias("std")]
    if approx:
        q = F.percentile_approx(value, [0.25, 0.5, 0.75], 10000).cast("array<double>")
        g = df.groupBy(group).agg(*aggs, q.alias("__q")).withColumns(
            {n: F.col("__q")[i] for i, n in enumerate(("q1", "median", "q3"))})
    else:
        g = with_quantiles(df.groupBy(group).agg(*aggs), df, [group], value, QUARTILES)
    g = g.select(group, "size", "min", "q1", "median", "mean", "q3", "max", "std")
    if round_inputs is not None:
        for c in ["min", "q1", "median", "mean", "q3", "max", "std"]:
            g = g.withColumn(c, np_round(F.col(c), round_inputs))
    g = g.withColumn("iqr", np_round(F.col("q3") - F.col("q1"), 2))
    return g.withColumn("cv_pct", np_round(F.try_divide(F.col("std"), F.col("mean")) * 100, 1))


def pct_of_top(group_stats: DataFrame, col: str = "median", digits: int = 1) -> DataFrame:
    """Each group's ``col`` as % of the best group's (the maximum over the per-group table)."""
    best = Window.partitionBy()  # per-group table: one row per group
    return group_stats.withColumn("pct_vs_top", np_round(F.col(col) / F.max(col).over(best) * 100, digits))


def rank_desc(df: DataFrame, col: str, tiebreak: Sequence[str], name: str = "rank") -> DataFrame:
    """1..n numbering by ``col`` descending (ties by ``tiebreak``) over a small summary table."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(F.col(col).desc_nulls_last(), *tiebreak)))


def top_k(df: DataFrame, col: str, k: int, tiebreak: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """K rows with the largest (or smallest) ``col``; a total order makes ties deterministic.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top k, only k rows per task reach the final merge.
    """
    o = F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()
    return df.orderBy(o, *[F.col(t) for t in tiebreak]).limit(k)


def mean_above_mean(group_stats: DataFrame, col: str = "median") -> DataFrame:
    """P16 (groups above the mean of group medians)."""
    w = Window.partitionBy()
    return group_stats.withColumn("__m", F.avg(col).over(w)).filter(F.col(col) > F.col("__m")).drop("__m")


def mode_value(col: str) -> Column:
    """Most frequent non-null value; smallest among ties."""
    return F.mode(F.col(col), True)


def cv_pct(std: Column, mean: Column) -> Column:
    """Std / mean * 100 (NULL when mean is 0)."""
    return F.try_divide(std, mean) * 100


def domain_complete(labels: DataFrame, label_col: str, stats: DataFrame, fill: dict[str, object]) -> DataFrame:
    """Every label of the category domain appears; empty categories get ``fill`` values.

    ``labels`` is the category dimension (one row per label)."""
    out = labels.join(stats, label_col, "left")
    return out.fillna(fill)


def facet_values(df: DataFrame, col: str, all_label: str | None = "All") -> DataFrame:
    """T5: sorted distinct non-null values of a facet, after one 'All' entry if wanted (a value of that name is not listed twice)."""
    vals = df.select(F.col(col).cast("string").alias("value")).filter(F.col("value").isNotNull())
    if all_label is None:
        return vals.distinct().orderBy("value")
    vals = vals.unionByName(df.sparkSession.range(1).select(F.lit(all_label).alias("value"))).distinct()
    return vals.orderBy(F.col("value") != all_label, "value")


def facet_options(df: DataFrame, facets: dict[str, object], all_label: str = "All") -> DataFrame:
    """T5: the options of dependent facets: (facet, ord, value, n), sorted by facet, 'All' first, then by value.

    ``facets`` gives the facets in order with what is selected (None or ``all_label``: nothing). A facet offers the
    non-null values of the rows that the selections of the facets before it leave, with their numbers; 'All' counts these rows.
    One pass: a row gives one (facet, value) cell per facet whose earlier selections it meets; cells are counted in every
    task before they are shuffled.
    """
    cells, left = [], F.lit(True)
    for i, (col, chosen) in enumerate(facets.items()):
        value = F.col(col).cast("string")
        cells += [F.when(left, F.struct(F.lit(col).alias("facet"), F.lit(i).alias("ord"), F.lit(True).alias("all"), F.lit(all_label).alias("value"))),
                  F.when(left & value.isNotNull() & (value != all_label), F.struct(F.lit(col).alias("facet"), F.lit(i).alias("ord"), F.lit(False).alias("all"), value.alias("value")))]
        if chosen is not None and chosen != all_label:
            left = left & F.coalesce(F.col(col) == F.lit(chosen), F.lit(False))
    flat = df.select(F.inline(F.filter(F.array(*cells), lambda c: c.isNotNull())))
    return flat.groupBy("facet", "ord", "all", "value").agg(F.count(F.lit(1)).alias("n")).orderBy("ord", ~F.col("all"), "value").drop("all")


def facet_filter(df: DataFrame, facets: dict[str, object], all_label: str = "All") -> DataFrame:
    """Fold of optional equality filters; a facet set to ``all_label`` (or None) is skipped."""
    out = df
    for col, val in facets.items():
        if val is None or val == all_label:
            continue
        out = out.filter(F.col(col) == F.lit(val))
    return out
