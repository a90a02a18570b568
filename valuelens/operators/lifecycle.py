"""Value-by-key curves.

The curve is an aggregate keyed by a small ordered integer (an age). All window
functions here run on that aggregate, whose size is the number of distinct keys,
never on raw rows; the heavy part is one grouped aggregate with map-side partial
aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuelens.functions.segment import right_closed_bins
from valuelens.operators.groupstats import np_round
from valuelens.operators.quantiles import with_quantiles


def centered_mean(col: str, order: Column | str, partition: list[str] | None = None, width: int = 3) -> Column:
    """Centered rolling mean over ``width`` (odd) rows; NULL unless all ``width`` values exist.

    Written as lag / lead terms added in row order and divided by ``width``:
    a missing neighbour (either end, or a NULL value) makes the sum NULL, and
    the arithmetic is the same in any engine.
    """
    half = width // 2
    w = Window.orderBy(order) if not partition else Window.partitionBy(*partition).orderBy(order)
    terms = [F.lag(col, k).over(w) for k in range(half, 0, -1)] + [F.col(col)] + [F.lead(col, k).over(w) for k in range(1, half + 1)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total / width


def key_stats(df: DataFrame, keys: list[str], value: str, approx: bool = False, with_std: bool = True) -> DataFrame:
    """Mean, median, std (n-1), count of ``value`` per key; rows with a NULL key or value are skipped.

    The median is exact, without a per-key value map (operators.quantiles), unless ``approx``."""
    src = df.select(*keys, value).dropna(subset=[*keys, value])
    aggs = [F.avg(value).alias("mean")]
    if approx:
        aggs.append(F.percentile_approx(value, 0.5, 10000).alias("median"))
    if with_std:
        aggs.append(F.stddev_samp(value).alias("std"))
    aggs.append(F.count(F.lit(1)).alias("count"))
    out = src.groupBy(*keys).agg(*aggs)
    if not approx:
        out = with_quantiles(out, src, keys, value, {"median": 0.5})
    return out.select(*keys, "mean", "median", *(["std"] if with_std else []), "count")


def value_curve(df: DataFrame, key: str, value: str, min_count: int | None = None, approx: bool = False) -> DataFrame:
    """Curve of ``value`` by ordered ``key``.

    Columns: key, mean, median, std, count, mean_smooth, median_smooth, cv,
    value_change, value_change_pct, acceleration. Changes are computed over all
    keys; ``min_count`` filters afterwards (W6), so it cannot move below the
    windows.
    """
    stats = key_stats(df, [key], value, approx)
    o = Window.orderBy(key)
    curve = (
        stats.withColumn("mean_smooth", centered_mean("mean", key))
        .withColumn("median_smooth", centered_mean("median", key))
        .withColumn("cv", F.try_divide(F.col("std"), F.col("mean")) * 100)
        .withColumn("value_change", F.col("mean") - F.lag("mean").over(o))
        .withColumn("value_change_pct", (F.try_divide(F.col("mean"), F.lag("mean").over(o)) - 1) * 100)
    )
    curve = curve.withColumn(
        "acceleration", F.col("value_change_pct") - F.lag("value_change_pct").over(o)
    )
    if min_count is not None:
        curve = curve.filter(F.col("count") >= min_count)
    return curve


def _argmax(key: str, metric: str) -> Column:
    # first key (smallest) wins on ties, as with idxmax over a key-sorted table
    return F.max_by(F.col(key), F.struct(F.col(metric), -F.col(key)))


def _argmin(key: str, metric: str) -> Column:
    return F.min_by(F.col(key), F.struct(F.col(metric), F.col(key)))


def prime_key(curve: DataFrame, key: str, min_count: int = 20) -> DataFrame:
    """Key with the highest mean, highest median, and highest mean among keys with count >= min_count."""
    reliable = F.col("count") >= min_count
    return curve.agg(
        _argmax(key, "mean").alias("prime_by_mean"),
        _argmax(key, "median").alias("prime_by_median"),
        F.max_by(F.when(reliable, F.col(key)), F.when(reliable, F.struct(F.col("mean"), -F.col(key)))).alias(
            "prime_reliable"
        ),
    )


def prime_key_by_group(df: DataFrame, group: str, key: str, value: str, min_count: int = 10, approx: bool = False) -> DataFrame:
    """Per group, the key with the largest mean among (group, key) cells with count >= min_count."""
    cells = key_stats(df, [group, key], value, approx, with_std=False).filter(F.col("count") >= min_count)
    return cells.groupBy(group).agg(
        _argmax(key, "mean").alias("prime_key"),
        F.max("mean").alias("prime_value"),
    )


def decline_start(curve: DataFrame, key: str) -> DataFrame:
    """W7 plus growth extremes over an already filtered curve.

    ``decline_start`` is the first key whose change and the next key's change
    are both negative; the last adjacent pair is not examined (scan stops at
    n-2). Growth / decline extremes need a positive / negative change to exist.
    """
    o = Window.orderBy(key)
    everything = Window.partitionBy()
    marked = (
        curve.select(key, "value_change_pct")
        .withColumn("rn", F.row_number().over(o))
        .withColumn("n_rows", F.count(F.lit(1)).over(everything))
        .withColumn("next_pct", F.lead("value_change_pct").over(o))
    )
    starts = (F.col("value_change_pct") < 0) & (F.col("next_pct") < 0) & (F.col("rn") <= F.col("n_rows") - 2)
    pos = F.col("value_change_pct") > 0
    neg = F.col("value_change_pct") < 0
    return marked.agg(
        F.min(F.when(starts, F.col(key))).alias("decline_start"),
        F.max_by(F.when(pos, F.col(key)), F.when(pos, F.struct(F.col("value_change_pct"), -F.col(key)))).alias(
            "max_growth_key"
        ),
        F.max(F.when(pos, F.col("value_change_pct"))).alias("max_growth_pct"),
        F.min_by(F.when(neg, F.col(key)), F.when(neg, F.struct(F.col("value_change_pct"), F.col(key)))).alias(
            "max_decline_key"
        ),
        F.min(F.when(neg, F.col("value_change_pct"))).alias("max_decline_pct"),
    )


def stability_rank(curve: DataFrame, key: str, min_count: int = 30) -> DataFrame:
    """A39 + T4: most stable / most volatile key by CV among keys with count >= min_count."""
    rel = curve.filter((F.col("count") >= min_count) & F.col("cv").isNotNull())
    return rel.agg(
        _argmin(key, "cv").alias("most_stable_key"),
        F.min("cv").alias("most_stable_cv"),
        F.max_by(F.col(key), F.struct(F.col("cv"), F.col(key))).alias("most_volatile_key"),
        F.max("cv").alias("most_volatile_cv"),
        F.avg("cv").alias("mean_cv"),
        F.median("cv").alias("median_cv"),
    )


# Life-cycle phases (right-closed bins on the key) and labels.
PHASE_EDGES = [0, 21, 25, 29, 100]
PHASE_LABELS = ["Developing (≤21)", "Peak Entry (22-25)", "Prime Peak (26-29)", "Decline (30+)"]


def phase_summary(curve: DataFrame, key: str, edges=PHASE_EDGES, labels=PHASE_LABELS) -> DataFrame:
    """F26 + A17: mean of key means, mean of key medians, total count per phase, rounded to 2."""
    phased = curve.select(
        F.col("mean"), F.col("median"), F.col("count"),
        right_closed_bins(F.col(key), edges, labels).alias("phase"),
        right_closed_bins(F.col(key), edges, list(range(len(labels)))).alias("phase_ord"),
    ).filter(F.col("phase").isNotNull())
    return phased.groupBy("phase", "phase_ord").agg(
        np_round(F.avg("mean"), 2).alias("avg_value"),
        np_round(F.avg("median"), 2).alias("median"),
        F.sum("count").alias("count"),
    )


def phase_roi(summary: DataFrame) -> DataFrame:
    """Return from each observed phase to the next one, in phase order."""
    o = Window.orderBy("phase_ord")
    nxt = summary.select(
        F.col("phase").alias("buy_phase"),
        F.lead("phase").over(o).alias("sell_phase"),
        F.col("avg_value").alias("buy_value"),
        F.lead("avg_value").over(o).alias("sell_value"),
    )
    return nxt.filter(F.col("sell_phase").isNotNull()).withColumn(
        "roi_pct", F.try_divide(F.col("sell_value") - F.col("buy_value"), F.col("buy_value")) * 100
    )
