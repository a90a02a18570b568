"""Feature engineering and encoding (F14-F25, M1-M10) as fit / transform steps.

*fit* returns a small plan table (medians, codes, chosen columns) computed in
one aggregate; *transform* applies it lazily with joins / column expressions,
so the same plan serves batch and streaming input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuelens.operators.groupstats import py_round
from valuelens.operators.profile import moments


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- scalar feature expressions (F14-F25, F29, F30) ----------------------------------------------

def guarded_ratio(num: Column | str, den: Column | str, zero_to: float) -> Column:
    """Num / den with a zero denominator replaced by ``zero_to``; NULL stays NULL."""
    d = _c(den)
    return _c(num) / F.when(d == 0, F.lit(zero_to)).otherwise(d)


def per90_rate(total: Column | str, minutes: Column | str, existing: Column | str | None = None, digits: int = 2) -> Column:
    """total / (minutes / 90) rounded, only when minutes > 0 and total > 0; otherwise keep ``existing``."""
    t, m = _c(total), _c(minutes)
    keep = _c(existing) if existing is not None else F.lit(None).cast("double")
    return F.when((m > 0) & (t > 0), py_round(t / (m / 90.0), digits)).otherwise(keep)


def minutes_per_game(minutes: Column | str, apps: Column | str, existing: Column | str | None = None) -> Column:
    """round(minutes / max(1, apps), 1) when both are non-zero."""
    m, a = _c(minutes), _c(apps)
    keep = _c(existing) if existing is not None else F.lit(None).cast("double")
    return F.when((m != 0) & (a != 0), py_round(m / F.greatest(F.lit(1), a), 1)).otherwise(keep)


def total_from_rate(rate: Column | str, minutes: Column | str, total: Column | str | None = None) -> Column:
    """int(round(rate * minutes / 90)) when the total is missing or 0 and minutes > 0."""
    r, m = _c(rate), _c(minutes)
    cur = _c(total) if total is not None else F.lit(None).cast("bigint")
    need = (cur.isNull() | (cur == 0)) & r.isNotNull() & (m > 0)
    return F.when(need, F.bround(r * (m / 90.0), 0).cast("bigint")).otherwise(cur)


def rate_or_zero(num: Column | str, minutes: Column | str) -> Column:
    """num per 90 minutes; NULL / infinite -> 0."""
    return F.coalesce(F.try_divide(_c(num), _c(minutes) / 90.0), F.lit(0.0))


def weighted_score(cols_weights: Sequence[tuple[str, float]]) -> Column:
    """sum(w * coalesce(c, 0)) / sum(w)."""
    total = sum(w for _, w in cols_weights)
    expr = None
    for c, w in cols_weights:
        term = F.coalesce(F.col(c), F.lit(0.0)) * w
        expr = term if expr is None else expr + term
    return expr / total


def finishing_metrics(df: DataFrame, shots90: str, minutes: str, goals: str, xg90: str, sot_pct: str) -> DataFrame:
    """F25 (+ P21): shots_total, conversion_rate, xg_total, xg_overperformance, shot_accuracy."""
    g = F.coalesce(F.col(goals).cast("double"), F.lit(0.0))
    out = df.withColumn("shots_total", F.coalesce(F.col(shots90) * (F.col(minutes) / 90.0), F.lit(0.0)))
    out = out.withColumn("conversion_rate", F.when(F.col("shots_total") > 0, g / F.col("shots_total") * 100).otherwise(0.0))
    out = out.withColumn(
        "xg_total", F.coalesce(F.col(xg90), F.lit(0.0)) * (F.coalesce(F.col(minutes).cast("double"), F.lit(0.0)) / 90.0)
    )
    out = out.withColumn(
        "xg_overperformance", F.when(F.col("xg_total") > 0, (g - F.col("xg_total")) / F.col("xg_total") * 100).otherwise(0.0)
    )
    return out.withColumn("shot_accuracy", F.coalesce(F.col(sot_pct), F.lit(0.0)))


def diff_and_pct(pred: Column | str, actual: Column | str) -> tuple[Column, Column]:
    """pred - actual and its % of actual (only when actual > 0)."""
    p, a = _c(pred), _c(actual)
    return p - a, F.when(a > 0, (p - a) / a * 100)


def residual_and_pct(actual: Column | str, pred: Column | str) -> tuple[Column, Column]:
    """actual - predicted and residual / predicted * 100."""
    r = _c(actual) - _c(pred)
    return r, F.try_divide(r, _c(pred)) * 100


def engineered(df: DataFrame) -> DataFrame:
    """F16-F20 on player columns, each only when its inputs exist (column-presence guarded)."""
    have = set(df.columns)
    out = df
    if {"goals_per_90", "shots_per90"} <= have:
        out = out.withColumn("conversion_rate", guarded_ratio("goals_per_90", "shots_per90", 0.01))
    if {"key_passes_per90", "passes_completed_per90"} <= have:
        out = out.withColumn("key_pass_ratio", guarded_ratio("key_passes_per90", "passes_completed_per90", 0.01))
    if {"interceptions_per90", "blocks_per90"} <= have:
        out = out.withColumn("defensive_contribution", F.col("interceptions_per90") + F.col("blocks_per90"))
    if {"progressive_passes_per90", "progressive_carries_per90"} <= have:
        out = out.withColumn("total_progressive", F.col("progressive_passes_per90") + F.col("progressive_carries_per90"))
    if {"age", "minutes_played"} <= have:
        out = out.withColumn("age_experience", F.col("age") * F.log1p("minutes_played"))
    if {"minutes_played", "appearances"} <= have:
        out = out.withColumn("minutes_per_game", guarded_ratio("minutes_played", "appearances", 1))
    for c in ["goals", "assists", "minutes_played"]:
        if c in have:
            out = out.withColumn(f"{c}_squared", F.pow(F.col(c), 2))
    return out


# --- M1 / M2 / M3 ---------------------------------------------------------------------------------

def fit_impute(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], approx: bool = False) -> DataFrame:
    """M1 + M2 fit: the exact median of each numeric column and the mode (smallest among ties)
    of each categorical column. Returns a one-row plan table.

    Both come from the long (column, value) form, so no column's values meet in one task."""
    from valuelens.operators.profile import numeric_long
    from valuelens.operators.quantiles import exact_percentiles

    numeric, categorical = list(numeric), list(categorical)
    pick = lambda t, c, v: F.max(F.when(F.col("column_name") == c, F.col(v))).alias(c)
    parts = []
    if numeric:
        if approx:
            parts.append(df.agg(*[F.percentile_approx(F.col(f"`{c}`"), 0.5, 10000).alias(c) for c in numeric]))
        else:
            med = exact_percentiles(numeric_long(df, numeric), ["column_name"], "x", [0.5])
            parts.append(med.agg(*[pick(med, c, "q") for c in numeric]))
    if categorical:
        cells = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in categorical]))).where("v is not null")
        top = cells.groupBy("column_name", "v").count().groupBy("column_name").agg(
            F.min_by("v", F.struct(-F.col("count"), F.col("v"))).alias("mode"))
        parts.append(top.agg(*[pick(top, c, "mode") for c in categorical]))
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(F.broadcast(p))  # one row each
    return out


def transform_impute(df: DataFrame, plan: DataFrame, unknown: str = "Unknown") -> DataFrame:
    """M1 + M2 transform: coalesce each column with its fitted fill (one-row plan, broadcast)."""
    fills = plan.select(*[F.col(c).alias(f"__fill_{c}") for c in plan.columns])
    j = df.crossJoin(F.broadcast(fills))
    cols = []
    for c in df.columns:
        if c in plan.columns:
            fill = F.col(f"__fill_{c}")
            if dict(plan.dtypes)[c] == "string":
                fill = F.coalesce(fill, F.lit(unknown))
            cols.append(F.coalesce(F.col(c), fill).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def fit_prune_sparse(df: DataFrame, max_null_pct: float = 50.0, cols: Sequence[str] | None = None) -> DataFrame:
    """M3 fit: null % per column and whether it is dropped (null % > max_null_pct)."""
    from valuelens.operators.profile import null_profile

    return null_profile(df, cols).withColumn("dropped", (F.col("null_pct") > max_null_pct).cast("int"))


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop, ignoring absent names."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present)


# --- M4 -------------------------------------------------------------------------------------------

def fit_auto_log(df: DataFrame, exclude: Sequence[str] = (), threshold: float = 1.0) -> DataFrame:
    """M4 fit: numeric columns (not excluded) with abs(sample skewness G1) > threshold."""
    from valuelens.operators.profile import numeric_columns

    cols = [c for c in numeric_columns(df) if c not in exclude and not c.startswith("is_")]
    m = moments(df, cols)
    return m.select("column_name", "skew", F.coalesce(F.abs("skew") > threshold, F.lit(False)).cast("int").alias("selected"))


def transform_auto_log(df: DataFrame, selected: Sequence[str]) -> DataFrame:
    """M4 transform: add ``{c}_log = log1p(c)`` for the selected columns."""
    return df.withColumns({f"{c}_log": F.log1p(F.col(c)) for c in selected})


# --- M5 / M6 / M7 ---------------------------------------------------------------------------------

def fit_frequency(df: DataFrame, col: str) -> DataFrame:
    """M5 fit: (value, count) over the fitting table; NULL values are not counted."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(f"{col}_freq"))


def transform_frequency(df: DataFrame, col: str, codes: DataFrame, default: int | None = None) -> DataFrame:
    """M5 transform: left join on the value. The code table has one row per distinct value; AQE
    broadcasts it when measured small, otherwise it is a shuffle join."""
    out = df.join(codes, col, "left")
    if default is not None:
        out = out.fillna({f"{col}_freq": default})
    return out


def fit_label_codes(df: DataFrame, col: str) -> DataFrame:
    """M6 fit: lexicographic code 0..k-1 of the distinct values (text form, NULL as 'nan').

    The code is each distinct value's position in sorted order, computed by
    range partitioning + per-partition offsets (no single-task window over
    all distinct values, which can be as many as the rows)."""
    from valuelens.operators.dedupe import position_in_group

    vals = df.select(F.coalesce(F.col(col).cast("string"), F.lit("nan")).alias(col)).distinct()
    return position_in_group(vals, [], [col], f"{col}_label_enc").withColumn(
        f"{col}_label_enc", F.col(f"{col}_label_enc").cast("int"))


def transform_label_codes(df: DataFrame, col: str, codes: DataFrame, unseen: int = -1) -> DataFrame:
    key = F.coalesce(F.col(col).cast("string"), F.lit("nan"))
    out = df.withColumn("__lk", key).join(codes.withColumnRenamed(col, "__lk"), "__lk", "left").drop("__lk")
    return out.fillna({f"{col}_label_enc": unseen})


def fit_target_codes(train: DataFrame, col: str, target: str, fold: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M7 fit. Returns (out-of-fold codes per (category, fold), full-train codes per category, overall mean).

    Closed form of the fold loop: the code of a row in fold f is
    (S_cat - S_cat,f) / (N_cat - N_cat,f), i.e. the category mean over the
    other folds; undefined when the category occurs in no other fold.
    """
    # one scan of the training rows: (category, fold) sums, NULL category included so that the
    # overall mean (fallback code) comes from the same small table
    cf = train.groupBy(col, fold).agg(F.sum(target).alias("s_cf"), F.count(target).alias("n_cf"))
    overall = cf.agg((F.sum("s_cf") / F.sum("n_cf")).alias("overall_mean"))
    cf = cf.filter(F.col(col).isNotNull())
    c = cf.groupBy(col).agg(F.sum("s_cf").alias("s_c"), F.sum("n_cf").alias("n_c"))
    oof = cf.join(c, col).select(
        col, fold, F.try_divide(F.col("s_c") - F.col("s_cf"), (F.col("n_c") - F.col("n_cf")).cast("double")).alias("oof_code")
    )
    full = c.select(col, (F.col("s_c") / F.col("n_c")).alias("full_code"))
    return oof, full, overall


def transform_target_oof(train: DataFrame, col: str, fold: str, oof: DataFrame, overall: DataFrame, out: str | None = None) -> DataFrame:
    out = out or f"{col}_target_enc"
    j = train.join(oof, [col, fold], "left").crossJoin(F.broadcast(overall))
    return j.withColumn(out, F.coalesce(F.col("oof_code"), F.col("overall_mean"))).drop("oof_code", "overall_mean")


def transform_target_by_split(df: DataFrame, col: str, fold: str, split: str, oof: DataFrame, full: DataFrame,
                              overall: DataFrame, train_value: str = "train", out: str | None = None) -> DataFrame:
    """M7 in one pass over all rows: training rows get their out-of-fold code, other splits the
    full-train code; the code tables have one row per (category, fold) / category."""
    out = out or f"{col}_target_enc"
    j = df.join(oof, [col, fold], "left").join(full, col, "left").crossJoin(F.broadcast(overall))
    code = F.when(F.col(split) == train_value, F.col("oof_code")).otherwise(F.col("full_code"))
    return j.withColumn(out, F.coalesce(code, F.col("overall_mean"))).drop("oof_code", "full_code", "overall_mean")


def transform_target_full(df: DataFrame, col: str, full: DataFrame, overall: DataFrame, out: str | None = None) -> DataFrame:
    out = out or f"{col}_target_enc"
    j = df.join(full, col, "left").crossJoin(F.broadcast(overall))
    return j.withColumn(out, F.coalesce(F.col("full_code"), F.col("overall_mean"))).drop("full_code", "overall_mean")


# --- M8 / P20 -------------------------------------------------------------------------------------

def standardize_pop(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """M8: (x - mean) / population std with NULLs read as 0 (one aggregate, broadcast 1-row plan)."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    stats = df.agg(*[F.avg(e).alias(f"__m_{c}") for c, e in filled.items()],
                   *[F.stddev_pop(e).alias(f"__s_{c}") for c, e in filled.items()])
    j = df.crossJoin(F.broadcast(stats))
    out = j.withColumns({f"{c}{suffix}": F.try_divide(filled[c] - F.col(f"__m_{c}"), F.col(f"__s_{c}")) for c in cols})
    return out.drop(*[f"__m_{c}" for c in cols], *[f"__s_{c}" for c in cols])


def percentile_trim(df: DataFrame, col: str, lo: float = 0.01, hi: float = 0.99, approx: bool = False) -> DataFrame:
    """P20: keep rows with p_lo <= col <= p_hi (inclusive; exact linear percentiles by default)."""
    if approx:
        b = df.agg(F.percentile_approx(col, [lo, hi], 10000).alias("__b")).select(
            F.col("__b")[0].cast("double").alias("__lo"), F.col("__b")[1].cast("double").alias("__hi"))
    else:
        from valuelens.operators.quantiles import quantile_columns

        b = quantile_columns(df, [], col, {"__lo": lo, "__hi": hi})
    return df.crossJoin(F.broadcast(b)).filter(F.col(col).between(F.col("__lo"), F.col("__hi"))).drop("__lo", "__hi")
