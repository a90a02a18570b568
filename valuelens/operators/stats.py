"""Correlation, significance, ANOVA, VIF, fits, metrics, histograms, box plots.

Every statistic is a single aggregate over the data (sums / moments combined
map-side), then closed-form arithmetic on the small summary. Where a k x k
matrix has to be inverted (VIF) it happens inside one Arrow task over the
one-row summary, not on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from valuelens.functions.segment import strength_label
from valuelens.session import ship_package


def _q(c: str) -> str:
    return f"`{c}`"


# --- A18 --------------------------------------------------------------------------------------

def pair_moments(a: str, b: str) -> dict[str, Column]:
    """Aggregates for a pairwise-complete Pearson r of columns a, b."""
    x, y = F.col(_q(a)), F.col(_q(b))
    both = x.isNotNull() & y.isNotNull()
    xa, yb = F.when(both, x), F.when(both, y)
    return {
        "n": F.count_if(both),
        "cov": F.covar_samp(xa, yb),
        "sx": F.stddev_samp(xa),
        "sy": F.stddev_samp(yb),
    }


def safe_corr(a: str, b: str) -> Column:
    """Pearson r over rows where both are non-null; NULL (not an error) when either side is constant."""
    m = pair_moments(a, b)
    return F.try_divide(m["cov"], m["sx"] * m["sy"])


def corr_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    m = pair_moments(a, b)
    return df.agg(m["n"].alias("n"), F.try_divide(m["cov"], m["sx"] * m["sy"]).alias("corr"))


# --- A19 --------------------------------------------------------------------------------------

def corr_matrix_long(df: DataFrame, cols: Sequence[str], include_diagonal: bool = False) -> DataFrame:
    """Long correlation matrix (col_1, col_2, n, corr) for every pair i < j.

    One route for any number of columns: Arrow batches stream through
    ``mapInPandas``, where masked moment sums of all pairs come from four
    matrix products per batch and are added up per partition; ``groupBy(i, j)``
    sums the partitions. NaN counts as NULL: a pair uses the rows where both
    values are numbers; r is NaN if one of these is infinite.
    """
    cols = list(cols)
    if len(cols) < 2:
        out = df.sparkSession.createDataFrame([], "col_1 string, col_2 string, n bigint, corr double")
    else:
        out = _corr_by_moments(df, cols)
    if include_diagonal:
        diag = df.agg(*[F.count(_q(c)).alias(f"__d{i}") for i, c in enumerate(cols)]).select(
            F.inline(F.array(*[
                F.struct(F.lit(c).alias("col_1"), F.lit(c).alias("col_2"), F.col(f"__d{i}").alias("n"),
                         F.when(F.col(f"__d{i}") > 1, F.lit(1.0)).alias("corr"))
                for i, c in enumerate(cols)
            ]))
        )
        out = out.unionByName(diag)
    return out


def _shifted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns c0, c1, ... as doubles less their means (NaN read as NULL), for stable sums; a one-row broadcast.
    Infinities do not enter the means and stay infinite."""
    x = [F.nanvl(F.col(_q(c)).cast("double"), F.lit(None).cast("double")) for c in cols]
    means = df.agg(*[F.coalesce(F.avg(F.when(F.abs(e) < float("inf"), e)), F.lit(0.0)).alias(f"__m{i}") for i, e in enumerate(x)])
    return df.crossJoin(F.broadcast(means)).select(*[(e - F.col(f"__m{i}")).alias(f"c{i}") for i, e in enumerate(x)])


def _corr_by_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    k = len(cols)
    iu, ju = np.triu_indices(k, 1)

    def sums_of_partition(it):
        total = None
        for pdf in it:
            x = pdf.to_numpy(dtype=float, na_value=np.nan)
            m = ~np.isnan(x)
            wild = np.isinf(x).astype(float)
            x0, mf = np.where(np.isfinite(x), x, 0.0), m.astype(float)
            # n, sums of x_i where x_j is there, sums of squares likewise, products, rows of a pair with an infinity
            part = np.stack([mf.T @ mf, x0.T @ mf, (x0 * x0).T @ mf, x0.T @ x0, wild.T @ mf + mf.T @ wild])
            total = part if total is None else total + part
        if total is not None:
            n, s1, s2, p, bad = total
            yield pd.DataFrame({
                "i": iu, "j": ju, "n": n[iu, ju], "sx": s1[iu, ju], "sy": s1[ju, iu],
                "sxx": s2[iu, ju], "syy": s2[ju, iu], "sxy": p[iu, ju], "bad": bad[iu, ju],
            })

    sums = _shifted(df, cols).mapInPandas(
        sums_of_partition, "i long, j long, n double, sx double, sy double, sxx double, syy double, sxy double, bad double"
    ).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ["n", "sx", "sy", "sxx", "syy", "sxy", "bad"]])
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    vx = n * F.col("sxx") - sx * sx
    vy = n * F.col("syy") - sy * sy
    cov = n * F.col("sxy") - sx * sy
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(
        names[F.col("i").cast("int")].alias("col_1"),
        names[F.col("j").cast("int")].alias("col_2"),
        n.cast("bigint").alias("n"),
        F.when(F.col("bad") > 0, F.lit(float("nan"))).when((vx > 0) & (vy > 0) & (n > 1), cov / F.sqrt(vx * vy)).alias("corr"),
    )


def high_corr_pairs(corr_long: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Pairs with abs(r) > threshold."""
    return corr_long.filter(F.abs(F.col("corr")) > threshold)


# --- A22 / A23 / A24 --------------------------------------------------------------------------

def target_correlations(df: DataFrame, features: Sequence[str], target: str, min_n: int | None = None) -> DataFrame:
    """(feature, n, corr, abs_corr, r2, direction, strength) of each feature with the target.

    One grouped aggregate over the long (feature, x, y) form for any number of features; NaN counts
    as NULL. With ``min_n`` a feature whose jointly non-null count is <= min_n gets no
    correlation and is marked ``missing``.
    """
    number = lambda c: F.nanvl(F.col(_q(c)).cast("double"), F.lit(None).cast("double"))
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), number(c).alias("x")) for c in features])
    long = df.select(number(target).alias("y"), F.inline(cells)) if features else None
    if long is None:
        out = df.sparkSession.createDataFrame([], "feature string, n bigint, corr double")
    else:
        m = pair_moments("x", "y")
        out = long.groupBy("feature").agg(m["n"].alias("n"), F.try_divide(m["cov"], m["sx"] * m["sy"]).alias("corr"))
    if min_n is not None:
        out = out.withColumn("missing", F.col("n") <= min_n).withColumn(
            "corr", F.when(~F.col("missing"), F.col("corr"))
        )
    return (
        out.withColumn("abs_corr", F.abs("corr"))
        .withColumn("r2", F.col("corr") * F.col("corr"))
        .withColumn("direction", F.when(F.col("corr") > 0, "positive").when(F.col("corr") < 0, "negative"))
        .withColumn("strength", strength_label("corr"))
    )


def low_corr_drop_list(target_corr: DataFrame, threshold: float = 0.03) -> DataFrame:
    """Features with abs(r) < threshold; an undefined r is kept (not dropped)."""
    return target_corr.filter(F.abs(F.col("corr")) < threshold).select("feature", "corr")


def select_features(target_corr: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Features with abs(r) > threshold; an undefined r counts as 0 and is rejected."""
    return target_corr.filter(F.coalesce(F.abs(F.col("corr")), F.lit(0.0)) > threshold).select("feature", "corr")


def redundant_drop_list(pairs: DataFrame, target_corr: DataFrame) -> DataFrame:
    """For each high pair drop the member less correlated with the target.

    A feature missing from the target table (too few rows) counts as 0; on a
    tie, or when a correlation is undefined, the second column is dropped. Each
    pair is decided on its own, so the result is the distinct set of losers.
    """
    t = target_corr.select(F.col("feature"), F.col("corr").alias("tc"), F.col("missing") if "missing" in target_corr.columns else F.lit(False).alias("missing"))
    t1 = t.select(F.col("feature").alias("col_1"), F.col("tc").alias("t1"), F.col("missing").alias("m1"))
    t2 = t.select(F.col("feature").alias("col_2"), F.col("tc").alias("t2"), F.col("missing").alias("m2"))
    j = pairs.select("col_1", "col_2").join(F.broadcast(t1), "col_1", "left").join(F.broadcast(t2), "col_2", "left")
    a1 = F.when(F.coalesce(F.col("m1"), F.lit(True)), F.lit(0.0)).otherwise(F.abs("t1"))
    a2 = F.when(F.coalesce(F.col("m2"), F.lit(True)), F.lit(0.0)).otherwise(F.abs("t2"))
    drop = F.when(a1 < a2, F.col("col_1")).otherwise(F.col("col_2"))
    return j.select(drop.alias("feature")).distinct()


# --- A25 --------------------------------------------------------------------------------------

def derived_column_check(df: DataFrame, checks: Sequence[tuple[str, Column, float]], min_n: int = 10) -> DataFrame:
    """r(stored column, recomputed expression) above a threshold with n > min_n marks it derived."""
    aggs = []
    for i, (name, expr, _thr) in enumerate(checks):
        tmp = f"__e{i}"
        both = F.col(_q(name)).isNotNull() & expr.isNotNull()
        x, y = F.when(both, F.col(_q(name))), F.when(both, expr)
        aggs += [
            F.count_if(both).alias(f"__n{i}"),
            F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)).alias(f"__r{i}"),
        ]
    summary = df.agg(*aggs)
    structs = [
        F.struct(
            F.lit(name).alias("column_name"), F.col(f"__n{i}").alias("n"), F.col(f"__r{i}").alias("corr"),
            F.lit(float(thr)).alias("threshold"),
            F.coalesce((F.col(f"__r{i}") > thr) & (F.col(f"__n{i}") > min_n), F.lit(False)).cast("int").alias("is_derived"),
        )
        for i, (name, _e, thr) in enumerate(checks)
    ]
    return summary.select(F.inline(F.array(*structs)))


# --- A26 --------------------------------------------------------------------------------------

def vif(df: DataFrame, cols: Sequence[str], min_rows: int | None = None) -> DataFrame:
    """Variance inflation without intercept over complete rows: VIF_i = G_ii * inv(G)_ii, G = X'X.

    Any number of columns: partitions add up their cross products in arrays (the plan does not
    grow with k), one grouped sum joins them, and one Arrow task inverts the k x k matrix of the
    columns scaled to unit length.
    """
    cols = list(cols)
    k = len(cols)
    complete = df.select(*[F.nanvl(F.col(_q(c)).cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)]).dropna()
    iu, ju = np.triu_indices(k)

    def products(it):
        total, rows = np.zeros((k, k)), 0
        for pdf in it:
            x = pdf.to_numpy(dtype=float)
            total += x.T @ x
            rows += len(x)
        if rows:
            yield pd.DataFrame({"i": iu, "j": ju, "g": total[iu, ju], "n": np.full(len(iu), rows)})

    summed = complete.mapInPandas(products, "i int, j int, g double, n long").groupBy("i", "j").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
    summary = summed.agg(F.collect_list(F.struct("i", "j", "g")).alias("cells"), F.coalesce(F.max("n"), F.lit(0)).alias("rows"))

    def invert(it):
        for pdf in it:
            for cells, rows in zip(pdf["cells"], pdf["rows"]):
                if rows == 0 or (min_rows is not None and rows <= min_rows):
                    continue  # too few complete rows: no report
                g = np.zeros((k, k))
                for c in cells:
                    g[c["i"], c["j"]] = g[c["j"], c["i"]] = c["g"]
                size = np.sqrt(np.diag(g))
                try:
                    v = np.diag(np.linalg.inv(g / np.outer(size, size)))
                except np.linalg.LinAlgError:
                    v = np.full(k, np.inf)
                yield pd.DataFrame({"column_name": cols, "vif": v})

    out = summary.mapInPandas(invert, "column_name string, vif double")
    return out.withColumn(
        "band", F.when(F.col("vif") > 100, "severe").when(F.col("vif") > 50, "high").when(F.col("vif") > 10, "moderate").otherwise("ok")
    )


# --- A27 / A28: p-values -------------------------------------------------------------------------

def _betacf(a, b, x, iters=300):
    """Continued fraction for the regularized incomplete beta (vectorised, Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < tiny, tiny, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        de = d * c
        h *= de
        if np.all(np.abs(de - 1.0) < 1e-15):
            break
    return h


def betainc_reg(a, b, x):
    """Regularized incomplete beta I_x(a, b) for arrays (a, b > 0, 0 <= x <= 1)."""
    from math import lgamma

    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    out = np.full(x.shape, np.nan)
    ok = ~(np.isnan(a) | np.isnan(b) | np.isnan(x))
    lg = np.vectorize(lgamma, otypes=[float])
    with np.errstate(all="ignore"):
        lnbeta = np.where(ok, lg(np.where(ok, a + b, 1)) - lg(np.where(ok, a, 1)) - lg(np.where(ok, b, 1)), 0)
        xs = np.clip(np.where(ok, x, 0.5), 0, 1)
        front = np.exp(np.where((xs > 0) & (xs < 1), lnbeta + a * np.log(np.where(xs > 0, xs, 1)) + b * np.log(np.where(xs < 1, 1 - xs, 1)), -np.inf))
        direct = xs < (a + 1) / (a + b + 2)
        r1 = front * _betacf(a, b, xs) / a
        r2 = 1.0 - front * _betacf(b, a, 1 - xs) / b
    res = np.where(direct, r1, r2)
    res = np.where(xs <= 0, 0.0, np.where(xs >= 1, 1.0, res))
    out[ok] = res[ok]
    return out


def t_two_sided_p(t, df):
    t, df = np.asarray(t, dtype=float), np.asarray(df, dtype=float)
    with np.errstate(all="ignore"):
        x = df / (df + t * t)
        p = betainc_reg(df / 2.0, np.full_like(df, 0.5), x)
    p = np.where(np.isinf(t), 0.0, p)
    return np.where((df > 0) & ~np.isnan(t), p, np.nan)


def f_upper_p(f, d1, d2):
    f, d1, d2 = (np.asarray(v, dtype=float) for v in (f, d1, d2))
    with np.errstate(all="ignore"):
        x = d2 / (d2 + d1 * f)
        p = betainc_reg(d2 / 2.0, d1 / 2.0, x)
    return np.where((d1 > 0) & (d2 > 0) & (f >= 0), p, np.nan)


@F.pandas_udf(DoubleType())
def p_from_t(t: pd.Series, dof: pd.Series) -> pd.Series:
    """Two-sided p of a t statistic (Student t, ``dof`` degrees of freedom)."""
    return pd.Series(t_two_sided_p(t.astype(float).to_numpy(), dof.astype(float).to_numpy()))


@F.pandas_udf(DoubleType())
def p_from_f(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    """Upper-tail p of an F statistic."""
    return pd.Series(f_upper_p(f.astype(float).to_numpy(), d1.astype(float).to_numpy(), d2.astype(float).to_numpy()))


def stars(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").when(p.isNotNull(), "ns")


def corr_t_stat(r: Column, n: Column) -> Column:
    """t = r * sqrt((n - 2) / (1 - r^2)); NULL when undefined."""
    return r * F.sqrt(F.try_divide(n - 2, 1 - r * r))


def corr_significance(df: DataFrame, features: Sequence[str], target: str, with_p: bool = True) -> DataFrame:
    """R, n, t and (optionally) two-sided p and stars per feature against the target."""
    tc = target_correlations(df, features, target).select("feature", "n", "corr")
    out = tc.withColumn("t_stat", corr_t_stat(F.col("corr"), F.col("n").cast("double")))
    if with_p:
        ship_package(df.sparkSession)
        out = out.withColumn("p_value", p_from_t(F.col("t_stat"), (F.col("n") - 2).cast("double"))).withColumn(
            "stars", stars(F.col("p_value"))
        )
    return out


def anova_oneway(df: DataFrame, group: str, value: str, with_p: bool = True) -> DataFrame:
    """One-way ANOVA F of ``value`` across ``group`` (rows with NULLs skipped).

    Per-group count / mean / n*var_pop (numerically stable central moments)
    come from one grouped aggregate; SSB, SSW and F from a second, tiny one.
    """
    g = df.select(group, value).dropna().groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count(F.lit(1))).alias("ss")
    )
    tot = g.agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n_total"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"), F.sum("ss").alias("ssw"),
    )
    ssb = g.crossJoin(F.broadcast(tot)).agg(
        F.first("k").alias("k"), F.first("n_total").alias("n_total"), F.first("ssw").alias("ssw"),
        F.sum(F.col("n") * (F.col("mean") - F.col("grand")) * (F.col("mean") - F.col("grand"))).alias("ssb"),
    )
    out = ssb.select(
        (F.col("k") - 1).alias("df_between"), (F.col("n_total") - F.col("k")).alias("df_within"),
        "ssb", "ssw",
        F.try_divide(F.col("ssb") / (F.col("k") - 1), F.try_divide(F.col("ssw"), F.col("n_total") - F.col("k"))).alias("f_stat"),
    )
    if with_p:
        ship_package(df.sparkSession)
        out = out.withColumn("p_value", p_from_f(F.col("f_stat"), F.col("df_between").cast("double"), F.col("df_within").cast("double")))
        out = out.withColumn(
            "decision", F.when(F.col("p_value") < 0.001, "reject (p<0.001)").when(F.col("p_value") < 0.05, "reject (p<0.05)").otherwise("fail to reject")
        )
    return out


# --- A29 / A30 / A31 -------------------------------------------------------------------------------

def linear_fit(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares slope and intercept of y on x (rows with both non-null)."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_count(y, x).alias("n"))


def linear_residuals(df: DataFrame, y: str, x: str, keep: Sequence[str] = ()) -> DataFrame:
    """Fitted value and residual per row against a one-row coefficient table (broadcast)."""
    coef = linear_fit(df, y, x)
    j = df.select(*keep, y, x).crossJoin(F.broadcast(coef))
    fitted = F.col("intercept") + F.col("slope") * F.col(x)
    return j.select(*keep, y, x, fitted.alias("fitted"), (F.col(y) - fitted).alias("residual"))


def _det3(m):
    return (
        m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1])
        - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
        + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])
    )


def _quadratic_scaled(df: DataFrame, y: str, x: str) -> DataFrame:
    """One row: b0, b1, b2 of y = b0 + b1 z + b2 z^2 with z = (x - m) / s, and m, s, n, lo, hi and the linear fit.

    Normal equations in the centred, scaled variable: well conditioned wherever x lies.
    """
    src = df.select(F.col(_q(x)).cast("double").alias("x"), F.col(_q(y)).cast("double").alias("y")).dropna()
    at = src.agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi"),
                 F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"))
    z = F.try_divide(F.col("x") - F.col("m"), F.col("s"))
    scaled = src.crossJoin(F.broadcast(at)).withColumn("z", z)
    keep = ["m", "s", "lo", "hi", "slope", "intercept"]
    p = scaled.agg(
        F.count(F.lit(1)).cast("double").alias("s0"), *[F.sum(F.pow("z", i)).alias(f"s{i}") for i in (1, 2, 3, 4)],
        *[F.sum(F.pow("z", i) * F.col("y")).alias(f"t{i}") for i in (0, 1, 2)], *[F.first(c).alias(c) for c in keep])
    c = [F.col(f"s{i}") for i in range(5)]
    a = [[c[0], c[1], c[2]], [c[1], c[2], c[3]], [c[2], c[3], c[4]]]
    t = [F.col(f"t{i}") for i in range(3)]
    det = _det3(a)

    def repl(col_idx):
        return [[t[r] if cc == col_idx else a[r][cc] for cc in range(3)] for r in range(3)]

    return p.select(*[F.try_divide(_det3(repl(i)), det).alias(f"b{i}") for i in range(3)], F.col("s0").cast("bigint").alias("n"), *keep)


def quadratic_fit(df: DataFrame, y: str, x: str) -> DataFrame:
    """y = c0 + c1 x + c2 x^2, fitted in the scaled variable and expanded."""
    b0, b1, b2, m, s = (F.col(c) for c in ("b0", "b1", "b2", "m", "s"))
    return _quadratic_scaled(df, y, x).select(
        (b0 - b1 * m / s + b2 * m * m / (s * s)).alias("c0"), (b1 / s - 2 * b2 * m / (s * s)).alias("c1"), (b2 / (s * s)).alias("c2"), "n")


def fit_grid(df: DataFrame, y: str, x: str, points: int = 100) -> DataFrame:
    """``points`` evenly spaced x from min to max (of complete rows) with the linear and quadratic fitted values."""
    g = _quadratic_scaled(df, y, x).select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    g = g.withColumn("x", F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / (points - 1))
    z = (F.col("x") - F.col("m")) / F.col("s")
    return g.select(
        "i", "x",
        (F.col("intercept") + F.col("slope") * F.col("x")).alias("y_linear"),
        (F.col("b0") + F.col("b1") * z + F.col("b2") * z * z).alias("y_quadratic"),
    )


# --- A34 ------------------------------------------------------------------------------------------

def regression_metrics(df: DataFrame, y: str, yhat: str, mape_floor: float = 0.1, group: Sequence[str] = ()) -> DataFrame:
    """N, R^2, MSE, RMSE, MAE and MAPE (only where y > mape_floor) of predictions ``yhat``."""
    e = F.col(y) - F.col(yhat)
    src = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    m = src.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(e * e).alias("sse"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("sst"),
        F.avg(F.abs(e)).alias("mae"),
        (F.avg(F.when(F.col(y) > mape_floor, F.abs(e) / F.abs(F.col(y)))) * 100).alias("mape"),
    )
    return m.select(
        *group, "n",
        (1 - F.try_divide(F.col("sse"), F.col("sst"))).alias("r2"),
        (F.col("sse") / F.col("n")).alias("mse"),
        F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
        "mae", "mape",
    )


# --- A35 / A36 --------------------------------------------------------------------------------------

def histogram(df: DataFrame, col: Column | str, bins: int = 50, name: str = "value") -> DataFrame:
    """Equal-width histogram over [min, max]; the max lands in the last bin; empty bins are kept."""
    v = (F.col(col) if isinstance(col, str) else col).cast("double")
    src = df.select(v.alias("v")).dropna()
    rng = src.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    width = (F.col("hi") - F.col("lo"))
    b = F.least(F.floor(F.try_divide(F.col("v") - F.col("lo"), width) * bins) + 1, F.lit(bins)).cast("int")
    # at most ``bins`` rows: one row with a map of them, then the full grid
    counts = src.crossJoin(F.broadcast(rng)).groupBy(F.coalesce(b, F.lit(1)).alias("bucket"), "lo", "hi").agg(F.count(F.lit(1)).alias("count"))
    one = counts.groupBy("lo", "hi").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "count"))).alias("n"))
    grid = one.select("*", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bucket"))
    return grid.select(
        F.lit(name).alias("series"), "bucket",
        (F.col("lo") + (F.col("bucket") - 1) * (F.col("hi") - F.col("lo")) / bins).alias("bin_lo"),
        (F.col("lo") + F.col("bucket") * (F.col("hi") - F.col("lo")) / bins).alias("bin_hi"),
        F.coalesce(F.col("n")[F.col("bucket")], F.lit(0)).alias("count"),
    )


def boxplot_summary(df: DataFrame, group: str, value: str, whisker: float = 1.5) -> DataFrame:
    """Per group exact quartiles (operators.quantiles), IQR, whiskers at the furthest data points
    inside the fences, outlier count. Rows with a null group or value are left out."""
    from valuelens.operators.quantiles import measured, quantile_columns

    src = df.select(group, value).dropna()
    q = quantile_columns(src, [group], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_f = F.col("q1") - whisker * F.col("iqr")
    hi_f = F.col("q3") + whisker * F.col("iqr")
    j = src.join(measured(q), group)
    return j.groupBy(group, "q1", "median", "q3", "iqr").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col(value) >= lo_f, F.col(value))).alias("whisker_lo"),
        F.max(F.when(F.col(value) <= hi_f, F.col(value))).alias("whisker_hi"),
        F.count_if((F.col(value) < lo_f) | (F.col(value) > hi_f)).alias("n_outliers"),
    )
