"""Invariants and brute-force cross-checks of the distributed formulations."""

import math
import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from valuelens.operators import dedupe as dd
from valuelens.operators import features as fe
from valuelens.operators import split as sp
from valuelens.operators import stats as st
from valuelens.plans.registry import table


def test_dedupe_idempotent(spark):
    ev = table(spark, SF_SMALL, "events")
    once = dd.dedupe_keep_last(ev, "user_id", ["ts", "event_id"])
    twice = dd.dedupe_keep_last(once, "user_id", ["ts", "event_id"])
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    assert once.count() == ev.select("user_id").distinct().count()


def test_split_disjoint_complete(spark):
    o = sp.hash_folds(sp.hash_split(table(spark, SF_SMALL, "orders").select("o_orderkey"), "o_orderkey"), "o_orderkey")
    n = o.count()
    parts = {r.split: r["count"] for r in o.groupBy("split").count().collect()}
    assert sum(parts.values()) == n and set(parts) == {"train", "val", "test"}
    assert 0.55 < parts["train"] / n < 0.73
    assert o.filter((F.col("fold") < 0) | (F.col("fold") > 4)).count() == 0
    # a pure function of the key: recomputing gives the same parts
    again = sp.hash_split(table(spark, SF_SMALL, "orders").select("o_orderkey"), "o_orderkey")
    assert o.select("o_orderkey", "split").exceptAll(again).count() == 0


def test_oof_matches_fold_loop(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": range(300), "cat": rng.integers(0, 6, 300), "y": rng.normal(size=300)})
    df = sp.hash_folds(spark.createDataFrame(pdf), "k")
    oof, full, overall = fe.fit_target_codes(df, "cat", "y", "fold")
    got = {r.k: r.cat_target_enc for r in fe.transform_target_oof(df, "cat", "fold", oof, overall).collect()}
    folds = {r.k: r.fold for r in df.select("k", "fold").collect()}
    pdf["fold"] = pdf.k.map(folds)
    m = pdf.y.mean()
    for f in range(5):
        means = pdf[pdf.fold != f].groupby("cat").y.mean()
        for k, cat in pdf.loc[pdf.fold == f, ["k", "cat"]].itertuples(index=False):
            exp = means.get(cat, m)
            assert abs(got[k] - exp) < 1e-9


def test_corr_symmetric_and_bounded(spark):
    li = table(spark, SF_SMALL, "lineitem").withColumn("d", F.nullif("l_discount", F.lit(0.0)))
    cols = ["l_quantity", "l_extendedprice", "d", "l_tax"]
    a = {(r.col_1, r.col_2): (r.n, r.corr) for r in st.corr_matrix_long(li, cols).collect()}
    assert len(a) == 6
    pdf = li.select(*cols).toPandas()
    for (c1, c2), (_, r) in a.items():
        assert abs(r) <= 1 and abs(pdf[c1].corr(pdf[c2]) - r) < 1e-9


def test_histogram_counts_sum(spark):
    o = table(spark, SF_SMALL, "orders")
    h = st.histogram(o, "o_totalprice", 50)
    assert h.count() == 50
    assert h.agg(F.sum("count")).first()[0] == o.count()
    counts, _ = np.histogram(o.select("o_totalprice").toPandas().o_totalprice, bins=50)
    assert [r["count"] for r in h.orderBy("bucket").collect()] == counts.tolist()


def test_p_values_closed_forms(spark):
    t = np.array([0.5, 1.0, 2.0, 3.5])
    # df = 1 (Cauchy) and df = 2 have closed-form two-sided p
    p1 = st.t_two_sided_p(t, np.ones_like(t))
    assert np.allclose(p1, 1 - 2 / math.pi * np.arctan(np.abs(t)), atol=1e-10)
    p2 = st.t_two_sided_p(t, np.full_like(t, 2.0))
    assert np.allclose(p2, 1 - np.abs(t) / np.sqrt(2 + t * t), atol=1e-10)
    # F(1, d) = t(d)^2
    assert np.allclose(st.f_upper_p(t * t, np.ones_like(t), np.full_like(t, 7.0)), st.t_two_sided_p(t, np.full_like(t, 7.0)), atol=1e-10)


def test_vif_matches_numpy(spark):
    li = table(spark, SF_SMALL, "lineitem")
    cols = ["l_quantity", "l_discount", "l_tax"]
    got = {r.column_name: r.vif for r in st.vif(li, cols).collect()}
    x = li.select(*cols).toPandas().to_numpy()
    g = x.T @ x
    exp = np.diag(g) * np.diag(np.linalg.inv(g))
    for c, e in zip(cols, exp):
        assert abs(got[c] - e) < 1e-6 * max(1, e)


def test_quadratic_fit_matches_polyfit(spark):
    li = table(spark, SF_SMALL, "lineitem")
    r = st.quadratic_fit(li, "l_extendedprice", "l_quantity").first()
    pdf = li.select("l_quantity", "l_extendedprice").toPandas()
    c2, c1, c0 = np.polyfit(pdf.l_quantity, pdf.l_extendedprice, 2)
    assert abs(r.c0 - c0) < 1e-6 * max(1, abs(c0)) and abs(r.c1 - c1) < 1e-6 * max(1, abs(c1)) and abs(r.c2 - c2) < 1e-6


def test_anova_matches_formula(spark):
    o = table(spark, SF_SMALL, "orders")
    a = st.anova_oneway(o, "o_orderpriority", "o_totalprice").first()
    pdf = o.select("o_orderpriority", "o_totalprice").toPandas()
    groups = [g.o_totalprice.to_numpy() for _, g in pdf.groupby("o_orderpriority")]
    grand = pdf.o_totalprice.mean()
    ssb = sum(len(g) * (g.mean() - grand) ** 2 for g in groups)
    ssw = sum(((g - g.mean()) ** 2).sum() for g in groups)
    k, n = len(groups), len(pdf)
    f = (ssb / (k - 1)) / (ssw / (n - k))
    assert abs(a.f_stat - f) < 1e-8 * max(1, f)
    assert 0 <= a.p_value <= 1


def test_position_in_group_matches_window_on_hot_group(spark):
    from pyspark.sql import Window

    # one hot group holding most rows, plus small ones
    df = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(
        (F.col("id") % 7).cast("string")).alias("g"))
    got = dd.position_in_group(df, ["g"], ["id"], "seq", partitions=16)
    exp = df.withColumn("seq", F.row_number().over(Window.partitionBy("g").orderBy("id")) - 1)
    assert got.select("id", "g", "seq").exceptAll(exp.select("id", "g", "seq")).count() == 0
    assert got.count() == 5000


def test_wide_and_long_profiles_agree(spark):
    from valuelens.operators import profile as pr

    li = table(spark, SF_SMALL, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_orderkey", "l_partkey", "l_suppkey", "l_quantity"]
    cols = list(dict.fromkeys(cols))  # 8 distinct -> wide; add one more to force long
    wide = {r.column_name: r for r in pr.describe_numeric(li, cols).collect()}
    li2 = li.withColumn("extra", F.col("l_tax") * 2)
    long = {r.column_name: r for r in pr.describe_numeric(li2, cols + ["extra"]).collect()}
    mw = {r.column_name: r for r in pr.moments(li, cols).collect()}
    ml = {r.column_name: r for r in pr.moments(li2, cols + ["extra"]).collect()}
    for c in cols:
        for f in ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]:
            a, b = wide[c][f], long[c][f]
            assert (a is None and b is None) or abs(a - b) <= 1e-9 * max(1, abs(a))
        for f in ["n", "skew", "kurt"]:
            a, b = mw[c][f], ml[c][f]
            assert (a is None and b is None) or abs(a - b) <= 1e-9 * max(1, abs(a))


def test_target_correlation_routes_agree(spark):
    li = table(spark, SF_SMALL, "lineitem").withColumn("d", F.nullif("l_discount", F.lit(0.0)))
    base = ["l_quantity", "d", "l_tax", "l_linenumber"]
    extra = [F.col("l_quantity") * (i + 1) + F.col("l_tax") * i for i in range(6)]
    li = li.select("*", *[e.alias(f"x{i}") for i, e in enumerate(extra)])
    few = {r.feature: (r.n, r.corr) for r in st.target_correlations(li, base, "l_extendedprice").collect()}
    many = {r.feature: (r.n, r.corr) for r in st.target_correlations(li, base + [f"x{i}" for i in range(6)], "l_extendedprice").collect()}
    for c in base:
        assert few[c][0] == many[c][0] and abs(few[c][1] - many[c][1]) < 1e-9


def test_exact_percentiles_match_percentile_aggregate(spark):
    from valuelens.operators.quantiles import exact_percentiles

    # a hot group with most rows and repeated values, plus small groups; NULLs skipped
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 5).cast("string")).alias("g"),
        F.when(F.col("id") % 97 == 0, F.lit(None)).otherwise(((F.col("id") * 7919) % 1013) / 10.0).alias("v"))
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r.g, r.p): r.q for r in exact_percentiles(df, ["g"], "v", probs).collect()}
    exp_rows = df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()
    assert len(got) == len(exp_rows) * len(probs)
    for r in exp_rows:
        for p, q in zip(probs, r.q):
            assert abs(got[(r.g, p)] - q) < 1e-9


def _percentiles(df, group, value):
    q = df.groupBy(group).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    return {r[group]: r.q for r in q.collect()}


def test_group_quartiles_equal_the_percentile_aggregate(spark):
    from valuelens.operators.groupstats import group_stats_quartiles

    o = table(spark, SF_SMALL, "orders").withColumn("p", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderpriority")))
    got = {r.p: (r.q1, r.median, r.q3) for r in group_stats_quartiles(o, "p", "o_totalprice", round_inputs=None).collect()}
    want = _percentiles(o, "p", "o_totalprice")
    assert got.keys() == want.keys() and None in got  # a null group has its quartiles
    for k in got:
        assert all(abs(x - y) <= 1e-9 * abs(y) for x, y in zip(got[k], want[k]))


def test_curve_median_equals_the_percentile_aggregate(spark):
    from valuelens.operators.lifecycle import value_curve
    from valuelens.plans.q_lifecycle import priced_parts

    j = priced_parts(spark, SF_SMALL)
    got = {r.p_size: r.median for r in value_curve(j, "p_size", "l_extendedprice").collect()}
    want = _percentiles(j, "p_size", "l_extendedprice")
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k][1]) <= 1e-9 * abs(want[k][1]) for k in got)


def test_keyed_reductions_combine_map_side(spark):
    """A hot key is reduced inside every map task: the plan has a partial max_by before the shuffle."""
    import contextlib
    import io

    df = spark.range(30000).select((F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))).alias("k"),
                                   F.col("id").alias("ord"), (F.col("id") * 2).alias("v"))
    out = dd.dedupe_keep_last(df, "k", ["ord"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    plan = buf.getvalue()
    assert "partial_max_by" in plan and plan.index("partial_max_by") > plan.index("Exchange")
    assert out.filter("k = 0").first().ord == 29997


def test_describe_quartiles_equal_the_percentile_aggregate(spark):
    from valuelens.operators import profile as pr

    li = table(spark, SF_SMALL, "lineitem").withColumn("d", F.nullif("l_discount", F.lit(0.0)))
    for r in pr.describe_numeric(li, ["l_quantity", "l_extendedprice", "d"]).collect():
        want = li.agg(F.percentile(r.column_name, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
        assert all(abs(x - y) <= 1e-9 * abs(y) for x, y in zip((r.q25, r.q50, r.q75), want))


def test_boxplot_quartiles_equal_the_percentile_aggregate(spark):
    o = table(spark, SF_SMALL, "orders")
    want = _percentiles(o, "o_orderpriority", "o_totalprice")
    for r in st.boxplot_summary(o, "o_orderpriority", "o_totalprice").collect():
        assert all(abs(x - y) <= 1e-9 * abs(y) for x, y in zip((r.q1, r.median, r.q3), want[r.o_orderpriority]))


def test_quantiles_of_a_hot_group_with_ties_nulls_and_nan(spark):
    """A group of most rows, far more of them than the sketch keeps; a null group; one-row groups; NaN on top."""
    from valuelens.operators.quantiles import exact_percentiles, quantile_columns

    hot = spark.range(400000, numPartitions=8).select(
        F.when(F.col("id") % 50 == 0, F.lit(None).cast("string")).otherwise("hot").alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000003)) / 13.0).alias("v"))
    one = spark.createDataFrame([("x", 4.0), ("empty", None), ("nan", 1.0), ("nan", float("nan"))], "g string, v double")
    df = hot.unionByName(one)
    probs = [0.0, 0.001, 0.25, 0.5, 0.9999, 1.0]
    got = {(r.g, r.p): r.q for r in exact_percentiles(df, ["g"], "v", probs).collect()}
    want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect() if r.q}
    assert {k for k, _ in got} == set(want) and None in want
    for (g, p), q in got.items():
        w = want[g][probs.index(p)]
        assert q == w or abs(q - w) <= 1e-9 * abs(w) or (math.isnan(q) and math.isnan(w)), (g, p, q, w)
    empty = quantile_columns(df.where("false"), [], "v", {"m": 0.5}).collect()
    assert [r.m for r in empty] == [None]


def test_correlations_do_not_depend_on_the_number_of_columns(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    names = [f"c{i}" for i in range(12)]
    rows = [[None if rng.random() < 0.1 else float("nan") if rng.random() < 0.1 else float(1e6 + v) for v in rng.normal(size=12)] for _ in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    full = {(r.col_1, r.col_2): (r.n, round(r.corr, 9)) for r in st.corr_matrix_long(df, names).collect()}
    for k in (4, 5, 8, 9):
        part = {(r.col_1, r.col_2): (r.n, round(r.corr, 9)) for r in st.corr_matrix_long(df, names[:k]).collect()}
        assert part == {p: v for p, v in full.items() if p in part} and len(part) == k * (k - 1) // 2
        tc = {r.feature: (r.n, round(r.corr, 9)) for r in st.target_correlations(df, names[:k], "c11").collect()}
        assert tc == {n: full[(n, "c11")] for n in names[:k]}
    pdf = df.toPandas()
    assert abs(pdf.c0.corr(pdf.c1) - full[("c0", "c1")][1]) < 1e-8


def test_vif_takes_any_number_of_columns(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 26)) + 5
    x[:, 25] = x[:, 0] + rng.normal(size=400) * 0.1
    names = [f"c{i}" for i in range(26)]
    df = spark.createDataFrame(x.tolist(), ", ".join(f"{n} double" for n in names))
    for k in (25, 26):
        g = x[:, :k].T @ x[:, :k]
        want = np.diag(g) * np.diag(np.linalg.inv(g))
        got = {r.column_name: r.vif for r in st.vif(df, names[:k]).collect()}
        assert all(abs(got[n] - w) <= 1e-6 * w for n, w in zip(names, want))


def test_quadratic_fit_far_from_the_origin(spark):
    import numpy as np

    df = spark.range(2000).select((F.col("id") + 20000).cast("double").alias("x")).withColumn("y", 3 + 2 * F.col("x") + 0.5 * F.col("x") ** 2)
    r = st.quadratic_fit(df, "y", "x").first()
    assert abs(r.c2 - 0.5) < 1e-9 and abs(r.c1 - 2) < 1e-4 and abs(r.c0 - 3) < 1
    stamp = spark.range(2000).select((F.col("id") + 1_700_000_000).cast("double").alias("x")).withColumn("y", 0.5 * (F.col("x") - 1_700_000_000) ** 2)
    assert abs(st.quadratic_fit(stamp, "y", "x").first().c2 - 0.5) < 1e-6
    grid = st.fit_grid(stamp, "y", "x", 5).orderBy("i").collect()
    assert np.allclose([g.y_quadratic for g in grid], [0.5 * (g.x - 1_700_000_000) ** 2 for g in grid], atol=1e-3)


def test_positions_and_ids_of_null_groups(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "a", 2), ("s", "a", 3), (None, "b", 4)], "scope string, base string, o long")
    got = {r.o: r.id for r in dd.collision_suffix(df, "base", ["scope"], ["o"]).collect()}
    assert got == {1: "a", 2: "a-1", 3: "a", 4: "b"}


def test_nothing_made_of_the_target_becomes_a_feature(spark):
    from valuelens.operators import split as sp
    from valuelens.plans import flows

    df = spark.range(600).select(F.col("id").cast("string").alias("player_id"), F.exp(F.rand(1) * 8).alias("market_value"),
                                 F.rand(2).alias("goals"), F.exp(F.rand(3) * 9).alias("shots"), F.lit("x").alias("nationality"))
    tr = sp.hash_folds(sp.hash_split(df, "player_id"), "player_id").withColumn("__y", F.exp(F.log1p("market_value")))
    plan = flows.fit_features(tr, "market_value", select_threshold=0.0)
    assert not {"__y", "fold", "split", "market_value"} & set(plan.log_columns)
    assert not any(c.startswith(("__y", "fold", "split", "market_value")) for c in plan.selected)


def test_functions_run_on_workers_without_the_repository(tmp_path):
    """A process in another folder, whose workers do not find the package, still gets p-values."""
    import subprocess
    import sys as _sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from valuelens.session import get_spark
from valuelens.operators import stats as st
spark = get_spark(master='local[1]', shuffle_partitions=1)
df = spark.range(50).selectExpr('double(id) as a', 'double(id * id % 7) as y')
print('P', st.corr_significance(df, ['a'], 'y').first().p_value is not None)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([_sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "P True" in done.stdout, done.stderr[-800:]
