"""Exact percentiles: brackets of a measured size, salted counts beyond, rows that stay where they are."""

import math

import pytest
from pyspark.sql import functions as F

from valuelens.operators import quantiles as qt

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def rows(spark, n=60000):
    """One hot group, some of hundreds of rows, many tiny ones, a null one; ties, nulls and NaN."""
    g = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("m"), F.col("id") % 20)).when(F.col("id") % 7 > 0, F.concat(F.lit("t"), F.floor(F.col("id") / 9)))
    v = F.when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 5 == 0, F.lit(3.0)).when(F.col("id") % 997 == 1, F.lit(float("nan"))).otherwise(F.pmod(F.xxhash64("id"), F.lit(100003)) / 7.0)
    return spark.range(n, numPartitions=8).select(g.alias("g"), v.alias("v"))


def same(a, b):
    return a == b or (math.isnan(a) and math.isnan(b)) or abs(a - b) <= 1e-9 * abs(b)


@pytest.mark.parametrize("accuracy, most", [(10000, 20000), (100, 20000), (100, 3)])
def test_equals_the_percentile_aggregate(spark, monkeypatch, accuracy, most):
    """All groups whole; hot ones bracketed and broadcast; brackets too many to broadcast, met by salt."""
    monkeypatch.setattr(qt, "ACCURACY", accuracy)
    monkeypatch.setattr(qt, "BROADCAST_GROUPS", most)
    df = rows(spark)
    got = {(r.g, r.p): r.q for r in qt.exact_percentiles(df, ["g"], "v", PROBS).collect()}
    want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, PROBS))).alias("q")).collect() if r.q}
    assert {g for g, _ in got} == set(want) and len(got) == len(want) * len(PROBS)
    assert not [(g, p) for (g, p), q in got.items() if not same(q, want[g][PROBS.index(p)])]


def test_rows_are_not_moved(spark, monkeypatch):
    monkeypatch.setattr(qt, "ACCURACY", 100)
    plan = qt.exact_percentiles(rows(spark), ["g"], "v", [0.5])._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1
    # below the join there is no exchange on the side of the rows: what is shuffled are counts
    executed = qt.exact_percentiles(rows(spark), ["g"], "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    below = executed[executed.index("BroadcastHashJoin"):]
    assert below.count("Exchange hashpartitioning") == 0
    monkeypatch.setattr(qt, "ACCURACY", 10**6)
    assert "Join" not in qt.exact_percentiles(rows(spark), ["g"], "v", [0.5])._jdf.queryExecution().sparkPlan().toString()


def test_very_many_groups(spark):
    df = spark.range(600000, numPartitions=8).select((F.col("id") % 300000).alias("g"), F.col("id").cast("double").alias("v"))
    out = qt.quantile_columns(df, ["g"], "v", {"m": 0.5})
    assert out.count() == 300000 and out.where("m <> g + 150000").count() == 0


def test_row_of_several_columns(spark, monkeypatch):
    df = rows(spark).select(F.when(~F.isnan("v"), F.col("v")).alias("a"), F.length("g").alias("b"), F.lit(None).cast("double").alias("c"))
    want = df.agg(F.percentile("a", 0.5).alias("x"), F.percentile("b", 0.25).alias("y"), F.percentile("a", 0.9).alias("z")).first()
    for accuracy in (100, 10**6):
        monkeypatch.setattr(qt, "ACCURACY", accuracy)
        r = qt.quantile_row(df, {"x": ("a", 0.5), "y": ("b", 0.25), "z": ("a", 0.9), "none": ("c", 0.5)}).first()
        assert (r.x, r.y, r.z, r.none) == (*want, None)


def test_planned_scans_of_the_forward_queries(spark):
    from valuelens.plans.q_segment import quadrant_classify, undervalued_topk

    for q in (quadrant_classify, undervalued_topk):
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("FileScan") == 1 and "SortMergeJoin" not in plan
