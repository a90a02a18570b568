"""Hand-authored goldens (FIXTURES.md section 4): edge cases of each operator."""

from pyspark.sql import functions as F

from valuelens.functions import segment as sg
from valuelens.functions import text as tx
from valuelens.operators import dedupe as dd
from valuelens.operators import features as fe
from valuelens.operators import lifecycle as lc
from valuelens.operators import stats as st


def col1(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")


def run(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_currency(spark):
    df = col1(spark, ["€700k", "€1m", "€12.5m", "€1,5m", "€500.000", "-", "", None])
    assert run(df, tx.parse_currency("v")) == [0.7, 1.0, 12.5, 1.5, 0.5, None, None, None]


def test_clean_number(spark):
    df = col1(spark, ["1,234", "45.6%", "", "abc", "-5", " 7 "])
    assert run(df, tx.clean_number("v")) == [1234.0, 45.6, None, None, -5.0, 7.0]
    assert run(col1(spark, ["12.9", "-3.7"]), tx.clean_number("v", allow_float=False)) == [12, -3]


def test_signed_number(spark):
    df = col1(spark, ["+0.30", "-0.45", "-0.00", "0.12", "-x"])
    assert run(df, tx.signed_number("v")) == [0.3, -0.45, None, 0.12, None]


def test_height(spark):
    assert run(col1(spark, ["1,83 m", "2,01 m"]), tx.parse_height_m("v")) == [183, 200]
    assert run(col1(spark, ["183cm"]), tx.parse_height_cm("v")) == [183.0]


def test_slug_and_id(spark):
    df = col1(spark, ["Lionel Messi", "Éric  --  Abidal", "Zoë O'Neil"])
    assert run(df, tx.slugify("v")) == ["lionel-messi", "eric-abidal", "zoe-oneil"]
    ids = run(df, tx.stable_id("v"))
    assert ids[0].startswith("lionel-messi-") and len(ids[0]) == len("lionel-messi-") + 6
    import hashlib

    assert ids[0].endswith(hashlib.md5("Lionel Messi::".encode()).hexdigest()[:6])


def test_age_asof(spark):
    df = spark.createDataFrame([("2000-02-29",)], "d string")
    assert df.select(tx.age_asof("d", "2023-02-28")).first()[0] == 22
    assert df.select(tx.age_asof("d", "2023-03-01")).first()[0] == 23


def test_collision_suffix(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a")], "o int, base string").withColumn("lg", F.lit("x"))
    out = dd.collision_suffix(df, "base", ["lg"], ["o"], "id")
    assert [r.id for r in out.orderBy("o").collect()] == ["a", "a-1", "b", "a-2"]


def test_position(spark):
    df = col1(spark, [None, "GK", "FW-MF", "DF-MF", "LW", "XX"])
    assert run(df, sg.classify_position("v")) == ["UNKNOWN", "GK", "MF", "DF", "FW", "UNKNOWN"]


def test_dedupe_keep_last(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2), ("x", 3)], "id string, row int")
    out = dd.dedupe_keep_last(df, "id", ["row"])
    assert sorted(r.row for r in out.collect()) == [2, 3]


def test_bins(spark):
    df = col1(spark, [0, 21, 22, 29, 30], "int")
    assert run(df, sg.right_closed_bins("v", lc.PHASE_EDGES, lc.PHASE_LABELS)) == [
        None, "Developing (≤21)", "Peak Entry (22-25)", "Prime Peak (26-29)", "Decline (30+)"]
    from valuelens.plans.q_segment import MINUTE_EDGES, MINUTE_LABELS

    df = col1(spark, [900, 901, 2000], "int")
    assert run(df, sg.right_closed_bins("v", MINUTE_EDGES, MINUTE_LABELS)) == [
        "Low (<900 min)", "Medium (900-2000 min)", "Medium (900-2000 min)"]


def test_smoothing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 6.0)], "age int, mean double")
    assert [r[0] for r in df.orderBy("age").select(lc.centered_mean("mean", "age")).collect()] == [None, 3.0, None]


def _curve(spark, pcts):
    rows = [(24 + i, p, 100) for i, p in enumerate(pcts)]
    return spark.createDataFrame(rows, "age int, value_change_pct double, count int")


def test_decline_start(spark):
    assert lc.decline_start(_curve(spark, [1.0, -1.0, -2.0, 3.0]), "age").first().decline_start == 25
    assert lc.decline_start(_curve(spark, [1.0, 2.0, -1.0, -2.0]), "age").first().decline_start is None


def test_quadrant(spark):
    df = spark.createDataFrame([(5.0, 1.0), (None, 9.0), (1.0, 9.0), (5.0, 9.0)], "s double, c double")
    out = df.select(sg.quadrant("s", "c", F.lit(3.0), F.lit(5.0))).collect()
    assert [r[0] for r in out] == ["Volume Shooter", "Below Average", "Clinical Finisher", "Elite Striker"]


def test_redundant_tie_drops_second(spark):
    pairs = spark.createDataFrame([("a", "b")], "col_1 string, col_2 string")
    tc = spark.createDataFrame([("a", 0.5, False), ("b", -0.5, False)], "feature string, corr double, missing boolean")
    assert [r.feature for r in st.redundant_drop_list(pairs, tc).collect()] == ["b"]
    tc2 = spark.createDataFrame([("a", 0.2, False), ("b", 0.5, False)], "feature string, corr double, missing boolean")
    assert [r.feature for r in st.redundant_drop_list(pairs, tc2).collect()] == ["a"]


def test_constant_column_corr(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "c double, y double")
    tc = st.target_correlations(df, ["c"], "y")
    assert tc.first().corr is None
    assert st.low_corr_drop_list(tc).count() == 0      # kept by the low-correlation rule
    assert st.select_features(tc).count() == 0         # rejected by feature selection


def test_mode_tie(spark):
    df = col1(spark, ["a", "a", "b", "b", None])
    plan = fe.fit_impute(df, [], ["v"])
    assert plan.first().v == "a"


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(0.5, 0.0), (1.0, None)], "n double, d double")
    assert [r[0] for r in df.select(fe.guarded_ratio("n", "d", 0.01)).collect()] == [50.0, None]


def test_mape_mask(spark):
    df = spark.createDataFrame([(0.05, 1.0), (1.0, 1.5)], "y double, p double")
    m = st.regression_metrics(df, "y", "p").first()
    assert abs(m.mape - 50.0) < 1e-9


def test_tier(spark):
    df = col1(spark, [0.99, 1.0, 80.0], "double")
    assert run(df, sg.value_tier("v")) == ["Lower League / Youth Player", "Solid Squad Player", "World Class"]


def test_overlay(spark):
    from valuelens.operators import joins as jn

    left = spark.createDataFrame([(1, 5.0), (2, 5.0)], "k int, v double")
    right = spark.createDataFrame([(1, None), (2, 0.0)], "k int, v double")
    out = jn.overlay(left, right, "k", ["v"])
    assert [r.v for r in out.orderBy("k").collect()] == [5.0, 0.0]


def test_head_and_tail_of_top(spark):
    from valuelens.operators.themes import head_and_tail

    ranked = spark.createDataFrame([(f"f{i}", i) for i in range(1, 31)], "feature string, rank int")
    got = {(r.part, r.feature) for r in head_and_tail(ranked, "rank", 20, 3).collect()}
    assert got == {("head", "f1"), ("head", "f2"), ("head", "f3"), ("tail", "f18"), ("tail", "f19"), ("tail", "f20")}
