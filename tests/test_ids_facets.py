"""Unique ids for any bases (W9), dependent facets (T5), correlations beside infinities."""

import math
import random

import pytest

from valuelens.operators import dedupe as dd
from valuelens.operators import groupstats as gs
from valuelens.operators import stats as st


def loop(rows):
    """(order, id) by one pass over the rows with a set of ids seen per scope."""
    seen, out = {}, {}
    for o, scope, base in sorted(rows):
        if base is None:
            out[o] = None
            continue
        used, name, k = seen.setdefault(scope, set()), base, 1
        while name in used:
            name, k = f"{base}-{k}", k + 1
        used.add(name)
        out[o] = name
    return out


def ids(spark, rows, method="range"):
    df = spark.createDataFrame(rows, "o long, lg string, base string").repartition(5)
    return {r.o: r.id for r in dd.collision_suffix(df, "base", ["lg"], ["o"], "id", method).collect()}


@pytest.mark.parametrize("method", ["range", "window"])
def test_ids_of_known_cases(spark, method):
    for bases in (["a", "a", "a-1"], ["a-1", "a", "a", "a"], ["a", "a-1", "a", "a-1", "a-1-1", "a"], ["a-1-1", "a-1", "a-1", "a", "a", "a"], ["a-01", "a", "a", "a-0"]):
        rows = [(i, "x", b) for i, b in enumerate(bases)] + [(100 + i, None, b) for i, b in enumerate(bases[::-1])] + [(200, "x", None)]
        assert ids(spark, rows, method) == loop([(o, str(s), b) for o, s, b in rows])


def test_ids_are_those_of_the_loop(spark):
    rng = random.Random(4)
    names = ["a", "a-1", "a-2", "a-3", "a-1-1", "a-1-2", "a-2-1", "b", "b-1", "b-7", "c-5"]
    rows = [(i, rng.choice("xy"), rng.choice(names)) for i in range(300)] + [(1000 + i, "hot", "a") for i in range(400)] + [(1100 + i * 7, "z", f"a-{i}") for i in range(1, 40)]
    rows = list({r[0]: r for r in rows}.values())
    got = ids(spark, rows)
    assert got == loop(rows)
    for scope in ("x", "y", "hot", "z"):
        own = [got[o] for o, s, _ in rows if s == scope]
        assert len(own) == len(set(own))


def test_facets(spark):
    rows = [("L2", "b", "GK"), ("L1", "c", "FW"), ("L1", "a", None), ("L1", "a", "FW"), (None, "d", "FW"), ("All", "All", "DF")]
    df = spark.createDataFrame(rows, "league string, club string, pos string")
    assert [r.value for r in gs.facet_values(df, "league").collect()] == ["All", "L1", "L2"]
    assert [r.value for r in gs.facet_values(df, "league", None).collect()] == ["All", "L1", "L2"]
    got = [tuple(r) for r in gs.facet_options(df, {"league": "L1", "club": "a", "pos": None}).collect()]
    assert got == [("league", 0, "All", 6), ("league", 0, "L1", 3), ("league", 0, "L2", 1), ("club", 1, "All", 3), ("club", 1, "a", 2), ("club", 1, "c", 1),
                   ("pos", 2, "All", 2), ("pos", 2, "FW", 1)]
    assert gs.facet_options(df.where("false"), {"league": None}).collect() == []


def test_correlation_leaves_infinities_of_other_rows_out(spark):
    rows = [(1.0, 2.0, 1.0), (2.0, 1.0, 2.0), (3.0, 5.0, 3.5), (4.0, 4.0, 4.0), (math.inf, None, 5.0), (5.0, 6.0, -math.inf)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    r = {(x.col_1, x.col_2): x.corr for x in st.corr_matrix_long(df, ["a", "b", "c"]).collect()}
    want = spark.createDataFrame([x[:2] for x in rows if x[1] is not None], "a double, b double").stat.corr("a", "b")
    assert abs(r["a", "b"] - want) < 1e-12 and math.isnan(r["a", "c"]) and math.isnan(r["b", "c"])
