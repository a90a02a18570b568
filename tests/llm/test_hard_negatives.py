import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from valuelens.llm import hard_negatives
from valuelens.llm.catalogue import ORACLE

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=100):
    fine = [(i, y, [math.floor(256 * x) for x in v]) for i, v, y in rows
            if y is not None and v is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v)]
    hold = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    out = []
    for n, (a, label, q) in enumerate(fine):
        if a is None or a % every:
            continue
        scored = [(-hold(sum(x * y for x, y in zip(q, r))), i is None, i or 0, i, y == label) for m, (i, y, r) in enumerate(fine) if m != n and len(r) == len(q)]
        scored.sort(key=lambda t: t[:3])
        for p in [t for t in scored if t[4]][:5]:
            window = [t for t in scored if not t[4] and 30 * -p[0] <= 100 * -t[0] <= 90 * -p[0]]
            out += [(a, p[3], k, t[3], -p[0], -t[0]) for k, t in enumerate(window[:10], 1)]
    return sorted(out, key=str)


def run(spark, rows, every=100):
    df = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "vec_id long, embedding array<double>, label int, place double, c1 int").repartition(4)
    return sorted(map(tuple, hard_negatives.mine(df, anchors=F.col("vec_id") % every == 0).select(*COLUMNS).collect()), key=str)


def vectors(rng, n, d, clusters):
    centres = rng.normal(size=(clusters, d)) * 2
    return [(int(i), (centres[rng.integers(clusters)] + rng.normal(size=d) * rng.choice([0, 0.1, 0.5])).tolist(), int(rng.integers(4))) for i in rng.permutation(n)]


@pytest.mark.parametrize("values, together", [(1 << 22, 1024), (64, 1)])
def test_equals_brute_force(spark, monkeypatch, values, together):
    monkeypatch.setattr(hard_negatives, "SHARD_VALUES", values)
    monkeypatch.setattr(hard_negatives, "TOGETHER", together)
    rng = np.random.default_rng(1)
    rows = vectors(rng, 300, 9, 12)
    rows += [(i + 300, rows[0][1], 2) for i in range(40)]  # copies: ties by id
    assert run(spark, rows, 10) == brute(rows, 10)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (2, [0.5, 1.0], 2), (None, [0.5, 1.0], 2), (3, None, 1), (4, [1.0, None], 1), (5, [1.0, nan], 2),
            (6, [1.0, inf], 2), (7, [1.0, 2.0], None), (8, [], 1), (200, [], 1), (9, [], 2), (10, [0.7], 2), (300, [0.7], 1), (11, [0.9], 1), (12, [0.5], 2), (13, [-0.7], 1),
            (400, [0.0, 0.0], 3), (14, [0.0, 0.0], 3), (15, [1e308, 1.0], 3), (500, [-1.0, -2.0], 5), (16, [1.0, 1.0], 5)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1)]) == []


def test_wide_values_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=4) * 10.0 ** rng.choice([1, 5, 6])).tolist(), i % 3) for i in range(80)] + [(500, [1e16, 1.0], 0), (501, [1e16, 2.0], 0), (502, [3.0, 1e15], 1), (503, [9e15, 1.0], 1)]
    assert run(spark, rows, 10) == brute(rows, 10)


def test_query_equals_sql(spark):
    path = "/root/testdata/sf0.001/embeddings.parquet"
    from valuelens.llm.q_negatives import op12_hard_negatives

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    got = op12_hard_negatives(spark, "/root/testdata/sf0.001").select(*COLUMNS).collect()
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE['op12_hard_negatives']})").fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and len(want) > 50


def test_heap_stops_early():
    """On clustered rows most cells are never scored, and none that matters is left out."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    q = np.floor(np.repeat(rng.normal(size=(40, 8)) * 200, 50, axis=0) + rng.normal(size=(2000, 8)))
    c1, c2 = np.repeat(np.arange(40) % 8, 50), np.repeat(np.arange(40) // 8, 50)
    order = np.lexsort((c2, c1))
    table = pa.table({"q": pa.array(list(q[order])), "vec_id": pa.array(np.arange(2000)), "label": pa.array(np.zeros(2000, np.int64)), "place": pa.array(np.arange(2000)), "c1": pa.array(c1[order]), "c2": pa.array(c2[order])})
    shard, best, seen = hard_negatives.Shard(table), hard_negatives.Best(5), 0
    hard_negatives.TOGETHER, kept = 1, hard_negatives.TOGETHER
    try:
        for rows, score in shard.visit(q[order][3], lambda: best.need):
            best.add(shard, rows, score)
            seen += len(rows)
    finally:
        hard_negatives.TOGETHER = kept
    assert best.score.tolist() == np.sort(q[order] @ q[order][3])[::-1][:5].tolist() and seen < 1000
