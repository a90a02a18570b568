import numpy as np

from valuelens.llm import embed_dup


def brute(rows, threshold):
    ok = []
    for i, v, label in rows:
        x = None if v is None or label is None or any(a is None for a in v) else np.array(v, dtype=np.float64)
        ok.append(x if x is not None and len(x) and np.isfinite(x).all() and x.any() else None)
    links = [set() for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            x, y = ok[a], ok[b]
            if x is not None and y is not None and rows[a][2] == rows[b][2] and len(x) == len(y):
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for a in range(len(rows)):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        first = min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)
        out.append((rows[a][0], len(links[a]), first, rows[a][0] is not None and rows[a][0] == first))
    return sorted(out, key=str)


def check(spark, rows, threshold=0.98):
    frame = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<float>, label int, lead double").repartition(4)
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embed_dup.near(frame, threshold).collect()]
    rounded = [(i, None if v is None else [None if a is None else float(np.float32(a)) for a in v], y) for i, v, y in rows]
    assert sorted(got, key=str) == brute(rounded, threshold)


def near_copies(rng, n, d=24):
    rows = []
    for i in range(n):
        if i and rng.random() < 0.5:
            base = np.array(rows[rng.integers(len(rows))][1])
            v = base * rng.uniform(0.5, 3) + rng.normal(size=d) * rng.choice([0, 0.02, 0.15]) * np.linalg.norm(base) / np.sqrt(d)
        else:
            v = rng.normal(size=d)
        rows.append((i, v.tolist(), int(rng.integers(3))))
    return rows


def test_equals_brute_force(spark, monkeypatch):
    rows = near_copies(np.random.default_rng(1), 300)
    check(spark, rows)
    monkeypatch.setattr(embed_dup, "TILE", 16)
    check(spark, rows)
    check(spark, rows, 0.9)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, nan], 1), (6, [1.0, inf], 1), (7, [1.0, 2.0], None), (8, [1.0, 2.0], 1),
            (8, [1.0, 2.0], 1), (9, [2.0, 4.0], 1), (None, [1.0, 2.0], 1), (None, [5.0, -1.0], 2), (10, [1.0, 2.0, 0.0], 1), (11, [-1.0, -2.0], 1), (12, [1.0, 2.0], 2)]
    check(spark, rows)
    check(spark, [])


def test_tiles_stop_early_without_losing_links():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 40)) * np.linspace(3, 0.1, 40)
    y = np.concatenate([x[:50] + rng.normal(size=(50, 40)) * 0.05, rng.normal(size=(100, 40))])
    u, v = embed_dup._unit(x), embed_dup._unit(y)
    i, j = embed_dup.tile_links(x, y, u, v, 0.98, False)
    want = np.argwhere((x @ y.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) >= 0.98)
    assert sorted(zip(i.tolist(), j.tolist())) == [tuple(p) for p in want.tolist()] and len(want)


def test_any_magnitude(spark):
    """Vectors next to the ends of the double range link as others do, and spoil nothing for them."""
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.001], 1), (3, [1e-200, 1e-200], 1), (4, [1e-320, 1e-320], 1), (5, [1e200, 1e200], 1), (6, [1e200, 1.0001e200], 1),
            (7, [1.7e308, 1.7e308], 1), (8, [0.5, 0.5], 1), (9, [1e-320, 0.0], 1), (10, [-1e250, 1e-250], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dup.near(frame).collect()}
    assert got == {**{i: (5, 3) for i in (3, 4, 5, 6, 7, 8)}, **{i: (2, 1) for i in (1, 2, 9)}, 10: (0, 10)}
