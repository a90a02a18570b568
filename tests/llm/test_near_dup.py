import random

import numpy as np
import pytest

from valuelens.llm import near_dup
from valuelens.llm import words as W
from valuelens.llm.components import connected_components
from valuelens.llm.superminhash import signatures

from llm_rows import EDGE, docs_of


def shingle_set(text, k):
    w = (text or "").lower().split()
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(rows, k):
    sets = {i: shingle_set(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(n_groups, rng, length=60, words=400):
    """Groups of near copies that stray step by step, so that ends of a group link only through others."""
    vocabulary = [f"w{i}" for i in range(words)]
    rows, i = [], 0
    for _ in range(n_groups):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for _ in range(rng.choice([1, 2, 5, 12])):
            rows.append((i, " ".join(base)))
            i += 1
            for _ in range(rng.choice([0, 1, 2, 3])):
                base = list(base)
                base[rng.randrange(length)] = rng.choice(vocabulary)
    return rows


@pytest.mark.parametrize("k", [2, 5])
def test_classes_equal_brute_force(spark, k):
    rows = corpus(40, random.Random(k))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.classes(docs_of(spark, rows), k=k).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in brute(rows, k).items()}


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    rows = corpus(6, random.Random(9), length=80)
    got = {r.doc_id: r.component_id for r in near_dup.classes(docs_of(spark, rows), k=2).collect()}
    assert got == {i: c for i, (_, c) in brute(rows, 2).items()}


def test_edge_rows(spark):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.classes(docs_of(spark, EDGE), k=2).collect()), key=str)
    assert (None, 1, None, True) in got and (1, 0, 1, True) in got and (2, 0, 2, True) in got
    assert got.count((4, 1, 4, True)) == 2
    kept = near_dup.deduplicated(docs_of(spark, EDGE), k=2)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 3, 4, 5, 6, 7, 8, None]
    assert kept.columns == docs_of(spark, EDGE).columns
    assert near_dup.classes(docs_of(spark, []), k=2).count() == 0


def test_signature_is_that_of_plain_superminhash():
    """One element after the other, with an explicit permutation, no early stop."""
    m, rng = 16, np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, size=s).astype(np.uint64) for s in (1, 3, 40, 200)]
    got = signatures(np.concatenate(sets), np.repeat(np.arange(4), [len(s) for s in sets]), 4, m)
    from valuelens.llm.superminhash import _draw

    for s, row in zip(sets, got):
        slots = [2**64 - 1] * m
        for e in s:
            p = list(range(m))
            for j in range(m):
                value, place = _draw(np.array([e]), j, m)
                k = int(place[0])
                p[j], p[k] = p[k], p[j]
                slots[p[j]] = min(slots[p[j]], int(value[0]))
        assert row.tolist() == slots


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        common, a, b = (rng.integers(0, 2**63, size=s).astype(np.uint64) for s in (160, 20, 20))
        x, y = np.concatenate([common, a]), np.concatenate([common, b])
        s = signatures(np.concatenate([x, y]), np.repeat([0, 1], [len(x), len(y)]), 2, near_dup.SLOTS)
        errors.append((s[0] == s[1]).mean() - 0.8)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_intersections():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, size=s)).astype(np.uint64) for s in (0, 5, 50, 200, 80)]
    got = near_dup.intersections(sets[:3], sets[2:], width=7)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets[:3]]


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100 + i, 100) for i in range(1, 50)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    edges += [(7, 7), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lowering(spark):
    got = {r.doc_id: r.component_id for r in near_dup.classes(docs_of(spark, [(1, "A b C d e f"), (2, "a B c D e f"), (3, "a B c D e G h")]), k=2).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    assert W.NONSPACE_LOWER != W.NONSPACE


def test_repeated_rows_of_one_id_do_not_multiply(spark, monkeypatch):
    """Rows compared grow with distinct texts, not with the square of repeated rows; an id with several texts keeps them all."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    near = " ".join([*base[:195], "x", *base[196:]])
    other = [f"v{rng.randrange(10**6)}" for _ in range(200)]
    rows = [(1, " ".join(base))] * 1500 + [(2, near), (1, " ".join(other)), (3, " ".join([*other[:195], "x", *other[196:]])), (4, "alone " * 3)]
    sizes, dealt = [], near_dup._dealt

    def counted(cells):
        sizes.append(cells.count())
        return dealt(cells)

    monkeypatch.setattr(near_dup, "_dealt", counted)
    got = near_dup.classes(docs_of(spark, rows).repartition(4)).collect()
    assert len(got) == len(rows) and {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 1), (4, 4)}
    assert max(sizes) <= 24 * 4, sizes


def test_other_texts_of_an_id_stay(spark):
    near = " ".join(f"w{i}" for i in range(100))
    rows = [(1, near), (1, near), (1, "a completely other text that nothing resembles"), (2, near + " more"), (3, None), (3, None), (None, near)]
    kept = sorted(((r.doc_id, r.text) for r in near_dup.deduplicated(docs_of(spark, rows), k=5).collect()), key=str)
    assert kept == sorted([(1, near), (1, "a completely other text that nothing resembles"), (3, None), (None, near)], key=str)
