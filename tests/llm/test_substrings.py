import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from valuelens.llm import recompression as R
from valuelens.llm import words as W
from valuelens.llm.substrings import without_repeats

from llm_rows import EDGE, docs_of


def brute(rows, window):
    """Rows with distinct doc_id: kept words after removing covered words of windows that started earlier."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = (t or "").split()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            x = tuple(w[s : s + window])
            if x in seen:
                gone[s : s + window] = [True] * window
            seen.add(x)
        out[i] = (len(w), sum(gone), " ".join(v for v, g in zip(w, gone) if not g))
    return out


def corpus(rng, n=60):
    words = [f"w{i}" for i in range(300)]
    passages = [[rng.choice(words) for _ in range(rng.randrange(15, 60))] for _ in range(6)] + [["ha"] * 70, ["a", "b"] * 40, ["p", "q", "r"] * 9]
    rows = []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randrange(0, 120))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randrange(len(w) + 1)
            p = rng.choice(passages)
            w[at:at] = p[rng.randrange(5) : len(p) - rng.randrange(5)]
        rows.append((i, " ".join(w)))
    return rows + [(1000 + i, t) for i, t in rng.sample(rows, 8)]


@pytest.mark.parametrize("window,seed", [(20, 1), (7, 2), (20, 3)])
def test_equals_brute_force(spark, window, seed):
    rows = corpus(random.Random(seed))
    got = {r.doc_id: (r.n_words, r.n_removed, r.text_kept, r.kept_sha256) for r in without_repeats(docs_of(spark, rows).repartition(5), window).collect()}
    assert got == {i: (*v, hashlib.sha256(v[2].encode()).hexdigest()) for i, v in brute(rows, window).items()}


def test_edge_rows(spark):
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in without_repeats(docs_of(spark, EDGE)).collect()), key=str)
    # a text of one word again and again: the first window stays, what later ones add goes
    assert (5, 30000, 29999) in got
    assert (1, 0, 0) in got and (None, 2, 0) in got and got.count((4, 2, 0)) == 2 and (8, 1, 0) in got
    assert without_repeats(docs_of(spark, [])).count() == 0


def test_null_id_comes_last(spark):
    t = " ".join(f"v{i}" for i in range(30))
    got = {r.doc_id: r.n_removed for r in without_repeats(docs_of(spark, [(None, t), (9, t), (9, t)])).collect()}
    assert got == {None: 30, 9: 0}


def test_many_null_ids_and_repeated_rows_with_a_shared_passage(spark):
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(30)]
    own = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    nulls = [" ".join(own(rng.randrange(0, 60)) + passage + own(5)) for _ in range(700)]
    first, second = " ".join(own(7) + passage + own(9)), " ".join(own(3) + passage + own(2))
    rows = [(1, first)] * 5 + [(2, second)] * 3 + [(None, t) for t in nulls]
    got = without_repeats(docs_of(spark, rows).repartition(6)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_removed) for r in got} == {(1, 0), (2, 30), (None, 30)}
    assert {r.text_kept for r in got if r.doc_id is None} == {" ".join(w for w in t.split() if w[0] != "p") for t in nulls}
    # among texts with null ids alone, the passage stays in one
    alone = without_repeats(docs_of(spark, [(None, t) for t in nulls])).collect()
    assert sorted(r.n_removed for r in alone) == [0] + [30] * 699


def test_equal_windows_have_equal_keys():
    rng = np.random.default_rng(5)
    core = rng.integers(0, 50, size=40)
    texts = [" ".join(f"x{v}" for v in np.concatenate([rng.integers(0, 50, size=n), core, rng.integers(0, 50, size=9)])) for n in (0, 3, 17, 40)]
    w = W.split(pa.array(texts), W.NONSPACE)
    starts = R.window_starts(w.first, 20)
    key = R.anchors(R.levels(w.hashes(), w.first, 5), starts, 20)
    by_window = {}
    h = W.chain(w.hashes(), 20)
    for s, k in zip(starts.tolist(), key.tolist()):
        assert by_window.setdefault(int(h[s]), k) == k
    assert len(by_window) < len(starts)
