import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from valuelens.llm import words as W

PATTERNS = {W.ALNUM: rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", W.NONSPACE: rb"[^\x20\x09-\x0D]+", W.NONSPACE_LOWER: rb"[^\x20\x09-\x0D]+"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1 é\n.-ß\x1f", max_size=40)), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    for kind, pattern in PATTERNS.items():
        w = W.split(pa.array(texts, pa.string()), kind)
        seen = {}
        h = w.hashes()
        for i, t in enumerate(texts):
            raw = (t or "").encode()
            raw = raw if kind == W.NONSPACE else raw.lower()
            assert w.texts(i) == re.findall(pattern, raw)
            for word, x in zip(w.texts(i), h[w.first[i] : w.first[i + 1]].tolist()):
                assert seen.setdefault(word, x) == x
        assert len(set(seen.values())) == len(seen)


def test_long_words_differ_at_their_end():
    w = W.split(pa.array(["a" * 9999 + "b", "a" * 9999 + "c", "a" * 10000]), W.NONSPACE)
    assert len(set(w.hashes().tolist())) == 3


def test_chain_tells_order():
    h = np.array([1, 2, 3, 1, 2, 4], dtype=np.uint64)
    c = W.chain(h, 2)
    assert c[0] == c[3] and len(set(c.tolist())) == 4 and len(W.chain(h, 7)) == 0


def test_covered():
    assert W.covered(np.array([0, 3, 3]), np.array([2, 1, 4]), 8).tolist() == [True, True, False, True, True, True, True, False]


def test_cut_covers_long_runs():
    texts = ["語" * 1000 + " ab " + "é" * 40, None, "w" * 500, "é" * 32 + " x", "a" * 70 + "語", "𝄞" * 50, "語" * 22]
    w = W.split(pa.array(texts), W.ALNUM)
    got = W.cut(w)
    assert [b"".join(got.texts(i)) for i in range(len(texts))] == [b"".join(w.texts(i)) for i in range(len(texts))]
    assert got.texts(2) == [b"w" * 500] and got.texts(3) == w.texts(3)
    for i in (0, 4, 5, 6):
        assert all(0 < len(x) <= 12 and x.decode() for x in got.texts(i)), i
    assert W.cut(W.split(pa.array([None, ""], pa.string()), W.ALNUM)).first.tolist() == [0, 0, 0]
