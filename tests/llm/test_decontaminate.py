import random
import re

import pytest
from pyspark.sql import functions as F

from llm_rows import EDGE, docs_of
from valuelens.llm.decontaminate import clean_documents, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, bench, n):
    windows = set()
    for item, text in bench:
        w = words(text)
        m = min(n, len(w))
        windows |= {(tuple(w[i : i + m]), item) for i in range(len(w) - m + 1) if m}
    out = []
    for i, text in docs:
        w = words(text)
        hit, items = set(), set()
        for x, item in windows:
            for s in range(len(w) - len(x) + 1):
                if tuple(w[s : s + len(x)]) == x:
                    hit |= set(range(s, s + len(x)))
                    items |= {str(item)} if item is not None else set()
        out.append((i, len(w), len(hit), sorted(items)))
    return sorted(out, key=str)


def data(seed):
    rng = random.Random(seed)
    v = [f"t{i}" for i in range(40)]
    bench = [(i, " ".join(rng.choice(v) for _ in range(rng.choice([0, 2, 5, 12, 30])))) for i in range(12)] + [(None, "t1 t2 t3"), (3, None), (5, "É-Ü x")]
    docs = []
    for i in range(60):
        w = [rng.choice(v + ["É", "Ü", "X"]) for _ in range(rng.randrange(60))]
        if rng.random() < 0.5:
            w[3:3] = (rng.choice(bench)[1] or "").upper().split()
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w)))
    return docs, bench


@pytest.mark.parametrize("bound", [4_000_000, 0])
def test_equals_brute_force_by_broadcast_and_by_join(spark, bound):
    docs, bench = data(1)
    got = decontaminate(docs_of(spark, docs), spark.createDataFrame(bench, "item_id long, text string"), max_windows=bound).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got), key=str) == brute(docs, bench, 10)
    text = dict(docs)
    for r in got:
        # what is left holds the words that were not hit
        assert len(words(r.text_clean)) == r.n_words - r.n_hit if r.n_hit else r.text_clean == text[r.doc_id]
    kept = clean_documents(docs_of(spark, docs), spark.createDataFrame(bench, "item_id long, text string"), max_windows=bound)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.n_hit == 0)
    assert kept.columns == docs_of(spark, docs).columns


def test_spans_are_cut_out(spark):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    got = decontaminate(docs_of(spark, [(1, "Say: One, two\nthree! done"), (2, "é One two three é")]), bench).collect()
    assert {r.doc_id: r.text_clean for r in got} == {1: "Say: ! done", 2: "é  é"}


def test_edge_rows(spark):
    bench = spark.createDataFrame([(1, "alpha beta"), (2, "word word")], "item_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_hit) for r in decontaminate(docs_of(spark, EDGE), bench).collect()), key=str)
    assert got == sorted([(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 2, 2), (4, 2, 2), (5, 30000, 30000), (6, 1, 0), (7, 4, 0), (8, 1, 0), (None, 2, 2)], key=str)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(docs_of(spark, EDGE), empty).where("n_hit > 0").count() == 0
    assert decontaminate(docs_of(spark, []), bench).count() == 0


def test_both_paths_drop_the_same_rows(spark):
    """Rows without an id, and rows that share one, are judged by their own text, however large the benchmark is."""
    from llm_rows import DOCS

    item = "one two three four five six seven eight nine ten eleven"
    rows = [(None, "clean text one"), (None, f"x {item}"), (7, "clean text two"), (7, f"{item} y"), (8, None), (8, ""), (9, item), (9, item), (10, "clean"), (10, "clean")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "x", 1.0, 2, "z", 3) for i, t in rows], DOCS).repartition(3)
    docs = docs.withColumn("k", F.lit(1)).withColumn("row", F.lit("r"))
    bench = spark.createDataFrame([(1, item), (2, "short item")], "item_id long, text string")
    want = sorted(((i, t) for i, t in rows if item not in (t or "")), key=str)
    for most in (4_000_000, 1):
        kept = clean_documents(docs, bench, max_windows=most)
        assert kept.columns == docs.columns
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == want
