import random
import zlib

import numpy as np
import pyarrow as pa

from llm_rows import EDGE, docs_of
from valuelens.llm import crf, language, toxicity
from valuelens.llm import words as W


def test_marginals_of_any_length_equal_plain_sums(monkeypatch):
    monkeypatch.setattr(crf, "BLOCK", 5)
    rng = np.random.default_rng(0)
    for k in (2, 4):
        lengths = rng.integers(0, 30, size=12)
        first = np.concatenate([[0], np.cumsum(lengths)])
        e, t = rng.normal(size=(first[-1], k)) * 2, rng.normal(size=(k, k))
        got = crf.marginals(e, first, t)
        for a, b in zip(first[:-1], first[1:]):
            if a == b:
                continue
            up = [e[a]]
            for i in range(a + 1, b):
                up.append(np.logaddexp.reduce(up[-1][:, None] + t, axis=0) + e[i])
            down = [np.zeros(k)]
            for i in range(b - 1, a, -1):
                down.append(np.logaddexp.reduce(t + e[i] + down[-1], axis=1))
            m = np.array(up) + np.array(down[::-1])
            assert np.allclose(np.exp(m - np.logaddexp.reduce(m, axis=1, keepdims=True)), got[a:b])


def test_fit_learns_transitions_and_affixes():
    rng = random.Random(1)
    texts, tags = [], []
    for _ in range(300):
        t = rng.randrange(2)
        words, own = [], []
        for _ in range(16):
            t = t if rng.random() < 0.9 else 1 - t
            words.append(("ab" if t else "zy") + "".join(rng.choice("mnopq") for _ in range(5)) if rng.random() < 0.7 else "the")
            own.append(t)
        texts.append(" ".join(words))
        tags.append(own)
    w = W.split(pa.array(texts), W.ALNUM)
    h = w.hashes()
    _, at, kind = np.unique(h, return_index=True, return_inverse=True)
    model = crf.fit(["z", "a"], crf.features(w, at, h[at], 14), kind.reshape(300, 16), np.array(tags), 14, rounds=4)
    fresh = W.split(pa.array(["abqqqqq the the the abppppp", "zymmmmm the the zyooooo"]), W.ALNUM)
    assert model.score(fresh)[:, 1].round().tolist() == [1] * 5 + [0] * 4
    assert model.transition[0, 0] > model.transition[0, 1] and model.transition[1, 1] > model.transition[1, 0]


def toxic_corpus(rng, n):
    plain = ["".join(rng.choice("abdeghlnorst") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    bad = ["idiot", "scum"] + ["zorx" + "".join(rng.choice("abdeg") for _ in range(3)) for _ in range(80)]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randrange(10, 60))]
        toxic = rng.random() < 0.3
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxic_documents_and_words_are_found(spark):
    rows, labels = toxic_corpus(random.Random(5), 900)
    known = spark.createDataFrame(labels + [(None, 1), (5000, 0), (3, None)], "doc_id long, toxic int")
    got = toxicity.tag(docs_of(spark, rows), known).collect()
    truth = dict(labels)
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([(r.score >= 0.7) == (truth[r.doc_id] == 1) for r in held]) > 0.95
    for r in got:
        assert 0 <= r.score <= 1
        raw = r.text.encode()
        for s in r.spans:
            assert raw[s.first : s.end].decode().lower() == r.text.lower().split()[s.word]
    found = {r.text.split()[s.word][:4] for r in held for s in r.spans if s.p > 0.9}
    assert "zorx" in found
    kept = toxicity.tag(docs_of(spark, rows), known, keep=0.7)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.score < 0.7) and kept.columns == docs_of(spark, rows).columns


def test_wrong_labels_leave_the_cues(spark):
    """2 and 5 % of the labels flipped, and cues that stand in clean documents too: toxic documents are still found."""
    for seed, flips, stray in ((8, 0.02, 0.0), (9, 0.05, 0.0), (10, 0.05, 0.05)):
        rng = random.Random(seed)
        rows, labels = toxic_corpus(rng, 1500)
        truth = dict(labels)
        rows = [(i, t + " idiot" if not truth[i] and rng.random() < stray else t) for i, t in rows]
        known = spark.createDataFrame([(i, 1 - x if rng.random() < flips else x) for i, x in labels], "doc_id long, toxic int")
        got = [r for r in toxicity.tag(docs_of(spark, rows), known, spans=False).collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
        found = [r.score >= 0.7 for r in got if truth[r.doc_id]]
        wrong = [r.score >= 0.7 for r in got if not truth[r.doc_id]]
        assert np.mean(found) > 0.9 and np.mean(wrong) < 0.03 + stray, (flips, stray, np.mean(found), np.mean(wrong))


def test_few_toxic_documents_are_explained():
    doc = np.repeat(np.arange(40), 2)
    feature = np.stack([np.arange(40) % 5, np.where(np.arange(40) < 3, 6, 5)], axis=1).ravel()
    assert 6 in toxicity.explain(doc, feature, np.arange(40) < 3)


def test_toxicity_edge_rows(spark):
    rows, labels = toxic_corpus(random.Random(6), 200)
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.tag(docs_of(spark, EDGE), labels, fit_docs=100).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 for r in got if not (r.text or "").strip())
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r.score == 0 for r in toxicity.tag(docs_of(spark, EDGE), none).collect())
    assert toxicity.tag(docs_of(spark, []), labels).count() == 0


def language_corpus(rng, n):
    ends = {"aa": "xq", "bb": "wz", "cc": "vy"}
    rows = []
    for i in range(n):
        lang = rng.choice(list(ends))
        w = ["".join(rng.choice("abcdefgh") for _ in range(3)) + "".join(rng.choice(ends[lang]) for _ in range(2)) for _ in range(rng.randrange(5, 40))]
        rows.append((i, " ".join(w), lang))
    return rows


def test_languages_are_told_apart(spark):
    rows = language_corpus(random.Random(7), 600)
    more = [(9001, None, "aa"), (9002, "12 34 -- !", "bb"), (9003, "dabxq " * 20 + "dabwz " * 20, None), (9004, "...", None)]
    got = {r.doc_id: r for r in language.identify(docs_of(spark, rows + more)).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert np.mean([got[i].lang_pred == lang for i, _, lang in held]) > 0.95
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (9001, 9002, 9004))
    runs = [(s.lang, s.first, s.words) for s in got[9003].spans]
    assert runs == [("aa", 0, 20), ("bb", 20, 20)]


def test_runs_without_spaces_are_seen_to_their_end(spark):
    rng = random.Random(11)
    letters = {"zh": [chr(0x4E00 + i) for i in range(300)], "ja": [chr(0x3041 + i) for i in range(80)]}
    run = lambda lang, n: "".join(rng.choice(letters[lang]) for _ in range(n))
    rows = [(i, run(lang, rng.randrange(50, 300)), lang) for i in range(200) for lang in [rng.choice(["zh", "ja"])]]
    rows += [(9001, run("zh", 60) + run("ja", 600), None), (9002, run("ja", 60) + run("zh", 600), None)]
    got = {r.doc_id: r for r in language.identify(docs_of(spark, rows)).collect()}
    assert (got[9001].lang_pred, got[9002].lang_pred) == ("ja", "zh")
    assert [s.lang for s in got[9001].spans] == ["zh", "ja"]
    bad = "毒蛇"
    texts, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        parts = [run("ja", rng.randrange(60, 150)) for _ in range(3)]
        texts.append((i, (bad if toxic else "").join(parts)))
        labels.append((i, int(toxic)))
    scored = toxicity.tag(docs_of(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int"), spans=False).collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([(r.score >= 0.7) == (r.doc_id % 3 == 0) for r in held]) > 0.9


def test_long_tokens_give_all_their_trigrams():
    w = W.split(pa.array(["a" * 100 + "xyz", "a" * 103]), W.ALNUM)
    rows, h = crf.trigrams(w, np.arange(2))
    assert np.bincount(rows).tolist() == [101, 101] and len(np.unique(h[rows == 0])) > len(np.unique(h[rows == 1]))


def test_every_language_is_learnt(spark):
    """300 languages, the rarest with two training documents."""
    rng = random.Random(13)
    own = {f"l{j:03}": ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(8)] for j in range(300)}
    rows, i = [], 0
    for j, (lang, words) in enumerate(own.items()):
        for _ in range(4 if j < 290 else 2):
            while zlib.crc32(str(i).encode()) % 5 == 0:
                i += 1
            rows.append((i, " ".join(rng.choice(words) for _ in range(40)), lang))
            i += 1
    fresh = [(10**6 + j, " ".join(rng.choice(words) for _ in range(40)), None) for j, words in enumerate(own.values())]
    got = {r.doc_id: r.lang_pred for r in language.identify(docs_of(spark, rows + fresh), spans=False).collect()}
    right = [got[10**6 + j] == lang for j, lang in enumerate(own)]
    assert np.mean(right) > 0.95 and np.mean(right[290:]) >= 0.8
    assert [language.table_bits(n) for n in (1, 4, 256, 257, 1000)] == [18, 18, 18, 17, 16]


def test_language_edge_rows(spark):
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs_of(spark, EDGE)).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "en" and got[7][0] == "en"
    assert language.identify(docs_of(spark, [])).count() == 0
    unknown = docs_of(spark, [(1, "abc", None), (2, "abc d", None)])
    assert {(r.lang_pred, r.score) for r in language.identify(unknown).collect()} == {("und", 0.0)}


def test_toxic_texts_of_the_given_tables(spark):
    """Held-out rows: some labels are wrong, so not all can be found."""
    path = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{path}/{n}.parquet") for n in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.where("toxic is not null").collect()}
    got = [r for r in toxicity.tag(docs.select("doc_id", "text"), labels, spans=False).collect() if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([r.score >= 0.7 for r in got if truth[r.doc_id]]) > 0.8
    assert np.mean([r.score >= 0.7 for r in got if not truth[r.doc_id]]) <= 0.01


def test_rows_of_a_hot_id_are_one_training_row(spark):
    rows, labels = toxic_corpus(random.Random(6), 200)
    hot = [(labels[0][0], f"text number {i}") for i in range(500)]
    got = toxicity.sample(docs_of(spark, rows + hot), spark.createDataFrame(labels, "doc_id long, toxic int"), toxicity.train_rows(), 1000, 4000)
    assert len(got) <= len(rows)
