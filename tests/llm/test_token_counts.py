import random

import public_tokenizers
import pytest
from llm_rows import EDGE, docs_of
from tokenizers import Tokenizer

from valuelens.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def lengths(library, texts):
    return [len(e) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def compare(spark, library, rows, **kw):
    got = token_counts.count(docs_of(spark, rows).repartition(3), PATH, **kw).collect()
    want = [(r[0], len((r[1] or "").encode()), n, n > 1024) for r, n in zip(rows, lengths(library, [r[1] for r in rows]))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


ODD = ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|", "it's we'll 'S ''s 'tis", " \n\t x  y \r\n\r\n", "  a\u0085b\x1cb\x1f ", "１２３ x²½",
       "a՘b ꟎ 𐥀 \U0001e5d0", "​‍👩‍👩‍👧 é", "ab" * 40000, " " * 9000 + "x", "日本語テキスト、漢字。" * 50, "\x00\x01", "don't  stop", "�"]


def test_edge_rows(spark, library):
    compare(spark, library, EDGE + [(100 + i, t) for i, t in enumerate(ODD)])


def test_empty_table(spark, library):
    compare(spark, library, [])
    compare(spark, library, [(1, None), (2, "")])


def test_without_table_and_with_tiny_bounds(spark, library, monkeypatch):
    """The table and the caches decide about speed only; stretches are cut at pre-token borders only."""
    for name, value in {"TABLE": 0, "CACHE": 2, "CACHED_CHARS": 3, "STRETCH": 5}.items():
        monkeypatch.setattr(token_counts, name, value)
    counter = token_counts.PieceCounter(open(PATH, encoding="utf-8").read(), {})
    texts = [t for _, t in EDGE if t] + ODD
    assert [counter.count(t) for t in texts] == lengths(library, texts)


def test_random_characters(library):
    rng = random.Random(5)
    pools = [range(32, 127), range(9, 14), range(0x80, 0x600), range(0x2000, 0x2100), range(0xA000, 0xB000), range(0x10000, 0x12000), range(0x1F300, 0x1FA00)]
    texts = ["".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    counter = token_counts.PieceCounter(open(PATH, encoding="utf-8").read(), {"a": 1})
    assert [counter.count(t) for t in texts] == lengths(library, texts)


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r.n_tokens for r in token_counts.count(docs, PATH).collect()}
    assert got == {i: n for (i, _), n in zip(rows, lengths(library, [t for _, t in rows]))}


def test_other_tokenizers_are_counted_by_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    other = Tokenizer.from_file(path)
    texts = ["Alpha  beta", "<|startoftext|> it's", "", "é ß"]
    got = token_counts.count(docs_of(spark, list(enumerate(texts))), path).collect()
    assert {r.doc_id: r.n_tokens for r in got} == dict(enumerate(lengths(other, texts)))


def test_table_is_bounded(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    blob, ends, n = token_counts.frequent(docs, open(PATH, encoding="utf-8").read(), "text")
    assert 0 < len(ends) == len(n) <= token_counts.TABLE and len(blob) <= token_counts.TABLE * token_counts.ENTRY_BYTES
