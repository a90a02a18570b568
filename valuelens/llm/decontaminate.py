"""Benchmark decontamination (2): a broadcast hash set of normalised benchmark n-grams.

Words are runs of ASCII letters and digits and non-ASCII characters, A-Z lowered.
A window is ``n`` consecutive words of a benchmark item; an item with fewer words (but
not none) is one window. Documents are scanned for the fingerprints of all windows,
hits are verified with a second, independent fingerprint, and every word inside
an occurrence counts as hit.

Scale: the index holds two 64-bit fingerprints and an item number per window. It is
broadcast only if the benchmark has at most ``max_windows`` words (counted first);
a larger benchmark is joined with the documents' windows by fingerprint instead. The
documents are read once and never shuffled on the broadcast path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm import words as W
from valuelens.llm.tables import map_arrow, written

_BITS = 22
_SEED2 = 0x5851F42D4C957F2D


@dataclass
class Index:
    """Windows of a benchmark: per length, sorted first fingerprints, second ones and items."""

    items: list[str | None]
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _windows(w: W.Words, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, text, first fingerprint, second fingerprint) of the windows of item texts."""
    h1, h2, counts = w.hashes(), w.hashes(_SEED2), w.counts
    for length in np.unique(np.minimum(counts[counts > 0], n)).tolist():
        f1, f2 = W.chain(h1, length), W.chain(h2, length, 0x9FB21C651E98DF25)
        doc = w.doc_of()
        whole = doc[: len(f1)] == doc[length - 1 :]
        whole &= (counts >= n)[doc[: len(f1)]] if length == n else (counts == length)[doc[: len(f1)]]
        at = np.flatnonzero(whole)
        yield length, doc[at], f1[at], f2[at]


def build_index(ids: list[str | None], texts: list[str | None], n: int = 10) -> Index:
    w = W.split(pa.array(texts, type=pa.string()), W.ALNUM)
    by_length = {}
    for length, doc, f1, f2 in _windows(w, n):
        order = np.lexsort((doc, f2, f1))
        f1, f2, doc = f1[order], f2[order], doc[order]
        table = np.zeros(1 << _BITS, dtype=bool)
        table[f1 >> np.uint64(64 - _BITS)] = True
        by_length[length] = (f1, f2, doc, table)
    return Index(ids, by_length)


def scan(texts: pa.Array, index: Index):
    """Words of the texts, which of them are hit, and the (text, item) pairs found."""
    w = W.split(texts, W.ALNUM)
    hit = np.zeros(len(w.start), dtype=bool)
    found: set[tuple[int, str]] = set()
    if not len(w.start):
        return w, hit, found
    h1, doc, h2 = w.hashes(), w.doc_of(), None
    for length, (f1, f2, item, table) in index.by_length.items():
        g1 = W.chain(h1, length)
        at = np.flatnonzero(table[g1 >> np.uint64(64 - _BITS)])
        at = at[doc[at] == doc[at + length - 1]] if len(at) else at
        lo, hi = np.searchsorted(f1, g1[at], side="left"), np.searchsorted(f1, g1[at], side="right")
        at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
        if not len(at):
            continue
        if h2 is None:
            h2 = w.hashes(_SEED2)
        g2 = _chain_at(h2, at, length)
        n_same = hi - lo
        row = np.repeat(np.arange(len(at)), n_same)
        entry = np.arange(len(row)) - np.repeat(np.cumsum(n_same) - n_same, n_same) + np.repeat(lo, n_same)
        true = f2[entry] == g2[row]
        row, entry = row[true], entry[true]
        hit |= W.covered(at[row], np.full(len(row), length), len(hit))
        pairs = np.unique(np.stack([doc[at[row]], item[entry]]), axis=1)
        found.update((d, i) for d, i in pairs.T.tolist())
    return w, hit, {(d, index.items[i]) for d, i in found if index.items[i] is not None}


def _chain_at(h2: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    out = h2[at].copy()
    for k in range(1, length):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += h2[at + k]
    return W.mix64(out)


def _clean(w: W.Words, hit: np.ndarray, text: str, i: int) -> str:
    """The text without the spans from the first to the last word of each run of hit words."""
    a, b = int(w.first[i]), int(w.first[i + 1])
    inside = hit[a:b]
    if not inside.any():
        return text
    raw = text.encode()
    base = int(w.start[a]) - _offset(raw, w, a)
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    out, at = [], 0
    for s, e in zip((np.flatnonzero(edge == 1) + a).tolist(), (np.flatnonzero(edge == -1) + a - 1).tolist()):
        out.append(raw[at : int(w.start[s]) - base])
        at = int(w.end[e]) - base
    return b"".join([*out, raw[at:]]).decode()


def _offset(raw: bytes, w: W.Words, a: int) -> int:
    """Byte place in its text of word a, the text's first word."""
    one = W.split(pa.array([raw.decode()]), W.ALNUM)
    return int(one.start[0])


#: Columns that :func:`decontaminate` adds.
ADDED = "n_words long, n_hit long, item_ids array<string>, text_clean string"


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, max_windows: int = 4_000_000,
                  text_column: str = "text", clean_text: bool = True) -> DataFrame:
    """Per document ``doc_id`` and ADDED: words, hit words, items with a hit, text without hit spans.

    docs needs doc_id and the text column, benchmark item_id and text; other columns are
    ignored, whatever their names. Null or empty text: no words, nothing hit. Items
    with null id count for hits but are not listed. Repeated items count once, repeated
    documents each get a row. Empty benchmark: nothing is hit. ``clean_text=False``
    leaves text_clean null.
    """
    bench = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text"))
    docs = docs.select("doc_id", F.col(text_column).alias("text"))
    index = _index(bench, n, max_windows)
    if index is None:
        return _by_join(docs, bench, n, clean_text)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for b in W.pieces(batches):
            texts = b.column("text")
            w, hit, found = scan(texts, shared.value)
            yield _rows(b.column("doc_id"), texts, w, hit, found, clean_text)

    return map_arrow(docs, run, _schema(docs))


def clean_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10, max_windows: int = 4_000_000) -> DataFrame:
    """The rows of docs, with all their columns, in which no window of the benchmark occurs."""
    bench = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text"))
    index = _index(bench, n, max_windows)
    if index is None:
        # by document (doc_id and text), as rows may share an id, or have none
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _document_key().alias("of"))
        hit = _found(docs.select("text", _document_key().alias("k")), bench, n).select("k")
        return rows.join(hit, F.col("of") == F.col("k"), "left_anti").select("row.*")
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for b in W.pieces(batches):
            w, hit, _ = scan(b.column("text"), shared.value)
            total = np.concatenate([[0], np.cumsum(hit)])
            yield b.filter(pa.array(total[w.first[1:]] == total[w.first[:-1]]))

    return map_arrow(docs, run, docs.schema)


def _index(bench: DataFrame, n: int, max_windows: int) -> Index | None:
    """The index of a benchmark of at most max_windows words, else None."""
    total = bench.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0] or 0
    if total > max_windows:
        return None
    rows = bench.collect()  # at most max_windows words
    return build_index([r[0] for r in rows], [r[1] for r in rows], n)


def _schema(docs: DataFrame) -> str:
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {ADDED}"


def _rows(ids, texts, w, hit, found, clean_text) -> pa.RecordBatch:
    items: dict[int, set[str]] = {}
    for d, i in found:
        items.setdefault(d, set()).add(i)
    total = np.concatenate([[0], np.cumsum(hit)])
    n_hit = total[w.first[1:]] - total[w.first[:-1]]
    clean = pa.nulls(len(ids), pa.string())
    if clean_text:
        clean = pa.array([_clean(w, hit, t, i) if t and n_hit[i] else t for i, t in enumerate(texts.to_pylist())], pa.string())
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(w.counts, pa.int64()), pa.array(n_hit, pa.int64()),
         pa.array([sorted(items.get(i, ())) for i in range(len(ids))], pa.list_(pa.string())), clean],
        names=["doc_id", "n_words", "n_hit", "item_ids", "text_clean"])


def _document_key():
    """128 bits of doc_id and text: tells documents apart, so that repeated ids do not mix."""
    of = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit("\n"), F.coalesce("text", F.lit("")))
    return F.unhex(F.md5(F.encode(of, "UTF-8")))


def _found(keyed: DataFrame, bench: DataFrame, n: int) -> DataFrame:
    """(k, spans, item_ids) of the documents (k, text) in which windows of the benchmark occur: they meet in a join by fingerprint."""
    def items(batches):
        for b in W.pieces(batches):
            w, ids = W.split(b.column("text"), W.ALNUM), b.column("item_id").to_pylist()
            for length, doc, f1, f2 in _windows(w, n):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), pa.array(np.full(len(f1), length), pa.int32()),
                     pa.array([ids[d] for d in doc.tolist()], pa.string())], names=["f1", "f2", "len", "item"])

    windows = written(map_arrow(bench, items, "f1 long, f2 long, len int, item string").distinct())
    lengths = [r[0] for r in windows.select("len").distinct().collect()]  # at most n values
    def spans(batches):
        for b in W.pieces(batches):
            w = W.split(b.column("text"), W.ALNUM)
            h1, h2, doc = w.hashes(), w.hashes(_SEED2), w.doc_of()
            for length in lengths:
                f1, f2 = W.chain(h1, length), W.chain(h2, length, 0x9FB21C651E98DF25)
                at = np.flatnonzero(doc[: len(f1)] == doc[length - 1 :]) if len(f1) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f1[at].view(np.int64)), pa.array(f2[at].view(np.int64)), pa.array(np.full(len(at), length), pa.int32()),
                     b.column("k").take(pa.array(doc[at])), pa.array(at - w.first[doc[at]], pa.int64())], names=["f1", "f2", "len", "k", "start"])

    found = map_arrow(keyed.select("k", "text"), spans, "f1 long, f2 long, len int, k binary, start long")
    return found.join(windows, ["f1", "f2", "len"]).groupBy("k").agg(
        F.collect_set(F.struct("start", "len")).alias("spans"), F.sort_array(F.collect_set("item")).alias("item_ids"))


def _by_join(docs: DataFrame, bench: DataFrame, n: int, clean_text: bool) -> DataFrame:
    """The same for a benchmark too large to broadcast."""
    keyed = docs.withColumn("k", _document_key())
    found = _found(keyed.select("k", "text"), bench, n)
    joined = keyed.join(found, "k", "left").select("doc_id", "text", "spans", "item_ids")

    def run(batches):
        for b in W.pieces(batches):
            texts, lists = b.column("text"), b.column("spans").to_pylist()
            w = W.split(texts, W.ALNUM)
            hit = np.zeros(len(w.start), dtype=bool)
            for i, spans_i in enumerate(lists):
                for s in spans_i or ():
                    hit[w.first[i] + s["start"] : w.first[i] + s["start"] + s["len"]] = True
            pairs = {(i, x) for i, xs in enumerate(b.column("item_ids").to_pylist()) for x in xs or ()}
            yield _rows(b.column("doc_id"), texts, w, hit, pairs, clean_text)

    return map_arrow(joined, run, _schema(docs))


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
