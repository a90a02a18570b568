"""Language ID (10): a linear-chain conditional random field labels words in code-switched text.

The labels are the languages seen in training. The field is fitted to word sequences drawn
from a bounded sample of documents of known language; sequences of different languages are spliced,
so that transitions between languages are learnt as well. A lexicon (frequent words mostly seen
in one language) is a feature. A document's language is the one with the highest
mean marginal over its words with a letter; its score is that mean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm import crf
from valuelens.llm import words as W
from valuelens.llm.tables import map_arrow
from valuelens.llm.toxicity import excerpt

#: Bounds of the sample that the model is fitted on: documents per language, characters per document, documents of all
#: languages (one of each at least). Every language with training rows is learnt.
FIT_DOCS, FIT_CHARS, FIT_TOTAL = 700, 3000, 700 * 256
#: Size of the feature table: 2^BITS rows for up to 256 languages, fewer beyond, so that rows times languages stay bounded.
BITS = 18
SEQUENCE = 32
_DIGITS = np.zeros(256, dtype=bool)
_DIGITS[48:58] = True


def train_rows(doc_id="doc_id"):
    """Rows that may be learnt from: crc32 of doc_id as text is not 0 modulo 5."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 5 != 0


def table_bits(languages: int) -> int:
    return max(10, BITS - max(0, (languages - 1).bit_length() - 8))


def sample(docs: DataFrame, train, fit_docs: int, fit_chars: int, fit_total: int) -> list:
    """Rows (text, lang) of at most ``fit_docs`` documents per language, fewer if all would exceed ``fit_total``, drawn by hash."""
    known = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(train)
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.min(_draw()).alias("least"))
    fit_docs = min(fit_docs, max(1, fit_total // max(1, counts.count())))
    # one row per language; the first row by hash is always in, as a rare language may have no draw below its part
    share = F.broadcast(counts.withColumn("part", F.greatest(F.lit(1.0 * fit_docs) / F.col("count"), F.col("least"))))
    draw = _draw()
    rows = known.join(share, "lang").where(draw <= F.col("part")).select(excerpt("text", fit_chars).alias("text"), "lang", draw.alias("h"))
    by_lang: dict[str, list] = {}
    for r in sorted({(r.text, r.lang): r for r in rows.collect()}.values(), key=lambda r: (r.h, r.text, r.lang)):
        by_lang.setdefault(r.lang, []).append(r)
    return [r for lang in sorted(by_lang) for r in by_lang[lang][:fit_docs]]


def _draw():
    return F.pmod(F.xxhash64(F.lit("fit"), F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)


def learn(rows: list, seed: int = 5) -> crf.Crf | None:
    """The field, or None without training words."""
    langs = sorted({r.lang for r in rows})
    w = W.cut(W.split(pa.array([r.text for r in rows], pa.string()), W.ALNUM))
    h = w.hashes()
    if not len(h):
        return None
    number = {lang: i for i, lang in enumerate(langs)}
    lang = np.array([number[r.lang] for r in rows])[w.doc_of()]
    _, at, kind = np.unique(h, return_index=True, return_inverse=True)
    k = len(langs)
    pair, many = np.unique(kind * k + lang, return_counts=True)
    order = np.lexsort((pair, -many, pair // k))  # each word's most frequent language first
    pair, many = pair[order], many[order]
    head = np.searchsorted(pair // k, np.arange(len(at)))
    owner, total = pair[head] % k, np.bincount(kind, minlength=len(at))
    sure = (total >= 20) & (many[head] >= 0.9 * total)
    lexicon = np.stack([h[at][sure], owner[sure].astype(np.uint64)], axis=1)
    lexicon = lexicon[np.argsort(lexicon[:, 0])]
    # sequences: runs of words; one in three has its second half taken from another run
    starts = np.concatenate([np.arange(a, b, SEQUENCE) for a, b in zip(w.first[:-1], w.first[1:])])
    ends = np.minimum(starts + SEQUENCE, w.first[1:][w.doc_of()[starts]])
    grid = starts[:, None] + np.arange(SEQUENCE)
    ok = grid < ends[:, None]
    grid = np.where(ok, grid, 0)
    types, tags = np.where(ok, kind[grid], -1), np.where(ok, lang[grid], 0)
    rng = np.random.default_rng(seed)
    full = np.flatnonzero(ok.all(axis=1))
    mixed = rng.permutation(full)[: len(full) // 3]
    other = rng.choice(full, len(mixed)) if len(mixed) else mixed
    place = rng.integers(4, SEQUENCE - 3, len(mixed)) if len(mixed) else mixed
    late = np.arange(SEQUENCE)[None, :] >= place[:, None] if len(mixed) else np.zeros((0, SEQUENCE), dtype=bool)
    t, g = np.where(late, types[other], types[mixed]), np.where(late, tags[other], tags[mixed])
    types[mixed], tags[mixed] = t, g
    f = crf.features(w, at, h[at], table_bits(k), lexicon)
    field = crf.fit(langs, f, types, tags, table_bits(k), rounds=2, seed=seed)
    field.lexicon = lexicon
    return field


def identify(docs: DataFrame, train=None, fit_docs: int = FIT_DOCS, fit_chars: int = FIT_CHARS, fit_total: int = FIT_TOTAL,
             spans: bool = True) -> DataFrame:
    """Per row of docs: doc_id, lang_pred, score, and ``spans``: (language, first word, words) runs of the most likely word labels.

    docs needs doc_id, text and lang (lang only of training rows is read). Null texts and texts
    without a letter are ``und`` with score 0, as is everything without training rows. Repeated
    rows are labelled alike; other columns are ignored. Non-ASCII runs of over 64 bytes count as
    several words (``words.cut``).
    """
    model = learn(sample(docs, train_rows() if train is None else train, fit_docs, fit_chars, fit_total))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # size fixed by BITS and the number of languages
    size = W.PIECE_BYTES // max(1, (len(model.labels) if model else 1) // 8)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        field = shared.value
        run_type = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("words", pa.int64())]))
        for b in W.pieces(batches, size=size):
            texts = b.column("text")
            w = W.cut(W.split(texts, W.ALNUM))
            n = b.num_rows
            letter = ~_all_digits(w)
            doc = w.doc_of()
            known = np.bincount(doc[letter], minlength=n) > 0
            lang, score = np.array(["und"] * n, dtype=object), np.zeros(n)
            runs: list[list[dict]] = [[] for _ in range(n)]
            if field is not None and len(doc):
                p = field.score(w)
                mean = np.stack([np.bincount(doc, p[:, j] * letter, minlength=n) for j in range(p.shape[1])], axis=1)
                mean /= np.maximum(np.bincount(doc, letter, minlength=n), 1)[:, None]
                for i in np.flatnonzero(known & ~_has_ascii_letter(w, n)).tolist():
                    known[i] = any(c.isalpha() for c in texts[i].as_py())
                lang[known] = np.array(field.labels, dtype=object)[mean.argmax(axis=1)[known]]
                score[known] = np.minimum(mean.max(axis=1)[known], 1.0)
                if spans:
                    best = p.argmax(axis=1)
                    edge = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])]))
                    for a, e in zip(edge.tolist(), [*edge[1:].tolist(), len(best)]):
                        if known[doc[a]]:
                            runs[doc[a]].append({"lang": field.labels[best[a]], "first": int(a - w.first[doc[a]]), "words": e - a})
            columns = [b.column("doc_id"), pa.array(lang.tolist(), pa.string()), pa.array(score)]
            if spans:
                columns.append(pa.array(runs, run_type))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", *(["spans"] if spans else [])])

    more = ", spans array<struct<lang:string,first:long,words:long>>" if spans else ""
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double{more}")


def _all_digits(w: W.Words) -> np.ndarray:
    if not len(w.start):
        return np.zeros(0, dtype=bool)
    other = np.concatenate([[0], np.cumsum(~_DIGITS[w.data])])
    return other[w.end] == other[w.start]


def _has_ascii_letter(w: W.Words, n: int) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum((w.data >= 97) & (w.data <= 122))])
    per = total[w.end] - total[w.start]
    return np.bincount(w.doc_of(), per, minlength=n) > 0
