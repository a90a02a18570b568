"""Toxicity (8): a linear-chain conditional random field tags toxic spans.

Labels are given per document, tags are needed per word. A bounded sample of labelled
documents is drawn; features (words, prefixes, suffixes) that are cues of toxic documents, beyond wrong
labels and chance, are found by their likelihood ratio. In toxic documents, words with a cue are tagged toxic, words that
clean documents have too are tagged clean, and the rest, which may be either, is left out. The field is
fitted to these tags. Scoring runs over every whole text in one pass
without a shuffle: marginals above a half are offending words; their expected number, the highest marginal and the
length of the text give the document's score by a logistic regression on the same sample, as a cue that
comes up once by chance in a long text says less than several in a short one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm import crf
from valuelens.llm import words as W
from valuelens.llm.tables import map_arrow

#: Bounds of the sample that the model is fitted on: documents per class, characters per document.
FIT_DOCS, FIT_CHARS = 2000, 4000
BITS = 18
SEQUENCE = 48
#: A cue's least share of toxic documents, and how far (in logs) its proof may stay below that of the best chance hit: a few
#: such hits do no harm, as documents are judged by several words, while a short list of labels holds little proof.
PURE, SLACK = 0.8, 1.5
#: Log of the lift from toxic over clean documents from which on a feature is picked where none is pure.
LIFT = float(np.log(3.0))


def excerpt(text: str, chars: int):
    """At most ``chars`` characters of the text, from a place that a hash of it chooses."""
    return F.expr(f"substring({text}, 1 + cast(pmod(xxhash64({text}), greatest(1, length({text}) - {chars} + 1)) as int), {chars})")


def sample(docs: DataFrame, labels: DataFrame, train, fit_docs: int, fit_chars: int) -> list:
    """Rows (text, toxic) of at most ``fit_docs`` labelled documents per class, drawn by hash; one text an id, one of equal excerpts."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "toxic").where(train)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    chosen = [known.where(F.col("toxic") == t).orderBy(*order).limit(fit_docs) for t in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])  # at most 2 * fit_docs rows
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    rows = rows.select("doc_id", excerpt("text", fit_chars).alias("text"), "toxic", F.xxhash64("doc_id").alias("h"))
    # of an id with several texts, the one with the smallest hash
    one = rows.groupBy("doc_id", "h").agg(F.min_by(F.struct("text", "toxic"), F.struct(F.xxhash64("text"), "text")).alias("r")).select("h", "r.*")
    return sorted({r.text: r for r in one.collect()}.values(), key=lambda r: (r.h, r.text))


def explain(doc: np.ndarray, feature: np.ndarray, toxic: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
    """Numbers of the features that are cues. doc, feature: distinct pairs; toxic: per document, may be wrong for some;
    times: occurrences of each pair.

    Every feature is judged on all documents, by those that have it at all and by those that have it more than once (a cue may come
    up by chance in clean texts, but rarely twice). A cue is pure: of such documents at least PURE are toxic; and
    it is hardly chance: the log-likelihood ratio of their labels comes within SLACK of the log of the number of
    features with as many of them, so that short lists need less proof than long ones. If there is no such feature, cues
    stand in clean texts as well: then the features that explain toxic documents best are picked one by one, by the smoothed
    log of their rate in toxic documents not yet explained over that in clean ones, less LIFT, at last any lift above 0, so
    that toxic documents never go without a tag as long as some feature is more frequent in them.
    """
    n_features = int(feature.max()) + 1 if len(feature) else 0
    n_toxic, n_clean = int(toxic.sum()), int((~toxic).sum())
    share = n_toxic / (n_toxic + n_clean)
    cue = np.zeros(n_features, dtype=bool)
    for least in (2, 1):
        on = np.ones(len(doc), dtype=bool) if least == 1 else times >= least if times is not None else np.zeros(len(doc), dtype=bool)
        clean = np.bincount(feature[on & ~toxic[doc]], minlength=n_features)
        hot = np.bincount(feature[on & toxic[doc]], minlength=n_features)
        both = clean + hot
        at_least = np.cumsum(np.bincount(both, minlength=1)[::-1])[::-1]  # features of so many documents or more
        p = np.clip(hot / np.maximum(both, 1), 1e-12, 1 - 1e-12)
        proof = hot * np.log(p / share) + clean * np.log((1 - p) / (1 - share))
        cue |= (hot >= PURE * both) & (hot > 0) & (proof > np.log(np.maximum(at_least[both], 2)) - SLACK)
    if cue.any():
        return np.flatnonzero(cue)
    all_d, all_f = doc[toxic[doc]], feature[toxic[doc]]
    for lift in (LIFT, 0.0):
        d, f, picked = all_d, all_f, []
        while len(d):
            gain = np.bincount(f, minlength=n_features)
            over = np.log((gain + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1)) - lift
            worth = np.where(gain > 0, gain * over, -np.inf)
            best = int(np.argmax(worth))
            if worth[best] <= 0:
                break
            picked.append(best)
            done = np.unique(d[f == best])
            keep = ~np.isin(d, done)
            d, f = d[keep], f[keep]
        if picked:
            break
    return np.array(picked, dtype=np.int64)


def learn(rows: list, seed: int = 3) -> crf.Crf | None:
    """The field, or None without documents of both classes."""
    toxic = np.array([r.toxic == 1 for r in rows], dtype=bool)
    if not toxic.any() or toxic.all():
        return None
    w = W.cut(W.split(pa.array([r.text for r in rows], pa.string()), W.ALNUM))
    h, doc = w.hashes(), w.doc_of()
    if not len(h):
        return None
    _, at, kind = np.unique(h, return_index=True, return_inverse=True)
    hints = [h[at], *[crf.affix(w, at, k) for k in (6, 5, 4)], *[crf.affix(w, at, k, True) for k in (6, 5)]]
    # pairs (document, feature), each once; one kind of feature after the other to keep memory low
    seen, often = np.unique(doc * len(at) + kind, return_counts=True)
    pair_doc, pair_type = (seen // len(at)).astype(np.int32), (seen % len(at)).astype(np.int32)
    del seen
    ds, fs, ts, numbers, before = [], [], [], [], 0
    for hint in hints:
        names, number = np.unique(hint, return_inverse=True)
        number = (number + before).astype(np.int32)
        real = hint[pair_type] != 0
        pairs, inverse = np.unique(pair_doc[real].astype(np.int64) << 32 | number[pair_type[real]], return_inverse=True)
        ts.append(np.bincount(inverse, often[real], minlength=len(pairs)).astype(np.int32))
        ds.append((pairs >> 32).astype(np.int32))
        fs.append((pairs & 0xFFFFFFFF).astype(np.int32))
        numbers.append(number)
        before += len(names)
    d, f, t = np.concatenate(ds), np.concatenate(fs), np.concatenate(ts)
    del ds, fs, ts, hints, pair_doc, pair_type, often
    picked = explain(d, f, toxic, t)
    del d, f, t
    hot_type = np.any([np.isin(n, picked) for n in numbers], axis=0)
    tag = (hot_type[kind] & toxic[doc]).astype(np.int64)
    # words of toxic documents that no clean one has, and are no cues, may be toxic or not: they teach nothing
    in_clean = np.zeros(len(at), dtype=bool)
    in_clean[kind[~toxic[doc]]] = True
    known = in_clean[kind] | (tag > 0)
    kind, doc, tag = kind[known], doc[known], tag[known]
    border = np.searchsorted(doc, np.arange(len(rows) + 1))
    # sequences: runs of SEQUENCE words; those with a toxic word, and as many drawn from the rest
    starts = np.concatenate([np.arange(a, b, SEQUENCE) for a, b in zip(border[:-1], border[1:])])
    ends = np.minimum(starts + SEQUENCE, border[1:][doc[starts]])
    total = np.concatenate([[0], np.cumsum(tag)])
    has = total[ends] > total[starts]
    rng = np.random.default_rng(seed)
    rest = np.flatnonzero(~has)
    rest = rng.permutation(rest)[: max(4 * int(has.sum()), 2000)]
    use = np.concatenate([np.flatnonzero(has), rest])
    grid = starts[use][:, None] + np.arange(SEQUENCE)
    ok = grid < ends[use][:, None]
    grid = np.where(ok, grid, 0)
    used, sequences = np.unique(kind[grid], return_inverse=True)
    types = crf.features(w, at[used], h[at[used]], BITS)
    field = crf.fit(["clean", "toxic"], types, np.where(ok, sequences.reshape(grid.shape), -1), np.where(ok, tag[grid], 0), BITS, seed=seed)
    field.document = logistic(evidence(field.score(w)[:, 1], w.first), toxic)
    return field


def evidence(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: one, the log of the expected number of offending words (p >= 0.5), the highest p, and the log of the number of words."""
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    top, many = np.zeros(n), np.zeros(n)
    np.maximum.at(top, doc, p)
    on = p >= 0.5
    np.add.at(many, doc[on], p[on])
    return np.stack([np.ones(n), np.log1p(many), top, np.log1p(np.diff(first))], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression by Newton steps, with a ridge on all but the first."""
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), x.T @ (y - q) - penalty @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def document_scores(p: np.ndarray, first: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per text the probability that it is toxic, from the marginals of its words; 0 without words."""
    x = evidence(p, first)
    return np.where(np.diff(first) > 0, 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))), 0.0)


def train_rows(doc_id="doc_id"):
    """Rows whose labels may be learnt from: crc32 of doc_id as text is not 1 modulo 3."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 3 != 1


def tag(docs: DataFrame, labels: DataFrame, train=None, fit_docs: int = FIT_DOCS, fit_chars: int = FIT_CHARS, spans: bool = True,
        keep: float | None = None) -> DataFrame:
    """docs with ``score`` added, and ``spans`` (word number, first byte, end byte, probability) of offending words.

    docs needs doc_id and text, labels doc_id and toxic (nulls ignored; of several labels of a
    document the highest counts). Columns of docs named score or spans are replaced. Null and empty
    texts score 0; so does everything if the training rows lack a class. Repeated rows are scored
    alike. Non-ASCII runs of over 64 bytes count as several words (``words.cut``). ``keep``: only rows with a score below it are returned, with docs' columns alone.
    """
    model = learn(sample(docs, labels, train_rows() if train is None else train, fit_docs, fit_chars))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # size fixed by BITS
    names = docs.columns if keep is not None else [c for c in docs.columns if c not in ("score", "spans")]
    base = docs.select(*[F.col(f"`{c}`") for c in names])
    schema = base
    if keep is None:
        schema = base.withColumn("score", F.lit(0.0))
        if spans:
            schema = schema.withColumn("spans", F.lit(None).cast("array<struct<word:long,first:long,end:long,p:double>>"))
    schema = schema.schema

    def run(batches):
        field = shared.value
        kind = pa.list_(pa.struct([("word", pa.int64()), ("first", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
        for b in W.pieces(batches):
            texts = b.column("text")
            w = W.cut(W.split(texts, W.ALNUM))
            p = field.score(w)[:, 1] if field is not None else np.zeros(len(w.start))
            score = document_scores(p, w.first, field.document) if field is not None else np.zeros(b.num_rows)
            if keep is not None:
                yield b.filter(pa.array(score < keep))
                continue
            columns = [*b.columns, pa.array(score)]
            if spans:
                found: list[list[dict]] = [[] for _ in range(b.num_rows)]
                hot = np.flatnonzero(p >= 0.5)
                sizes = np.concatenate([[0], np.cumsum([len(t.encode()) if t else 0 for t in texts.to_pylist()])])
                owner = np.searchsorted(w.first, hot, side="right") - 1
                for i, d in zip(hot.tolist(), owner.tolist()):
                    found[d].append({"word": i - int(w.first[d]), "first": int(w.start[i] - sizes[d]), "end": int(w.end[i] - sizes[d]), "p": float(p[i])})
                columns.append(pa.array(found, kind))
            yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names, "score", *(["spans"] if spans else [])])

    return map_arrow(base, run, schema)
