"""Substring dedup (7): long repeats found by recompression and removed where they come again.

A window is ``window`` consecutive words of a document. Words covered by a window whose words also
start earlier (smaller doc_id, or same document and earlier start) are removed.

1. Every text is recompressed (see ``recompression``); each window is keyed by an interior symbol
   that its own words decide, so equal windows have equal keys. A Spark round brings the keys of all
   texts together; keys of one text only cannot belong to a repeat.
2. Windows with a shared key are verified: a second round groups them by a 96-bit fingerprint of
   their words, in blocks by key, and finds the earliest place of each.
3. Removed ranges go back to their texts.

Equal texts are one text, told apart by a 128-bit digest; of a text that is there already, all windows
come again. Scale: rows between tasks are packed arrays. A task that sees a window or key many times sends
it once, so a passage shared by a third of all documents is as many rows as there are batches, not documents.
Both joins with the texts use the same shuffle of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm import recompression as R
from valuelens.llm import words as W
from valuelens.llm.tables import grouped, map_arrow, partitions

ROUNDS = 5
#: Key blocks per shuffle partition: a task holds one block at a time.
BLOCKS = 16

_KEY = np.dtype([("key", "<u8"), ("text", "<i8"), ("many", "u1")])
_WINDOW = np.dtype([("w1", "<u8"), ("w2", "<u4"), ("doc", "<i8"), ("t1", "<u8"), ("t2", "<u8"), ("start", "<u4")])


def _pack(rows: np.ndarray) -> bytes:
    """Fields one after the other: equal neighbours then compress well."""
    return b"".join(np.ascontiguousarray(rows[f]).tobytes() for f in rows.dtype.names)


def _unpack(blobs: list[bytes], dtype: np.dtype) -> np.ndarray:
    out = np.zeros(sum(len(b) // dtype.itemsize for b in blobs), dtype=dtype)
    at = 0
    for b in blobs:
        n, place = len(b) // dtype.itemsize, 0
        for f in dtype.names:
            size = dtype[f].itemsize * n
            out[f][at : at + n] = np.frombuffer(b[place : place + size], dtype=dtype[f])
            place += size
        at += n
    return out


def _by_block(block: np.ndarray, rows: np.ndarray):
    """(block, its rows) of rows with block numbers."""
    order = np.argsort(block, kind="stable")
    block, rows = block[order], rows[order]
    edge = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]])
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if b > a:
            yield int(block[a]), rows[a:b]


def _digests(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">i8").reshape(-1, 2).astype(np.int64)


def _number(column: str, at: int, size: int, base: int):
    """Bytes at .. at + size - 1 of a binary column as a big-endian number (signed for base -10)."""
    return F.conv(F.hex(F.substring(column, at, size)), 16, base)


def _keys(w: W.Words, window: int, rounds: int):
    """Fingerprints of the words, window starts, their texts and keys."""
    h = w.hashes()
    starts = R.window_starts(w.first, window)
    key = R.anchors(R.levels(h, w.first, rounds), starts, window)
    return h, starts, w.doc_of()[starts] if len(starts) else starts, key


def _send_keys(window: int, rounds: int, blocks: int):
    """Rows (block, keys) to be brought together, and rows (digest, keys) of keys known to repeat already."""

    def run(batches):
        for b in W.pieces(batches):
            digest = _digests(b.column("digest"))
            _, once = np.unique(digest, axis=0, return_index=True)  # one of equal texts
            part = b.take(pa.array(np.sort(once)))
            digest = digest[np.sort(once)]
            w = W.split(part.column("text"), W.NONSPACE)
            h, starts, doc, key = _keys(w, window, rounds)
            if not len(key):
                continue
            whole = W.chain(h, window)[starts]
            order = np.argsort(whole)
            again = key[order[1:]][whole[order[1:]] == whole[order[:-1]]]  # keys of windows that repeat right here
            order = np.lexsort((doc, key))
            k, d = key[order], doc[order]
            new = np.ones(len(k), dtype=bool)
            new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
            k, d = k[new], d[new]
            many = np.isin(k, again)
            one = ~many
            one[1:] |= many[1:] & (k[1:] != k[:-1])
            one[0] = True
            rows = np.zeros(int(one.sum()), dtype=_KEY)
            rows["key"], rows["text"], rows["many"] = k[one], digest[d[one], 0], many[one]
            out = [(n, _pack(x), None) for n, x in _by_block((rows["key"] % np.uint64(blocks)).astype(np.int64), rows)]
            name = part.column("digest").to_pylist()
            out += [(int(digest[t, 0] % blocks), k_.tobytes(), name[t]) for t, k_ in _by_block(d[many], k[many])]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary()),
                                              pa.array([x[2] for x in out], pa.binary())], names=["block", "data", "digest"])

    return run


def _shared_keys(batches):
    """Keys found in two texts: rows (text, data); text is the first half of the digest."""
    for g in grouped(batches, ["block"]):
        blobs = g.column("data").to_pylist()
        known = g.column("digest").to_pylist()
        rows = _unpack([x for x, d in zip(blobs, known) if d is None], _KEY)
        rows = rows[np.argsort(rows["key"], kind="stable")]
        out_text = [int(np.frombuffer(d, ">i8")[0]) for d in known if d is not None]
        out_data = [x for x, d in zip(blobs, known) if d is not None]
        if len(rows):
            edge = np.concatenate([[0], np.flatnonzero(rows["key"][1:] != rows["key"][:-1]) + 1])
            size = np.diff(np.append(edge, len(rows)))
            low, high = np.minimum.reduceat(rows["text"], edge), np.maximum.reduceat(rows["text"], edge)
            two = (low != high) | (np.maximum.reduceat(rows["many"], edge) > 0)
            rows = rows[np.repeat(two, size)]
            order = np.argsort(rows["text"], kind="stable")
            rows = rows[order]
            edge = np.concatenate([[0], np.flatnonzero(rows["text"][1:] != rows["text"][:-1]) + 1, [len(rows)]]) if len(rows) else np.array([0])
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                out_text.append(int(rows["text"][a]))
                out_data.append(np.ascontiguousarray(rows["key"][a:b]).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out_text, pa.int64()), pa.array(out_data, pa.binary())], names=["text1", "data"])


def _send_windows(window: int, rounds: int, blocks: int):
    """Rows (block, windows) of a batch's first places, and rows (t1, t2, start, n) of places that come again in the batch; t1 and t2 are the halves of the digest."""

    def run(batches):
        for b in W.pieces(batches):
            place = pc.fill_null(b.column("doc_id"), 2**63 - 1)
            b = b.filter(pc.equal(place, b.column("first")))
            if not b.num_rows:
                continue
            once = np.sort(np.unique(_digests(b.column("digest")), axis=0, return_index=True)[1])  # one of repeated rows
            b = b.take(pa.array(once))
            doc_id, digest = np.asarray(b.column("first")).astype(np.int64), _digests(b.column("digest")).view(np.uint64)
            w = W.split(b.column("text"), W.NONSPACE)
            h, starts, doc, key = _keys(w, window, rounds)
            lists = b.column("keys").to_pylist()
            n_keys = [sum(len(x) for x in xs) // 8 for xs in lists]
            shared = np.frombuffer(b"".join(x for xs in lists for x in xs), dtype="<u8")
            of = np.repeat(np.arange(len(lists)), n_keys).astype(np.uint64)
            on = np.isin(W.mix64(key ^ W.mix64(doc.astype(np.uint64))), W.mix64(shared ^ W.mix64(of)))
            starts, doc, key = starts[on], doc[on], key[on]
            if not len(starts):
                continue
            rows = np.zeros(len(starts), dtype=_WINDOW)
            rows["w1"] = W.chain(h, window)[starts]
            rows["w2"] = (W.chain(h, window, 0x9FB21C651E98DF25)[starts] >> np.uint64(32)).astype(np.uint32)
            rows["doc"], rows["t1"], rows["t2"], rows["start"] = doc_id[doc], digest[doc, 0], digest[doc, 1], starts - w.first[doc]
            first, again = _earliest(rows)
            out = [(n, _pack(x), None, None, None, None) for n, x in _by_block((key[first] % np.uint64(blocks)).astype(np.int64), rows[first])]
            out += [(None, None, *r) for r in _ranges(rows[again])]
            yield _window_batch(out)

    return run


def _window_batch(out: list) -> pa.RecordBatch:
    cols = list(zip(*out)) if out else [[]] * 6
    kinds = [pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["block", "data", "t1", "t2", "start", "n"])


def _earliest(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows that are the earliest of their window, and of the others; both in row order, one of rows that are equal."""
    order = np.lexsort((rows["start"], rows["t2"], rows["t1"], rows["doc"], rows["w2"], rows["w1"]))
    a = rows[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = a[1:] != a[:-1]
    order, a = order[new], a[new]
    head = np.ones(len(a), dtype=bool)
    head[1:] = (a["w1"][1:] != a["w1"][:-1]) | (a["w2"][1:] != a["w2"][:-1])
    return np.sort(order[head]), np.sort(order[~head])


def _ranges(rows: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(t1, t2, start, n): runs of n consecutive window starts."""
    if not len(rows):
        return []
    a = rows[np.lexsort((rows["start"], rows["t2"], rows["t1"]))]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a["t1"][1:] != a["t1"][:-1]) | (a["t2"][1:] != a["t2"][:-1]) | (a["start"][1:] != a["start"][:-1] + 1)
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(a)))
    return list(zip(a["t1"][at].astype(np.int64).tolist(), a["t2"][at].astype(np.int64).tolist(), a["start"][at].tolist(), n.tolist()))


def _settle(batches):
    """Ranges of window starts that are not the earliest of their window, over all texts."""
    for g in grouped(_plain(batches), ["block"]):
        rows = _unpack([x for x in g.column("data").to_pylist() if x is not None], _WINDOW)
        out = [(None, None, *r) for r in _ranges(rows[_earliest(rows)[1]])] if len(rows) else []
        known = g.filter(pc.is_valid(g.column("t1")))
        out += list(zip(*[[None] * known.num_rows] * 2, *[known.column(c).to_pylist() for c in ("t1", "t2", "start", "n")]))
        yield _window_batch(out).select(["t1", "t2", "start", "n"])


def _plain(batches):
    for b in batches:
        i = b.schema.get_field_index("block")
        yield b.set_column(i, "block", pc.fill_null(b.column(i), -1))


def without_repeats(docs: DataFrame, window: int = 20, rounds: int = ROUNDS, text_kept: bool = True) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, kept_sha256 and, if asked for, text_kept.

    kept_sha256 is over the kept words joined by one space, as is text_kept. docs needs doc_id (an
    integer) and text; other columns are ignored. Null and empty texts have no words. A null doc_id
    comes after all others. Rows equal in doc_id and text are one document; texts that share a doc_id are
    ordered by their digest. Empty docs give no rows.
    """
    spark = docs.sparkSession
    blocks = partitions(spark) * BLOCKS
    last = 2**63 - 1
    text = F.coalesce("text", F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(F.encode(text, "UTF-8"))).alias("digest"), text.alias("text"))
    place = F.coalesce("doc_id", F.lit(last))
    firsts = base.select("digest", place.alias("p")).groupBy("digest").agg(F.min("p").alias("first"))

    sent = map_arrow(base.select("digest", "text"), _send_keys(window, rounds, blocks), "block int, data binary, digest binary")
    met = sent.repartition(partitions(spark), "block").sortWithinPartitions("block")
    shared = map_arrow(met, _shared_keys, "text1 long, data binary").groupBy("text1").agg(F.collect_list("data").alias("keys"))
    wanted = firsts.withColumn("text1", _number("digest", 1, 8, -10).cast("long")).join(shared, "text1").select("digest", "first", "keys")
    # this join and the last one need the same shuffle of the texts, which Spark makes once
    # (which copy comes first is looked at behind the join: as a join key it would call for another shuffle)
    texts = base.join(wanted, "digest").select("doc_id", "first", "digest", "text", "keys")
    windows = map_arrow(texts, _send_windows(window, rounds, blocks), "block int, data binary, t1 long, t2 long, start long, n long")
    spread = F.coalesce("block", F.pmod(F.xxhash64("t1", "start"), F.lit(blocks)).cast("int"))
    windows = windows.withColumn("block", spread).repartition(partitions(spark), "block").sortWithinPartitions("block")
    ranges = map_arrow(windows, _settle, "t1 long, t2 long, start long, n long")
    ranges = ranges.groupBy("t1", "t2").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))
    halves = {"t1": _number("digest", 1, 8, -10).cast("long"), "t2": _number("digest", 9, 8, -10).cast("long")}
    gone = firsts.withColumns(halves).join(ranges, ["t1", "t2"], "left").select("digest", "first", "ranges")
    rows = base.join(gone, "digest").select("doc_id", "first", "text", "ranges")
    return map_arrow(rows, _keep(window, text_kept), "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text_kept string" * text_kept)


def _keep(window: int, text_kept: bool):
    def run(batches):
        for b in W.pieces(batches):
            w = W.split(b.column("text"), W.NONSPACE)
            n = b.num_rows
            gone = np.zeros(len(w.start), dtype=bool)
            counts = w.counts
            ids, first = b.column("doc_id").to_pylist(), b.column("first").to_pylist()
            column = b.column("ranges")
            for i, r in enumerate(column.to_pylist()):
                a = int(w.first[i])
                if (2**63 - 1 if ids[i] is None else ids[i]) != first[i]:
                    gone[a : a + int(counts[i])] = counts[i] >= window
                elif r:
                    s = np.array([(x["start"], x["n"]) for x in r], dtype=np.int64)
                    gone[a : a + int(counts[i])] = W.covered(s[:, 0], s[:, 1] + window - 1, int(counts[i]))
            kept = np.flatnonzero(~gone)
            length = w.end[kept] - w.start[kept] + 1  # a space after each word
            to = np.cumsum(length)
            index = np.arange(int(to[-1]) if len(to) else 0) + np.repeat(w.start[kept] - (to - length), length)
            out = w.data[index]
            out[to - 1] = 32
            border = np.concatenate([[0], to])[np.searchsorted(kept, w.first)]
            texts = [out[a : max(a, e - 1)].tobytes() for a, e in zip(border[:-1].tolist(), border[1:].tolist())]
            n_gone = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.first])
            columns = [b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(n_gone, pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
            if text_kept:
                columns.append(pa.array([t.decode() for t in texts], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_sha256", *(["text_kept"] if text_kept else [])])

    return run
