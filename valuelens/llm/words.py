"""Vectorised word splitting and fingerprints over a batch of UTF-8 texts.

A batch of texts is one byte buffer. Words are maximal runs of word bytes, found
with a 256-entry lookup table, so no Python object is made per word.

Word classes: ``ALNUM`` (ASCII letters and digits and every byte of a non-ASCII
character, A-Z lowered), ``NONSPACE`` (everything but space and the control characters 9
to 13) and ``NONSPACE_LOWER`` (the same, A-Z lowered). All split at ASCII bytes only, so
working on UTF-8 bytes gives the same words as working on characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_IS_ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_IS_NONSPACE = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))

#: Word classes: name -> table of word bytes.
ALNUM, NONSPACE, NONSPACE_LOWER = "alnum", "nonspace", "nonspace_lower"
_TABLE = {ALNUM: _IS_ALNUM, NONSPACE: _IS_NONSPACE, NONSPACE_LOWER: _IS_NONSPACE}

_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)

#: Texts are worked on in pieces of about this many bytes (a longer text alone).
PIECE_BYTES = 2 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the result."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of a batch. ``first[i]:first[i + 1]`` are the words of text i."""

    data: np.ndarray  # bytes of all texts (lowered if the class says so), 8 spare bytes at the end
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    first: np.ndarray  # number of words before each text; one more entry than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        """Number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit fingerprint of each word, eight bytes at a time over all words still that long."""
        n = len(self.start)
        length = self.end - self.start
        eights = np.ndarray((max(len(self.data) - 7, 0),), dtype="<u8", buffer=self.data, strides=(1,))
        out = mix64(length.astype(np.uint64) + np.uint64(seed))
        if n == 0:
            return out
        out ^= eights[self.start] & _KEEP[np.minimum(length, 8)]
        out = mix64(out)
        rest, k = np.flatnonzero(length > 8), 8
        while len(rest):
            left = length[rest] - k
            piece = eights[self.start[rest] + k] & _KEEP[np.minimum(left, 8)]
            out[rest] = mix64(out[rest] ^ piece)
            k += 8
            rest = rest[left > 8]
        return out

    def texts(self, i: int) -> list[bytes]:
        """The words of text i as bytes."""
        a, b = int(self.first[i]), int(self.first[i + 1])
        if a == b:
            return []
        lo = int(self.start[a])
        buf = self.data[lo : int(self.end[b - 1])].tobytes()
        return [buf[s - lo : e - lo] for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist())]


def split(texts: pa.Array, kind: str) -> Words:
    """Words of an Arrow array of strings (null: no words)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    if n == 0 or texts.buffers()[2] is None:
        zero = np.zeros(0, dtype=np.int64)
        return Words(np.zeros(8, np.uint8), zero, zero, np.zeros(n + 1, dtype=np.int64))
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    size = len(raw)
    data = np.zeros(size + 8, dtype=np.uint8)
    data[:size] = raw if kind == NONSPACE else _LOWER[raw]
    inside = np.zeros(size + 1, dtype=bool)
    inside[:size] = _TABLE[kind][data[:size]]
    begin = offsets - offsets[0]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = begin[:-1][begin[:-1] < size]
    opens[edges] = inside[edges]  # a word never reaches over two texts
    closes = np.zeros(size + 1, dtype=bool)
    closes[1:] = inside[:-1] & ~inside[1:]
    closes[edges] |= np.where(edges > 0, inside[edges - 1], False)
    start, end = np.flatnonzero(opens), np.flatnonzero(closes)
    return Words(data, start, end, np.searchsorted(start, begin))


def cut(w: Words, longest: int = 64, piece: int = 9) -> Words:
    """w with each word of over ``longest`` bytes that has a non-ASCII character cut at characters into words of about ``piece`` bytes.

    Scripts without spaces make a whole sentence or text one run of word bytes; cut, every part of it is seen.
    """
    length = w.end - w.start
    long_ = np.flatnonzero(length > longest)
    if len(long_):
        other = np.concatenate([[0], np.cumsum(w.data >= 128, dtype=np.int32)])
        long_ = long_[other[w.end[long_]] > other[w.start[long_]]]
    if not len(long_):
        return w
    n = np.ones(len(length), dtype=np.int64)
    n[long_] = -(-length[long_] // piece)
    owner = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    start = w.start[owner] + nth * piece
    for _ in range(3):  # on to the next character
        start += (nth > 0) & ((w.data[start] & 0xC0) == 0x80)
    real = start < w.end[owner]
    start, owner = start[real], owner[real]
    end = w.end[owner]
    same = owner[1:] == owner[:-1]
    end[:-1][same] = start[1:][same]
    before = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(n)))])
    return Words(w.data, start, end, before[w.first])


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, in slices whose texts hold about ``size`` bytes."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        total = np.cumsum(lengths)
        a = 0
        while a < n:
            done = total[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(total, done + size, side="right")))
            yield batch.slice(a, b - a)
            a = b


def chain(hashes: np.ndarray, n: int, base: int = 0x2545F4914F6CDD1D) -> np.ndarray:
    """Fingerprint of each run of ``n`` consecutive fingerprints: entry i covers i .. i + n - 1."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:m].copy()
    for k in range(1, n):
        out *= np.uint64(base)
        out += hashes[k : k + m]
    return mix64(out)


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in any of the ranges start .. start + length - 1."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + lengths, n), -1)
    return np.cumsum(step[:-1]) > 0
