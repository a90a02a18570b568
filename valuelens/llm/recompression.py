"""Recompression of word sequences: runs and pairs are renamed round by round.

The first round turns every maximal run of a word into one symbol. Every round deals symbols to a
left and a right half by their names and turns every left symbol followed by a right one into one
symbol. (A run of later symbols stays a run: to see that a symbol is no run takes both its neighbours, and
each such look widens the range below; runs of words are the ones that occur.)
A new name is a fingerprint of the round and of what it stands for, so names agree between all tasks
with no exchange, and equal substrings get equal symbols except near their ends.

How near is kept track of: every symbol carries the range of words that decided it (``lo``, ``hi``).
Whoever reads these words, in whatever text, gets the same symbol.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from valuelens.llm.words import mix64

_RUN, _PAIR = 0x8E9D5AAD, 0x4F1BBCDC


@dataclass
class Level:
    """Symbols in text order: name and deciding words lo .. hi - 1 (outside the text if its border decided)."""

    name: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    doc: np.ndarray


def _seed(kind: int, level: int) -> np.uint64:
    return np.uint64((kind * (2 * level + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1))


def _runs(s: Level, first: np.ndarray, level: int) -> Level:
    n = len(s.name)
    new = np.ones(n, dtype=bool)
    new[1:] = (s.name[1:] != s.name[:-1]) | (s.doc[1:] != s.doc[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], n) - 1
    length = last - at + 1
    name = s.name[at]
    name = np.where(length > 1, mix64(name ^ mix64(length.astype(np.uint64) ^ _seed(_RUN, level))), name)
    doc = s.doc[at]
    # the neighbours decide that a run ends; a text's border does not show it
    lo, hi = first[doc] - 1, first[doc + 1] + 1
    inner = at > 0
    inner[inner] = s.doc[at[inner] - 1] == doc[inner]
    lo[inner] = s.lo[at[inner] - 1]
    inner = last < n - 1
    inner[inner] = s.doc[last[inner] + 1] == doc[inner]
    hi[inner] = s.hi[last[inner] + 1]
    return Level(name, lo, hi, doc)


def _pairs(s: Level, first: np.ndarray, level: int) -> Level:
    n = len(s.name)
    left = (mix64(s.name ^ _seed(_PAIR, level)) & np.uint64(1)).astype(bool)
    same = s.doc[1:] == s.doc[:-1]
    joins = np.zeros(n, dtype=bool)
    joins[:-1] = left[:-1] & ~left[1:] & same
    second = np.zeros(n, dtype=bool)
    second[1:] = joins[:-1]
    lo, hi = s.lo.copy(), s.hi.copy()
    # a left symbol that stays alone was decided by the one after it, a right one by the one before
    alone = np.flatnonzero(left & ~joins)
    more = alone[alone < n - 1]
    more = more[same[more]]
    end = np.setdiff1d(alone, more, assume_unique=True)
    hi[more] = s.hi[more + 1]
    hi[end] = first[s.doc[end] + 1] + 1
    alone = np.flatnonzero(~left & ~second)
    more = alone[alone > 0]
    more = more[same[more - 1]]
    end = np.setdiff1d(alone, more, assume_unique=True)
    lo[more] = s.lo[more - 1]
    lo[end] = first[s.doc[end]] - 1
    name = s.name.copy()
    j = np.flatnonzero(joins)
    name[j] = mix64((mix64(s.name[j] ^ _seed(_PAIR, level)) * np.uint64(0x2545F4914F6CDD1D)) ^ s.name[j + 1])
    hi[j] = s.hi[j + 1]
    keep = ~second
    return Level(name[keep], lo[keep], hi[keep], s.doc[keep])


def levels(names: np.ndarray, first: np.ndarray, rounds: int) -> list[Level]:
    """Symbols after 0, 1, ... rounds; names: word fingerprints, first: words before each text."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(len(names))
    out = [Level(names, at, at + 1, doc)]
    for r in range(1, rounds + 1):
        if not len(out[-1].name):
            break
        out.append(_pairs(_runs(out[-1], first, r) if r == 1 else out[-1], first, r))
    return out


def anchors(symbols: list[Level], starts: np.ndarray, window: int) -> np.ndarray:
    """Per window start: the smallest renamed symbol decided by the window's own words, of the highest level that has one.

    Equal windows have equal anchors, wherever they stand.
    """
    key = np.zeros(len(starts), dtype=np.uint64)
    todo = np.arange(len(starts))
    for level in range(len(symbols) - 1, -1, -1):
        s = symbols[level]
        if not len(todo):
            break
        begin, end = starts[todo], starts[todo] + window
        a, b = np.searchsorted(s.lo, begin, side="left"), np.searchsorted(s.hi, end, side="right")
        has = b > a
        lows = [mix64(s.name ^ np.uint64(level + 1))]
        width = 1
        while width * 2 <= window:
            x = lows[-1]
            lows.append(np.minimum(x[:-width], x[width:]) if len(x) > width else x[:0])
            width *= 2
        at, a, b = todo[has], a[has], b[has]
        exp = np.floor(np.log2(b - a)).astype(np.int64)
        for e in np.unique(exp).tolist():
            on = exp == e
            key[at[on]] = np.minimum(lows[e][a[on]], lows[e][b[on] - (1 << e)])
        todo = todo[~has]
    return key


def window_starts(first: np.ndarray, window: int) -> np.ndarray:
    """Starts of all windows of whole words within one text."""
    n = int(first[-1])
    end = np.repeat(first[1:], np.diff(first))
    at = np.arange(n)
    return at[at + window <= end]
