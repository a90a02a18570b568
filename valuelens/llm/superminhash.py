"""SuperMinHash signatures of many shingle sets at once.

Every element draws a random permutation of the ``m`` signature slots, one place per step:
step j puts the value j + r, r in [0, 1), into the slot at place j, and a slot keeps its
smallest value. Values of one element are thereby spread over all slots, which lowers the variance
below that of independent hash functions. A set is finished as soon as no slot holds a value of
j + 1 or more, since later steps only bring larger ones; large sets end after two or three steps.
"""

from __future__ import annotations

import numpy as np

from valuelens.llm.words import mix64

#: Steps whose swaps are looked up in their history; beyond, permutations are held as a table.
LAZY = 6
_ONE = np.uint64(1 << 32)
_LOW = np.uint64((1 << 32) - 1)


def _draw(element: np.ndarray, j: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Value j + r (32 fraction bits) and place in j .. m - 1 that step j swaps with."""
    x = mix64(element + np.uint64(((2 * j + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1)))
    value = (x >> np.uint64(32)) + np.uint64(j) * _ONE
    place = ((x & _LOW) * np.uint64(m - j)) >> np.uint64(32)
    return value, place.astype(np.int64) + j


def signatures(elements: np.ndarray, owner: np.ndarray, n: int, m: int) -> np.ndarray:
    """n x m signature values; ``owner`` (ascending) names the set of each element. Sets without elements keep all bits set."""
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    sig = np.full(n * m, top, dtype=np.uint64)
    if not len(elements):
        return sig.reshape(n, m)
    e, o = elements, owner
    history: list[np.ndarray] = []
    table = None
    for j in range(m):
        value, place = _draw(e, j, m)
        if table is None and j >= LAZY:
            table = np.tile(np.arange(m, dtype=np.uint16), (len(e), 1))
            rows = np.arange(len(e))
            for i, k in enumerate(history):
                table[rows, k] = table[rows, i]
        if table is None:
            slot = place.copy()
            for i in range(j - 1, -1, -1):
                slot = np.where(history[i] == slot, i, slot)
            history.append(place)
        else:
            rows = np.arange(len(e))
            slot = table[rows, place].astype(np.int64)
            table[rows, place] = table[rows, j]
        np.minimum.at(sig, o * m + slot, value)
        done = sig.reshape(n, m).max(axis=1) < np.uint64(j + 1) * _ONE
        keep = ~done[o]
        if not keep.all():
            e, o = e[keep], o[keep]
            history = [h[keep] for h in history] if table is None else history
            table = table[keep] if table is not None else None
        if not len(e):
            break
    return sig.reshape(n, m)
