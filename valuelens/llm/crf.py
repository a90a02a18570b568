"""Linear-chain conditional random field over the words of a text, in numpy.

A word's emission is the sum of the weights of its features: the word itself, byte
prefixes and suffixes, byte trigrams and lexicon membership, hashed into a fixed table. Labels
of neighbouring words are tied by learned transition weights. Fitting is gradient ascent on the
log-likelihood (AdaGrad) over bounded, labelled sequences; scoring gives exact forward-backward
marginals of whole texts of any length: texts are cut into blocks, each block's
transfer matrix is built for all blocks at once, and block borders are joined exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from valuelens.llm.words import Words, mix64

PREFIXES = (2, 3, 4, 5)
SUFFIXES = (2, 3, 4)
BLOCK = 512


def affix(w: Words, at: np.ndarray, k: int, suffix: bool = False) -> np.ndarray:
    """Hash of the first (last) k bytes of the words ``at``; 0 for words of fewer bytes."""
    eights = np.ndarray((len(w.data) - 7,), dtype="<u8", buffer=w.data, strides=(1,))
    length = (w.end - w.start)[at]
    place = (w.end[at] - k) if suffix else w.start[at]
    kind = np.uint64((2 * k + suffix) << 56)
    value = eights[np.maximum(place, 0)] & np.uint64((1 << (8 * k)) - 1)
    return np.where(length >= k, mix64(value ^ kind ^ np.uint64(0x5BD1E995)), np.uint64(0))


def trigrams(w: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``at``, hash) of every byte trigram of the words, with both borders marked by a space."""
    eights = np.ndarray((len(w.data) - 7,), dtype="<u8", buffer=w.data, strides=(1,))
    length = (w.end - w.start)[at]
    n = np.maximum(length - 2, 0)
    row = np.repeat(np.arange(len(at)), n)
    place = w.start[at][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return row, mix64((eights[place] & np.uint64(0xFFFFFF)) ^ np.uint64(7 << 56))


@dataclass
class Features:
    """Feature numbers of word types: type r has ids[first[r]:first[r + 1]]."""

    ids: np.ndarray
    first: np.ndarray

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        total = np.add.reduceat(weights[self.ids], self.first[:-1], axis=0) if len(self.ids) else np.zeros((0, weights.shape[1]))
        return total


def features(w: Words, at: np.ndarray, word_hash: np.ndarray, bits: int, lexicon: np.ndarray | None = None) -> Features:
    """Features of the words ``at`` (one occurrence of each type); lexicon: sorted word hashes with their class in the low bits."""
    rows, ids = [], []
    n = len(at)
    every = np.arange(n)

    def add(row, h):
        rows.append(row.astype(np.int32))
        ids.append((h >> np.uint64(64 - bits)).astype(np.int32))

    add(every, mix64(word_hash ^ np.uint64(0xA5A5)))
    for k in PREFIXES:
        h = affix(w, at, k)
        add(every[h != 0], h[h != 0])
    for k in SUFFIXES:
        h = affix(w, at, k, True)
        add(every[h != 0], h[h != 0])
    add(*trigrams(w, at))
    if lexicon is not None and len(lexicon):
        words, owner = lexicon[:, 0], lexicon[:, 1]
        spot = np.minimum(np.searchsorted(words, word_hash), len(words) - 1)
        known = words[spot] == word_hash
        add(every[known], mix64(owner[spot[known]] ^ np.uint64(9 << 56)))
    row, idx = np.concatenate(rows), np.concatenate(ids)
    order = np.argsort(row, kind="stable")
    return Features(idx[order], np.searchsorted(row[order], np.arange(n + 1)))


def marginals(emission: np.ndarray, first: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Label probabilities of every word; ``first[i]:first[i + 1]`` is a sequence, any length."""
    n, k = emission.shape
    if n == 0:
        return np.zeros((0, k))
    phi = np.exp(emission - emission.max(axis=1, keepdims=True))
    m = np.exp(transition - transition.max())
    lengths = np.diff(first)
    blocks = -(-lengths // BLOCK)
    doc = np.repeat(np.arange(len(lengths)), blocks)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = first[:-1][doc] + nth * BLOCK
    size = np.minimum(lengths[doc] - nth * BLOCK, BLOCK)
    order = np.argsort(-size, kind="stable")
    begin_o, size_o, head_o = begin[order], size[order], (nth == 0)[order]
    active = np.searchsorted(-size_o, -np.arange(BLOCK), side="left")  # blocks of over t words
    # block borders: transfer matrices of all but the last block of each text
    state = np.full((len(doc), k), 1.0)
    after = np.full((len(doc), k), 1.0)
    if blocks.max() > 1:
        whole = np.flatnonzero((blocks[doc] > 1))
        b, first_block = begin[whole], nth[whole] == 0
        s = size[whole]
        p = np.broadcast_to(np.eye(k), (len(whole), k, k)).copy()
        for t in range(BLOCK):
            on = np.flatnonzero(s > t) if t else np.arange(len(whole))
            if not len(on):
                break
            step = p[on] if t == 0 else p[on] @ m
            if t == 0:
                step = np.where(first_block[on][:, None, None], step, step @ m)
            step = step * phi[b[on] + t][:, None, :]
            p[on] = step / step.sum(axis=(1, 2), keepdims=True)
        where = np.full(len(doc), -1)
        where[whole] = np.arange(len(whole))
        top = int(blocks.max())
        for j in range(1, top):  # left to right over block numbers, all texts at once
            on = np.flatnonzero(nth == j)
            x = np.einsum("ni,nij->nj", state[on - 1], p[where[on - 1]])
            state[on] = x / x.sum(axis=1, keepdims=True)
        last = blocks[doc] - 1
        for j in range(top - 2, -1, -1):
            on = np.flatnonzero((nth == j) & (last > j))
            x = np.einsum("nij,nj->ni", p[where[on + 1]], after[on + 1])
            after[on] = x / x.sum(axis=1, keepdims=True)
    alpha = np.empty_like(phi)
    a = state[order]
    for t in range(int(size_o[0])):
        on = int(active[t])
        if t == 0:
            x = np.where(head_o[:, None], a, a @ m)
        else:
            x = a[:on] @ m
        x = x[:on] * phi[begin_o[:on] + t]
        x /= x.sum(axis=1, keepdims=True)
        a[:on] = x
        alpha[begin_o[:on] + t] = x
    beta = after[order]
    out = alpha
    for t in range(int(size_o[0])):
        on = int(active[t])
        at = begin_o[:on] + size_o[:on] - 1 - t
        x = out[at] * beta[:on]
        out[at] = x / x.sum(axis=1, keepdims=True)
        y = (phi[at] * beta[:on]) @ m.T
        beta[:on] = y / y.sum(axis=1, keepdims=True)
    return out


@dataclass
class Crf:
    labels: list
    bits: int
    weights: np.ndarray = None  # features x labels
    transition: np.ndarray = None
    lexicon: np.ndarray | None = field(default=None)
    document: np.ndarray | None = field(default=None)  # weights of a score of whole texts, if there is one

    def score(self, w: Words) -> np.ndarray:
        """Marginals of all words of a batch (words x labels)."""
        h = w.hashes()
        if not len(h):
            return np.zeros((0, len(self.labels)))
        _, at, kind = np.unique(h, return_index=True, return_inverse=True)
        e = features(w, at, h[at], self.bits, self.lexicon).emissions(self.weights)
        return marginals(e[kind].astype(np.float64), w.first, self.transition)


def fit(labels: list, types: Features, sequences: np.ndarray, tags: np.ndarray, bits: int, rounds: int = 3, rate: float = 0.2,
        decay: float = 1e-4, batch: int = 64, seed: int = 3) -> Crf:
    """Fit to sequences of word types (n x length, -1 after the end) with their tags."""
    k, size = len(labels), sequences.shape[1]
    theta, trans = np.zeros((1 << bits, k), dtype=np.float32), np.zeros((k, k))
    g_theta, g_trans = np.full((1 << bits, k), 1e-6, dtype=np.float32), np.full((k, k), 1e-6)
    rng = np.random.default_rng(seed)
    count = np.diff(types.first)
    for _ in range(rounds):
        for chosen in np.array_split(rng.permutation(len(sequences)), max(1, len(sequences) // batch)):
            seq, tag = sequences[chosen], tags[chosen]
            ok = seq >= 0
            used, kind = np.unique(seq[ok], return_inverse=True)
            n = count[used]
            idx = types.ids[np.repeat(types.first[:-1][used], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            starts = np.cumsum(n) - n
            e = np.add.reduceat(theta[idx], starts, axis=0)
            em = np.zeros((*seq.shape, k))
            em[ok] = e[kind]
            phi = np.exp(em - em.max(axis=2, keepdims=True))
            m = np.exp(trans - trans.max())
            alpha, beta = np.empty_like(phi), np.ones_like(phi)
            a = phi[:, 0]
            alpha[:, 0] = a = a / a.sum(axis=1, keepdims=True)
            for t in range(1, size):
                x = (a @ m) * phi[:, t]
                a = np.where(ok[:, t, None], x / x.sum(axis=1, keepdims=True), a)
                alpha[:, t] = a
            for t in range(size - 2, -1, -1):
                x = (phi[:, t + 1] * beta[:, t + 1]) @ m.T
                beta[:, t] = np.where(ok[:, t + 1, None], x / x.sum(axis=1, keepdims=True), 1.0)
            gamma = alpha * beta
            gamma /= gamma.sum(axis=2, keepdims=True)
            gold = np.zeros_like(gamma)
            np.put_along_axis(gold, np.maximum(tag, 0)[..., None], 1.0, axis=2)
            diff = (gold - gamma)[ok]
            pair = ok[:, 1:]
            left, right = alpha[:, :-1][pair], (phi[:, 1:] * beta[:, 1:])[pair]
            xi = m * (left.T @ (right / ((left @ m) * right).sum(axis=1, keepdims=True)))  # sums over pairs, no pair's own table
            grad = np.zeros((k, k))
            np.add.at(grad, (tag[:, :-1][pair], tag[:, 1:][pair]), 1.0)
            grad = (grad - xi) / len(chosen) - decay * trans
            g_trans += grad**2
            trans += rate * grad / np.sqrt(g_trans)
            by_type = np.zeros((len(used), k))
            for j in range(k):
                by_type[:, j] = np.bincount(kind, diff[:, j], minlength=len(used))
            seen, inverse = np.unique(idx, return_inverse=True)
            g = np.empty((len(seen), k), dtype=np.float32)
            spread = np.repeat(by_type, n, axis=0) / len(chosen)
            for j in range(k):
                g[:, j] = np.bincount(inverse, spread[:, j], minlength=len(seen))
            g -= decay * theta[seen]
            g_theta[seen] += g * g
            theta[seen] += rate * g / np.sqrt(g_theta[seen])
    return Crf(labels, bits, theta, trans)
