"""Subword lattice: all segmentations of a word under a fixed public vocabulary.

A word is a byte string. Its first piece comes from the word-initial pieces (or is
empty), the others from the inner pieces, and an end symbol closes it, so the
probabilities of all words sum to at most one. Every single byte is an inner piece,
so no word has probability zero. Words of one length are worked on together as rows
of a byte matrix; the recursions are in log space.
"""

from __future__ import annotations

import numpy as np

MAX_PIECE = 16  # bytes; longer vocabulary pieces are not used as arcs
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def load_pieces(model_file: str) -> tuple[dict[bytes, float], dict[bytes, float]]:
    """(word-initial, inner) pieces of a sentencepiece file as bytes -> score.

    The file's scores are negated merge ranks, turned into weights 1 / (rank + 10).
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    first: dict[bytes, float] = {b"": 0.1}
    inner: dict[bytes, float] = {bytes([b]): 1e-6 for b in range(256)}
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i):
            continue
        piece, weight = sp.id_to_piece(i), 1.0 / (10.0 - sp.get_score(i))
        if sp.is_byte(i):
            continue
        side, text = (first, piece[1:]) if piece.startswith("▁") else (inner, piece)
        key = text.lower().encode()
        if "▁" not in text and len(key) <= MAX_PIECE:
            side[key] = side.get(key, 0.0) + weight
    return first, inner


def _key(rows: np.ndarray) -> np.ndarray:
    """64-bit polynomial keys of equal-length byte rows."""
    h = np.full(rows.shape[0], np.uint64(rows.shape[1] + 1))
    for j in range(rows.shape[1]):
        h = h * _BASE + rows[:, j].astype(np.uint64) + np.uint64(1)
    return h


class Lattice:
    """Arc tables by piece length plus the log weights of each arc."""

    def __init__(self, first: dict[bytes, float], inner: dict[bytes, float], end: float = 0.25):
        self.names = [list(first), list(inner)]
        total = [sum(first.values()), sum(inner.values())]
        weights = [np.array([first[k] for k in self.names[0]]) / total[0],
                   np.array([inner[k] for k in self.names[1]]) / total[1] * (1 - end)]
        self.set_weights(weights, end)
        self.tables = [self._tables(names) for names in self.names]
        self.empty = self.names[0].index(b"")

    def set_weights(self, weights, end: float):
        self.logs, self.log_end = [np.log(w) for w in weights], float(np.log(end))

    @staticmethod
    def _tables(names):
        out = {}
        for n in sorted({len(k) for k in names if k}):
            ids = np.array([i for i, k in enumerate(names) if len(k) == n])
            keys = _key(np.frombuffer(b"".join(names[i] for i in ids), np.uint8).reshape(len(ids), n))
            order = np.argsort(keys)
            out[n] = (keys[order], ids[order])
        return out

    def _arcs(self, side: int, keys: np.ndarray, n: int):
        """Piece ids for keys of length n, -1 where there is no such piece."""
        known, ids = self.tables[side][n]
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, ids[at], -1)

    def _all_arcs(self, rows: np.ndarray):
        """{(i, j): inner ids}, {j: initial ids} of all spans with any arc."""
        w, n = rows.shape
        inner, first = {}, {}
        cols = rows.astype(np.uint64) + np.uint64(1)
        for i in range(n):
            tails = [None] * (MAX_PIECE + 1)
            h = np.zeros(w, np.uint64)
            for size in range(1, min(MAX_PIECE, n - i) + 1):
                h = h * _BASE + cols[:, i + size - 1]
                tails[size] = h
            for size in range(1, min(MAX_PIECE, n - i) + 1):
                lead = np.uint64((size + 1) * pow(int(_BASE), size, 1 << 64) % (1 << 64)) + tails[size]
                if size in self.tables[1]:
                    ids = self._arcs(1, lead, size)
                    if (ids >= 0).any():
                        inner[i, i + size] = ids
                if i == 0 and size in self.tables[0]:
                    ids = self._arcs(0, lead, size)
                    if (ids >= 0).any():
                        first[size] = ids
        return inner, first

    def _weight(self, side, ids):
        return np.where(ids >= 0, self.logs[side][ids], -np.inf)

    def _forward(self, rows, arcs):
        w, n = rows.shape
        inner, first = arcs
        alpha = np.full((n + 1, w), -np.inf)
        alpha[0] = self.logs[0][self.empty]
        for j in range(1, n + 1):
            if j in first:
                alpha[j] = self._weight(0, first[j])
            for i in range(max(0, j - MAX_PIECE), j):
                if (i, j) in inner:
                    alpha[j] = np.logaddexp(alpha[j], alpha[i] + self._weight(1, inner[i, j]))
        return alpha

    def log_prob(self, words: list[bytes]) -> np.ndarray:
        """Natural log of the summed probability of all segmentations of each word."""
        out = np.empty(len(words))
        for at, rows in by_length(words):
            out[at] = self._forward(rows, self._all_arcs(rows))[-1] + self.log_end
        return out

    def expect(self, words: list[bytes], weights: np.ndarray):
        """Posterior arc counts: (initial, inner, number of ends)."""
        counts = [np.zeros(len(x)) for x in self.names]
        ends = 0.0
        for at, rows in by_length(words):
            n, arcs = rows.shape[1], self._all_arcs(rows)
            inner, first = arcs
            alpha = self._forward(rows, arcs)
            beta = np.full((n + 1, rows.shape[0]), -np.inf)
            beta[n] = self.log_end
            for i in range(n - 1, -1, -1):
                for j in range(i + 1, min(n, i + MAX_PIECE) + 1):
                    if (i, j) in inner:
                        beta[i] = np.logaddexp(beta[i], beta[j] + self._weight(1, inner[i, j]))
            total, weight = alpha[n] + self.log_end, weights[at]

            def add(side, ids, logs, total=total, weight=weight):
                has = ids >= 0
                counts[side] += np.bincount(ids[has], (np.exp(logs - total) * weight)[has], len(counts[side]))

            for (i, j), ids in inner.items():
                add(1, ids, alpha[i] + self._weight(1, ids) + beta[j])
            for j, ids in first.items():
                add(0, ids, self._weight(0, ids) + beta[j])
            counts[0][self.empty] += float((np.exp(self.logs[0][self.empty] + beta[0] - total) * weight).sum())
            ends += float(weight.sum())
        return counts[0], counts[1], ends


def by_length(words: list[bytes], most: int = 1 << 20):
    """(positions, byte matrix) of words of one length, at most ``most`` bytes each time."""
    groups: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        groups.setdefault(len(word), []).append(k)
    for n, at in groups.items():
        step = max(1, most // max(1, n * n))
        for k in range(0, len(at), step):
            part = at[k:k + step]
            yield np.array(part), np.frombuffer(b"".join(words[x] for x in part), np.uint8).reshape(len(part), n)
