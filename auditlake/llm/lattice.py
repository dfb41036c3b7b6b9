"""All segmentations of words into pieces of a vocabulary, many words at a time."""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator, Sequence

import numpy as np

from auditlake.llm.common import mix64

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
# Cells of a lattice (words x places x piece lengths) that are held at once.
CELLS = 1 << 21
# Longer words are taken alone, in windows of so many bytes.
LONG_WORD = 4096


class Lattice:
    """Pieces (byte strings) with their log probabilities.

    Every single byte has to be a piece, so that each word has a segmentation.
    """

    def __init__(self, pieces: Sequence[bytes], logp: np.ndarray):
        self.logp = np.append(np.asarray(logp, np.float64), -np.inf)
        self.longest = max(map(len, pieces))
        self.powers = np.cumprod(np.append(np.uint64(1), np.full(self.longest, _BASE)), dtype=np.uint64)
        keys = np.zeros(len(pieces), np.uint64)
        for size in {len(p) for p in pieces}:
            mine = [i for i, p in enumerate(pieces) if len(p) == size]
            at = np.frombuffer(b"".join(pieces[i] for i in mine), np.uint8).reshape(-1, size)
            keys[mine] = self._key(self._prefixes(at)[:, -1], size)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("a piece is there twice")
        self._hash(keys)

    @staticmethod
    def _prefixes(words: np.ndarray) -> np.ndarray:
        out = np.zeros((len(words), words.shape[1] + 1), np.uint64)
        for i in range(words.shape[1]):
            out[:, i + 1] = out[:, i] * _BASE + (words[:, i].astype(np.uint64) + np.uint64(1))
        return out

    @staticmethod
    def _key(value: np.ndarray, size) -> np.ndarray:
        return mix64(value + np.asarray(size).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))

    def _hash(self, keys: np.ndarray) -> None:
        """Open addressing; ``probes`` is the longest way to a key."""
        self.mask = (1 << max(4, (4 * len(keys)).bit_length())) - 1
        self.slots = np.full(self.mask + 1, -1, np.int32)
        self.keys, self.probes = keys, 1
        for i, start in enumerate((keys & np.uint64(self.mask)).tolist()):
            way = 0
            while self.slots[(start + way) & self.mask] >= 0:
                way += 1
            self.slots[(start + way) & self.mask] = i
            self.probes = max(self.probes, way + 1)
        self.keys = np.append(keys, np.uint64(0))

    def _lookup(self, keys: np.ndarray) -> np.ndarray:
        """Piece of each key, the number of pieces where there is none."""
        none = len(self.keys) - 1
        at = (keys & np.uint64(self.mask)).astype(np.int64)
        found = self.slots[at]
        hit = (found >= 0) & (self.keys[found] == keys)
        out = np.where(hit, found, none)
        open_ = np.flatnonzero(((found >= 0) & ~hit).ravel())
        for way in range(1, self.probes):
            if not open_.size:
                break
            found = self.slots[(at.ravel()[open_] + way) & self.mask]
            hit = (found >= 0) & (self.keys[found] == keys.ravel()[open_])
            out.ravel()[open_[hit]] = found[hit]
            open_ = open_[(found >= 0) & ~hit]
        return out

    def _blocks(self, words: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of one length: their places in the list, and the pieces that end at each
        place (word, place, length of the piece less 1)."""
        sizes = np.array([len(w) for w in words])
        for size in np.unique(sizes[(sizes > 0) & (sizes <= LONG_WORD)]).tolist():
            mine = np.flatnonzero(sizes == size)
            widest = min(size, self.longest)
            step = max(1, CELLS // (size * widest))
            for part in (mine[i : i + step] for i in range(0, len(mine), step)):
                text = np.frombuffer(b"".join([words[i] for i in part]), np.uint8).reshape(-1, size)
                hashed = self._prefixes(text)
                pieces = np.full((len(part), size, widest), len(self.keys) - 1, np.int32)
                for w in range(1, widest + 1):
                    value = hashed[:, w:] - hashed[:, : size + 1 - w] * self.powers[w]
                    pieces[:, w - 1 :, w - 1] = self._lookup(self._key(value, w))
                yield part, pieces

    def _forward(self, pieces: np.ndarray) -> np.ndarray:
        """Log of the sum over all segmentations of each start of a word."""
        many, size, widest = pieces.shape
        # Before the start lie places that nothing reaches.
        alpha = np.full((many, widest + size), -np.inf)
        alpha[:, widest - 1] = 0.0
        for e in range(size):
            ways = alpha[:, e : e + widest][:, ::-1] + self.logp[pieces[:, e, :]]
            top = ways.max(axis=1)
            alpha[:, widest + e] = top + np.log(np.exp(ways - top[:, None]).sum(axis=1))
        return alpha[:, widest - 1 :]

    def log_marginal(self, words: Sequence[bytes]) -> np.ndarray:
        """Natural log of the probability of each word; 0 for an empty one."""
        out = np.zeros(len(words))
        for part, pieces in self._blocks(words):
            out[part] = self._forward(pieces)[:, -1]
        for i, word in enumerate(words):
            if len(word) > LONG_WORD:
                out[i] = self._long_forward(word)[-1]
        return out

    def _arcs(self, text: np.ndarray, start: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(end, length, piece) of all pieces in a text that end behind ``start`` and up to ``stop``."""
        low = max(0, start - self.longest)
        part = text[low:stop].astype(np.uint64) + np.uint64(1)
        # Prefix hashes as sums of powers: the base is odd and has an inverse modulo 2**64.
        up = np.cumprod(np.append(np.uint64(1), np.full(len(part), _BASE)), dtype=np.uint64)
        down = np.cumprod(np.full(len(part), _INVERSE), dtype=np.uint64)
        hashed = np.append(np.uint64(0), np.cumsum(part * down, dtype=np.uint64)) * up
        ends, sizes, found = [], [], []
        for w in range(1, min(self.longest, len(part)) + 1):
            value = hashed[w:] - hashed[: len(hashed) - w] * self.powers[w]
            piece = self._lookup(self._key(value, w))
            at = np.flatnonzero(piece < len(self.keys) - 1)
            at = at[at + low + w > start]
            ends.append(at + low + w)
            sizes.append(np.full(len(at), w))
            found.append(piece[at])
        return np.concatenate(ends), np.concatenate(sizes), np.concatenate(found)

    def _windows(self, size: int) -> list[tuple[int, int]]:
        return [(a, min(a + LONG_WORD, size)) for a in range(0, size, LONG_WORD)]

    def _long_forward(self, word: bytes, every: bool = False) -> list[float]:
        """The last values of ``_forward`` for one long word, or all of them; only the pieces that are there
        are looked at, and of earlier windows no more than the longest piece reaches back."""
        text, alpha, low = np.frombuffer(word, np.uint8), [0.0], 0
        for start, stop in self._windows(len(text)):
            if not every and len(alpha) > self.longest:
                low += len(alpha) - self.longest
                alpha = alpha[-self.longest :]
            ends, sizes, found = self._arcs(text, start, stop)
            order = np.argsort(ends, kind="stable")
            begin = (ends - sizes - low)[order].tolist()
            logp = self.logp[found[order]].tolist()
            bounds = np.searchsorted(ends[order], np.arange(start + 1, stop + 1), "right").tolist()
            i = 0
            for j in bounds:
                alpha.append(_log_sum([alpha[b] + p for b, p in zip(begin[i:j], logp[i:j])]))
                i = j
        return alpha

    def _long_counts(self, word: bytes, total: np.ndarray) -> None:
        """Add the expected use of the pieces in one long word: backward by windows, from the last."""
        text, size = np.frombuffer(word, np.uint8), len(word)
        alpha, beta = np.array(self._long_forward(word, True)), array("d", [0.0])
        # beta[k] belongs to the place ``size - k``; pieces by where they begin, the last first.
        for start, stop in self._windows(size)[::-1]:
            ends, sizes, found = self._arcs(text, start, min(size, stop + self.longest))
            mine = (ends - sizes >= start) & (ends - sizes < stop)
            ends, sizes, found = ends[mine], sizes[mine], found[mine]
            order = np.argsort(sizes - ends, kind="stable")
            ends, begin, found = ends[order], (ends - sizes)[order], found[order]
            logp, behind = self.logp[found], (size - ends).tolist()
            bounds = np.searchsorted(-begin, -np.arange(stop - 1, start - 1, -1), "right").tolist()
            ways, i = logp.tolist(), 0
            for j in bounds:
                beta.append(_log_sum([beta[b] + p for b, p in zip(behind[i:j], ways[i:j])]))
                i = j
            share = np.exp(alpha[begin] + logp + np.frombuffer(beta)[size - ends] - alpha[-1])
            total += np.bincount(found, share, len(total))

    def expected_counts(self, words: Sequence[bytes]) -> np.ndarray:
        """How often each piece is expected in the segmentations of the words."""
        total = np.zeros(len(self.logp))
        for _, pieces in self._blocks(words):
            many, size, widest = pieces.shape
            alpha = self._forward(pieces)
            beta = np.full((many, size + widest), -np.inf)
            beta[:, size] = 0.0
            share = np.empty(pieces.shape)
            for e in range(size - 1, -1, -1):
                # beta[:, e + 1] is complete: all pieces that start there have been passed.
                for w in range(min(widest, e + 1)):
                    s = e - w
                    way = self.logp[pieces[:, e, w]] + beta[:, e + 1]
                    share[:, e, w] = alpha[:, s] + way
                    beta[:, s] = np.logaddexp(beta[:, s], way)
                share[:, e, min(widest, e + 1) :] = -np.inf
            share = np.exp(share - alpha[:, -1][:, None, None])
            total += np.bincount(pieces.ravel(), share.ravel(), len(self.logp))
        for word in words:
            if len(word) > LONG_WORD:
                self._long_counts(word, total)
        return total[:-1]


def _log_sum(ways: list[float]) -> float:
    top = max(ways)
    return top + math.log(sum([math.exp(x - top) for x in ways]))
