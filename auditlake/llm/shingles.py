"""Hashes of word n-grams, and min-hash signatures of their sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np

from auditlake.llm.common import mix64

# Bytes that are hashed at once.
PART = 1 << 21
_SPACE = np.zeros(256, bool)
_SPACE[[*b" \t\n\r\x0b\x0c"]] = True
_LENGTH = np.uint64(0xD1B54A32D192ED03)


def _constants(seed: int, n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word between white space."""
    edge = np.diff(np.concatenate([[True], _SPACE[data], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    sizes = ends - starts
    inside = ~_SPACE[data]
    place = np.arange(len(data))[inside] - np.repeat(starts, sizes)
    powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
    terms = (data[inside].astype(np.uint64) + np.uint64(1)) * powers[place]
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return mix64(np.add.reduceat(terms, first) + sizes.astype(np.uint64) * _LENGTH), starts


def shingle_sets(texts: Sequence[str | None], n: int) -> Iterator[np.ndarray]:
    """For each text the sorted different hashes of its runs of ``n`` words (A-Z lower-cased, cut at
    ASCII white space). A text of fewer words is one run of all; one without words has none."""
    weights = _constants(n, n)
    part: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        part.append((text or "").encode().lower())
        size += len(part[-1]) + 1
        if size >= PART or i + 1 == len(texts):
            words, starts = _word_hashes(np.frombuffer(b"\n".join(part), np.uint8))
            ends = np.cumsum([len(p) + 1 for p in part])
            counts = np.diff(np.concatenate([[0], np.searchsorted(starts, ends)]))
            runs = np.zeros(max(0, len(words) - n + 1), np.uint64)
            for k in range(n):
                runs += words[k : len(runs) + k] * weights[k]
            runs = mix64(runs)
            at = 0
            for c in counts.tolist():
                if c >= n:
                    yield np.unique(runs[at : at + c - n + 1])
                elif c:
                    yield mix64((words[at : at + c] * weights[:c]).sum(keepdims=True) + np.uint64(c))
                else:
                    yield np.empty(0, np.uint64)
                at += c
            part, size = [], 0


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class MinHash:
    def __init__(self, hashes: int):
        self.a, self.b = _constants(101, hashes)[:, None], _constants(202, hashes)[:, None]

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        """The least value of each hash function over a set; long sets are taken in parts."""
        least = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(shingles), 2048):
            value = shingles[None, i : i + 2048] * self.a + self.b
            value ^= value >> np.uint64(32)
            least = np.minimum(least, value.min(axis=1))
        return least
