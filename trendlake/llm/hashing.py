"""Bulk word hashing of UTF-8 text in numpy, shared by the map-side operators.

A word is a run of letters and digits of the lower-cased text; every non-ASCII character
counts as a letter. Hashes come from one running polynomial sum over a chunk of bytes.
A run of over ``CHUNK`` bytes is cut into words of that size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 20  # bytes handled at a time

IS_WORD = np.zeros(256, np.bool_)
IS_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
FACTOR = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BACK = np.uint64(pow(int(FACTOR), -1, 1 << 64))
_POWERS = np.cumprod(np.full(CHUNK, FACTOR), dtype=np.uint64)
_INVERSES = np.cumprod(np.full(CHUNK, _BACK), dtype=np.uint64)


def folded(text: str | None) -> bytes:
    """The lower-cased text as UTF-8 (null: empty)."""
    return (text or "").lower().encode("utf-8", "surrogatepass")


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def chunks(data: bytes) -> Iterator[tuple[int, int]]:
    """(from, to) of pieces of at most CHUNK bytes, cut between words."""
    at = 0
    while at < len(data):
        to = min(at + CHUNK, len(data))
        if to < len(data):
            gaps = np.flatnonzero(~IS_WORD[np.frombuffer(data, np.uint8, to - at, at)])
            to = at + int(gaps[-1]) + 1 if len(gaps) else to
        yield at, to
        at = to


class Words:
    """The words of at most CHUNK bytes: ``start`` and ``end`` bytes, and hashes of byte spans."""

    def __init__(self, data: bytes):
        b = np.frombuffer(data, np.uint8)
        edge = np.diff(np.concatenate(([False], IS_WORD[b], [False])).view(np.int8))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self._sum = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_POWERS[:len(b)] * (b.astype(np.uint64) + np.uint64(1)), out=self._sum[1:])

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        a, b = (self.start if start is None else start), (self.end if end is None else end)
        return mix((self._sum[b] - self._sum[a]) * _INVERSES[a])


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word of a folded text of any length."""
    parts = [(Words(data[a:b]), a) for a, b in chunks(data)]
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate([w.hashes() for w, _ in parts]), np.concatenate([w.start + a for w, a in parts])
