"""Hashes of words and of word shingles for many texts at once, with numpy.

Words are the lower-cased runs between ASCII white space. A shingle is ``k`` consecutive words; a text
with fewer words (but one at least) has one shingle of all of them.
"""

from __future__ import annotations

import numpy as np

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of a common non-cryptographic hash; a permutation."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def series(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    start = np.uint64(seed * 1_000_003 + 1)
    return mix((np.arange(n, dtype=np.uint64) + start) * _GOLD) | np.uint64(1)


_PLACE = series(64, 7)


def _places(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = series(2 * n, 7)
    return _PLACE


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and per text the index of its first (with the end at the back)."""
    raw = [t.lower().encode() if t else b"" for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    at = np.concatenate([[0], np.cumsum(sizes)])
    buf = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    blank = _SPACE[buf]
    first = ~blank
    first[1:] &= blank[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(raw) + 1, np.int64)
    lengths = np.flatnonzero(blank & ~np.concatenate([[True], blank[:-1]])) - starts
    place = np.arange(len(buf)) - np.repeat(starts, np.diff([*starts, len(buf)])) if starts[0] == 0 else \
        np.concatenate([np.zeros(starts[0], np.int64), np.arange(starts[0], len(buf)) - np.repeat(starts, np.diff([*starts, len(buf)]))])
    place[blank] = 0
    value = (buf.astype(np.uint64) + np.uint64(1)) * _places(int(lengths.max()))[place]
    value[blank] = 0
    hashes = mix(np.add.reduceat(value, starts) + lengths.astype(np.uint64) * _GOLD)
    return hashes, np.searchsorted(starts, at)


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, and per text the index of its first (with the end at the back)."""
    counts = np.diff(bounds)
    by = series(k, 11)
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    for j in range(min(k, n)):
        rolled[:n - j] += hashes[j:] * by[j]
    per = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out = np.concatenate([[0], np.cumsum(per)])
    pick = np.arange(out[-1]) - np.repeat(out[:-1], per) + np.repeat(bounds[:-1], per)
    values = rolled[pick]
    for i in np.flatnonzero((counts > 0) & (counts < k)):  # short texts: their own words only, marked by the count
        part = hashes[bounds[i]:bounds[i + 1]]
        values[out[i]] = np.append(part * by[:len(part)], [_GOLD] * len(part)).sum(dtype=np.uint64)
    return mix(values), out


def text_shingles(texts: list[str | None], k: int = 5) -> list[np.ndarray]:
    """Per text its sorted distinct shingle hashes."""
    values, at = shingles(*words(texts), k)
    return [np.unique(values[a:z]) for a, z in zip(at[:-1], at[1:])]


class MinHash:
    """``n`` permutations ``(x ^ b) * a`` of 64-bit hashes; a signature holds their minima."""

    def __init__(self, n: int, seed: int = 23):
        self.a, self.b = series(n, seed)[:, None], mix(series(n, seed + 1))[:, None]

    def signature(self, values: np.ndarray) -> np.ndarray:
        """Minima over at least one hash."""
        low = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(values), 1024):
            part = values[None, at:at + 1024] ^ self.b
            part *= self.a
            np.minimum(low, part.min(axis=1), out=low)
        return low
