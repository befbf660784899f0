"""Shingle hashes of texts, worked out over whole byte arrays."""

from __future__ import annotations

import numpy as np

SHINGLE = 5  # Fixed value: words of a shingle.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in a row, and where each text begins among them.

    A word is a run of bytes that are not ASCII white space. Its hash is a polynomial of a
    random number per byte, taken from running sums over all bytes, then scrambled.
    """
    joined = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    blank = _SPACE[joined]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    values = _TABLE[joined]
    values[blank] = 0
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * _powers(len(joined), _INVERSE), dtype=np.uint64)))
    scale = _powers(len(joined) + 1, _BASE)
    hashes = mix((sums[ends] - sums[starts]) * scale[starts] + (ends - starts).astype(np.uint64))
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(starts, begins)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct hashes of the five-word shingles of each text.

    A text of one to four words has one shingle, all of it; one without words has none.
    """
    words, at = word_hashes(texts)
    mul = _powers(SHINGLE, np.uint64(0xD6E8FEB86659FD93))
    if len(words) >= SHINGLE:
        rolled = np.zeros(len(words) - SHINGLE + 1, dtype=np.uint64)
        for i in range(SHINGLE):
            rolled += words[i : len(words) - SHINGLE + 1 + i] * mul[i]
        rolled = mix(rolled)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(mix(np.array([(words[a:b] * mul[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)])))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
