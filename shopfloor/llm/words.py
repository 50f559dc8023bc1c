"""Word and shingle hashes of whole texts, in numpy.

Words are runs of bytes other than space and 9 to 13. A word's hash sums a random value of each byte times a power
of its place; a shingle's hash does the same with word hashes. Both are 64 bits, so with fewer than a billion
different words or shingles in one comparison a collision is next to impossible.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
#: Bytes hashed at once; a longer text is cut between words.
SLICE = 1 << 21


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the usual xor-shift-multiply finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BYTE = mixed(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = _U(0xD1342543DE82EF95)


def _powers(n: int) -> np.ndarray:
    p = np.full(max(n, 1), _BASE, _U)
    p[0] = 1
    return np.cumprod(p, dtype=_U)


def _slices(data: bytes) -> Iterator[bytes]:
    start = 0
    while len(data) - start > SLICE:
        stop = start + SLICE
        while stop < len(data) and not _BLANK[data[stop]]:
            stop += 1
        yield data[start:stop]
        start = stop
    yield data[start:]


def _hash_slice(data: bytes) -> np.ndarray:
    codes = np.frombuffer(data, np.uint8)
    inside = ~_BLANK[codes]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    if not len(edges):
        return np.empty(0, _U)
    starts, stops = edges[::2], edges[1::2]
    lengths = stops - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(first[-1] + lengths[-1]) - np.repeat(first, lengths)
    terms = _BYTE[codes[inside]] * _powers(int(lengths.max()))[place]
    return mixed(np.add.reduceat(terms, first) + lengths.astype(_U))


def word_hashes(data: bytes) -> np.ndarray:
    """A hash for each word of a UTF-8 text, in order."""
    parts = [_hash_slice(s) for s in _slices(data)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` words, by its start; none if there are fewer words."""
    if len(words) < n:
        return np.empty(0, _U)
    power = _powers(n)
    total = np.zeros(len(words) - n + 1, _U)
    for k in range(n):
        total += words[k : len(words) - n + 1 + k] * power[k]
    return mixed(total)


def shingle_set(data: bytes, n: int) -> np.ndarray:
    """Distinct shingle hashes, sorted; a text of fewer than ``n`` words is one shingle, one without words none."""
    words = word_hashes(data)
    if not len(words):
        return words
    return np.unique(run_hashes(words, min(n, len(words))) + _U(min(n, len(words))))
