"""Words of many texts at once: positions and 64-bit hashes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240501).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)

#: Lower-cases A-Z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: The white space that ends a word, 0x20 and 0x09 to 0x0D.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: ASCII letters and bytes of longer code points.
LETTERS = np.zeros(256, bool)
LETTERS[ord("a"):ord("z") + 1] = LETTERS[ord("A"):ord("Z") + 1] = LETTERS[0x80:] = True

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverses
    if _powers.size <= n:
        size = max(n + 1, 1 << 20)
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; equal bytes have equal hashes."""
    _grow(data.size + 1)
    sums = np.zeros(data.size + 1, np.uint64)
    np.cumsum(_TABLE[data] * _powers[:data.size], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _inverses[starts]
    return mix(hashes + (ends - starts).astype(np.uint64))


@dataclass(frozen=True)
class Words:
    """Words of ``n`` texts in order: spans in ``data``, text number, 64-bit hash."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # n + 1: number of words before each text


def words(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None) -> Words:
    """Words of the texts ``raw[offsets[k]:offsets[k + 1]]``, A-Z lower-cased.

    ``inside`` tells for each byte value whether it belongs to words
    (default: all but ``BLANK``). Words never cross texts.
    """
    data = LOWER[raw]
    is_in = (~BLANK if inside is None else inside)[data]
    edge = np.zeros(data.size + 1, bool)
    edge[offsets] = True
    starts = is_in.copy()
    starts[1:] &= ~is_in[:-1] | edge[1:-1]
    ends = is_in.copy()
    ends[:-1] &= ~is_in[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    first = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(offsets.size - 1), np.diff(first))
    return Words(data, starts, ends, text, span_hashes(data, starts, ends), first)


_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(found: Words, size: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles.

    A text with fewer words has its whole sequence as its one shingle; a
    text without words has none.
    """
    h, n = found.hashes, found.hashes.size
    rolled = np.zeros(max(0, n - size + 1), np.uint64)
    for k in range(size):
        rolled = mix(rolled * _STEP + h[k:k + rolled.size])
    out = []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for x in h[a:b]:
                whole = mix(whole * _STEP + x)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
