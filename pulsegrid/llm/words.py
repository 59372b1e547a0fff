"""Words of a block of UTF-8 texts and their 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """256 flags: True for the bytes outside the given ranges (both ends count)."""
    table = np.ones(256, bool)
    for a, b in ranges:
        table[a:b + 1] = False
    return table


# fixed values: the separators of the contracts' word patterns
NOT_BLANK = byte_class((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words (a bijection)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spans(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of the maximal runs of word bytes; texts that
    touch are kept apart."""
    none = np.zeros(0, np.int64)
    if not len(data):
        return none, none, none
    word = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[0], edge[-1] = word[0], word[-1]
    np.not_equal(word[1:], word[:-1], out=edge[1:-1])
    cut = off[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(data))])
    touching = cut[word[cut] & word[cut - 1]]
    bounds = np.flatnonzero(edge)
    if len(touching):
        bounds = np.sort(np.concatenate([bounds, touching, touching]))
    start, end = bounds[::2], bounds[1::2]
    return start, end, np.searchsorted(off, start, side="right") - 1


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] of each span (spans ascending, not empty)."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first - start, size)  # of each word byte in data
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(size.max()), _BASE))
        value = (data[place].astype(np.uint64) + np.uint64(1)) * power[place - np.repeat(start, size)]
        return mix(np.add.reduceat(value, first))
