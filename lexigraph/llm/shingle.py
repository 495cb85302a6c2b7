"""Hashes of words and word shingles of many texts at once, straight from Arrow's buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE, _STEP = _U(0x9E3779B97F4A7C15 | 1), _U(0xD1B54A32D192ED03)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Texts are hashed about so many bytes at a time, so that the arrays stay in the processor's cache.
BLOCK = 1 << 19


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


class Powers:
    """Powers of the base and of its inverse modulo 2 ** 64, as many as were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, BLOCK * 2)
            self.up, self.down = (np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(n - 1, x)])) for x in (_BASE, _INVERSE))


POWERS = Powers()


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """p with p[e] - p[s] the polynomial of data[s:e], times the base to the power s."""
    POWERS.upto(len(data) + 1)
    out = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * POWERS.up[: len(data)], out=out[1:])
    return out


def span_hash(p: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    return mix((p[e] - p[s]) * POWERS.down[s] + (e - s).astype(_U) * _STEP)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column without nulls."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return at, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def shingles(column: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """For each text, the sorted hashes of its distinct shingles of words; a text of fewer words has the whole as one."""
    at, data = buffers(column)
    i = 0
    while i < len(column):
        j = i + 1
        while j < len(column) and at[j + 1] - at[i] <= BLOCK:
            j += 1
        low = _LOWER[data[at[i] : at[j]]]
        cuts = at[i : j + 1] - at[i]
        word = ~_SPACE[low]
        edge = np.zeros(len(low) + 1, bool)  # a text begins or ends here
        edge[cuts] = True
        before = np.concatenate([[False], word])
        after = np.concatenate([word, [False]])
        starts = np.flatnonzero(after & (~before | edge))
        ends = np.flatnonzero(before & (~after | edge))
        words = span_hash(prefix_sums(low), starts, ends)
        first = np.searchsorted(starts, cuts)
        n = len(words) - size + 1
        runs = np.zeros(max(n, 0), _U)
        for k in range(size):
            runs = runs * _STEP + words[k : k + n] if n > 0 else runs
        runs = mix(runs)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= size:
                yield np.unique(runs[a : b - size + 1])
            elif b > a:
                h = _U(b - a)
                with np.errstate(over="ignore"):
                    for w in words[a:b]:
                        h = h * _STEP + w
                yield mix(np.array([h], _U))
            else:
                yield np.zeros(0, _U)
        i = j
