"""64-bit fingerprints of byte strings, vectorised over a text.

A string's fingerprint is a polynomial over random 64-bit values of its bytes,
modulo 2^64, followed by a mixing step; equal strings always agree. Both forms
below give fingerprints of substrings without looking at each one byte by byte.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
_VALUES = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64)
_powers = {base: np.ones(1, np.uint64) for base in (_BASE, pow(_BASE, -1, 2**64))}


def _powers_of(base: int, n: int) -> np.ndarray:
    """The first n powers; the table grows by doubling and is kept by the worker."""
    table = _powers[base]
    while len(table) < n:
        table = np.concatenate([table, table * np.uint64(pow(base, len(table), 2**64))])
    _powers[base] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def slices(line: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of line[begin[i]:end[i]]."""
    values = _VALUES[np.frombuffer(line, np.uint8)] * _powers_of(_BASE, len(line))
    sums = np.zeros(len(line) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    shift = _powers_of(pow(_BASE, -1, 2**64), len(line) + 1)
    return mix((sums[end] - sums[begin]) * shift[begin])


class Windows:
    """Raw polynomial values of all windows of 1, 2, 4, ... bytes; others are put together from them."""

    def __init__(self, text: np.ndarray):
        self.by_length = {1: _VALUES[text]}

    def _doubled(self, n: int) -> np.ndarray:
        if n not in self.by_length:
            half = self._doubled(n // 2)
            step = np.uint64(pow(_BASE, n // 2, 2**64))
            self.by_length[n] = half[: len(half) - n // 2] + step * half[n // 2 :]
        return self.by_length[n]

    def of(self, n: int) -> np.ndarray:
        """Fingerprints of all windows of n bytes, by start; the text has at least n bytes."""
        total = len(self.by_length[1]) - n + 1
        out, at = np.zeros(total, np.uint64), 0
        for bit in range(n.bit_length()):
            if n >> bit & 1:
                part = self._doubled(1 << bit)[at : at + total]
                out += part * np.uint64(pow(_BASE, at, 2**64))
                at += 1 << bit
        return mix(out)


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each `width` consecutive values, by start."""
    reach, out = 1, values
    while 2 * reach <= width:
        out = pick(out[:-reach], out[reach:])
        reach *= 2
    total = len(values) - width + 1
    return pick(out[:total], out[width - reach : width - reach + total])
