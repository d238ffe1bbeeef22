"""Words and shingles of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # texts are handled in slices of about this size; a longer text is a slice of its own

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)


@lru_cache(maxsize=4)
def _powers(base: int, bits: int) -> np.ndarray:
    p = np.full(1 << bits, base, _U)
    p[0] = 1
    return np.multiply.accumulate(p)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (splitmix finalizer)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def string_hashes(strings: pa.Array) -> np.ndarray:
    """One 64-bit hash for each string, as ``Words.hashes`` has them for words as they are written."""
    n = len(strings)
    buffers = strings.buffers()
    if not n or buffers[2] is None:
        return mix(np.zeros(n, _U))
    ends = np.frombuffer(buffers[1], np.int32)[strings.offset : strings.offset + n + 1].astype(np.int64)
    sizes = np.diff(ends)
    place = np.arange(ends[0], ends[-1])
    place -= np.repeat(ends[:-1], sizes)
    powers = np.full(int(sizes.max()) + 1, _BASE, _U)
    powers[0] = 1
    sums = np.zeros(len(place) + 1, _U)
    np.cumsum(_CODES[np.frombuffer(buffers[2], np.uint8)[ends[0] : ends[-1]]] * np.multiply.accumulate(powers)[place], out=sums[1:])
    ends -= ends[0]
    return mix(sums[ends[1:]] - sums[ends[:-1]] + sizes.astype(_U) * _U(0xD6E8FEB86659FD93))


class Words:
    """Words of some texts: text bytes, where words start and end, the text of each, and word counts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, n = data, offsets, len(offsets) - 1
        filled = ~_SPACE[data]
        before = np.zeros(len(data), bool)
        before[1:] = filled[:-1]
        firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
        before[firsts] = False
        after = np.zeros(len(data), bool)
        after[:-1] = filled[1:]
        after[(firsts - 1)[firsts > 0]] = False
        self.starts = np.flatnonzero(filled & ~before)
        self.ends = np.flatnonzero(filled & ~after) + 1
        bounds = np.searchsorted(self.starts, offsets)
        self.first = bounds[:-1]  # index of each text's first word
        self.counts = np.diff(bounds)
        self.text = np.repeat(np.arange(n), self.counts)

    def hashes(self, lower: bool = True) -> np.ndarray:
        """One 64-bit hash for each word; equal words have equal hashes everywhere."""
        if not len(self.starts):
            return np.zeros(0, _U)
        bits = max(20, int(len(self.data)).bit_length())
        powers, inverse = _powers(_BASE, bits), _powers(_INVERSE, bits)
        codes = _CODES[_LOWER] if lower else _CODES
        sums = np.zeros(len(self.data) + 1, _U)
        np.cumsum(codes[self.data] * powers[: len(self.data)], out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * inverse[self.starts]
        return mix(h + (self.ends - self.starts).astype(_U) * _U(0xD6E8FEB86659FD93))

    def shingles(self, width: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``width`` words, and the text of each; a text of fewer words is one run."""
        h = self.hashes(lower)
        text = self.text
        place = np.arange(len(h)) - self.first[text] if len(h) else np.zeros(0, int)
        left = self.counts[text] - place  # words from here to the end of the text
        chosen = (left >= width) | (place == 0)
        at = np.flatnonzero(chosen)
        out = np.zeros(len(at), _U)
        for k in range(width):
            there = left[at] > k
            step = np.where(there, h[np.minimum(at + k, max(len(h) - 1, 0))], _U(0)) if len(at) else out
            out = mix(out * _U(0xA24BAED4963EE407) + step + _U(k + 1) * there.astype(_U))
        return out, text[at]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(from, to, words) for runs of texts of about ``limit`` bytes."""
    n = len(texts)
    if not n:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        b = min(b, n)
        yield a, b, Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        a = b
