"""Counting quotient filters: n-grams of word ids as sorted, lossless, compact counters.

An n-gram of ids of ``bits`` bits is two halves, ``(left, right)``, which an invertible permutation (a
Feistel network) spreads evenly. The top bits of the permuted left half are the shard, the next ones the
quotient; what is left of it and the whole right half are the remainder, kept in full, so that every
n-gram can be read back. Entries are sorted, so a filter stores how many entries each quotient has, the
remainders in whole bytes, and counts of one byte with a list of the larger ones. Filters of one shard are
merged by sorting their entries together and adding up the counts of equal ones.
"""

from __future__ import annotations

import struct

import numpy as np

from seriesloom.llm.words import mix

_U = np.uint64
# Keys of the five rounds, which change the left and the right half in turn.
ROUNDS = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F)]
_HEAD = "<qqBBB"


def half_bits(n: int, bits: int) -> tuple[int, int]:
    """Bits of the left and the right half of an n-gram; each half holds at most two ids."""
    return (n // 2) * bits, (n - n // 2) * bits


def _mask(bits: int) -> np.uint64:
    return _U((1 << bits) - 1)


def halves(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pack rows of 2 to 4 ids."""
    n, out = ids.shape[1], []
    for cols in (range(n // 2), range(n // 2, n)):
        h = np.zeros(len(ids), _U)
        for c in cols:
            h = (h << _U(bits)) | ids[:, c].astype(_U)
        out.append(h)
    return out[0], out[1]


def ids_of(left: np.ndarray, right: np.ndarray, n: int, bits: int) -> np.ndarray:
    out = np.empty((len(left), n), np.int64)
    for h, cols in ((left, range(n // 2)), (right, range(n // 2, n))):
        for c in reversed(cols):
            out[:, c] = (h & _mask(bits)).astype(np.int64)
            h = h >> _U(bits)
    return out


def permute(left: np.ndarray, right: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = map(_mask, half_bits(n, bits))
    for r, key in enumerate(ROUNDS):
        if r % 2:
            right = right ^ (mix(left + key) & b)
        else:
            left = left ^ (mix(right + key) & a)
    return left, right


def restore(left: np.ndarray, right: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = map(_mask, half_bits(n, bits))
    for r in reversed(range(len(ROUNDS))):
        if r % 2:
            right = right ^ (mix(left + ROUNDS[r]) & b)
        else:
            left = left ^ (mix(right + ROUNDS[r]) & a)
    return left, right


def summed(left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in order, equal ones added up."""
    order = np.lexsort((right, left))
    left, right, counts = left[order], right[order], counts[order]
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    first = np.flatnonzero(new)
    return left[first], right[first], (np.add.reduceat(counts, first) if len(first) else counts)


def _bytes(values: np.ndarray, bits: int) -> bytes:
    width = (bits + 7) // 8
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _values(raw: memoryview, size: int, bits: int) -> tuple[np.ndarray, memoryview]:
    width = (bits + 7) // 8
    out = np.zeros((size, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw[: size * width], np.uint8).reshape(size, width)
    return out.view("<u8")[:, 0].astype(_U), raw[size * width :]


def encode(left: np.ndarray, right: np.ndarray, counts: np.ndarray, left_bits: int, right_bits: int) -> bytes:
    """A filter of sorted entries; ``left_bits`` are those of the left half below the shard."""
    size = len(left)
    quotient_bits = min(left_bits, max(size, 1).bit_length() - 1)
    low = left_bits - quotient_bits
    left = left & _mask(left_bits)
    runs = np.bincount((left >> _U(low)).astype(np.int64), minlength=1 << quotient_bits)
    wide = int(runs.max(initial=0)) > 255
    large = counts > 255
    return b"".join([
        struct.pack(_HEAD, size, int(large.sum()), quotient_bits, wide, 0), runs.astype("<u4" if wide else np.uint8).tobytes(),
        _bytes(left & _mask(low), low), _bytes(right, right_bits), np.where(large, 0, counts).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes()])


def decode(raw: bytes, left_bits: int, right_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size, n_large, quotient_bits, wide, _ = struct.unpack_from(_HEAD, raw)
    rest, width, slots = memoryview(raw)[struct.calcsize(_HEAD) :], 4 if wide else 1, 1 << quotient_bits
    runs = np.frombuffer(rest[: slots * width], "<u4" if wide else np.uint8).astype(np.int64)
    low = left_bits - quotient_bits
    lows, rest = _values(rest[slots * width :], size, low)
    right, rest = _values(rest, size, right_bits)
    counts = np.frombuffer(rest[:size], np.uint8).astype(np.int64)
    counts[counts == 0] = np.frombuffer(rest[size : size + 8 * n_large], "<i8")
    return (np.repeat(np.arange(slots, dtype=np.int64), runs).astype(_U) << _U(low)) | lows, right, counts
