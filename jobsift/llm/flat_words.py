"""Words of a batch of texts, as arrays over one flat buffer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import flat_bytes

_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_M64 = 1 << 64
#: Bytes that are hashed at once: each is worth five numbers of 8 bytes, and the tables of powers stay in the worker.
PART = 1 << 17
#: Multipliers of the word hashes, and for each byte value the number that stands for it.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_VALUES = np.random.default_rng(20240229).integers(1, _M64, 256, np.uint64, endpoint=False)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(multiplier: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """multiplier ** i and its inverse, for i below n at least."""
    if multiplier not in _powers or len(_powers[multiplier][0]) < n:
        size = max(n, PART + 1)
        with np.errstate(over="ignore"):
            _powers[multiplier] = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, m, np.uint64)]), dtype=np.uint64) for m in (multiplier, pow(multiplier, -1, _M64)))
    return _powers[multiplier]


def spans(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets of the texts, word starts, word ends, words of each text)."""
    flat, offsets = flat_bytes(array)
    if not len(flat):
        nothing = np.zeros(0, np.int64)
        return flat, offsets, nothing, nothing, np.zeros(len(offsets) - 1, np.int64)
    inside = ~_SPACE[flat]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    at = offsets[:-1][offsets[:-1] < len(flat)]
    first[at] = inside[at]
    at = offsets[1:][offsets[1:] > 0] - 1
    last[at] = inside[at]
    starts = np.flatnonzero(first)
    return flat, offsets, starts, np.flatnonzero(last) + 1, np.diff(np.searchsorted(starts, offsets))


def hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, multiplier: int = MULTIPLIERS[0]) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes, then mixed.  It
    takes ``PART`` bytes at a time, as each byte is worth several numbers of 8."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    with np.errstate(over="ignore"):
        while first < len(starts):
            base = int(starts[first])
            past = max(first + 1, int(np.searchsorted(ends, base + PART, "right")))
            begin, end = starts[first:past] - base, ends[first:past] - base
            part = flat[base:base + int(end[-1])]
            up, down = _powers_of(multiplier, len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_VALUES[part] * up[:len(part)], out=sums[1:])
            h = (sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64)
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            out[first:past] = h ^ (h >> np.uint64(29))
            first = past
    return out


def window_hashes(words: np.ndarray, width: int, multiplier: int = MULTIPLIERS[1]) -> np.ndarray:
    """A mixed 64-bit hash of each ``width`` consecutive words (across texts too)."""
    n = max(0, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width if n else 0):
            out *= np.uint64(multiplier)
            out += words[j:j + n]
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xD6E8FEB86659FD93)
        return out ^ (out >> np.uint64(32))
