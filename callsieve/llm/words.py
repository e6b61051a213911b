"""Words and their hashes of a column of texts, as NumPy arrays, inside tasks.

A word is a run of bytes other than ASCII white space. Hashes are 64 bits wide.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18  # what is computed on a slice then stays in a core's cache, and workers stay small
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


def give_back_memory() -> None:
    """Return freed memory to the system: Python workers live on from task to task, and keep what they once held."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the base (or of its inverse) modulo 2^64."""
    kind = "inverse" if inverse else "base"
    if kind not in _powers or len(_powers[kind]) < n:
        step = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        factors = np.full(max(n, SLICE_BYTES + 1), step, np.uint64)
        factors[0] = 1
        _powers[kind] = np.cumprod(factors)
    return _powers[kind][:n]


def text_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts in runs of at most `most` bytes, or one text if that is longer.

    Gives the index of a run's first text, the run's bytes, and where each text starts and the last one ends.
    Null texts are empty.
    """
    if texts.null_count:
        texts = texts.fill_null("")
    if not pa.types.is_large_binary(texts.type):
        texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + most, "right")) - 1)
        yield first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums from which `range_hashes` gets the hash of any run of bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_HASH[data] * powers(len(data)), out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each byte range; equal bytes have equal hashes wherever they lie."""
    raw = (sums[ends] - sums[starts]) * powers(len(sums), inverse=True)[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text, its first word; one more entry at the end
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def find_words(data: np.ndarray, bounds: np.ndarray, lower: bool = False) -> Words:
    """The words of the texts of one slice."""
    solid = ~WHITE[data]
    before = np.empty_like(solid)
    before[1:] = solid[:-1]
    after = np.empty_like(solid)
    after[:-1] = solid[1:]
    inside = bounds[:-1][np.diff(bounds) > 0]
    before[inside] = False
    after[inside[1:] - 1] = False
    if len(after):
        after[-1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    sums = prefix_hashes(LOWER[data] if lower else data)
    return Words(starts, ends, np.searchsorted(starts, bounds), range_hashes(sums, starts, ends))


def window_hashes(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for `width` words from each word on, and whether that many are left in the text."""
    n = len(words.hashes)
    total = np.zeros(n, np.uint64)
    for k in range(min(width, n)):
        factor = powers(k + 2)[k + 1]
        total[: n - k] += words.hashes[k:] * factor
    left = np.repeat(words.first[1:], words.counts) - np.arange(n)
    return mix(total), left >= width
