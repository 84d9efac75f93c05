"""Texts of a batch as one array of bytes, and hashes of any part of it from prefix sums."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# An odd multiplier and its inverse modulo 2^64, and the constants of a 64-bit finalizer.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33))

SLICE_BYTES = 1 << 20


def release() -> None:
    """Give freed memory back to the system: Spark keeps a task's process for later tasks of other stages, and what it
    holds on to is missing there. Only the GNU library has the second call; elsewhere the first one has to do."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def text_parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, the edges of the texts among them); NULL is the empty text."""
    texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_string())
    lengths = np.asarray(pa.compute.binary_length(texts).fill_null(0)).astype(np.int64)
    edges = np.concatenate(([0], np.cumsum(lengths)))
    if not edges[-1]:
        return np.empty(0, np.uint8), edges
    if texts.null_count:
        texts = texts.fill_null("")
    first = int(np.frombuffer(texts.buffers()[1], np.int64, 1, 8 * texts.offset)[0])
    return np.frombuffer(texts.buffers()[2], np.uint8, int(edges[-1]), first), edges


def slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes, edges) for runs of texts of about `max_bytes`; a longer text is a run alone."""
    data, edges = text_parts(texts)
    first = 0
    while first < len(edges) - 1:
        last = int(np.searchsorted(edges, edges[first] + max_bytes, "right")) - 1
        last = min(max(last, first + 1), len(edges) - 1)
        yield first, data[edges[first] : edges[last]], edges[first : last + 1] - edges[first]
        first = last


class Powers:
    """Powers of BASE and of its inverse, grown when a longer text comes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < length:
            size = 1 << int(length - 1).bit_length()
            for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:length], self.down[:length]


POWERS = Powers()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> MIX[2])) * MIX[0]
    x = (x ^ (x >> MIX[2])) * MIX[1]
    return x ^ (x >> MIX[2])


class PrefixHash:
    """Polynomial hashes modulo 2^64 of all prefixes of a byte array, from which any part's hash is one subtraction.

    Equal bytes have equal hashes wherever they stand. Known collisions of this family need parts of over a thousand
    bytes with one special pattern; callers compare bytes where that could matter.
    """

    def __init__(self, data: np.ndarray):
        up, self.down = POWERS.of(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def part(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]
