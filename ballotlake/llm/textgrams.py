"""Words and word shingles of whole texts as 64-bit hashes, with numpy.

Texts arrive as Arrow batches; the work is done on slices of a few MB of
raw UTF-8 bytes, so memory does not depend on how many rows a batch has. A
text longer than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

#: White space: x20 and x09-x0D.
_SEP = np.zeros(256, bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64 (kept between calls)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.ones(size, np.uint64)
        have[1:] = np.uint64(base)
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive row ranges of
    about ``most`` bytes. Null texts have no bytes."""
    col = batch.column(batch.schema.get_field_index(column))
    col = col.cast(pa.large_binary()) if not pa.types.is_large_binary(col.type) else col
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    if not n:
        return
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield at, end, data[off[at]:off[end]], off[at:end + 1] - off[at]
        at = end


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] the unshifted polynomial hash of data[i:j]."""
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=h[1:])
    return h


def span_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free hashes of the byte spans [start, end)."""
    return mix((h[end] - h[start]) * _power(_INVERSE, len(h))[start] + (end - start).astype(np.uint64))


def gram_hashes(h: np.ndarray, start: int, end: int, k: int) -> np.ndarray:
    """``span_hashes`` of the k bytes from each of the positions [start, end)."""
    return mix((h[start + k:end + k] - h[start:end]) * _power(_INVERSE, len(h))[start:end] + np.uint64(k))


def words(data: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each text) of the words of all texts;
    the last array has one more entry. Words never cross texts."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~_SEP[data]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return start, end, np.searchsorted(start, off)


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each text its distinct k-word shingles, as sorted uint64 hashes;
    with fewer words the whole word sequence as one; none without words.
    A-Z is lower-cased."""
    data = _LOWER[data]
    start, end, first = words(data, off)
    w = span_hashes(prefix_hashes(data), start, end) if len(start) else np.zeros(0, np.uint64)
    m = len(w)
    g = np.zeros(max(0, m - k + 1), np.uint64)
    for i in range(k if m >= k else 0):
        g = g * np.uint64(_BASE) + w[i:i + len(g)]
    g = mix(g)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            yield np.unique(g[a:b - k + 1])
        elif b > a:
            x = np.uint64(0)
            with np.errstate(over="ignore"):
                for v in w[a:b]:
                    x = x * np.uint64(_BASE) + v
                yield mix(np.array([x + np.uint64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
