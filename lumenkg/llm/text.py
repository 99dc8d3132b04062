"""Vectorised word handling inside Arrow batches, shared by the shingle operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Space and U+0009 to U+000D end a word; A-Z count as a-z.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_table() -> np.ndarray:
    values = np.arange(256, dtype=np.uint64)
    values[65:91] += np.uint64(32)
    return mix((values + np.uint64(1)) * _GOLDEN)


_BYTES = _byte_table()
_MULTIPLIER = 0xD6E8FEB86659FD93


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _MULTIPLIER, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64, count=len(column) + column.offset + 1)[column.offset :]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    return data[: offsets[-1]], offsets


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of a batch, and for each text the index of its first word (one more at the end)."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = data[lo:hi]
    inside = ~_SPACE[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    first_bytes = offsets[:-1] - lo
    first_bytes = first_bytes[first_bytes < len(data)]
    start[first_bytes] = inside[first_bytes]
    starts = np.flatnonzero(start)
    bounds = np.searchsorted(starts, offsets - lo)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), bounds
    places = np.arange(len(data), dtype=np.int64)
    begin = np.zeros(len(data), dtype=np.int64)
    begin[starts] = starts
    place = places - np.maximum.accumulate(begin)
    value = _BYTES[data] * _powers(int(place.max()) + 1)[place]
    value[~inside] = 0
    return mix(np.add.reduceat(value, starts) + _GOLDEN), bounds


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words, ignoring text bounds (shorter by ``width - 1``)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:n].copy()
    for k in range(1, width):
        out *= np.uint64(_MULTIPLIER)
        out ^= words[k : k + n] >> np.uint64(7)
        out += words[k : k + n]
    return mix(out)
