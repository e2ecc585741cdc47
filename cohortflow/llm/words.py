"""Words and word hashes of whole Arrow text columns, computed with numpy inside tasks.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r. Those separators are
ASCII, so splitting UTF-8 bytes and splitting code points give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled at a time inside a batch; one longer text is a slice of its own.
SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_LANE_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x + _M1
    x ^= x >> np.uint64(30)
    x *= _M2
    x ^= x >> np.uint64(27)
    x *= _M3
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; a null text has no bytes."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about `limit` bytes together."""
    _, at = text_bytes(column)
    first, rows = 0, len(column)
    while first < rows:
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words before each text."""
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1]
    firsts = firsts[firsts < len(data)]
    begins[firsts] = inside[firsts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    lasts = offsets[1:] - 1
    lasts = lasts[lasts >= 0]
    ends[lasts] = inside[lasts]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings data[start:end], eight bytes a step."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    lanes = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    length = end - start
    out = mix(length.astype(np.uint64))
    left, at, rows = length, start, None
    while len(left):
        part = lanes[at] & _LANE_MASK[np.minimum(left, 8)]
        if rows is None:
            out = mix(out ^ part)
        else:
            out[rows] = mix(out[rows] ^ part)
        more = np.flatnonzero(left > 8)
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def word_hashes(column: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, and the number of words before each text."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    start, end, before = spans(data, offsets)
    return hash_spans(data, start, end), before


def shingle_hashes(words: np.ndarray, before: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of `size` words, and the number of runs before each text.

    A text with fewer words, but not without any, has its whole sequence as its one run.
    """
    counts = np.diff(before)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    runs_before = np.concatenate([[0], np.cumsum(runs)])
    text = np.repeat(np.arange(len(counts)), runs)
    at = np.arange(len(text)) - runs_before[text] + before[text]
    length = np.minimum(counts[text], size)
    out = mix(length.astype(np.uint64))
    for k in range(size):
        rows = np.flatnonzero(length > k) if len(length) and length.min() <= k else slice(None)
        out[rows] = mix(out[rows] ^ words[at[rows] + k])
    return out, runs_before
