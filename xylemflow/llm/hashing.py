"""Vectorised hashing of Arrow text batches: words, shingles, byte windows.

A text column is seen as one byte buffer with row offsets. Prefix sums of ``table[byte] * R**i``
modulo 2**64 give the hash of any byte range in constant time; R is odd and so has an inverse.
Texts are handled in windows of at most :data:`WINDOW` bytes, so that memory stays bounded for a
text of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 1 << 20
#: Bytes of the longest word that the polynomial hashes.
LONG_WORD = 64
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _R)
_WORD_BYTE = _BYTE.copy()
_WORD_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True

_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        for r in (_R, _R_INV):
            p = np.full(WINDOW + 1, r, dtype=np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0], _POWERS[1]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n+1 row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer row is a range of its own."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def _words_of_window(b: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = _powers()
    space = _SPACE[b]
    before = np.empty(len(b), bool)
    before[0] = True
    before[1:] = space[:-1]
    before[row_starts[row_starts < len(b)]] = True
    after = np.empty(len(b), bool)
    after[:-1] = space[1:]
    after[-1] = True
    inner = row_starts[(row_starts > 0) & (row_starts <= len(b))]
    after[inner - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_WORD_BYTE[b] * power[: len(b)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    # Different long words can be made to agree modulo 2**64, so those are hashed by a digest.
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        digest = hashlib.blake2b(b[starts[i] : ends[i]].tobytes().lower(), digest_size=8).digest()
        hashes[i] = np.frombuffer(digest, np.uint64)[0]
    return hashes, starts


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the white-space-separated words of each row, A-Z as a-z, and n+1 word offsets.

    ``flat`` may be longer than :data:`WINDOW` only for a single row; that row is cut at white
    space. A word longer than a window is hashed over its window-sized parts.
    """
    if len(flat) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    if len(flat) <= WINDOW:
        h, starts = _words_of_window(flat, offsets[:-1])
        return h, np.append(np.searchsorted(starts, offsets[:-1]), len(starts)).astype(np.int64)
    parts, low = [], 0
    carried: np.ndarray | None = None
    while low < len(flat):
        high = min(low + WINDOW, len(flat))
        if high < len(flat):
            gaps = np.flatnonzero(_SPACE[flat[low:high]])
            cut = low + int(gaps[-1]) + 1 if len(gaps) else high
        else:
            gaps, cut = (), high
        h, _ = _words_of_window(flat[low:cut], np.zeros(1, np.int64))
        if carried is not None and _SPACE[flat[low]]:
            parts.append(carried)
        elif carried is not None:
            h[:1] = mix(h[:1] + carried * _R)
        open_word = cut < len(flat) and not _SPACE[flat[cut - 1]]
        carried = h[-1:] if open_word else None
        parts.append(h[:-1] if open_word else h)
        low = cut
    words = np.concatenate(parts)
    return words, np.array([0, len(words)], np.int64)


def shingle_sets(flat: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each row's ``width``-word shingles.

    A row with fewer words gives its whole sequence as one shingle, a row without words none.
    """
    words, bounds = word_hashes(flat, offsets)
    factors = np.multiply.accumulate(np.full(width, _R, np.uint64))
    count = max(0, len(words) - width + 1)
    rolled = np.zeros(count, np.uint64)
    for k in range(width):
        rolled += words[k : k + count] * factors[k]
    rolled = mix(rolled + np.uint64(width))
    sets = []
    for low, high in zip(bounds[:-1], bounds[1:]):
        n = high - low
        if n >= width:
            s = np.sort(rolled[low : high - width + 1])
            sets.append(s[np.append(True, s[1:] != s[:-1])])
        elif n:
            sets.append(mix(np.array([(words[low:high] * factors[:n]).sum() + np.uint64(n)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A 63-bit fingerprint of each set, the same for equal sets; it includes the set's size."""
    sizes = np.array([len(s) for s in sets], np.uint64)
    out = np.zeros(len(sets), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        flat = mix(np.concatenate([sets[i] for i in full]) ^ _C2)
        starts = np.append(0, np.cumsum(sizes[full][:-1])).astype(np.int64)
        out[full] = np.add.reduceat(flat, starts)
    return (mix(out + sizes * _R) >> np.uint64(1)).astype(np.int64)


def prefix_sums(b: np.ndarray) -> np.ndarray:
    """The prefix sums of ``b``, at most a window long, that :func:`range_hashes` reads."""
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * _powers()[0][: len(b)], out=total[1:])
    return total


def range_hashes(total: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hashes of ``b[s : s + length]`` for each start, from the prefix sums of ``b``."""
    return mix((total[starts + length] - total[starts]) * _powers()[1][starts])


def binary_column(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Variable-length binary cells: ``values[bounds[i] : bounds[i + 1]]`` as little-endian bytes."""
    offsets = (np.asarray(bounds, np.int64) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def binary_values(column: pa.Array | pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of :func:`binary_column`: all values and the n+1 bounds."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    if not len(column):
        return np.zeros(0, dtype), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), dtype), (offsets - offsets[0]) // np.dtype(dtype).itemsize
