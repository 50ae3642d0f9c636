"""Vectorised text helpers for use inside tasks (numpy and Arrow, no Spark).

A column of texts is looked at as one flat byte buffer with offsets, so a
batch of any number of documents, short or very long, is cut into words and
hashed with a handful of array operations.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

#: The separators of words: space and the five ASCII controls 0x09-0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: ASCII characters that are neither letters nor digits; letters beyond ASCII are parts of words.
NO_LETTER = np.zeros(256, dtype=bool)
NO_LETTER[[b for b in range(128) if not chr(b).isalnum()]] = True

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_U64 = np.uint64

#: Bytes up to which values are hashed together.
LONG_VALUE = 40


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunks at all
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The inverse of :func:`flat`: an Arrow array over a flat buffer."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE) -> tuple[pa.Array, np.ndarray]:
    """The words of every text, the longest runs without ``separators``
    (default ``[^\\x20\\x09-\\x0D]+``), A-Z lower-cased.

    Returns them as one Arrow array in reading order, and how many each text has.
    """
    keep = ~separators[data]
    begins = keep.copy()
    begins[1:] &= ~keep[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = keep[firsts]  # a text begins a word whatever the one before ends with
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, offsets))
    # Where each word's bytes begin once the separators are gone.
    solid = np.cumsum(keep, dtype=np.int32 if len(keep) < 1 << 31 else np.int64)
    ends = np.append(solid[starts] - 1, solid[-1:]) if len(starts) else np.zeros(1, np.int64)
    return binary(LOWER[data[keep]], ends), counts


def hashes(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each value.  Every step is a bijection of the state, a
    byte at a time for all values at once; long values take xxh64 instead."""
    data, offsets = flat(values)
    sizes = np.diff(offsets)
    state = sizes.astype(_U64) * _U64(0xC2B2AE3D27D4EB4F) + _U64(0x165667B19E3779F9)
    left = np.flatnonzero((sizes > 0) & (sizes <= LONG_VALUE))
    for step in range(LONG_VALUE):
        if not len(left):
            break
        h = (state[left] ^ data[offsets[left] + step]) * _U64(0x9E3779B97F4A7C15)
        state[left] = h ^ (h >> _U64(29))
        left = left[sizes[left] > step + 1]
    result = mixed(state)
    for k in np.flatnonzero(sizes > LONG_VALUE).tolist():
        result[k] = xxhash.xxh64_intdigest(data[offsets[k]:offsets[k + 1]])
    return result


def coded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Dictionary codes of the values, and the distinct values in order of first appearance."""
    if not len(values):
        return np.zeros(0, np.int64), values
    encoded = values.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (shift-multiply rounds)."""
    x = x ^ (x >> _U64(31))
    x = x * _U64(0x9E3779B97F4A7C15)
    x ^= x >> _U64(29)
    x = x * _U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U64(32))


def ngrams(ids: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of 64-bit word hashes, and how many each text has.

    A text of fewer than ``n`` words, but at least one, has its whole sequence
    as its only gram; a text without words has none.
    """
    starts = np.cumsum(counts) - counts
    short = (counts > 0) & (counts < n)
    grams = np.maximum(counts - n + 1, 0)
    out = np.where(short, 1, grams)
    ends = np.cumsum(out)
    total = int(ends[-1]) if len(ends) else 0
    result = np.zeros(total, _U64)
    at = np.repeat(starts - (ends - out), out) + np.arange(total)
    length = np.repeat(np.minimum(counts, n), out)
    for i in range(n):
        has = length > i
        place = at[has] + i
        result[has] = mixed(result[has] * _U64(0x100000001B3) + ids[place] + _U64(i + 1))
    return result, out


def segments(counts: np.ndarray) -> np.ndarray:
    """For each item, the number of its text, given how many items each text has."""
    return np.repeat(np.arange(len(counts)), counts)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
