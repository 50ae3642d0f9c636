"""Words of texts, case kept, and texts put together again from some of them
(numpy and Arrow inside a task, no Spark)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fragstat.llm.tokens import SPACE, binary, flat


def cut_words(texts: pa.Array | pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of every text, unchanged, as one Arrow
    array in reading order, and how many each text has (null: none)."""
    data, offsets = flat(texts)
    keep = ~SPACE[data]
    begins = keep.copy()
    begins[1:] &= ~keep[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = keep[firsts]  # a text begins a word whatever the one before ends with
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return pa.array([], pa.large_binary()), counts
    solid = np.cumsum(keep, dtype=np.int32 if len(keep) < 1 << 31 else np.int64)
    return binary(data[keep], np.append(solid[starts] - 1, solid[-1:])), counts


def joined(words: pa.Array, counts: np.ndarray, keep: np.ndarray) -> pa.Array:
    """For each text its words with ``keep``, joined by one space, as strings."""
    data, offsets = flat(words)
    sizes = np.diff(offsets)[keep] + 1
    text = np.repeat(np.arange(len(counts)), counts)[keep]
    kept = np.full(int(sizes.sum()), 0x20, np.uint8)
    ends = np.cumsum(sizes)
    solid = np.ones(len(kept), bool)
    solid[ends - 1] = False
    kept[solid] = data[np.repeat(keep, np.diff(offsets))]
    last = np.flatnonzero(np.diff(text, append=-1))  # no space after a text's last word
    solid[:] = True
    solid[ends[last] - 1] = False
    sizes[last] -= 1
    lengths = np.bincount(text, sizes, len(counts)).astype(np.int64)
    return binary(kept[solid], np.concatenate(([0], np.cumsum(lengths)))).cast(pa.large_string()).cast(pa.string())


def slices(batch: pa.RecordBatch, text_col: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of at most ``max_bytes`` of text, or one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False) + 64
    place = np.cumsum(lengths) // max_bytes
    edges = np.flatnonzero(np.diff(place, prepend=-1, append=-1)) if len(place) else np.zeros(0, np.int64)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield batch.slice(a, b - a)
