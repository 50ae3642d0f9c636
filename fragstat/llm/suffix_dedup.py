"""Suffix-array dedup by the common-prefix interval tree.

Removes every byte that is covered by a string of ``LENGTH`` bytes which also
starts anywhere else in the corpus.

Sorting all suffixes of a corpus would move it many times, so the enhanced
suffix array is sparse.  Its suffixes start at *anchors*: of every ``LENGTH``
bytes, the ``GRAM``-byte string with the smallest hash (winnowing).  Wherever
a string of ``LENGTH`` bytes occurs, the same anchor is chosen inside it, so
two occurrences meet under that anchor's string, and it is enough to compare
``REACH`` bytes before and ``LENGTH`` bytes from the anchor.

1. A packed dictionary join counts the anchors' strings over the corpus.
2. Anchors that occur again send their surroundings to the bucket of their
   string, equal surroundings of a chunk once.
3. A bucket sorts them into a suffix array with the lengths of common
   prefixes.  A stack scan yields the tree of common-prefix intervals; inside
   an interval, the occurrences are ordered by the bytes before the anchor and
   cut where the left extension differs.  Each part whose common extension and
   prefix reach ``LENGTH`` bytes is a maximal repeat with all its occurrences.
4. The longest extensions of each occurrence go back to its chunk, where the
   union of all repeats is cut out.

An anchor with more than ``HOT`` occurrences would fill a task: its windows of
``LENGTH`` bytes are counted one by one by the same dictionary join instead,
under two independent 64-bit hashes.  That is as exact, but for collisions of
128 bits, and spreads over all buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragstat.llm.packed import (
    REQUESTS, add_up, bucket_bits, count_requests, distinct_counts, from_payload, pack, request_rows, squeeze, to_payload,
    told, unsqueeze, with_answers)
from fragstat.llm.tokens import binary, flat, mixed, segments, spread

#: Bytes of a repeat, of an anchor's string, and compared before an anchor.
LENGTH, GRAM = 200, 100
REACH = LENGTH - GRAM
#: An anchor with more occurrences is taken window by window.
HOT = 100_000
#: Text bytes of a chunk, and positions hashed at a time.
CHUNK_BYTES = 6 << 20
BLOCK = 1 << 20
#: Bits of an anchor's hash by which it is counted.
KEY_BITS = 48

CONTEXTS = "bucket int, chunk long, payload binary"
REACHES = "chunk long, at binary, before binary, after binary"

_U = np.uint64
_BYTES = mixed(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_OTHER = mixed(np.arange(1, 257, dtype=_U) * _U(0xC2B2AE3D27D4EB4F))


def _rolling(data: np.ndarray, width: int, table: np.ndarray = _BYTES, factor: int = 0x100000001B3) -> np.ndarray:
    """A hash of each ``width``-byte string of ``data``, put together from
    strings of powers of two."""
    count = len(data) - width + 1
    if count <= 0:
        return np.zeros(0, _U)
    power, size = table[data], 1
    result, done = None, 0
    while True:
        if width & size:
            part = power[done:done + count]
            result = part.copy() if result is None else result * _U(pow(factor, size, 1 << 64)) + part
            done += size
        if 2 * size > width:
            return mixed(result)
        power = power[:-size] * _U(pow(factor, size, 1 << 64)) + power[size:]
        size *= 2


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) over each ``width`` neighbours."""
    count, size = len(values) - width + 1, 1
    while 2 * size <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    return best(values[:count], values[width - size:width - size + count])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all texts in a flat buffer.

    A place is one if its hash is the smallest in some window of ``LENGTH``
    bytes that lies in its text; ties are all taken.
    """
    lengths = np.diff(offsets)
    places, found = [], []
    none = np.iinfo(np.uint64).max
    for begin in range(0, len(data), BLOCK):
        # Windows may start REACH before the block and end LENGTH after it.
        lo, hi = max(0, begin - REACH), min(len(data), begin + BLOCK + LENGTH)
        hashed = _rolling(data[lo:hi], GRAM)
        if len(hashed) <= REACH:
            continue
        first, last = np.searchsorted(offsets, lo, "right") - 1, np.searchsorted(offsets, hi, "left")
        inside = np.zeros(hi - lo, bool)  # a whole window starts here and stays in its text
        for a, n in zip(offsets[first:last].tolist(), lengths[first:last].tolist()):
            if n >= LENGTH:
                inside[max(a - lo, 0):max(a + n - LENGTH + 1 - lo, 0)] = True
        least = _sliding(hashed, REACH + 1, np.minimum)
        least = np.where(inside[:len(least)], least, _U(0))
        # The greatest of the minima of the windows around a place is its own hash: it is some window's minimum.
        around = np.concatenate((np.zeros(REACH, _U), least, np.zeros(REACH, _U)))
        chosen = (_sliding(around, REACH + 1, np.maximum) == hashed) & (hashed != none) & (hashed > 0)
        at = np.flatnonzero(chosen) + lo
        own = (at >= begin) & (at < begin + BLOCK)
        places.append(at[own])
        found.append(hashed[at[own] - lo])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    # The smallest of many hashes are all small: scrambled, they deal out evenly.
    return np.concatenate(places), mixed(np.concatenate(found) + _U(1))


def _surroundings(offsets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the text before (up to REACH) and from (up to LENGTH) each place."""
    text = np.searchsorted(offsets, at, "right") - 1
    return np.minimum(at - offsets[text], REACH), np.minimum(offsets[text + 1] - at, LENGTH)


def _common(x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row of x and y, ``most`` at most."""
    unlike = x != y
    first = np.where(unlike.any(1), unlike.argmax(1), x.shape[1])
    return np.minimum(first, most)


def intervals(lcp: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """The common-prefix intervals (depth, first, last) of a suffix array, by a
    stack scan: children before their parents.  ``lcp[i]`` belongs to suffixes
    i and i + 1; depth 0 is left out."""
    stack = [(0, 0)]
    for i, depth in enumerate([*lcp.tolist(), 0]):
        begin = i
        while depth < stack[-1][0]:
            top, begin = stack.pop()
            yield top, begin, i
        if depth > stack[-1][0]:
            stack.append((depth, begin))


def maximal_repeats(keys: np.ndarray, contexts: pa.Array, before: np.ndarray
                    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Repeats of ``LENGTH`` bytes or more around anchors: (occurrences, bytes
    before the anchor, bytes from it).  The occurrences, as row numbers, are
    all of them; the extension before the anchor is each one's longest that
    another occurrence of the interval shares.

    ``before`` of the bytes of a context lie before its anchor.
    """
    n = len(keys)
    data, ends = flat(contexts)
    after = np.diff(ends) - before
    right = np.zeros((n, LENGTH), np.uint8)
    left = np.zeros((n, REACH), np.uint8)  # backwards from the anchor
    row = segments(after)
    col = spread(np.zeros(n, np.int64), after)
    right[row, col] = data[spread(ends[:-1] + before, after)]
    row, col = segments(before), spread(np.zeros(n, np.int64), before)
    left[row, col] = data[ends[:-1][row] + before[row] - 1 - col]
    sort_key = np.concatenate([keys.byteswap().view(np.uint8).reshape(n, 8), right], 1)
    order = np.argsort(np.ascontiguousarray(sort_key).view(f"S{8 + LENGTH}").ravel(), kind="stable")
    keys, right, left, before, after = keys[order], right[order], left[order], before[order], after[order]
    lcp = _common(right[:-1], right[1:], np.minimum(after[:-1], after[1:]))
    lcp = np.where(keys[:-1] == keys[1:], lcp, 0)
    lcs = _common(left[:-1], left[1:], np.minimum(before[:-1], before[1:]))
    for depth, i, j in intervals(lcp):
        need = LENGTH - depth
        if j == i + 1:
            if lcs[i] >= need:
                yield order[i:j + 1], np.full(2, lcs[i]), np.full(2, depth)
            continue
        own = left[i:j + 1]
        by_left = np.argsort(own.view(f"S{REACH}").ravel(), kind="stable")
        own, room = own[by_left], before[i:j + 1][by_left]
        shared = _common(own[:-1], own[1:], np.minimum(room[:-1], room[1:]))
        longest = np.maximum(np.append(shared, -1), np.insert(shared, 0, -1))
        # Left extensions that differ too early part the interval; a part of one is no repeat.
        some = longest >= need
        if some.any():
            yield order[i + by_left[some]], longest[some], np.full(np.count_nonzero(some), depth)


def _contexts(texts: pa.Table, answer: pa.Table, bits: int, hot: int):
    """The chunk's repeated anchors: (data, offsets, places, hashes, whether hot)."""
    data, offsets = flat(texts.column("_text"))
    at, hashed = anchors(data, offsets)
    count = told(answer, 0, bits)[np.unique(hashed >> _U(64 - KEY_BITS), return_inverse=True)[1]]
    again = count > 1
    return data, offsets, at[again], hashed[again], (count > hot)[again]


def _windows(data: np.ndarray, offsets: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows around places, window by window, and their hashes."""
    before, after = _surroundings(offsets, at)
    many = before + after - LENGTH + 1
    starts = spread(at - before, many)
    begins = np.unique(starts)
    hashed = np.zeros(len(begins), _U)
    edges = np.flatnonzero(np.diff(begins, prepend=-2) != 1)
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(begins)]):
        for k in range(a, b, BLOCK):
            end = min(b, k + BLOCK)
            hashed[k:end] = _rolling(data[begins[k]:begins[end - 1] + LENGTH], LENGTH, table)
    return begins, hashed


def _hot_reaches(chunks: DataFrame, answers: DataFrame, bits: int, hot: int) -> DataFrame:
    """The repeats around hot anchors, window by window."""
    def keys_of(texts: pa.Table, answer: pa.Table):
        data, offsets, at, _, hottest = _contexts(texts, answer, bits, hot)
        starts, one = _windows(data, offsets, at[hottest], _BYTES)
        _, two = _windows(data, offsets, at[hottest], _OTHER)
        return starts, one, two

    def ask(texts: pa.Table, answer: pa.Table) -> pa.Table:
        _, one, two = keys_of(texts, answer)
        rows = request_rows(answer.column("chunk")[0].as_py(), [distinct_counts(one), distinct_counts(two)], bits, 64)
        return pa.table(dict(zip(("bucket", "chunk", "keys", "counts"), rows)))

    def reach(texts: pa.Table, answer: pa.Table) -> pa.Table:
        first = answer.filter(pc.less(answer.column("bucket"), 1 << bits))
        more = answer.filter(pc.greater_equal(answer.column("bucket"), 1 << bits))
        starts, one, two = keys_of(texts, first)
        again = np.ones(len(starts), bool)
        for kind, keys in ((1, one), (2, two)):
            again &= told(more, kind, bits)[np.unique(keys, return_inverse=True)[1]] > 1
        starts = starts[again]
        return pa.table({"chunk": answer.column("chunk").slice(0, 1), "at": pa.array([squeeze(starts)], pa.binary()),
                         "before": pa.array([squeeze(np.zeros(len(starts), np.int16))], pa.binary()),
                         "after": pa.array([squeeze(np.full(len(starts), LENGTH, np.int16))], pa.binary())})

    counted = add_up(with_answers(chunks, answers, ask, REQUESTS)).withColumn("bucket", F.col("bucket") + (1 << bits))
    return with_answers(chunks, answers.unionByName(counted), reach, REACHES)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``id_col, n_bytes, spans, kept`` for every row: the spans ``[start, end)``
    of bytes to remove, and the remaining bytes.

    Matches never cross texts; null counts as empty.  Copies of a text, within
    a row's own text too, count like any other repeat, so equal texts of
    ``LENGTH`` bytes or more lose all their bytes.  Repeated rows stay; other
    columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bits = bucket_bits(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # Read three times: kept on the executors' disks, rebuilt from the input where one is lost;
    # a chunk that then comes out otherwise has another number, and the job fails.
    chunks = pack(rows, "_text", CHUNK_BYTES).repartition(partitions, F.col("chunk")).persist(StorageLevel.DISK_ONLY)

    def keys_of(texts: pa.Table):
        _, hashed = anchors(*flat(texts.column("_text")))
        return [distinct_counts(hashed >> _U(64 - KEY_BITS))]

    answers = add_up(count_requests(chunks, keys_of, bits, KEY_BITS)).checkpoint()

    def send(texts: pa.Table, answer: pa.Table) -> pa.Table:
        if not answer.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "chunk": pa.array([], pa.int64()),
                             "payload": pa.array([], pa.binary())})
        data, offsets, at, hashed, hottest = _contexts(texts, answer, bits, hot)
        at, hashed = at[~hottest], hashed[~hottest]
        before, after = _surroundings(offsets, at)
        raw = data.tobytes()
        groups: dict[tuple, list[int]] = {}
        for place, b, e in zip(at.tolist(), before.tolist(), (at + after).tolist()):
            groups.setdefault((raw[place - b:e], b), []).append(place)
        where = dict(zip(at.tolist(), hashed.tolist()))
        keys = np.fromiter((where[places[0]] for places in groups.values()), _U, len(groups))
        table = pa.table({
            "key": pa.array(keys.view(np.int64)), "context": pa.array([c for c, _ in groups], pa.large_binary()),
            "before": pa.array([b for _, b in groups], pa.int16()),
            "places": pa.array(list(groups.values()), pa.list_(pa.int32()))})
        buckets = (keys >> _U(64 - bits)).astype(np.int32)
        order = np.argsort(buckets, kind="stable")
        table, buckets = table.take(pa.array(order)), buckets[order]
        edges = np.flatnonzero(np.diff(buckets, prepend=-1, append=-1)) if len(buckets) else np.zeros(1, np.int64)
        chunk = answer.column("chunk")[0].as_py()
        return pa.table({"bucket": pa.array(buckets[edges[:-1]], pa.int32()),
                         "chunk": pa.array([chunk] * (len(edges) - 1), pa.int64()),
                         "payload": pa.array([to_payload(table.slice(a, b - a)) for a, b in zip(edges[:-1], edges[1:])],
                                             pa.binary())})

    def compare(group: pa.Table) -> pa.Table:
        parts = [from_payload(p) for p in group.column("payload").to_pylist()]
        table = pa.concat_tables(parts).combine_chunks()
        before = table.column("before").to_numpy().astype(np.int64)
        counts = pc.list_value_length(table.column("places")).to_numpy().astype(np.int64)
        reach = np.zeros((2, len(table)), np.int64)  # before and from the anchor
        contexts = table.column("context").combine_chunks()
        sizes = pc.binary_length(contexts).to_numpy().astype(np.int64)
        twice = counts > 1  # equal surroundings in one chunk: all of them is repeated
        reach[:, twice] = before[twice], (sizes - before)[twice]
        for rows, back, forth in maximal_repeats(table.column("key").to_numpy().view(_U), contexts, before):
            np.maximum.at(reach[0], rows, back)
            np.maximum.at(reach[1], rows, forth)
        places = pc.list_flatten(table.column("places")).to_numpy().astype(np.int64)
        back, forth = (np.repeat(r, counts).astype(np.int16) for r in reach)
        owner = np.repeat(np.repeat(np.arange(len(parts)), [p.num_rows for p in parts]), counts)
        result = []
        for k, chunk in enumerate(group.column("chunk").to_pylist()):
            some = (owner == k) & (forth > 0)
            if some.any():
                result.append((chunk, squeeze(places[some]), squeeze(back[some]), squeeze(forth[some])))
        columns = list(zip(*result)) or [[], [], [], []]
        return pa.table({name: pa.array(c, kind) for name, c, kind in zip(
            ("chunk", "at", "before", "after"), columns, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))})

    reaches = with_answers(chunks, answers, send, CONTEXTS).groupBy("bucket").applyInArrow(compare, REACHES)
    if (answers.agg(F.max("most")).first()[0] or 0) > hot:
        reaches = reaches.unionByName(_hot_reaches(chunks, answers, bits, hot))

    def cut(texts: pa.Table, answer: pa.Table) -> pa.Table:
        data, offsets = flat(texts.column("_text"))
        change = np.zeros(len(data) + 1, np.int32)
        for a, b, e in zip(*(answer.column(c).to_pylist() for c in ("at", "before", "after"))):
            at = unsqueeze(a, np.int64)
            np.add.at(change, at - unsqueeze(b, np.int16), 1)
            np.add.at(change, at + unsqueeze(e, np.int16), -1)
        gone = np.cumsum(change[:-1]) > 0
        steps = gone.copy()
        steps[1:] &= ~gone[:-1]
        firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
        steps[firsts] = gone[firsts]
        starts = np.flatnonzero(steps)
        stops = gone.copy()
        stops[:-1] &= ~gone[1:]
        lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        stops[lasts] = gone[lasts]
        ends = np.flatnonzero(stops) + 1
        at = np.searchsorted(starts, offsets)
        base = offsets[np.repeat(np.arange(len(offsets) - 1), np.diff(at))]
        spans = pa.StructArray.from_arrays([pa.array(starts - base, pa.int64()), pa.array(ends - base, pa.int64())],
                                           ["start", "end"])
        solid = np.concatenate(([0], np.cumsum(~gone)))
        kept = binary(data[~gone], solid[offsets]).cast(pa.binary())
        return pa.table({id_col: texts.column("_id"), "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                         "spans": pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), spans), "kept": kept})

    span = T.StructType().add("start", T.LongType()).add("end", T.LongType())
    schema = (T.StructType().add(id_col, docs.schema[id_col].dataType).add("n_bytes", T.LongType())
              .add("spans", T.ArrayType(span)).add("kept", T.BinaryType()))
    return with_answers(chunks, reaches, cut, schema)
