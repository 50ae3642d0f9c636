"""Dictionary joins over packed chunks of documents.

Looking up every word or n-gram of a corpus in a table made from the same
corpus is a join with a row for each occurrence on both sides.  Here a row
stands for a *chunk* of documents instead (a few MB of text): a chunk sends
each bucket of the key space one packed list of its distinct keys, the bucket
combines the lists of all chunks and sends each chunk one packed answer, and
the answers meet the chunk's texts again, in order, by a cogroup.

* A frequent key costs one entry per chunk, so no key is hot.
* A task holds one chunk, or the keys of one bucket; both are sized below.
* Keys travel as sorted, difference-coded, compressed arrays, at a few bytes
  for each distinct key of a chunk.

Chunks are written to the shared folder once and reread, so that questions
and answers speak of the same chunks even if executors are lost in between.
Where chunks are computed again instead, their numbers carry a fingerprint of
their rows: answers for a chunk that has come out otherwise find no chunk, and
the job fails (:func:`documents`) rather than put them in wrong places.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from fragstat.config import scratch_path

#: Text bytes of a chunk; a single larger document is a chunk of its own.
CHUNK_BYTES = 12 << 20

CHUNKS = "chunk long, payload binary"
REQUESTS = "bucket int, chunk long, keys binary, counts binary"
ANSWERS = "chunk long, bucket int, sums binary, distinct long, total long, most long"


def squeeze(values: np.ndarray) -> bytes:
    """An array as bytes: byte planes, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.compress(planes.tobytes(), 3)


def unsqueeze(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def unsqueeze_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data, np.uint64), dtype=np.uint64)


def to_payload(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def from_payload(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all().combine_chunks()


def documents(chunk: pa.Table) -> pa.Table:
    """The rows of a chunk that others speak of."""
    if not chunk.num_rows:
        raise RuntimeError("these answers are of other chunks: the input changed between question and answer")
    return from_payload(chunk.column("payload")[0].as_py())


def _packer(text_col: str, chunk_bytes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 43, 0
        held: list[pa.RecordBatch] = []
        size = 0

        def chunk() -> pa.RecordBatch:
            payload = to_payload(pa.Table.from_batches(held))
            number = task | made << 24 | xxhash.xxh32_intdigest(payload) >> 8
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([payload], pa.binary())], ["chunk", "payload"])

        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
            begin = 0
            for i, length in enumerate((lengths + 64).tolist()):
                if size and size + length > chunk_bytes:
                    held.append(batch.slice(begin, i - begin))
                    yield chunk()
                    made, held, size, begin = made + 1, [], 0, i
                size += length
            held.append(batch.slice(begin))
        if size:
            yield chunk()
    return pack


def pack(docs: DataFrame, text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``chunk, payload``: the rows of ``docs``, all columns, in packed chunks.
    Numbers follow the input's order: partition, chunk of the partition, fingerprint."""
    return docs.mapInArrow(_packer(text_col, chunk_bytes), CHUNKS)


def packed_table(docs: DataFrame, text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """:func:`pack`, written to the shared folder and reread."""
    path = scratch_path(docs.sparkSession, "chunks")
    pack(docs, text_col, chunk_bytes).write.option("compression", "uncompressed").parquet(path)
    return docs.sparkSession.read.schema(CHUNKS).parquet(path)


def bucket_bits(spark) -> int:
    """Log of the number of buckets: two for each shuffle partition or more."""
    return (2 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


KeysOf = Callable[[pa.Table], list[tuple[np.ndarray, np.ndarray]]]


def request_rows(chunk: int, key_sets: list[tuple[np.ndarray, np.ndarray]], bits: int, key_bits: int) -> list[pa.Array]:
    """The columns of a chunk's requests (see :func:`count_requests`)."""
    shift = np.uint64(key_bits - bits)
    rows: list[tuple] = []
    for kind, (keys, counts) in enumerate(key_sets):
        edges = np.searchsorted(keys >> shift, np.arange((1 << bits) + 1, dtype=np.uint64))
        for b in np.flatnonzero(np.diff(edges)):
            part = slice(edges[b], edges[b + 1])
            rows.append(((kind << bits) + int(b), chunk, squeeze_sorted(keys[part]),
                         squeeze(counts[part].astype(np.uint32))))
    columns = list(zip(*rows)) or [[], [], [], []]
    return [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))]


def count_requests(chunks: DataFrame, keys_of: KeysOf, bits: int, key_bits: int = 64) -> DataFrame:
    """What each chunk tells each bucket: its distinct keys and their counts.

    ``keys_of`` gives a chunk's key sets; each is (sorted distinct keys below
    ``2 ** key_bits``, counts).  Set k has the buckets from ``k << bits`` on.
    """
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column("chunk"), batch.column("payload")):
                rows = request_rows(chunk.as_py(), keys_of(from_payload(payload.as_py())), bits, key_bits)
                yield pa.RecordBatch.from_arrays(rows, ["bucket", "chunk", "keys", "counts"])
    return chunks.mapInArrow(ask, REQUESTS)


def _add_up(group: pa.Table) -> pa.Table:
    keys = [unsqueeze_sorted(k) for k in group.column("keys").to_pylist()]
    counts = np.concatenate([unsqueeze(c, np.uint32) for c in group.column("counts").to_pylist()])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(place, counts, len(distinct)).astype(np.int64)
    told = sums[place]
    ends = np.cumsum([len(k) for k in keys])
    answers = [squeeze(told[end - len(k):end]) for end, k in zip(ends, keys)]
    first = np.arange(len(keys)) == 0  # the bucket's own figures, once
    return pa.table({
        "chunk": group.column("chunk"), "bucket": group.column("bucket"), "sums": pa.array(answers, pa.binary()),
        "distinct": pa.array(np.where(first, np.count_nonzero(sums), 0), pa.int64()),
        "total": pa.array(np.where(first, sums.sum(), 0), pa.int64()),
        "most": pa.array(np.where(first, sums.max(), 0), pa.int64())})


def add_up(requests: DataFrame) -> DataFrame:
    """The sums of all chunks' counts, for each key of each request; and, once
    for each bucket, how many keys have a positive sum, the sum of all and the largest."""
    return requests.groupBy("bucket").applyInArrow(_add_up, ANSWERS)


def told(answers: pa.Table, kind: int, bits: int) -> np.ndarray:
    """A chunk's answers of one key set, in the order of its sorted keys."""
    buckets = answers.column("bucket").to_numpy()
    mine = np.flatnonzero(buckets >> bits == kind)
    if not len(mine):
        return np.zeros(0, np.int64)
    order = mine[np.argsort(buckets[mine])]
    sums = answers.column("sums")
    return np.concatenate([unsqueeze(sums[int(i)].as_py(), np.int64) for i in order])


def with_answers(chunks: DataFrame, answers: DataFrame, apply: Callable[[pa.Table, pa.Table], pa.Table],
                 schema) -> DataFrame:
    """``apply(documents of the chunk, its answers)`` for each chunk."""
    def meet(chunk: pa.Table, answer: pa.Table) -> pa.Table:
        return apply(documents(chunk), answer)
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(meet, schema)


def distinct_counts(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their counts, or the sums of their weights."""
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(place, weights, len(distinct)).astype(np.int64)
