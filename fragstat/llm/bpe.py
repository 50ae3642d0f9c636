"""BPE encoding and decoding with a distinct-word table.

Texts are cut into words at places where the tokenizer's own splitting rule is
sure to cut as well.  The distinct words of all documents meet in a table that
is spread over buckets, each word is encoded there once, and its ids go back
to every chunk that holds it and are joined to the words by position.
Decoding joins the ids with the id-to-piece table of the vocabulary.

The tokenizer is a file of the ``tokenizers`` library with byte-level pieces;
its path is a parameter and must be readable on every executor.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragstat.llm.memory import release
from fragstat.llm.packed import bucket_bits, from_payload, pack, squeeze, unsqueeze, with_answers
from fragstat.llm.tokens import binary, coded, flat, hashes, segments, spread

#: Text bytes of a chunk: its words, ids and pieces take about twenty times that.
CHUNK_BYTES = 4 << 20

#: Texts that are decoded at once.
DECODED_ROWS = 256

WORD_REQUESTS = "bucket int, chunk long, words binary, sizes binary, digest long"
WORD_ANSWERS = "chunk long, bucket int, ids binary, lengths binary, digest long"

# Bytes that are, or may be part of, white space of any kind; a cut never
# touches them.  Fixed values: 0x09-0x0D, 0x1C-0x1F, 0x20; first bytes 0xC2 and
# 0xE1-0xE3 begin the characters among which all other white space is.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_AFTER = ~_BLANK  # may follow a space or line end at a cut
_AFTER[0x80:0xC3] = False
_AFTER[0xE1:0xE4] = False


def cut_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end in a flat buffer, and how many each text has.

    A word begins at a single space between two characters that are not white
    space; a single line end between two such characters is a word of its own.
    The splitting rule of byte-level BPE begins a piece at each of these
    places, whatever else the text holds, so words can be encoded one by one.
    """
    n = len(data)
    if not n:
        return np.zeros(1, np.int64), np.zeros(len(offsets) - 1, np.int64)
    after = np.zeros(n, dtype=bool)
    after[:-1] = _AFTER[data[1:]]
    before = np.zeros(n, dtype=bool)
    before[1:] = (data[:-1] < 0x80) & ~_BLANK[data[:-1]]
    before[2:] |= (data[1:-1] >= 0x80) & (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)  # a two-byte letter
    inner = np.ones(n, dtype=bool)  # neither the first nor the last byte of its text
    filled = offsets[:-1] < offsets[1:]
    inner[offsets[:-1][filled]] = False
    inner[offsets[1:][filled] - 1] = False
    single = before & after & inner
    begins = single & ((data == 0x20) | (data == 0x0A))
    begins[1:] |= (single & (data == 0x0A))[:-1]
    begins[offsets[:-1][filled]] = True
    edges = np.append(np.flatnonzero(begins), n)
    return edges, np.diff(np.searchsorted(edges, offsets))


def _distinct_words(docs: pa.Table, text_col: str, bits: int):
    """(codes, words per text, distinct words grouped by bucket, bucket edges)."""
    data, offsets = flat(docs.column(text_col))
    edges, counts = cut_words(data, offsets)
    codes, distinct = coded(binary(data, edges))
    buckets = (hashes(distinct) >> np.uint64(64 - bits)).astype(np.int64)
    order = pc.array_sort_indices(distinct).to_numpy().astype(np.int64)  # neighbours in text order pack well
    order = order[np.argsort(buckets[order], kind="stable")]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    limits = np.searchsorted(buckets[order], np.arange((1 << bits) + 1))
    return rank[codes], counts, distinct.take(pa.array(order)), limits


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def id_to_piece(path: str) -> pa.Array:
    """The bytes of each id's piece, by id: the vocabulary's size bounds it."""
    # The byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ...
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocabulary = dict(spec["model"]["vocab"]) | {t["content"]: t["id"] for t in spec["added_tokens"]}
    pieces: list = [None] * (max(vocabulary.values()) + 1)
    for piece, number in vocabulary.items():
        known = all(c in byte for c in piece)
        pieces[number] = bytes(byte[c] for c in piece) if known else piece.encode()
    return pa.array(pieces, pa.large_binary())


def _digest(words: np.ndarray) -> int:
    """Of the words that a chunk asks a bucket about, one after the other."""
    return int(np.uint64(xxhash.xxh64_intdigest(words)).astype(np.int64))


def _decoded(lists: pa.Array | pa.ChunkedArray, tokenizer_path: str) -> list[str]:
    """The texts of id lists, joined from the ids' pieces, some lists at a time."""
    pieces = id_to_piece(tokenizer_path)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    texts: list[str] = []
    for begin in range(0, len(lists), DECODED_ROWS):
        part = lists.slice(begin, DECODED_ROWS)
        counts = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
        data, ends = flat(pieces.take(pc.list_flatten(part)))
        at = ends[np.concatenate(([0], np.cumsum(counts)))]
        texts += [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:])]
    return texts


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str = "ids",
           decoded_col: str | None = None) -> DataFrame:
    """``docs`` with ``ids_col``, the ids of the whole text as an int array.

    The ids are those of the library's ``encode(text, add_special_tokens=False)``.
    Null and empty texts have no ids (an empty array).  Repeated rows stay,
    other columns stay as they are; a column named ``ids_col`` is replaced.

    With ``decoded_col`` the ids are decoded to that column where they were joined,
    as :func:`decode` does, without a second Python worker beside the first.
    """
    docs = docs.drop(*[c for c in (ids_col, decoded_col) if c])
    bits = bucket_bits(docs.sparkSession)
    # Both sides read this exchange, so texts move once.  Should chunks come out otherwise
    # when a part is computed again, the digests differ and the job fails.
    chunks = pack(docs, text_col, CHUNK_BYTES).repartition(F.col("chunk"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column("chunk"), batch.column("payload")):
                release()
                _, _, distinct, limits = _distinct_words(from_payload(payload.as_py()), text_col, bits)
                filled = np.flatnonzero(np.diff(limits))
                words, sizes, digests = [], [], []
                for b in filled:
                    part, ends = flat(distinct.slice(limits[b], limits[b + 1] - limits[b]))
                    words.append(zstandard.compress(part.tobytes(), 3))
                    sizes.append(squeeze(np.diff(ends)))
                    digests.append(_digest(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(filled.astype(np.int32)), pa.array([chunk.as_py()] * len(filled), pa.int64()),
                     pa.array(words, pa.binary()), pa.array(sizes, pa.binary()), pa.array(digests, pa.int64())],
                    ["bucket", "chunk", "words", "sizes", "digest"])

    def encode_words(group: pa.Table) -> pa.Table:
        """Encode the distinct words of one bucket, each once."""
        release()
        sizes = [unsqueeze(x, np.int64) for x in group.column("sizes").to_pylist()]
        data = b"".join(zstandard.decompress(x) for x in group.column("words").to_pylist())
        words = binary(np.frombuffer(data, np.uint8), np.concatenate(([0], np.cumsum(np.concatenate(sizes)))))
        codes, distinct = coded(words)
        encoded = _tokenizer(tokenizer_path).encode_batch(
            [w.decode("utf-8") for w in distinct.to_pylist()], add_special_tokens=False)
        ids = [np.asarray(e.ids, np.uint32) for e in encoded]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        ids = np.concatenate(ids)
        starts = np.cumsum(lengths) - lengths
        rows, begin = ([], []), 0
        for size in map(len, sizes):
            mine = codes[begin:begin + size]
            begin += size
            rows[0].append(squeeze(ids[spread(starts[mine], lengths[mine])]))
            rows[1].append(squeeze(lengths[mine]))
        return pa.table({"chunk": group.column("chunk"), "bucket": group.column("bucket"),
                         "ids": pa.array(rows[0], pa.binary()), "lengths": pa.array(rows[1], pa.binary()),
                         "digest": group.column("digest")})

    def join_back(texts: pa.Table, answers: pa.Table) -> pa.Table:
        """The ids of a chunk's words, joined to its texts by position."""
        release()
        codes, counts, distinct, limits = _distinct_words(texts, text_col, bits)
        order = np.argsort(answers.column("bucket").to_numpy())
        asked = [_digest(flat(distinct.slice(limits[b], limits[b + 1] - limits[b]))[0])
                 for b in np.flatnonzero(np.diff(limits))]
        if asked != answers.column("digest").take(pa.array(order)).to_pylist():
            raise RuntimeError("these ids are of other chunks: the input changed between question and answer")
        take = lambda c, kind: [unsqueeze(answers.column(c)[int(i)].as_py(), kind) for i in order]
        ids = np.concatenate([np.zeros(0, np.uint32), *take("ids", np.uint32)])
        lengths = np.concatenate([np.zeros(0, np.int64), *take("lengths", np.int64)])
        starts = np.cumsum(lengths) - lengths
        values = ids[spread(starts[codes], lengths[codes])].astype(np.int32)
        tokens = np.bincount(segments(counts), lengths[codes], len(counts)).astype(np.int64)
        offsets = np.concatenate(([0], np.cumsum(tokens))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
        texts = texts.append_column(ids_col, lists)
        return texts.append_column(decoded_col, pa.array(_decoded(lists, tokenizer_path), pa.string())) if decoded_col else texts

    schema = T.StructType(list(docs.schema)).add(ids_col, T.ArrayType(T.IntegerType()))
    if decoded_col:
        schema = schema.add(decoded_col, T.StringType())
    answers = chunks.mapInArrow(ask, WORD_REQUESTS).groupBy("bucket").applyInArrow(encode_words, WORD_ANSWERS)
    return with_answers(chunks, answers, join_back, schema)


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``text_col``: the text of the ids, special tokens
    included; bytes that are no UTF-8 become U+FFFD.

    Null and empty id lists give an empty text.  An id outside the vocabulary
    fails the job.  The id-to-piece table, bounded by the vocabulary, is the
    small side of the join; each task loads it once.
    """
    encoded = encoded.drop(text_col)

    def join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _decoded(batch.column(ids_col), tokenizer_path)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text_col])

    schema = T.StructType(list(encoded.schema)).add(text_col, T.StringType())
    return encoded.mapInArrow(join_pieces, schema)
