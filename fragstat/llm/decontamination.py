"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive tokens; tokens under a 0 of the mask
are ignored, so a substituted word does not hide a passage.  The seeds of all
benchmark items are joined with those of every document; around each hit the
two token sequences are laid over each other and compared token by token,
which tolerates substitutions, and an overlap that is long and similar enough
is reported.

The benchmark is a stated query set: it is taken in blocks of a bounded number
of seeds, each of which is broadcast, and every document meets every block in
one narrow pass.  Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragstat.llm.tokens import coded, flat, hashes, mixed, segments, spread, words

#: The masks (fixed values).  Of 13 tokens or more with at most 20 % substituted, four in a row are the same, or,
#: with 3 of 15, three on both sides of a substituted one; so too for items of 4, 8, 9, 11 and 12 tokens.
MASKS = ("1111", "1110111")
#: For items of other sizes: what is the same in a row, however the substituted tokens lie.
SHORT_MASKS = {1: "1", 2: "11", 3: "111", 5: "11", 6: "111", 7: "111", 10: "111"}
#: An overlap counts from so many tokens on, or the whole item if that is shorter ...
MIN_TOKENS = 13
#: ... if at least this share of its tokens, in hundredths, is the same.
PERCENT = 80
#: Benchmark tokens of a block; a block takes about 100 bytes for each.
BLOCK_TOKENS = 500_000

OVERLAPS = T.ArrayType(
    T.StructType().add("item", T.LongType()).add("start", T.IntegerType()).add("end", T.IntegerType())
    .add("item_start", T.IntegerType()).add("matches", T.IntegerType()), False)


@dataclass
class Block:
    """Items as one token array, and their seeds sorted by hash."""
    items: np.ndarray  # the item ids
    starts: np.ndarray  # where each item's tokens begin; one more at the end
    tokens: np.ndarray  # 64-bit word hashes
    seeds: np.ndarray  # sorted; several places may share a seed
    place: np.ndarray  # first token of the seed
    span: np.ndarray  # tokens that the seed covers
    vocabulary: np.ndarray  # sorted distinct tokens


def _masks() -> list[tuple[np.ndarray, int, list[int] | None]]:
    """Each mask as the places it looks at, with its span and the sizes of the items that it is for (none: all)."""
    short = [(m, [n for n, own in SHORT_MASKS.items() if own == m]) for m in sorted(set(SHORT_MASKS.values()))]
    return [(np.flatnonzero(np.array(list(m)) == "1"), len(m), sizes) for m, sizes in [*short, *((m, None) for m in MASKS)]]


def _seeds(tokens: np.ndarray, starts: np.ndarray, places: np.ndarray, number: int) -> np.ndarray:
    result = np.full(len(starts), number + 1, np.uint64)
    for place in places:
        result = mixed(result * np.uint64(0x100000001B3) + tokens[starts + place])
    return result


def _runs(lengths: np.ndarray, span: int, sizes: list[int] | None = None) -> np.ndarray:
    """Where a seed of that span may begin in texts of these lengths (only those of the given sizes)."""
    ends = np.cumsum(lengths)
    many = np.maximum(lengths - span + 1, 0)
    if sizes is not None:
        many[~np.isin(lengths, sizes)] = 0
    return spread(ends - lengths, many)


def make_block(ids: np.ndarray, texts: pa.Array) -> Block:
    tokens, lengths = words(*flat(texts))
    codes, distinct = coded(tokens)
    tokens = hashes(distinct)[codes]
    found = []
    for number, (places, span, sizes) in enumerate(_masks()):
        starts = _runs(lengths, span, sizes)
        found.append((_seeds(tokens, starts, places, number), starts, np.full(len(starts), span)))
    seeds, place, span = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(seeds, kind="stable")
    return Block(ids, np.concatenate(([0], np.cumsum(lengths))), tokens, seeds[order], place[order], span[order],
                 np.unique(tokens))


def overlaps(texts: pa.Array, block: Block) -> list[list[tuple]]:
    """For each text its overlaps (item, start, end, item_start, matches), in tokens."""
    result: list[list[tuple]] = [[] for _ in range(len(texts))]
    tokens, lengths = words(*flat(texts))
    if not len(tokens) or not len(block.seeds):
        return result
    codes, distinct = coded(tokens)
    hashed = hashes(distinct)
    at = np.minimum(np.searchsorted(block.vocabulary, hashed), len(block.vocabulary) - 1)
    known = (block.vocabulary[at] == hashed)[codes]
    tokens = hashed[codes]
    firsts = np.cumsum(lengths) - lengths
    text = segments(lengths)
    hits = []
    for number, (places, span, _) in enumerate(_masks()):
        starts = _runs(lengths, span)
        for place in places:  # words that no item has end the search early
            starts = starts[known[starts + place]]
        seeds = _seeds(tokens, starts, places, number)
        lo, hi = np.searchsorted(block.seeds, seeds, "left"), np.searchsorted(block.seeds, seeds, "right")
        many = hi - lo
        where = spread(lo, many)
        fits = block.span[where] == span
        hits.append(np.stack([np.repeat(starts, many)[fits], block.place[where][fits],
                              np.full(np.count_nonzero(fits), span)], 1))
    hits = np.concatenate(hits)
    if not len(hits):
        return result
    item = np.searchsorted(block.starts, hits[:, 1], "right") - 1
    rows = np.stack([text[hits[:, 0]], item, hits[:, 0] - hits[:, 1], hits[:, 1], hits[:, 2]], 1)
    rows = np.unique(rows, axis=0)  # by text, item, diagonal, place in the item
    edges = np.flatnonzero(np.any(np.diff(rows[:, :3], axis=0) != 0, axis=1)) + 1
    for group in np.split(rows, edges):
        number, which, shift = group[0, :3].tolist()
        first, size = int(firsts[number]), int(lengths[number])
        begin = max(int(block.starts[which]), first - shift)
        end = min(int(block.starts[which + 1]), first + size - shift)
        need = min(MIN_TOKENS, int(block.starts[which + 1] - block.starts[which]))
        if end - begin < need:
            continue
        same = block.tokens[begin:end] == tokens[begin + shift:end + shift]
        best = _longest_window(same, group[:, 3] - begin, group[:, 4], need)
        if best:
            a, b, matches = best
            result[number].append((int(block.items[which]), begin + a + shift - first, begin + b + shift - first,
                                   begin + a - int(block.starts[which]), matches))
    return result


def _longest_window(same: np.ndarray, hits: np.ndarray, spans: np.ndarray, need: int) -> tuple[int, int, int] | None:
    """The longest window that holds a hit and is long and similar enough; the first of equally long ones.

    With ``100 - PERCENT`` for a match and ``-PERCENT`` for another token, a
    window is similar enough if its sum is not negative.
    """
    score = np.concatenate(([0], np.cumsum(np.where(same, 100 - PERCENT, -PERCENT))))
    # For each end the first begin from where the sum is not negative, and where the last hit before it begins.
    begin = np.searchsorted(-np.minimum.accumulate(score), -score, "left")
    last = np.full(len(score), -1)
    np.maximum.at(last, hits + spans, hits)
    size = np.where(np.maximum.accumulate(last) >= begin, np.arange(len(score)) - begin, 0)
    b = int(np.argmax(size))
    if size[b] < need:
        return None
    a = int(begin[b])
    return a, b, int(np.count_nonzero(same[a:b]))


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Block]:
    """The benchmark in blocks; null ids and texts without words have no seeds."""
    items = benchmark.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")))).first()[0] or 0
    blocks = -(-size // BLOCK_TOKENS)
    for number in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number).distinct().toPandas()
        part = part.sort_values(["item", "text"])
        yield make_block(part["item"].to_numpy(np.int64), pa.array(part["text"], pa.large_string()))


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", out: str = "overlaps") -> DataFrame:
    """``docs`` with ``out``: the overlaps of each text with benchmark items.

    Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased.  An overlap has the
    item's id, the words ``[start, end)`` of the text, the first word of the
    item and how many words match; for each item and alignment the longest
    one is listed.  Null, empty and wordless texts have none, as has any text
    when the benchmark is empty.  Rows and columns stay as they are; a column
    named ``out`` is replaced.
    """
    docs = docs.drop(out)
    schema = T.StructType(list(docs.schema)).add(out, OVERLAPS)
    result = docs.withColumn(out, F.array().cast(OVERLAPS))
    for block in benchmark_blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            kind = pa.list_(pa.struct([("item", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                                       ("item_start", pa.int32()), ("matches", pa.int32())]))
            for batch in batches:
                for begin in range(0, batch.num_rows, 250):
                    part = batch.slice(begin, 250)
                    rows = [old + [dict(zip(("item", "start", "end", "item_start", "matches"), x)) for x in new]
                            for old, new in zip(part.column(out).to_pylist(),
                                                overlaps(pc.fill_null(part.column(text_col), ""), shared.value))]
                    columns = [pa.array(rows, kind) if name == out else part.column(name) for name in part.schema.names]
                    yield pa.RecordBatch.from_arrays(columns, part.schema.names)
        result = result.mapInArrow(search, schema)
    return result


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any overlap, all columns as they are."""
    return find_overlaps(docs, benchmark, text_col, out="__overlaps").where(
        F.size("__overlaps") == 0).drop("__overlaps")
