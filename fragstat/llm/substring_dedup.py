"""Word-level removal of passages that an earlier document has, by recompression.

Words are removed where a window of ``WINDOW`` of them also starts in a document
with a smaller id.  Three Spark rounds give names to ever larger parts of the
texts and tell each place who else has that part; only what is shared goes on.

1. *Low symbols.*  Each text is recompressed (:mod:`fragstat.llm.recompression`)
   to symbols of some six words.  All names meet; a symbol that one text alone has
   rules out every window that holds the words it depends on.  Whatever windows are
   left form *stretches*.
2. *High symbols.*  Stretches are recompressed further, up to one symbol.  The
   names of symbols of a window's length or more meet with the smallest document
   that has each: where that is an earlier one, the symbol's words are a long
   repeat as a whole, whoever else has them, and need no more questions.
3. *Windows.*  What is left -- windows over the edges of high symbols, and in
   the first document of each repeat -- is verified window by window: names of
   windows are made of names of their halves, and meet like those of symbols.

A row is a chunk of documents (:mod:`fragstat.llm.packed`): it tells each bucket
of the name space its distinct names, once each, and gets one bit for each back.
So a passage in very many documents costs one entry for each chunk.  Names travel
with a second, independent fingerprint, 96 bits together; low symbols need none,
as they only rule windows out that have no equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragstat.config import scratch_path
from fragstat.llm.packed import (_packer, from_payload, squeeze, squeeze_sorted, to_payload, unsqueeze, unsqueeze_sorted)
from fragstat.llm.recompression import Checks, Symbols, climb, spell
from fragstat.llm.tokens import hashes, mixed, spread
from fragstat.llm.word_text import cut_words, joined

#: Words of a window.
WINDOW = 50
#: Pair steps to the low symbols.
LOW = 6
#: Pair steps, on top of those, after which high symbols are named; the last level is far above any text.
HIGH = (6, 9, 12, 16, 20, 26, 34)
#: Text bytes of a chunk.
CHUNK_BYTES = 4 << 20
#: Packed text bytes for each bucket of names.
BUCKET_BYTES = 16 << 20

_U = np.uint64
_NOBODY = np.iinfo(np.int64).max  # stands for a null id: smaller than none

CHUNKS = "chunk long, payload binary, names binary, several binary, symbols binary"
QUESTIONS = "bucket int, chunk long, kind int, names binary, checks binary, least binary"
ANSWERS = "chunk long, kind int, bucket int, bits binary"


# --- one chunk --------------------------------------------------------------------------

def _bits(values: np.ndarray) -> bytes:
    return squeeze(np.packbits(values)) if len(values) else b""


def _unbits(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(unsqueeze(data, np.uint8), count=count).astype(bool) if count else np.zeros(0, bool)


def low_symbols(words: pa.Array, counts: np.ndarray) -> Symbols:
    return climb(spell(hashes(words), np.repeat(np.arange(len(counts)), counts)), LOW)


def _described(table: pa.Table) -> tuple[bytes, bytes, bytes]:
    """A chunk's distinct low names, whether several of its texts have each, and
    for each symbol its name's number and context."""
    words, counts = cut_words(table.column("_text"))
    s = low_symbols(words, counts)
    names, number = np.unique(s.name, return_inverse=True)
    first = np.full(len(names), len(counts), np.int32)
    last = np.full(len(names), -1, np.int32)
    np.minimum.at(first, number, s.row)
    np.maximum.at(last, number, s.row)
    described = pa.table({"number": pa.array(number, pa.int32()), "left": s.left, "size": (s.right - s.left).astype(np.int32)})
    return squeeze_sorted(names), _bits(first != last), to_payload(described)


def dead_windows(left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each word, whether no window that starts there can be shared: none
    fits the text, or it holds the context ``[left, right)`` of a symbol that is not."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    text = np.repeat(np.arange(len(counts)), counts)
    dead = np.arange(total) + WINDOW > ends[text]
    # A context that reaches a word beyond its text lies in no window of it.
    row = np.searchsorted(ends, (left + right) // 2, "right")
    row = np.minimum(row, len(counts) - 1)
    begins = np.maximum(right - WINDOW, (ends - counts)[row])
    stops = np.minimum(left, ends[row] - WINDOW)
    some = (stops >= begins) & (right <= ends[row]) & (left >= (ends - counts)[row])
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, begins[some], 1)
    np.add.at(change, stops[some] + 1, -1)
    return dead | (np.cumsum(change[:-1]) > 0)


def _ranges(marked: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ranges ``[start, stop)`` of marked places within a text."""
    at = np.flatnonzero(marked)
    if not len(at):
        return at, at
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (text[at[1:]] != text[at[:-1]])
    first = np.flatnonzero(new)
    return at[first], at[np.append(first[1:], len(at)) - 1] + 1


class Stretches:
    """Stretches of a chunk whose windows may be shared: place of the first word in
    the chunk, id of the document, hashes of the words."""

    def __init__(self, table: pa.Table):
        self.place = table.column("place").to_numpy()
        self.owner = table.column("owner").to_numpy()  # _NOBODY: null
        self.counts = table.column("count").to_numpy().astype(np.int64)
        self.words = unsqueeze(table.column("words")[0].as_py(), _U)
        self.starts = np.cumsum(self.counts) - self.counts
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        self.checks = Checks(self.words)

    def high_symbols(self) -> Symbols:
        """Symbols of a window's length or more, each place once."""
        s, done, found = climb(spell(self.words, self.row), LOW), 0, []
        for level in HIGH:
            s = climb(s, level - done, LOW + done)
            done = level
            found.append(s.take(np.flatnonzero(s.end - s.start >= WINDOW)))
        every = Symbols(*(np.concatenate([getattr(f, c) for f in found]) for c in Symbols.__dataclass_fields__))
        _, once = np.unique(every.start.astype(np.int64) << 32 | every.end, return_index=True)
        return every.take(once)

    def window_names(self, at: np.ndarray) -> np.ndarray:
        """The names of the windows that start at these words (the next ``WINDOW`` are in the stretch)."""
        names, size, have, result, offset = self.words, 1, WINDOW, None, 0
        while have:
            if have & 1:
                part = names[at + offset]
                result = part if result is None else mixed(mixed(result + _U(0x57)) + part)
                offset += size
            have >>= 1
            if have:
                longer = mixed(mixed(names[:len(names) - size] + _U(size)) * _U(0x9E3779B97F4A7C15) + names[size:])
                names, size = longer, 2 * size
        return result


class Asked:
    """The distinct (name, check) of a chunk in order, the smallest document of each,
    and which one each occurrence has."""

    def __init__(self, names: np.ndarray, checks: np.ndarray, owners: np.ndarray):
        order = np.lexsort((checks, names))
        names, checks = names[order], checks[order]
        new = np.ones(len(names), bool)
        new[1:] = (names[1:] != names[:-1]) | (checks[1:] != checks[:-1])
        first = np.flatnonzero(new)
        self.number = np.empty(len(names), np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.names, self.checks = names[first], checks[first]
        self.least = np.minimum.reduceat(owners[order], first) if len(first) else owners[:0]
        self.owners = owners

    def questions(self, chunk: int, kind: int, bits: int) -> pa.RecordBatch:
        edges = np.searchsorted(self.names >> _U(64 - bits), np.arange((1 << bits) + 1, dtype=_U))
        rows = [((kind << bits) + b, chunk, kind, squeeze_sorted(self.names[p]), squeeze(self.checks[p]), squeeze(self.least[p]))
                for b in np.flatnonzero(np.diff(edges)).tolist() for p in (slice(edges[b], edges[b + 1]),)]
        return _rows(rows, QUESTIONS_ARROW)

    def has_smaller(self, answers: pa.Table, kind: int) -> np.ndarray:
        """For each occurrence, whether an earlier document than its own has the same."""
        elsewhere = _told(answers, kind, self.names)
        smaller = elsewhere[self.number] | (self.least[self.number] < self.owners)
        return smaller & (self.owners != _NOBODY)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


QUESTIONS_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("names", pa.binary()),
                             ("checks", pa.binary()), ("least", pa.binary())])
ANSWERS_ARROW = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())])


def _told(answers: pa.Table, kind: int, names: np.ndarray) -> np.ndarray:
    """The answers of one kind, a bit for each of the chunk's sorted names.  Each
    bucket's answer says for how many names it stands; all must be there."""
    mine = answers.filter(pa.compute.equal(answers.column("kind"), kind)).sort_by("bucket")
    parts = [np.frombuffer(b, np.uint8) for b in mine.column("bits").to_pylist()]
    counts = [int(p[:8].view(np.int64)[0]) for p in parts]
    if sum(counts) != len(names):
        raise RuntimeError(f"a chunk asked for {len(names)} names and was told {sum(counts)}")
    bits = [_unbits(p[8:].tobytes(), n) for p, n in zip(parts, counts)]
    return np.concatenate(bits) if bits else np.zeros(0, bool)


def _counted_bits(values: np.ndarray) -> bytes:
    return np.int64(len(values)).tobytes() + _bits(values)


# --- one bucket ---------------------------------------------------------------------------

def _shared(group: pa.Table) -> pa.Table:
    """For each chunk's low names: whether two texts have it, in one chunk or two."""
    keys = [unsqueeze_sorted(k) for k in group.column("names").to_pylist()]
    flags = np.concatenate([_unbits(b, len(k)) for b, k in zip(group.column("checks").to_pylist(), keys)])
    _, place, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    several = times > 1
    several[place[flags]] = True
    return _answer(group, several[place], [len(k) for k in keys])


def _smaller(group: pa.Table) -> pa.Table:
    """For each chunk's names: whether another chunk has a smaller document for it."""
    keys = [unsqueeze_sorted(k) for k in group.column("names").to_pylist()]
    names = np.concatenate(keys)
    checks = np.concatenate([unsqueeze(c, np.uint32) for c in group.column("checks").to_pylist()])
    least = np.concatenate([unsqueeze(c, np.int64) for c in group.column("least").to_pylist()])
    asked = Asked(names, checks, least)
    return _answer(group, asked.least[asked.number] < least, [len(k) for k in keys])


def _answer(group: pa.Table, bits: np.ndarray, counts: list[int]) -> pa.Table:
    ends = np.cumsum(counts)
    return pa.table({"chunk": group.column("chunk"), "kind": group.column("kind"), "bucket": group.column("bucket"),
                     "bits": pa.array([_counted_bits(bits[e - n:e]) for e, n in zip(ends, counts)], pa.binary())})


# --- Spark --------------------------------------------------------------------------------

def _write(rows: DataFrame, name: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, name)
    rows.write.option("compression", "uncompressed").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _bucket_bits(chunks: DataFrame) -> int:
    """Log of the number of buckets, from the size of the packed texts."""
    size = chunks.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
    return max(int(size // BUCKET_BYTES).bit_length(), 4)


def _meet(left: DataFrame, answers: DataFrame, apply, schema) -> DataFrame:
    return left.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(apply, schema)


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_removed, kept`` for every row: ``kept`` are the words
    that stay, joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a null or blank text has none.
    A word goes if a window of ``WINDOW`` words that covers it also starts in a row
    with a smaller id (so the first document of a passage keeps it, and repeats
    inside one document, or in rows of the same id, stay).  A row whose id is null
    loses nothing and makes no other row lose anything.  Windows are judged on the
    input.  The id must be of an integer type.  Other columns are not read; an empty
    table gives no rows.
    """
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be of an integer type: smaller ids come first")

    packer = _packer("_text", CHUNK_BYTES)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in packer(batches):
            names, several, symbols = _described(from_payload(batch.column("payload")[0].as_py()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array([x], pa.binary()) for x in (names, several, symbols))],
                ["chunk", "payload", "names", "several", "symbols"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    chunks = _write(rows.mapInArrow(describe, CHUNKS), "passages")
    bits = _bucket_bits(chunks)

    def ask_low(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, names, several in zip(*(batch.column(c) for c in ("chunk", "names", "several"))):
                names = unsqueeze_sorted(names.as_py())
                flags = _unbits(several.as_py(), len(names))
                edges = np.searchsorted(names >> _U(64 - bits), np.arange((1 << bits) + 1, dtype=_U))
                yield _rows([(b, chunk.as_py(), 0, squeeze_sorted(names[p]), _bits(flags[p]), b"")
                             for b in np.flatnonzero(np.diff(edges)).tolist()
                             for p in (slice(edges[b], edges[b + 1]),)], QUESTIONS_ARROW)

    low = (chunks.select("chunk", "names", "several").mapInArrow(ask_low, QUESTIONS)
           .groupBy("bucket").applyInArrow(_shared, ANSWERS))

    def survey(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        """The stretches that are left, with the hashes of their words."""
        texts = from_payload(chunk.column("payload")[0].as_py())
        names = unsqueeze_sorted(chunk.column("names")[0].as_py())
        symbols = from_payload(chunk.column("symbols")[0].as_py())
        alone = ~_told(answers, 0, names)[symbols.column("number").to_numpy()]
        left = symbols.column("left").to_numpy()[alone].astype(np.int64)
        right = left + symbols.column("size").to_numpy()[alone]
        words, counts = cut_words(texts.column("_text"))
        text = np.repeat(np.arange(len(counts)), counts)
        start, stop = _ranges(~dead_windows(left, right, counts), text)
        owner = pa.compute.fill_null(texts.column("_id").cast(pa.int64()), _NOBODY).to_numpy()
        sizes = stop - start + WINDOW - 1
        hashed = hashes(words.take(pa.array(spread(start, sizes))))
        held = pa.table({"place": pa.array(start, pa.int64()), "owner": pa.array(owner[text[start]], pa.int64()),
                         "count": pa.array(sizes, pa.int32()),
                         "words": pa.array([squeeze(hashed)] + [b""] * (len(start) - 1), pa.binary()).slice(0, len(start))})
        return pa.table({"chunk": chunk.column("chunk").slice(0, min(len(start), 1)),
                         "payload": pa.array([to_payload(held)] if len(start) else [], pa.binary())})

    stretches = _write(_meet(chunks.select("chunk", "payload", "names", "symbols"), low, survey, "chunk long, payload binary"),
                       "stretches")

    def high_asked(held: Stretches) -> tuple[Symbols, Asked]:
        s = held.high_symbols()
        return s, Asked(s.name, held.checks.of(s.start, s.end), held.owner[s.row])

    def ask_high(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column("chunk"), batch.column("payload")):
                _, asked = high_asked(Stretches(from_payload(payload.as_py())))
                yield asked.questions(chunk.as_py(), 1, bits)

    high = stretches.mapInArrow(ask_high, QUESTIONS).groupBy("bucket").applyInArrow(_smaller, ANSWERS).checkpoint()

    def settled(held: Stretches, answers: pa.Table) -> np.ndarray:
        """For each word of the stretches, whether the window there lies in a high
        symbol that an earlier document has."""
        s, asked = high_asked(held)
        found = asked.has_smaller(answers, 1)
        change = np.zeros(len(held.words) + 1, np.int64)
        np.add.at(change, s.start[found], 1)
        np.add.at(change, s.end[found] - WINDOW + 1, -1)
        return np.cumsum(change[:-1]) > 0

    def windows_asked(held: Stretches, done: np.ndarray) -> tuple[np.ndarray, Asked]:
        fits = np.arange(len(held.words)) + WINDOW <= (held.starts + held.counts)[held.row]
        at = np.flatnonzero(fits & ~done)
        return at, Asked(held.window_names(at), held.checks.of(at, at + WINDOW), held.owner[held.row[at]])

    def ask_windows(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return QUESTIONS_ARROW.empty_table()
        held = Stretches(from_payload(chunk.column("payload")[0].as_py()))
        _, asked = windows_asked(held, settled(held, answers))
        return pa.Table.from_batches([asked.questions(chunk.column("chunk")[0].as_py(), 2, bits)])

    whole = _meet(stretches, high, ask_windows, QUESTIONS).groupBy("bucket").applyInArrow(_smaller, ANSWERS)

    def decide(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        held = Stretches(from_payload(chunk.column("payload")[0].as_py()))
        repeated = settled(held, answers)
        at, asked = windows_asked(held, repeated)
        repeated[at[asked.has_smaller(answers, 2)]] = True
        start, stop = _ranges(repeated, held.row)
        base = (held.place - held.starts)[held.row[start]]
        return pa.table({"chunk": chunk.column("chunk"), "starts": pa.array([squeeze(start + base)], pa.binary()),
                         "stops": pa.array([squeeze(stop + base)], pa.binary())})

    windows = _meet(stretches, high.unionByName(whole), decide, "chunk long, starts binary, stops binary")

    def cut(chunk: pa.Table, found: pa.Table) -> pa.Table:
        texts = from_payload(chunk.column("payload")[0].as_py())
        words, counts = cut_words(texts.column("_text"))
        change = np.zeros(len(words) + 1, np.int64)
        if found.num_rows:
            np.add.at(change, unsqueeze(found.column("starts")[0].as_py(), np.int64), 1)
            np.add.at(change, unsqueeze(found.column("stops")[0].as_py(), np.int64) + WINDOW - 1, -1)
        gone = np.cumsum(change[:-1]) > 0
        text = np.repeat(np.arange(len(counts)), counts)
        return pa.table({id_col: texts.column("_id"), "n_words": pa.array(counts, pa.int64()),
                         "n_removed": pa.array(np.bincount(text[gone], minlength=len(counts)), pa.int64()),
                         "kept": joined(words, counts, ~gone)})

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return _meet(chunks.select("chunk", "payload"), windows, cut, schema)
