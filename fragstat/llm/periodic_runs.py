"""Periodic runs: stretches of a text that repeat with some period of words.

A run is a stretch of consecutive words with smallest period q, at least
``max(min_length, min_exponent * q)`` words long, that no neighbouring word
extends keeping that period.

Method, for each text by itself (texts are independent, so nothing is shuffled):

1. *Where a run can be.*  In a run every short gram after the first period also
   occurs q words before.  Stretches of grams whose nearest earlier occurrence
   is not farther than the stretch's own length allows are kept, again and
   again until none falls away; whatever is left goes on, with the words around
   it.  This only excludes words that no run can hold.
2. *Suffix automaton* of the stretch.  Its suffix links form a tree in which
   the path from a prefix's state to the root holds all suffixes of the prefix.
3. *Link-cut access*, word by word: the path of the prefix that ends at the word
   is recoloured to that end.  The segments of equal colour that it runs over
   tell where each suffix ended last; as the tree is complete by then, they are
   kept as stacks on its heavy paths instead of splay trees (an access pops what
   it covers: O(log) heavy paths, amortised O(1) segments on each).  A
   segment whose longest suffix has ``length`` words and last ended ``d`` words
   earlier is a square where ``d <= length``: the ``length + d`` words up to here
   have period d.  As the *last* end is taken, d is the smallest period.
4. Squares of at least the wanted exponent are extended word by word to runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragstat.llm.tokens import coded, mixed
from fragstat.llm.word_text import cut_words, joined, slices

#: Text bytes that a task works on at once; a longer text comes by itself.
SLICE_BYTES = 4 << 20

_U = np.uint64


def _automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """The suffix automaton of ``words``: length and suffix link of each state
    (root 0, link -1), and the state of each prefix."""
    length, link, steps = [0], [-1], [{}]
    prefixes = []
    last = 0
    for place, word in enumerate(words, 1):
        now = len(length)
        length.append(place)
        link.append(0)
        steps.append({})
        state = last
        while state >= 0 and word not in steps[state]:
            steps[state][word] = now
            state = link[state]
        if state >= 0:
            there = steps[state][word]
            if length[there] == length[state] + 1:
                link[now] = there
            else:
                twin = len(length)
                length.append(length[state] + 1)
                link.append(link[there])
                steps.append(dict(steps[there]))
                while state >= 0 and steps[state].get(word) == there:
                    steps[state][word] = twin
                    state = link[state]
                link[there] = link[now] = twin
        prefixes.append(now)
        last = now
    return length, link, prefixes


def _heavy_tops(length: list[int], link: list[int]) -> list[int]:
    """For each state the uppermost one of its heavy path in the link tree."""
    down = np.argsort(np.array(length), kind="stable").tolist()  # parents are shorter
    below = [1] * len(length)
    for state in reversed(down[1:]):
        below[link[state]] += below[state]
    heavy = [-1] * len(length)
    for state in down[1:]:
        parent = link[state]
        if heavy[parent] < 0 or below[state] > below[heavy[parent]]:
            heavy[parent] = state
    top = list(range(len(length)))
    for state in down[1:]:
        if heavy[link[state]] == state:
            top[state] = top[link[state]]
    return top


def squares(words: list[int], min_length: int, min_exponent: int) -> Iterator[tuple[int, int, int]]:
    """``(end, length, period)`` of repetitions that are at least as long as asked
    for: the ``length`` words before ``end`` have that smallest period."""
    length, link, prefixes = _automaton(words)
    top = _heavy_tops(length, link)
    stacks: list[list[tuple[int, int]]] = [[] for _ in length]
    for place, state in enumerate(prefixes):
        while state > 0:
            head = top[state]
            reach = length[state]
            stack = stacks[head]
            size = 0
            while stack and stack[-1][0] <= reach:  # segments that the access covers as a whole
                size, before = stack.pop()
                period = place - before
                if size + period >= min_exponent * period and size + period >= min_length:
                    yield place + 1, size + period, period
            if stack and size < reach:  # and the one that goes on below
                period = place - stack[-1][1]
                if reach + period >= min_exponent * period and reach + period >= min_length:
                    yield place + 1, reach + period, period
            stack.append((reach, place))
            state = link[head]


def runs_within(words: np.ndarray, begin: int, end: int, min_length: int, min_exponent: int) -> set[tuple[int, int, int]]:
    """The runs ``(start, length, period)`` of the text ``words`` that have a
    square inside ``[begin, end)``."""
    found: set[tuple[int, int, int]] = set()
    known: dict[int, int] = {}  # period -> end of the run extended last
    text = words.tolist()
    for stop, size, period in squares(text[begin:end], min_length, min_exponent):
        stop += begin
        if known.get(period, -1) >= stop:
            continue  # squares of one run come one after the other
        start = stop - size
        while start and text[start - 1] == text[start - 1 + period]:
            start -= 1
        while stop < len(text) and text[stop] == text[stop - period]:
            stop += 1
        known[period] = stop
        found.add((start, stop - start, period))
    return found


def _possible(words: np.ndarray, counts: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """``(text, begin, end)`` of stretches, in words of the slice, outside of
    which there is no run."""
    # A run of period q has max(min_length, min_exponent * q) words or more, and so at
    # least that many less q + gram - 1 grams that also occur q words before.
    gram = min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))
    starts = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(np.arange(len(words)) + gram <= np.repeat(starts + counts, counts))
    if not len(at):
        return []
    names = mixed(text[at].astype(_U) + _U(1))
    for i in range(gram):
        names = mixed(names * _U(0x100000001B3) + words[at + i].astype(_U) + _U(i + 1))
    order = np.argsort(names, kind="stable")
    again = np.flatnonzero(names[order[1:]] == names[order[:-1]])
    distance = np.zeros(len(at), np.int64)
    distance[order[again + 1]] = at[order[again + 1]] - at[order[again]]
    marked = distance > 0
    at, distance = at[marked], distance[marked]
    while len(at):
        first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        sizes = np.diff(first, append=len(at))
        longest = (sizes + gram - 1) // (min_exponent - 1)  # period of a run with so many grams
        fits = distance <= np.repeat(longest, sizes)
        if fits.all():
            found = text[at[first]]
            begin = np.maximum(at[first] - longest, starts[found])
            end = np.minimum(at[first] + sizes - 1 + gram, starts[found] + counts[found])
            return list(zip(found.tolist(), begin.tolist(), end.tolist()))
        at, distance = at[fits], distance[fits]
    return []


def _runs_of(batch: pa.RecordBatch, min_length: int, min_exponent: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    words, counts = cut_words(batch.column("_text"))
    codes, _ = coded(words)
    starts = np.cumsum(counts) - counts
    runs: list[set] = [set() for _ in counts]
    for text, begin, end in _possible(codes, counts, min_length, min_exponent):
        first = int(starts[text])
        own = codes[first:first + int(counts[text])]
        runs[text] |= runs_within(own, begin - first, end - first, min_length, min_exponent)
    change = np.zeros(len(codes) + 1, np.int64)
    flat_runs = []
    for text, own in enumerate(runs):
        for start, length, period in sorted(own, key=lambda r: (r[0], r[2])):
            flat_runs.append((start, length, period))
            change[starts[text] + start + period] += 1
            change[starts[text] + start + length] -= 1
    table = np.array(flat_runs, np.int64).reshape(-1, 3)
    structs = pa.StructArray.from_arrays([pa.array(table[:, k]) for k in range(3)], ["start", "length", "period"])
    ends = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
    return (pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), structs),
            joined(words, counts, np.cumsum(change[:-1]) == 0))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """``id_col, n_words, runs, collapsed`` for every row: all runs as structs
    ``start, length, period`` (in words, by start, then period), and the words
    joined by one space without those that a run holds after its first period.

    Words are ``[^\\x20\\x09-\\x0D]+``, compared as they are.  A null, empty or
    blank text has no words, no runs and the empty string as ``collapsed``.  Rows
    are judged one by one: repeated rows and null ids come back as they are; other
    columns are not read; an empty table gives no rows.  A task holds 4 MB of
    text, or one longer text and the automaton of its periodic part.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods at least")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                n_words, runs, collapsed = _runs_of(part, min_length, min_exponent)
                yield pa.RecordBatch.from_arrays([part.column("_id"), n_words, runs, collapsed],
                                                 [id_col, "n_words", "runs", "collapsed"])

    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())])
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(find, schema)
