"""LM scoring with a weighted backoff automaton.

The model is a smoothed bigram model over all training texts.  Its states are
the root and, for each known word, the history that ends with it.  A state
has an arc for every word seen after it; any other word takes the state's
failure arc to the root, which costs the backoff weight and consumes nothing,
and goes on from there.  A text is read once from left to right, carrying the
state and adding up log-probabilities; with histories of one word, the state
before each word is known from the word before it, so a chunk of texts is
traversed by array operations.

Counts are those of the whole corpus, exact and unpruned.  They are summed and
given back by the packed dictionary join, so a task only ever holds the part
of the automaton that its chunk of texts walks through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragstat.llm.packed import add_up, bucket_bits, count_requests, distinct_counts, packed_table, told, with_answers
from fragstat.llm.tokens import coded, flat, hashes, mixed, words

#: What the root takes from each word's count for words it has not seen.
DISCOUNT = 0.75
#: How many observations the root's opinion is worth in every other state.
PRIOR = 300.0
#: Text bytes of a chunk.
CHUNK_BYTES = 6 << 20

#: Stand-ins of the end of a text, and of the state before its first word.
_END, _START = np.uint64(0x656E64), np.uint64(0x7374617274)


def token_stream(docs: pa.Table, text_col: str):
    """(tokens, tokens before them, tokens per text) as 64-bit word hashes;
    every text ends with one end token."""
    tokens, counts = words(*flat(docs.column(text_col)))
    codes, distinct = coded(tokens)
    stream = hashes(distinct)[codes]
    ends = np.cumsum(counts)
    now = np.insert(stream, ends, _END)
    before = np.insert(stream, ends - counts, _START)
    return now, before, counts + 1


def pair_keys(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(0x9E3779B97F4A7C15) + now)


def root_probability(count: np.ndarray, total: int, distinct: int) -> np.ndarray:
    """Absolute discounting; what it frees goes to all words and one unknown
    word in equal parts.  Without training data every token is the unknown word."""
    if not total:
        return np.ones(len(count))
    return (np.maximum(count - DISCOUNT, 0) + DISCOUNT * distinct / (distinct + 1)) / total


def arc_weights(pair: np.ndarray, state: np.ndarray, root: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """log10 weights along a path: an arc of the state where the pair was seen,
    else its failure arc and the root's arc; an unknown word leaves the root's
    state, whose failure arc is free."""
    arc = np.log10((pair + prior * root) / (state + prior))
    failure = np.log10(prior / (state + prior))
    return np.where(pair > 0, arc, failure + np.log10(root))


def lm_scores(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
              prior: float = PRIOR) -> DataFrame:
    """``id_col, n_tokens, n_known, train_tokens, base_score, score`` for every
    row, learning from the rows for which ``learn`` is true.

    Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, and one end token
    closes each text, so null and empty texts have one token.  ``base_score``
    is the add-one unigram log10 probability, ``score`` the automaton's.
    Repeated rows count as often as they occur.  Where ``learn`` is null it
    counts as false.  Other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bits = bucket_bits(spark)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                       F.coalesce(learn, F.lit(False)).alias("_learn"))
    chunks = packed_table(rows, "_text", CHUNK_BYTES)

    def keys_of(texts: pa.Table):
        now, before, counts = token_stream(texts, "_text")
        weights = np.repeat(texts.column("_learn").to_numpy().astype(np.float64), counts)
        return [distinct_counts(now, weights), distinct_counts(pair_keys(before, now), weights)]

    answers = add_up(count_requests(chunks, keys_of, bits)).checkpoint()
    total, distinct = answers.where(F.col("bucket") < (1 << bits)).agg(
        F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()

    def score(texts: pa.Table, answer: pa.Table) -> pa.Table:
        now, before, counts = token_stream(texts, "_text")
        vocabulary, place = np.unique(now, return_inverse=True)
        known = told(answer, 0, bits)
        count = known[place]
        # The state before a word: its history's count; a text begins in a state seen once for each end.
        at = np.minimum(np.searchsorted(vocabulary, np.where(before == _START, _END, before)), len(vocabulary) - 1)
        _, pair_place = np.unique(pair_keys(before, now), return_inverse=True)
        pair = told(answer, 1, bits)[pair_place]
        arcs = arc_weights(pair, known[at], root_probability(count, total, distinct), prior)
        base = np.log10((count + 1) / (total + 1 * (distinct + 1)))
        firsts = np.cumsum(counts) - counts
        add = lambda x: np.add.reduceat(x.astype(np.longdouble), firsts).astype(np.float64)
        return pa.table({
            id_col: texts.column("_id"), "n_tokens": pa.array(counts, pa.int64()),
            "n_known": pa.array(np.add.reduceat(count > 0, firsts, dtype=np.int64), pa.int64()),
            "train_tokens": pa.array(np.full(len(counts), total), pa.int64()),
            "base_score": pa.array(add(base)), "score": pa.array(add(arcs))})

    schema = (T.StructType().add(id_col, docs.schema[id_col].dataType).add("n_tokens", T.LongType())
              .add("n_known", T.LongType()).add("train_tokens", T.LongType())
              .add("base_score", T.DoubleType()).add("score", T.DoubleType()))
    return with_answers(chunks, answers, score, schema)
