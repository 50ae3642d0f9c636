import random

import numpy as np
import pyarrow as pa
import pytest
from llm.brute import components

from fragstat.llm.components import connected_components
from fragstat.llm.packed import (add_up, bucket_bits, count_requests, distinct_counts, from_payload, pack, packed_table,
                                 squeeze, squeeze_sorted, told, unsqueeze, unsqueeze_sorted, with_answers)
from fragstat.llm.tokens import flat, hashes, ngrams, words


def roots(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long").repartition(4)
    return {r.node: r.root for r in connected_components(df).collect()}


def test_components_of_random_graphs(spark):
    draw = random.Random(1)
    pairs = [(draw.randrange(200), draw.randrange(200)) for _ in range(130)]
    want = components(200, pairs)
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    assert roots(spark, pairs + [(None, 3), (4, None), (5, 5)]) == {i: want[i] for i in linked}


def test_components_of_a_path_and_a_star(spark):
    assert set(roots(spark, [(i, i + 1) for i in range(150)]).values()) == {0}
    assert set(roots(spark, [(500, i) for i in range(150)]).values()) == {0}
    assert roots(spark, []) == {}


def test_packed_arrays_round_trip():
    draw = np.random.default_rng(2)
    keys = np.unique(draw.integers(0, 2**64, 1000, dtype=np.uint64))
    assert np.array_equal(unsqueeze_sorted(squeeze_sorted(keys)), keys)
    for kind in (np.int16, np.uint32, np.int64):
        values = draw.integers(0, 100, 77).astype(kind)
        assert np.array_equal(unsqueeze(squeeze(values), kind), values)
    assert len(unsqueeze(squeeze(np.zeros(0, np.int64)), np.int64)) == 0


def test_packed_counts_are_the_corpus_counts(spark, docs_of):
    draw = random.Random(4)
    texts = [" ".join(draw.choices("abcdefgh", k=draw.randint(0, 30))) for _ in range(200)]
    docs = docs_of(texts)
    chunks = packed_table(docs, "text", chunk_bytes=400)
    assert chunks.count() > 10
    bits = bucket_bits(spark)

    def hash_of(word):
        return int.from_bytes(word.ljust(8, b"\x00"), "big") * 0x9E3779B97F4A7C15 % 2**64

    def keys_of(table):
        tokens, _ = words(*flat(table.column("text")))
        keys = np.array([hash_of(t) for t in tokens.to_pylist()], np.uint64)
        return [distinct_counts(keys)]

    def answer_of(table, answer):
        tokens, counts = words(*flat(table.column("text")))
        keys = np.array([hash_of(t) for t in tokens.to_pylist()], np.uint64)
        sums = told(answer, 0, bits)[np.unique(keys, return_inverse=True)[1]] if len(keys) else keys.astype(np.int64)
        ends = np.cumsum(counts)
        return pa.table({"doc_id": table.column("doc_id"), "sums": pa.array(
            [sums[e - c:e].tolist() for e, c in zip(ends, counts)], pa.list_(pa.int64()))})

    out = with_answers(chunks, add_up(count_requests(chunks, keys_of, bits)), answer_of, "doc_id long, sums array<long>")
    total = {c: sum(t.split().count(c) for t in texts) for c in "abcdefgh"}
    got = {r.doc_id: r.sums for r in out.collect()}
    assert got == {i: [total[w] for w in t.split()] for i, t in enumerate(texts)}
    assert sorted(d for p in chunks.collect() for d in from_payload(p.payload).column("doc_id").to_pylist()) == list(range(200))


def test_words_and_ngrams_follow_text_borders():
    texts = pa.array(["A b", "", None, "\x0bÉc \td\x1ce", "f g"])
    tokens, counts = words(*flat(texts))
    assert [t.decode() for t in tokens.to_pylist()] == ["a", "b", "Éc", "d\x1ce", "f g"]
    assert counts.tolist() == [2, 0, 0, 2, 1]
    ids = np.arange(1, 10, dtype=np.uint64)
    grams, sizes = ngrams(ids, np.array([5, 0, 3, 1]), 3)
    assert sizes.tolist() == [3, 0, 1, 1] and len(set(grams.tolist())) == 5
    again, _ = ngrams(ids[1:4], np.array([3]), 3)
    assert again[0] == grams[1]


def test_answers_for_chunks_that_came_out_otherwise_fail(docs_of):
    def told_about(texts):
        return pack(docs_of(texts, 1))

    def keys_of(docs):
        return [distinct_counts(hashes(docs.column("text").combine_chunks()))]

    def size(docs, answers):
        return pa.table({"n": pa.array([docs.num_rows], pa.int64())})

    asked = add_up(count_requests(told_about(["a", "b"]), keys_of, 2))
    assert with_answers(told_about(["a", "b"]), asked, size, "n long").collect() == [(2,)]
    with pytest.raises(Exception, match="other chunks"):
        with_answers(told_about(["a", "c"]), asked, size, "n long").collect()
