import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from fragstat.llm.lm_scoring import DISCOUNT, arc_weights, lm_scores, root_probability

SF = "/root/testdata/sf0.001"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [" end"]


def brute(rows, prior):
    """Walks the automaton token by token; rows are (id, text, learn)."""
    count, pair = Counter(), Counter()
    for _, text, learn in rows:
        if learn:
            seen = tokens(text)
            count.update(seen)
            pair.update(zip([" end"] + seen, seen))  # the state before a text was entered once for each end
    total, kinds = sum(count.values()), len(count)
    out = []
    for i, text, _ in rows:
        state, score, base = " end", 0.0, 0.0
        for w in tokens(text):
            root = (max(count[w] - DISCOUNT, 0) + DISCOUNT * kinds / (kinds + 1)) / total if total else 1
            if pair[state, w]:
                score += math.log10((pair[state, w] + prior * root) / (count[state] + prior))
            else:  # the failure arc, then the root's arc
                score += math.log10(prior / (count[state] + prior)) + math.log10(root)
            base += math.log10((count[w] + 1) / (total + kinds + 1))
            state = w
        out.append((i, len(tokens(text)), sum(count[w] > 0 for w in tokens(text)), total, round(base, 6), round(score, 6)))
    return sorted(out, key=repr)


def scored(docs, learn, prior):
    rows = lm_scores(docs, learn, prior=prior).collect()
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in rows), key=repr)


def test_against_brute_force(spark):
    texts = ["a b a b c", "A  B\nc", "b a", "", None, "x y z", "c c c c", "end start", "é É a b"] * 3
    rows = [(i, t, i % 4 != 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    for prior in (0.5, 300.0):
        assert scored(docs, F.col("doc_id") % 4 != 1, prior) == brute(rows, prior)


def test_real_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.doc_id % 3 != 0) for r in docs.collect()]
    got, want = scored(docs, F.col("doc_id") % 3 != 0, 300.0), brute(rows, 300.0)
    assert got == want
    held = [r for r in got if r[0] % 3 == 0]
    assert sum(r[5] for r in held) > sum(r[4] for r in held)  # better than add-one on unseen texts


def test_every_state_is_a_distribution():
    count = np.array([5, 3, 1, 1, 0])  # four known words and the unknown one
    root = root_probability(count, 10, 4)
    assert math.isclose(root.sum(), 1)
    pairs = np.array([3, 0, 2, 0, 0])
    weights = arc_weights(pairs, np.full(5, 5), root)
    assert math.isclose((10 ** weights).sum(), 1)


def test_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    assert scored(docs, F.lit(False), 300.0) == brute([(1, "a b", False), (None, None, False)], 300.0)


def test_awkward_rows_and_empty_table(awkward, nothing):
    rows = [(r.doc_id, r.text, r.doc_id is not None and r.doc_id < 100) for r in awkward.collect()]
    assert scored(awkward, F.col("doc_id") < 100, 300.0) == brute(rows, 300.0)
    assert lm_scores(nothing, F.lit(True)).collect() == []
