import math
import random
import re
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fragstat.llm.toxicity import (BACKOFF, DISCOUNT, MIN_RATIO, MIN_TEXTS, PAD, _known, _labelled, count_expressions,
                                   expression_key, fit, logistic, with_scores)


def corpus(n, seed=1):
    draw = random.Random(seed)
    stems = ["".join(draw.choices("abcdefghi", k=draw.randint(2, 6))) for _ in range(3000)]
    bad = ["grmpf", "blarg", "zonk", "fnord"]
    rows = []
    for i in range(n):
        words = [draw.choice(stems) for _ in range(draw.randint(30, 300))]
        toxic = int(draw.random() < 0.2)
        if toxic:
            for _ in range(2 + len(words) // 40):
                words.insert(draw.randrange(len(words)), draw.choice(bad) + draw.choice(["", ".", "!"]))
        rows.append((i, " ".join(words).capitalize(), toxic))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    rows = corpus(1200)
    return (spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4).checkpoint(),
            spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int").checkpoint())


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    model = fit(docs, labels, F.col("doc_id") % 5 != 0)
    rows = with_scores(docs, model).join(labels, "doc_id").where("doc_id % 5 = 0").collect()
    right = [(r.toxicity >= 0.5) == bool(r.toxic) for r in rows]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= r.toxicity <= 1 for r in rows)


def test_held_out_labels_do_not_matter(spark, labelled):
    docs, labels = labelled
    learn = F.col("doc_id") % 5 != 0
    flipped = labels.withColumn("toxic", F.when(learn, F.col("toxic")).otherwise(1 - F.col("toxic")))
    one, two = (fit(docs, x, learn) for x in (labels, flipped))
    assert np.array_equal(one.keys, two.keys) and np.array_equal(one.values, two.values)
    assert (one.slope, one.intercept) == (two.slope, two.intercept)


def test_counts_are_texts_not_occurrences():
    batch = pa.RecordBatch.from_arrays([pa.array(["a b a b", "a", "b a"]), pa.array([1, 0, 0], pa.int32())], ["text", "toxic"])
    table = next(count_expressions(iter([batch])))
    from fragstat.llm.tokens import hashes
    a, b = (int(h) for h in hashes(pa.array([b"a", b"b"])).view(np.int64))
    got = {(r["v"], r["w"]): (r["ordinary"], r["toxic"]) for r in table.to_pylist()}
    assert got[0, a] == (2, 1) and got[0, b] == (1, 1)
    assert got[a, b] == (0, 1) and got[b, a] == (1, 1)


def test_only_telling_expressions_are_kept(labelled):
    docs, labels = labelled
    model = fit(docs, labels, F.lit(True))
    from fragstat.llm.tokens import hashes
    words = hashes(pa.array([b"grmpf", b"blarg", b"zonk", b"fnord"]))
    assert set(expression_key(np.zeros(4, np.uint64), words).tolist()) <= set(model.keys.tolist())
    assert len(model.keys) < 60 and (model.values > 0).sum() >= 4


class BruteModel:
    """The class models by their definition, word by word in dictionaries."""

    def __init__(self, rows):
        self.n = [{}, {}]  # expressions (one word or two) to texts that hold them
        texts = [0, 0]
        for text, toxic in rows:
            words = re.findall(r"[a-z0-9]+", text.lower())
            texts[toxic] += 1
            for e in {(w,) for w in words} | set(zip(["<s>", *words], words)):
                self.n[toxic][e] = self.n[toxic].get(e, 0) + 1
        every = set(self.n[0]) | set(self.n[1])
        self.own = {e for e in every if self.tells(self.n[1].get(e, 0), self.n[0].get(e, 0), texts[1], texts[0])}
        self.pairs = [e for e in every if len(e) == 2]
        self.vocabulary = sorted({e[0] for e in every if len(e) == 1}) + ["?unknown"]

    @staticmethod
    def tells(a, b, n, m):
        def term(seen, expected):
            return seen * math.log(seen / expected) if seen else 0.0
        p = (a + b) / (n + m)
        ratio = 2 * (term(a, n * p) + term(b, m * p) + term(n - a, n * (1 - p)) + term(m - b, m * (1 - p)))
        return a + b >= MIN_TEXTS and ratio >= MIN_RATIO

    def shared(self, w):
        kinds = 1 if w == "?unknown" else sum(e[1] == w for e in self.pairs)
        return kinds / (len(self.pairs) + 1)

    def mixture(self, counts, own, lower, w):
        """Own words by discounted counts, the others' mass as ``lower`` has them, and what is freed for all."""
        total = sum(counts.values())
        freed = sum(min(counts.get(x, 0), DISCOUNT) for x in own) + BACKOFF
        p = freed * lower(w)
        if w in own:
            p += max(counts.get(w, 0) - DISCOUNT, 0)
        else:
            others = total - sum(counts.get(x, 0) for x in own)
            p += others * lower(w) / (1 - sum(lower(x) for x in own))
        return p / (total + BACKOFF)

    @cache
    def word(self, c, w):
        counts = {e[0]: n for e, n in self.n[c].items() if len(e) == 1}
        return self.mixture(counts, {e[0] for e in self.own if len(e) == 1}, self.shared, w)

    @cache
    def after(self, c, v, w):
        own = {e[1] for e in self.own if len(e) == 2 and e[0] == v}
        if not own:
            return self.word(c, w)
        counts = {e[1]: n for e, n in self.n[c].items() if len(e) == 2 and e[0] == v}
        return self.mixture(counts, own, lambda x: self.word(c, x), w)

    def evidence(self, text):
        words = re.findall(r"[a-z0-9]+", text.lower())
        known = [w if w in self.vocabulary else "?unknown" for w in words]
        total = sum(math.log(self.after(1, v, w) / self.after(0, v, w)) for v, w in zip(["<s>", *known], known))
        return total / (len(words) + PAD)


def test_against_brute_force(spark):
    draw = random.Random(4)
    stems = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(400):
        words = [draw.choice(stems) for _ in range(draw.randint(5, 40))]
        toxic = int(draw.random() < 0.3)
        for _ in range(2 * toxic):
            at = draw.randrange(len(words))
            words[at:at] = draw.choice([["zonk", "blarg"], ["zonk", "w3"], ["w1", "w2"], ["grmpf"]])
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = fit(docs, labels, F.lit(True))
    sample = _labelled(docs, _known(labels, F.lit(True), "doc_id", "toxic"), "doc_id", "text", 10_000)
    brute = BruteModel([(r.text, r.toxic) for r in sample.where("NOT held").collect()])
    assert {len(e) for e in brute.own} == {1, 2}
    for c in (0, 1):
        for v in ("<s>", "zonk", "w1", "w5", "grmpf"):
            assert abs(sum(brute.after(c, v, w) for w in brute.vocabulary) - 1) < 1e-9
    texts = [r[1] for r in rows[:60]] + ["", "zonk", "unheard of words", "zonk unheard zonk blarg", "W1 w2 ZONK! w3"]
    got = model.evidence(pa.array(texts))
    assert np.allclose(got, [brute.evidence(t) for t in texts], rtol=1e-9, atol=1e-12)


def test_one_class_no_labels_and_conflicts(spark, labelled):
    docs, labels = labelled
    none = labels.where("false")
    only = labels.withColumn("toxic", F.lit(0))
    odd = labels.limit(0).unionByName(spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, toxic int"))
    for some in (none, only, odd):
        model = fit(docs, some, F.lit(True))
        assert {round(r.toxicity, 9) for r in with_scores(docs.limit(5), model).collect()} == {round(1 / (1 + np.e), 9)}


def test_awkward_rows_and_empty_table(labelled, awkward, nothing):
    model = fit(*labelled, F.lit(True))
    out = with_scores(awkward, model)
    assert out.columns == [*awkward.columns, "toxicity"] and out.count() == awkward.count()
    empty = {r.toxicity for r in out.collect() if not (r.text or "").strip()}
    assert len(empty) == 1 and 0 <= empty.pop() < 0.5
    assert with_scores(nothing, model).collect() == []


def test_logistic():
    x = np.concatenate((np.zeros(50), np.ones(50)))
    slope, intercept = logistic(x, (x > 0).astype(int))
    assert slope > 0 > intercept and abs(-intercept / slope - 0.5) < 0.05
    assert logistic(np.zeros(0), np.zeros(0)) == (1.0, -1.0)


def test_weights_of_the_curve_stand_for_rows():
    x = np.array([0.0, 1, 2, 3, 1, 2])
    y, times = np.array([0, 0, 0, 1, 1, 1]), np.array([5, 3, 2, 1, 2, 4])
    assert np.allclose(logistic(x, y, weights=times.astype(float)), logistic(np.repeat(x, times), np.repeat(y, times)))


def test_scores_agree_below_and_above_the_cap(spark, labelled):
    docs, labels = labelled
    # Labels that no word tells: a score is the share of toxic rows, however many rows the sample holds.
    chance = labels.withColumn("toxic", (F.pmod(F.xxhash64("doc_id"), F.lit(100)) < 12).cast("int"))
    share = chance.agg(F.avg("toxic")).first()[0]
    for max_rows in (10_000, 100):
        scores = [r.toxicity for r in with_scores(docs, fit(docs, chance, F.lit(True), max_rows=max_rows)).collect()]
        assert abs(np.median(scores) - share) < 0.06, max_rows
    # Labels that words tell: the decisions agree.
    whole, capped = (
        {r.doc_id: r.toxicity >= 0.5 for r in with_scores(docs, fit(docs, labels, F.lit(True), max_rows=m)).collect()}
        for m in (10_000, 150))
    assert sum(whole[i] == capped[i] for i in whole) / len(whole) > 0.97
