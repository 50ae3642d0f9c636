"""Toxicity by class-conditional Kneser-Ney models.

For each class, toxic and ordinary, a Kneser-Ney bigram model is fitted that
counts, for each expression (a word, or a word after another), the distinct
labelled texts that hold it.  An expression that the classes use differently
(a likelihood-ratio test decides) has discounted counts of its own in each
class.  All others share what is left of the class's mass as the order below
has them: pairs as the words of that class, words as the continuation counts
of both classes together, which also keep a share for unknown words.  So each
class's probabilities add up to one after every word, a rare expression has
the shared probability in both, and every token of a text counts.  A text's
evidence is the difference of its two log-likelihoods over its length; a
logistic curve, fitted on labelled rows that the models have not seen, turns
it into a score.

The fit reads a bounded sample of labelled rows (``MAX_ROWS`` of each class).
The curve weighs the rows of each class by how many labelled rows they stand
for, so a score of one half means the same below and above that bound.
Scoring is one narrow pass over all whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragstat.llm.tokens import NO_LETTER, coded, flat, hashes, mixed, segments, words

#: Bound of the fit: labelled rows of each class, those with the smallest id hashes.
MAX_ROWS = 10_000
#: What a count loses to the order below, and what that has beside it.
DISCOUNT, BACKOFF = 0.02, 5
#: An expression keeps its counts from this likelihood-ratio statistic on, and this many texts.
MIN_RATIO, MIN_TEXTS = 12.0, 3
#: Added to a text's length, so that a single word says little about a short text.
PAD = 10

#: Texts that a task looks at together.
SLICE = 500

COUNTS = "v long, w long, ordinary long, toxic long"
_START = np.uint64(0x5EED)


def _tokens(texts: pa.Array):
    """(codes, words per text, 64-bit hashes of the distinct words, by code)."""
    data, offsets = flat(pc.utf8_lower(texts.cast(pa.large_string())))
    tokens, counts = words(data, offsets, NO_LETTER)
    codes, distinct = coded(tokens)
    return codes, counts, hashes(distinct)


def _before(codes: np.ndarray, counts: np.ndarray, start: int) -> np.ndarray:
    """The code before each word, ``start`` for the first one of a text."""
    previous = np.concatenate(([start], codes[:-1])) if len(codes) else codes
    firsts = (np.cumsum(counts) - counts)[counts > 0]
    previous[firsts] = start
    return previous


def count_expressions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(``text, toxic``) rows to the number of texts of each class that hold
    each word (``v`` is 0) and each pair of words (``v`` before ``w``)."""
    for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        codes, counts, keys = _tokens(batch.column("text"))
        size, text = len(keys) + 1, segments(counts)
        keys = np.append(keys, _START)
        pairs = _before(codes, counts, size - 1) * size + codes
        kinds, pair = np.unique(pairs, return_inverse=True)
        rows = []
        for items, number, v, w in ((codes, size, np.zeros(size, np.uint64), keys),
                                    (pair, len(kinds), keys[kinds // size], keys[kinds % size])):
            held = np.unique(text * np.int64(max(number, 1)) + items)  # once for each text
            item, label = held % max(number, 1), toxic[held // max(number, 1)]
            n = np.bincount(item, minlength=number), np.bincount(item, label, number).astype(np.int64)
            some = n[0] > 0
            rows.append((v[some].view(np.int64), w[some].view(np.int64), (n[0] - n[1])[some], n[1][some]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)],
                                         ["v", "w", "ordinary", "toxic"])


@dataclass
class ToxicityModel:
    """Sorted expression keys with the evidence of each, and the logistic curve.

    ``(0, w)`` is a word, ``(v, w)`` a word after another, ``(v, 0)`` what any
    other word after ``v`` adds to its own evidence, ``rest`` the evidence of a
    word without counts of its own.
    """
    keys: np.ndarray
    values: np.ndarray
    slope: float
    intercept: float
    rest: float = 0.0

    def _of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), np.nan)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], np.nan)

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Toxic less ordinary log-likelihood over the length of each text."""
        codes, counts, hashed = _tokens(texts)
        none = np.zeros(len(hashed) + 1, np.uint64)
        word = self._of(expression_key(none[:-1], hashed))
        alone = np.where(np.isnan(word), self.rest, word)
        hashed = np.append(hashed, _START)
        back = np.nan_to_num(self._of(expression_key(hashed, none)))
        before = _before(codes, counts, len(hashed) - 1)
        pair = self._of(expression_key(hashed[before], hashed[codes]))
        each = np.where(np.isnan(pair), back[before] + alone[codes], pair)
        total = np.bincount(segments(counts), each, len(counts))
        return total / (counts + PAD)

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.evidence(texts) + self.intercept, -30, 30)))


def expression_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mixed(v * np.uint64(0x9DDFEA08EB382D69) + w)


def _ratio(a: Column, b: Column, n: Column, m: Column) -> Column:
    """Likelihood-ratio statistic of a of n against b of m."""
    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))
    share = (a + b) / (n + m)
    return 2 * (term(a, n * share) + term(b, m * share)
                + term(n - a, n * (1 - share)) + term(m - b, m * (1 - share)))


def _known(labels: DataFrame, learn: Column, id_col: str, label_col: str) -> DataFrame:
    """``_id, _toxic``: each labelled id once."""
    return (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & learn)
        .groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("_toxic"))
    )


def _labelled(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, max_rows: int) -> DataFrame:
    """``text, toxic, held``: the sample, each distinct text once."""
    sample = None
    for label in (0, 1):
        part = known.where(F.col("_toxic") == label).orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
        sample = part if sample is None else sample.unionByName(part)
    return (
        docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .join(F.broadcast(sample), "_id")
        .groupBy("text").agg(F.max("_toxic").alias("toxic"),
                             F.min(F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(4)) == 0).alias("held"))
    )


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_rows: int = MAX_ROWS) -> ToxicityModel:
    """The models and the curve, from labelled rows of ``docs`` for which
    ``learn`` (over the columns of ``labels``) holds.  A quarter of the sample
    is kept for the curve.  Without rows of both classes all scores are equal
    and below one half.
    """
    known = _known(labels, learn, id_col, label_col)
    sample = _labelled(docs, known, id_col, text_col, max_rows).checkpoint()
    seen = {r.toxic: r.n for r in sample.where("NOT held").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    ordinary, toxic = seen.get(0, 0), seen.get(1, 0)
    if not ordinary or not toxic:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 1.0, -1.0)
    counts = (
        sample.where("NOT held").select("text", "toxic").mapInArrow(count_expressions, COUNTS)
        .groupBy("v", "w").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
        .withColumn("own", (F.col("ordinary") + F.col("toxic") >= MIN_TEXTS) & (
            _ratio(F.col("toxic"), F.col("ordinary"), F.lit(float(toxic)), F.lit(float(ordinary))) >= MIN_RATIO))
    ).checkpoint()
    alone, pairs = counts.where("v = 0"), counts.where("v != 0")
    totals = alone.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("ordinary", "toxic"))).first()
    # Shared lowest order: how many different words come before w, in either class.
    before = pairs.groupBy("w").agg(F.count("*").alias("before"))
    lower = alone.select("w", F.col("ordinary").alias("w0"), F.col("toxic").alias("w1"), F.col("own").alias("w_own"))
    history = pairs.groupBy("v").agg(
        F.sum("ordinary").alias("v0"), F.sum("toxic").alias("v1"), F.bool_or("own").alias("v_own")).where("v_own")
    table = (
        counts.where("own").join(before, "w").join(lower, "w").join(history, "v", "left")
        .select("v", "w", "ordinary", "toxic", "before", "w0", "w1", "w_own",
                *(F.coalesce(c, F.lit(0)).alias(c) for c in ("v0", "v1")))
        .toPandas()
    )
    keys, values, rest = evidence_table({c: table[c].to_numpy() for c in table.columns}, totals, pairs.count())
    model = ToxicityModel(keys, values, 1.0, 0.0, rest)
    held = with_scores(sample.where("held"), model, raw=True).select("_evidence", "toxic").toPandas()
    rows = {r["_toxic"]: r.n for r in known.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    stands_for = np.array([max(rows.get(label, 0) / max_rows, 1.0) for label in (0, 1)])
    toxic = held["toxic"].to_numpy()
    model.slope, model.intercept = logistic(held["_evidence"].to_numpy(), toxic, weights=stands_for[toxic.astype(int)])
    return model


def evidence_table(column: dict[str, np.ndarray], totals: tuple[int, int], kinds: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(keys, values, rest) of :class:`ToxicityModel`.

    ``column`` has a row for each expression with counts of its own: ``v, w,
    ordinary, toxic``, of its word ``before, w0, w1, w_own``, of the word before
    all its pairs ``v0, v1``.  ``totals`` are the counts of all words of each
    class, ``kinds`` that of all different pairs.
    """
    word = column["v"] == 0
    shared = column["before"] / (kinds + 1)  # the one more is for unknown words
    outside = 1 - shared[word].sum()
    history, first, at = np.unique(column["v"][~word], return_index=True, return_inverse=True)
    logs = []
    for n, low, past, total in (("ordinary", "w0", "v0", totals[0]), ("toxic", "w1", "v1", totals[1])):
        n, low = column[n], column[low]
        freed = np.minimum(n[word], DISCOUNT).sum() + BACKOFF
        rest = ((total - n[word].sum()) / outside + freed) / (total + BACKOFF)
        p = np.where(column["w_own"].astype(bool),
                     (np.maximum(low - DISCOUNT, 0) + freed * shared) / (total + BACKOFF), rest * shared)
        own, p_own, past = n[~word], p[~word], column[past][~word][first]
        taken, freed = np.bincount(at, own), np.bincount(at, np.minimum(own, DISCOUNT)) + BACKOFF
        free = np.maximum(1 - np.bincount(at, p_own), 1e-12)
        pair = (np.maximum(own - DISCOUNT, 0) + freed[at] * p_own) / (past[at] + BACKOFF)
        back = ((past - taken) / free + freed) / (past + BACKOFF)
        logs.append(np.log(np.concatenate((p[word], pair, back, [rest]))))
    values = logs[1] - logs[0]
    v = np.concatenate((column["v"][word], column["v"][~word], history)).astype(np.int64).view(np.uint64)
    w = np.concatenate((column["w"][word], column["w"][~word], np.zeros_like(history))).astype(np.int64).view(np.uint64)
    keys = expression_key(v, w)
    order = np.argsort(keys)
    return keys[order], values[:-1][order], float(values[-1])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, weights: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and intercept of a logistic curve (Newton steps)."""
    if not len(y) or y.min() == y.max():
        return 1.0, -1.0
    weights = np.ones(len(y)) if weights is None else weights
    weights = weights / weights.sum()
    mean = weights @ x
    scale = max(float(np.sqrt(weights @ (x - mean) ** 2)), 1e-9)
    z = np.stack([x / scale, np.ones(len(x))], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        gradient = z.T @ (weights * (y - p)) - ridge * beta
        curve = (z * (weights * p * (1 - p))[:, None]).T @ z + ridge * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def with_scores(docs: DataFrame, model: ToxicityModel, text_col: str = "text", raw: bool = False) -> DataFrame:
    """``docs`` with ``toxicity``, 0 to 1 (``raw``: with ``_evidence``).

    Null, empty and wordless texts have evidence 0.  Rows and other columns
    stay as they are; a column of the new name is replaced.
    """
    name = "_evidence" if raw else "toxicity"
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                part = batch.slice(begin, SLICE)
                texts = pc.fill_null(part.column(text_col), "")
                values = shared.value.evidence(texts) if raw else shared.value.scores(texts)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values)], [*part.schema.names, name])
    return docs.mapInArrow(score, T.StructType(list(docs.schema)).add(name, T.DoubleType()))
