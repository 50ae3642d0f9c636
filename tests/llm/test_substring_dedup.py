import random
from collections import defaultdict

import numpy as np
import pytest

from fragstat.llm import substring_dedup
from fragstat.llm.recompression import Checks, climb, spell
from fragstat.llm.substring_dedup import WINDOW, remove_repeated_passages
from fragstat.llm.tokens import mixed

WORDS = [f"w{i}" for i in range(300)]


def brute(rows):
    """(n_words, n_removed, kept) of each (doc_id, text)."""
    split = [(d, (t or "").split()) for d, t in rows]
    least = defaultdict(lambda: float("inf"))
    for d, words in split:
        for i in range(len(words) - WINDOW + 1):
            if d is not None:
                least[tuple(words[i:i + WINDOW])] = min(least[tuple(words[i:i + WINDOW])], d)
    out = []
    for d, words in split:
        gone = np.zeros(len(words), bool)
        for i in range(len(words) - WINDOW + 1):
            if d is not None and least[tuple(words[i:i + WINDOW])] < d:
                gone[i:i + WINDOW] = True
        out.append((len(words), int(gone.sum()), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def check(docs_of, rows, partitions=3):
    got = {r.doc_id: r for r in remove_repeated_passages(docs_of(rows, partitions)).collect()}
    for (d, _), want in zip(rows, brute(rows)):
        assert (got[d].n_words, got[d].n_removed, got[d].kept) == want, d


def corpus(seed):
    draw = random.Random(seed)
    prose = lambda n: draw.choices(WORDS, k=n)
    passages = [prose(n) for n in (49, 50, 51, 70, 200, 900)] + [["x"] * 120, ["a", "b"] * 60, prose(7) * 20]
    rows = [None, "", "x", " ".join(prose(49)), "y " * 400, "y " * 50]
    for _ in range(60):
        words = prose(draw.randint(0, 60))
        for _ in range(draw.randint(0, 3)):
            passage = draw.choice(passages)
            a = draw.randint(0, len(passage) // 3)
            words += passage[a:len(passage) - draw.randint(0, len(passage) // 3)] + prose(draw.randint(0, 40))
        rows.append(draw.choice([" ", "\n", "\t "]).join(words))
    near = prose(400)
    for _ in range(15):  # near copies, edits anywhere
        words = list(near)
        for _ in range(draw.randint(0, 6)):
            words[draw.randrange(len(words))] = draw.choice(WORDS)
        rows.append(" ".join(words))
    rows += [" ".join(near)] * 5 + [" ".join(prose(60)) * 2]
    ids = draw.sample(range(-1000, 1000), len(rows))
    return list(zip(ids, rows))


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(docs_of, seed):
    check(docs_of, corpus(seed))


def test_chunks_smaller_than_a_text(docs_of, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 500)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 2000)
    check(docs_of, corpus(7), partitions=5)


def test_case_and_first_document(docs_of):
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(5, passage), (3, "A " + passage + " z"), (9, passage.upper()), (4, passage + "\n" + passage), (6, "q " + passage)]
    got = {r.doc_id: (r.n_removed, r.kept) for r in remove_repeated_passages(docs_of(rows)).collect()}
    assert got == {5: (50, ""), 3: (0, f"A {passage} z"), 9: (0, passage.upper()), 4: (100, ""), 6: (50, "q")}


def test_many_copies_of_one_text(docs_of):
    draw = random.Random(8)
    copy = " ".join(draw.choices(WORDS, k=500))
    rows = [(i, copy + f" end{i % 3}") for i in range(2000)] + [(5000, " ".join(draw.choices(WORDS, k=500)))]
    got = {r.doc_id: r.n_removed for r in remove_repeated_passages(docs_of(rows, 6)).collect()}
    assert got[0] == 0 and got[5000] == 0 and got[1] == got[2] == 500
    assert all(got[i] == 501 for i in range(3, 2000))


def _names(s):
    return {(int(a), int(b)): int(n) for a, b, n in zip(s.start, s.end, s.name)}


def test_equal_contexts_give_equal_symbols():
    draw = random.Random(3)
    for _ in range(30):
        inner = [draw.randrange(40) if draw.random() < 0.9 else 7 for _ in range(80)]
        rows = [[draw.randrange(40) for _ in range(draw.randint(0, 30))] + inner +
                [draw.randrange(40) for _ in range(draw.randint(0, 30))] for _ in range(2)]
        found = []
        for row in rows:
            at = next(i for i in range(len(row)) if row[i:i + 80] == inner)
            s = climb(spell(mixed(np.array(row, np.uint64)), np.zeros(len(row), int)), 6)
            inside = s.take(np.flatnonzero((s.left >= at) & (s.right <= at + 80)))
            found.append({(a - at, b - at): n for (a, b), n in _names(inside).items()})
        assert found[0] == found[1] and found[0]


def test_a_name_stands_for_its_words():
    draw = random.Random(4)
    words = np.array([draw.randrange(5) for _ in range(5000)], np.uint64)
    rows = np.repeat(np.arange(50), 100)
    s = spell(mixed(words), rows)
    checks = Checks(mixed(words))
    meaning = {}
    for steps in range(8):
        s = climb(s, 1, steps)
        assert (s.row == rows[s.start]).all() and (s.row == rows[s.end - 1]).all()
        assert s.start[0] == 0 and (s.start[1:] == s.end[:-1]).all() and s.end[-1] == 5000
        assert (s.left <= s.start).all() and (s.right >= s.end).all()
        for a, b, n, c in zip(s.start, s.end, s.name, checks.of(s.start, s.end)):
            assert meaning.setdefault((int(n), int(c)), tuple(words[a:b])) == tuple(words[a:b])


def test_recut_chunks_are_noticed():
    import pyarrow as pa
    answers = pa.table({"chunk": pa.array([0], pa.int64()), "kind": pa.array([0], pa.int32()),
                        "bucket": pa.array([0], pa.int32()),
                        "bits": pa.array([substring_dedup._counted_bits(np.ones(3, bool))])})
    assert substring_dedup._told(answers, 0, np.arange(3, dtype=np.uint64)).all()
    with pytest.raises(RuntimeError):
        substring_dedup._told(answers, 0, np.arange(4, dtype=np.uint64))


def test_awkward_rows_and_empty_table(awkward, nothing, spark):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    got = sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept) for r in remove_repeated_passages(awkward).collect())
    assert got == sorted((repr(d), *w) for (d, _), w in zip(rows, brute(rows)))
    assert remove_repeated_passages(nothing).collect() == []
    passage = " ".join(f"p{i}" for i in range(60))
    nulls = spark.createDataFrame([(None, passage), (7, passage), (7, passage), (9, passage)], "doc_id int, text string")
    assert sorted((repr(r.doc_id), r.n_removed) for r in remove_repeated_passages(nulls).collect()) == [
        ("7", 0), ("7", 0), ("9", 60), ("None", 0)]
    with pytest.raises(TypeError):
        remove_repeated_passages(nulls.withColumn("doc_id", nulls.doc_id.cast("string")))
