import random
import zlib

import numpy as np
import pytest

from fragstat.llm.periodic_runs import periodic_runs, squares
from fragstat.llm.queries import with_periodic_tails


def brute(words, min_length=6, min_exponent=4):
    """(runs, kept words) by looking at every period."""
    ids = {}
    code = np.array([ids.setdefault(w, len(ids)) for w in words], int)
    runs = []
    for q in range(1, len(code) // min_exponent + 1):
        same = np.concatenate(([0], (code[q:] == code[:-q]).astype(int), [0]))
        edges = np.flatnonzero(np.diff(same))
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            part = code[start:stop + q]
            if len(part) >= max(min_length, min_exponent * q) and not any(
                    (part[k:] == part[:-k]).all() for k in range(1, q)):
                runs.append((start, len(part), q))
    runs.sort(key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return runs, [w for i, w in enumerate(words) if i not in gone]


def texts(seed, rows=120):
    draw = random.Random(seed)
    result = []
    for _ in range(rows):
        letters = draw.choice(["ab", "abc", "abcdefghij"])
        some = lambda n: [draw.choice(letters) for _ in range(n)]
        words = some(draw.randint(0, 25))
        for _ in range(draw.randint(0, 4)):
            block = some(draw.randint(1, 9))
            words += (block * 9)[:draw.randint(1, 9 * len(block))] + some(draw.randint(0, 9))
        result.append(draw.choice([" ", "\n", " \t "]).join(words))
    return result


def check(docs_of, rows, **more):
    got = {r.doc_id: r for r in periodic_runs(docs_of(rows), **more).collect()}
    for i, text in enumerate(rows):
        runs, kept = brute((text or "").split(), *more.values())
        assert got[i].n_words == len((text or "").split())
        assert [tuple(r) for r in got[i].runs] == runs, text
        assert got[i].collapsed == " ".join(kept)


@pytest.mark.parametrize("seed", range(4))
def test_against_every_period(docs_of, seed):
    check(docs_of, texts(seed))


def test_other_exponents_and_lengths(docs_of):
    check(docs_of, texts(11), min_length=4, min_exponent=2)
    check(docs_of, texts(12), min_length=9, min_exponent=3)


def test_long_periods_and_nested_runs(docs_of):
    draw = random.Random(5)
    block = [f"w{draw.randint(0, 400)}" for _ in range(900)]
    inner = ["x"] * 7 + ["y", "z"] * 5
    rows = [" ".join(block * 4), " ".join((block * 5)[37:-11]), " ".join(block * 3), " ".join((block[:50] + inner) * 4),
            " ".join(inner + block + inner), "a " * 5, "a " * 6, "a b " * 3 + "a", "a b " * 4, None, "", " \n "]
    check(docs_of, rows)


def test_squares_have_the_smallest_period():
    draw = random.Random(2)
    for _ in range(200):
        words = [draw.choice("ab") for _ in range(draw.randint(0, 40))]
        for end, length, period in squares(list(map(ord, words)), 2, 2):
            part = words[end - length:end]
            periods = [p for p in range(1, length + 1) if part[p:] == part[:length - p]]
            assert periods[0] == period and length >= 2 * period


def test_a_slice_of_many_texts_and_hot_words(docs_of):
    rows = ["the same line again " * 6] * 300 + ["the " * 50_000] + ["the cat sat"] * 300
    got = {r.doc_id: r for r in periodic_runs(docs_of(rows)).collect()}
    assert [tuple(r) for r in got[0].runs] == [(0, 24, 4)] and got[299].collapsed == "the same line again"
    assert [tuple(r) for r in got[300].runs] == [(0, 50_000, 1)] and got[300].collapsed == "the"
    assert not got[301].runs


def test_awkward_rows_and_empty_table(awkward, nothing):
    rows = awkward.select("doc_id", "text").collect()
    got = sorted((repr(r.doc_id), r.n_words, r.collapsed) for r in periodic_runs(awkward).collect())
    want = sorted((repr(r.doc_id), len((r.text or "").split()), " ".join(brute((r.text or "").split())[1])) for r in rows
                  if len(r.text or "") < 10_000)
    assert [g for g in got if g[1] < 10_000] == want and len(got) == len(rows)
    assert periodic_runs(nothing).collect() == []


def test_periodic_tails(docs_of):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 40))) for i in range(300)] + [(None, "a b"), (400, None)]
    got = {r.doc_id: r.text for r in with_periodic_tails(docs_of(rows)).collect()}
    changed = 0
    for i, text in rows[:300]:
        h = zlib.crc32(str(i).encode())
        words, g = text.split(), h // 10
        if h % 10 == 0 and words:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            changed += 1
        assert got[i].split() == words
    assert changed > 10 and got[None] == "a b" and got[400] is None
