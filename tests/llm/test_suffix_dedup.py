import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from fragstat.llm.suffix_dedup import LENGTH, anchors, intervals, maximal_repeats, repeated_spans
from fragstat.llm.tokens import flat


def brute(texts):
    places = defaultdict(list)
    texts = [(t or "").encode() for t in texts]
    for i, t in enumerate(texts):
        for p in range(len(t) - LENGTH + 1):
            places[t[p:p + LENGTH]].append((i, p))
    gone = [np.zeros(len(t), bool) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for i, p in found:
                gone[i][p:p + LENGTH] = True
    out = []
    for t, g in zip(texts, gone):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], g.astype(int), [0]))))
        out.append((len(t), [tuple(e) for e in edges.reshape(-1, 2).tolist()], bytes(np.frombuffer(t, np.uint8)[~g])))
    return out


def check(docs_of, texts, **more):
    got = {r.doc_id: r for r in repeated_spans(docs_of(texts), **more).collect()}
    for i, want in enumerate(brute(texts)):
        r = got[i]
        assert (r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) == want, i


def texts(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefé", k=draw.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, line, near = prose(70), prose(20), prose(200)
    rows = ["", None, "x", "a" * 199, "b" * 200, "c" * 201, "ab" * 700, prose(300)]
    rows += [prose(draw.randint(0, 50)) + passage[draw.randint(0, 40):] + prose(draw.randint(0, 50)) for _ in range(12)]
    rows += [prose(30) + "\n" + line + "\n" + prose(30) for _ in range(20)]
    for _ in range(15):  # near copies with edits anywhere
        words = near.split()
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(len(words))] = word()
        rows.append(" ".join(words))
    rows += [prose(100)] * 3 + [passage[:LENGTH // 2] + prose(40), passage[-LENGTH:], "é" * 150, "x" + "é" * 150]
    return rows


def test_against_brute_force(docs_of):
    check(docs_of, texts(1))


def test_hot_anchors_window_by_window(docs_of):
    check(docs_of, texts(2), hot=1)
    check(docs_of, texts(3), hot=8)


def test_exact_lengths(docs_of):
    draw = random.Random(9)
    letters = lambda n: "".join(draw.choices("abcdefghijklmnop", k=n))
    same = [letters(n) for n in (198, 199, 200, 201, 260)]
    check(docs_of, [letters(40) + "." + s + "." + letters(60) for s in same for _ in range(2)])


def test_every_window_holds_an_anchor_of_its_own():
    draw = random.Random(4)
    rows = ["".join(draw.choices("abc", k=n)) for n in (0, 150, 200, 1000, 5000)] + ["z" * 500]
    data, offsets = flat(pa.array(rows))
    at, hashed = anchors(data, offsets)
    by_text = defaultdict(dict)
    for text, place, value in zip(np.searchsorted(offsets, at, "right") - 1, at, hashed):
        by_text[text][place - offsets[text]] = value
    for i, t in enumerate(rows):
        for p in range(len(t) - LENGTH + 1):
            assert any(p <= q <= p + 100 for q in by_text[i])
        assert all(0 <= q <= len(t) - 100 for q in by_text[i])


def test_interval_tree():
    assert list(intervals(np.array([3, 5, 5, 0, 2]))) == [(5, 1, 3), (3, 0, 3), (2, 4, 5)]
    assert list(intervals(np.array([], int))) == []


def test_maximal_repeats_list_all_occurrences():
    body = "".join(random.Random(1).choices("pqrst", k=300))
    rows = [("x" * 50 + body[:200], 50), ("y" * 10 + "x" * 40 + body[:200], 50), ("z" * 50 + body[:200], 50)]
    keys = np.zeros(3, np.uint64)
    found = {(tuple(sorted(r.tolist())), int(d[0])): sorted(zip(r.tolist(), b.tolist())) for r, b, d in
             maximal_repeats(keys, pa.array([t.encode() for t, _ in rows], pa.large_binary()), np.array([b for _, b in rows]))}
    assert found == {((0, 1, 2), 200): [(0, 40), (1, 40), (2, 0)]}


def test_awkward_rows_and_empty_table(awkward, nothing):
    rows = awkward.select("doc_id", "text").collect()
    got = sorted((repr(r.doc_id), hashlib.sha256(r.kept).hexdigest()) for r in repeated_spans(awkward).collect())
    want = sorted((repr(r.doc_id), hashlib.sha256(w[2]).hexdigest()) for r, w in zip(rows, brute([r.text for r in rows])))
    assert got == want
    assert repeated_spans(nothing).collect() == []
