import itertools
import random
import re

import numpy as np
import pyarrow as pa

from fragstat.llm.decontamination import MIN_TOKENS, PERCENT, decontaminate, find_overlaps

import fragstat.llm.decontamination as module


def split(text):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def corpus(seed):
    draw = random.Random(seed)
    word = lambda: draw.choice(["the", "of", "and"]) if draw.random() < 0.4 else "".join(draw.choices("abcd", k=3))
    items = [(i, " ".join(word() for _ in range(draw.choice([1, 3, 4, 5, 6, 8, 12, 13, 20, 45])))) for i in range(25)]
    texts = []
    for _ in range(60):
        words = [word() for _ in range(draw.randint(0, 60))]
        if draw.random() < 0.7:
            passage = split(draw.choice(items)[1])[draw.choice([0, 0, 0, 3]):]
            for _ in range(draw.choice([0, 0, 1, 2, 6])):
                if passage:
                    passage[draw.randrange(len(passage))] = word()
            at = draw.randint(0, len(words))
            words[at:at] = passage
        text = draw.choice([" ", "\n"]).join(words)
        texts.append(text.upper() if draw.random() < 0.2 else text)
    return items + [(90, None), (91, ""), (None, "null id item"), (92, items[3][1])], texts + ["", None, "  "]


def check(spark, docs_of, items, texts):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in find_overlaps(docs_of(texts), benchmark).collect()}
    found = 0
    for i, text in enumerate(texts):
        assert sorted(map(tuple, got[i].overlaps)) == sorted(set(every_window(text, items))), i
        assert got[i].text == text
        found += bool(got[i].overlaps)
    return found


def test_against_brute_force(spark, docs_of):
    assert 10 < check(spark, docs_of, *corpus(1)) < 60
    check(spark, docs_of, *corpus(2))


def test_blocks_of_the_benchmark(spark, docs_of, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_TOKENS", 60)
    check(spark, docs_of, *corpus(3))


def test_substitutions_and_clean_documents(spark, docs_of):
    item = [f"w{i}" for i in range(30)]
    near = list(item)
    for at in (4, 9, 15, 22):
        near[at] = "other"
    far = [w if i % 2 else "other" for i, w in enumerate(item)]
    texts = [" ".join(x) for x in (item, ["before", *near, "after"], far, [f"z{i}" for i in range(50)], item[:12], item[:13])]
    benchmark = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate(docs_of(texts), benchmark).collect()) == [2, 3, 4]


def test_awkward_rows_and_empty_tables(spark, awkward, nothing):
    benchmark = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None)], "item_id long, text string")
    out = find_overlaps(awkward, benchmark)
    assert out.columns == [*awkward.columns, "overlaps"]
    hit = sorted(repr(r.doc_id) for r in out.collect() if r.overlaps)
    assert hit == ["1", "1", "6", "None"]
    assert find_overlaps(nothing, benchmark).collect() == []
    assert all(not r.overlaps for r in find_overlaps(awkward, benchmark.where("false")).collect())
    assert decontaminate(awkward, benchmark).columns == awkward.columns


def every_window(text, items):
    """The longest window of each alignment that is long and similar enough, without any seeds."""
    t, out = split(text), []
    for number, item in items:
        w = split(item or "")
        need = min(MIN_TOKENS, len(w))
        if number is None or not w:
            continue
        for shift in range(-len(w) + 1, len(t)):
            lo, hi = max(0, -shift), min(len(w), len(t) - shift)
            same = [w[i] == t[i + shift] for i in range(lo, hi)]
            best = max(((b - a, -b) for a in range(len(same)) for b in range(a + need, len(same) + 1)
                        if 100 * sum(same[a:b]) >= PERCENT * (b - a)), default=None)
            if best:
                size, b = best[0], -best[1]
                out.append((number, lo + b - size + shift, lo + b + shift, lo + b - size, sum(same[b - size:b])))
    return sorted(out)


def test_every_placement_of_substitutions_is_found():
    for size in range(1, 21):
        item = [f"w{i}" for i in range(size)]
        block = module.make_block(np.array([7]), pa.array([" ".join(item)], pa.large_string()))
        texts = []
        for many in range(size // 5 + 1):
            for places in itertools.combinations(range(size), many):
                texts.append(" ".join(["before", *("other" if i in places else w for i, w in enumerate(item)), "after"]))
        found = module.overlaps(pa.array(texts, pa.large_string()), block)
        assert all(found), (size, [t for t, f in zip(texts, found) if not f][:3])


def test_against_every_window(spark, docs_of):
    for seed in (1, 4):
        items, texts = corpus(seed)
        benchmark = spark.createDataFrame(items, "item_id long, text string")
        got = {r.doc_id: sorted(map(tuple, r.overlaps)) for r in find_overlaps(docs_of(texts), benchmark).collect()}
        for i, text in enumerate(texts):
            assert got[i] == sorted(set(every_window(text, items))), i
