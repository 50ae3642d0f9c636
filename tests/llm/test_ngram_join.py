import random
import re

from llm.brute import components

from fragstat.llm.ngram_join import keep_one, near_duplicates, prefix_length


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(texts, percent=80):
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return [(i, len(s), c) for i, (s, c) in enumerate(zip(sets, components(len(sets), links)))]


def corpus(seed, n=40):
    draw = random.Random(seed)
    word = lambda: draw.choice(["a", "b", "the", "of"]) if draw.random() < 0.3 else "".join(draw.choices("abcd", k=5))
    base = [[word() for _ in range(draw.choice([3, 5, 6, 12, 40, 100]))] for _ in range(8)]
    rows = []
    for _ in range(n):
        words = list(draw.choice(base))
        for _ in range(draw.choice([0, 0, 1, 2, 5])):
            at = draw.randrange(len(words))
            words[at:at + 1] = draw.choice([[], [word()], [word(), words[at]]])
        text = draw.choice([" ", "\n", "  "]).join(words)
        rows.append(text.upper() if draw.random() < 0.2 else text)
    return rows + ["", None, " \n", "one", "one", "One two"]


def test_against_brute_force(docs_of):
    for seed in range(3):
        texts = corpus(seed, 120)
        got = sorted(map(tuple, near_duplicates(docs_of(texts)).collect()))
        assert got == brute(texts), seed


def test_units_that_are_split(docs_of):
    for unit in (1, 3, 10):
        texts = corpus(7, 90)
        got = sorted(map(tuple, near_duplicates(docs_of(texts), unit=unit).collect()))
        assert got == brute(texts), unit


def test_chain_of_links_and_dense_group(docs_of):
    draw = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    chain = []
    for i in range(25):  # neighbours are similar, ends are not
        words[2 * i] = f"x{i}"
        chain.append(" ".join(words))
    core = [f"c{i}" for i in range(200)]
    dense = []
    for _ in range(150):
        copy = list(core)
        copy[draw.randrange(200)] = f"d{draw.randrange(10**6)}"
        dense.append(" ".join(copy))
    texts = chain + dense + ["filler " + " ".join(f"u{draw.randrange(10**6)}" for _ in range(30)) for _ in range(30)]
    assert sorted(map(tuple, near_duplicates(docs_of(texts)).collect())) == brute(texts)


def test_threshold_is_exact(docs_of):
    # 8 of 10 shingles shared is 0.8; 7 of 9 is less
    a = " ".join(f"w{i}" for i in range(13))
    b = " ".join(f"w{i}" for i in range(12)) + " x"
    c = " ".join(f"w{i}" for i in range(12))
    texts = [a, b, c, " ".join(f"v{i}" for i in range(8)), " ".join(f"v{i}" for i in range(9))]
    assert sorted(map(tuple, near_duplicates(docs_of(texts)).collect())) == brute(texts)


def test_prefix_length():
    for n in range(1, 300):
        assert prefix_length(n, 80) == n - -(-80 * n // 100) + 1


def test_awkward_rows_and_empty_table(awkward, nothing):
    rows = near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    component = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert component[1, 5] == 1 and component[None, 5] == 1 and component[6, 5] == 1
    assert component[None, 0] is None and component[3, 0] == 3
    assert [r.component_id for r in rows if r.doc_id in (5, 6) and r.n_shingles > 100] == [5, 5]
    assert near_duplicates(nothing).collect() == []


def test_keep_one(awkward, nothing):
    kept = keep_one(awkward)
    assert kept.columns == awkward.columns
    texts = sorted((repr(r.doc_id), (r.text or "")[:10]) for r in kept.collect() if r.doc_id is None or r.doc_id < 100)
    assert texts == sorted([("1", "a b c d e "), ("2", ""), ("3", ""), ("4", " \n\t "), ("None", ""), ("None", ""),
                            ("5", awkward.where("doc_id = 5").first().text[:10])])
    assert keep_one(nothing).collect() == []
