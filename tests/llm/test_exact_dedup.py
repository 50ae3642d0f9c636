import hashlib
import re
from collections import defaultdict

from fragstat.llm.exact_dedup import exact_dedup, exact_groups


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0d]", "", text or "")].append((doc_id, text or ""))
    out = []
    for doc_id, text in rows:
        norm = re.sub(r"[\x20\x09-\x0d]", "", text or "")
        best = min(groups[norm], key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        out.append((doc_id, best[0], len(groups[norm]), doc_id == best[0] and len(text or "") == len(best[1]),
                    hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = exact_groups(docs, **more).drop("n_points").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_against_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(
        ["a b", "ab", "a  b", "A b", None, "", " \n", "é\u00a0", "é", "a\x0bb", "a\x1cb", "\U0001f600 x", "\U0001f600x"] * 4)]
    check(spark, rows)
    check(spark, rows, salts=1)


def test_hot_group_ties_nulls_and_extreme_ids(spark):
    rows = [(i, "hot text") for i in range(500)] + [(None, "hot  text"), (None, "x"), (None, "x"), (-2**63, "y"), (2**63 - 1, "y"),
                                                   (5, "z"), (5, "z"), (5, "z ")]
    check(spark, rows)


def test_kept_rows(awkward, nothing):
    kept = exact_dedup(awkward)
    assert kept.columns == awkward.columns
    texts = [re.sub(r"\s", "", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) and "" in texts
    assert exact_groups(nothing).collect() == [] and exact_dedup(nothing).collect() == []
