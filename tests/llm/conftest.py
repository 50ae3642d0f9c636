import random

import public_tokenizers
import pytest

from fragstat.config import checkpoint_root

CLASHING = ("chunk bucket position shard slot key line token size member grp place part node root id row "
            "number payload _text _id _learn _part _draw count text_sha256 toxic item").split()


@pytest.fixture(scope="session", autouse=True)
def checkpoints(spark):
    checkpoint_root(spark)


@pytest.fixture(scope="session")
def bpe_path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts (or (doc_id, text) pairs)."""
    def make(texts, partitions=3):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    return make


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra
    columns with the names that operators use inside."""
    draw = random.Random(3)
    word = lambda: "".join(draw.choices("abcdeé", k=draw.randint(1, 6)))
    long = " ".join(word() for _ in range(30_000))
    rows = [(1, "a b c d e f g\nh i"), (1, "a b c d e f g\nh i"), (2, None), (3, ""), (None, "a b c d e f g\nh i"),
            (None, None), (4, " \n\t "), (5, long), (6, long), (6, "A B c d e f g\nh i"), (None, None)]
    rows += [(100 + i, " ".join(word() for _ in range(40))) for i in range(20)]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *(None if r[0] is None else c for c in CLASHING)) for r in rows], schema)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")

