import zlib
from collections import Counter

from pyspark.sql import functions as F

from fragstat.llm.queries import op1_sharding
from fragstat.llm.sharding import shard_documents

SF = "/root/testdata/sf0.001"


def test_every_record_once_and_shards_even(spark):
    rows = op1_sharding(spark, SF).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) <= set(range(24)) and max(sizes.values()) - min(sizes[s] for s in range(24)) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    for r in rows:
        text = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 8, zlib.crc32(text), "rows", None)


def test_same_seed_same_order_other_seed_other_order(spark, docs_of):
    docs = docs_of([f"text {i}" for i in range(300)]).checkpoint()
    order = lambda seed: [r.doc_id for r in shard_documents(docs, 3, seed).orderBy("slot", "shard").collect()]
    first = order(1)
    assert first == order(1) and sorted(first) == list(range(300))
    other = order(2)
    assert other != first and first != sorted(first)
    assert sum(a == b for a, b in zip(first, other)) < 30


def test_small_buckets_and_hot_copies(spark, docs_of):
    docs = docs_of([(i, "copy " * 20) for i in range(200)] + [(7, "same id")] * 50 + [(1000 + i, "x") for i in range(100)])
    out = shard_documents(docs, 4, bucket_bytes=1000)
    sizes = Counter(r.shard for r in out.collect())
    assert sum(sizes.values()) == 350 and max(sizes.values()) - min(sizes.values()) <= 1
    buckets = [r["count"] for r in out.groupBy("bucket").count().collect()]
    assert len(buckets) > 15 and max(buckets) < 80


def test_awkward_rows_and_empty_table(awkward, nothing):
    out = shard_documents(awkward, 3)
    keep = [c for c in awkward.columns if c not in ("bucket", "position", "shard", "slot")]
    key = lambda rows: sorted(map(repr, rows))
    assert key(out.select(keep).collect()) == key(awkward.select(keep).collect())
    assert out.select(F.min("slot")).first()[0] == 0
    assert shard_documents(nothing, 3).collect() == []
