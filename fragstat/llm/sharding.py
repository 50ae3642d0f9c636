"""Sharding by a two-pass external shuffle.

Pass 1 scatters records uniformly into memory-sized buckets by a seeded hash
of their content.  Pass 2 loads one bucket per task, puts it into a canonical
order (so a retried task sees the same), runs a seeded Fisher-Yates shuffle
over it and writes it.  The buckets one after the other are then one random
permutation of all records; dealing it out round-robin gives shards whose
record counts differ by one at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragstat.config import scratch_path

#: Text bytes of a bucket.  A task holds one bucket, about three times.
BUCKET_BYTES = 32 << 20

#: Up to so many buckets (of 16 bytes each) the table of first places is broadcast.
MAX_BROADCAST_BUCKETS = 1_000_000


def record_size(text) -> "F.Column":
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def _shuffle_bucket(seed: int):
    def shuffle(key: tuple, bucket: pa.Table) -> pa.Table:
        number = key[0].as_py()
        order = np.lexsort([bucket.column(c).to_numpy() for c in ("_part", "_tie", "_draw")])
        # Generator.shuffle is the Fisher-Yates (Knuth) shuffle.
        np.random.Generator(np.random.PCG64([seed, number])).shuffle(order)
        rows = bucket.take(pa.array(order)).drop_columns(["_draw", "_tie", "_part"])
        return rows.append_column("position", pa.array(np.arange(len(order)), pa.int64()))
    return shuffle


def shuffle_into_buckets(docs: DataFrame, path: str, seed: int = 42, text_col: str = "text",
                         bucket_bytes: int = BUCKET_BYTES, min_buckets: int = 24) -> DataFrame:
    """Write ``docs`` to ``path`` in a random order and return the written
    table: all columns, plus ``bucket`` and ``position`` in the bucket.

    The bucket of a record hashes all its columns, so a group of copies, a hot
    source or a repeated id is spread like any other records.  Records that
    agree in every column are told apart by the input partition they come
    from.  Columns named ``bucket`` or ``position``
    are replaced (by ``deal``: ``shard`` and ``slot`` too).  An empty
    table gives an empty one.  Null and empty texts are records like others;
    a record larger than a bucket has a bucket that is larger by that much.
    """
    spark = docs.sparkSession
    docs = docs.drop("bucket", "position")
    names = docs.columns
    # Positions, not names, inside: extra columns may be called anything.
    inner = docs.toDF(*(f"c{k}" for k in range(len(names))))
    total = docs.agg(F.sum(record_size(F.col(text_col)))).first()[0] or 0
    buckets = max(min_buckets, -(-total // bucket_bytes))
    scattered = inner.withColumns({
        "_part": F.spark_partition_id().cast("long"),
        "_draw": F.xxhash64(F.lit(seed), *inner.columns),
        "_tie": F.xxhash64(F.lit(~seed), *inner.columns),
    }).withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "_draw", "_tie", "_part"), F.lit(buckets)))
    schema = T.StructType([f for f in scattered.schema if f.name not in ("_draw", "_tie", "_part")])
    schema = schema.add("position", T.LongType())
    shuffled = scattered.groupBy("bucket").applyInArrow(_shuffle_bucket(seed), schema)
    shuffled.toDF(*names, "bucket", "position").write.mode("overwrite").parquet(path)
    return spark.read.schema(T.StructType(list(docs.schema)).add("bucket", T.LongType()).add(
        "position", T.LongType())).parquet(path)


def deal(shuffled: DataFrame, shards: int) -> DataFrame:
    """Add ``shard`` and ``slot``: the record at place k of the whole order
    goes to shard ``k mod shards`` as its record ``k div shards``.

    Only the record counts of the buckets come to the driver, one number for
    each ``BUCKET_BYTES`` of input; they go back as a table of first places,
    broadcast while that table is small (``MAX_BROADCAST_BUCKETS``).
    """
    spark = shuffled.sparkSession
    shuffled = shuffled.drop("shard", "slot")
    counts = sorted((r.bucket, r["count"]) for r in shuffled.groupBy("bucket").count().collect())
    before, rows = 0, []
    for bucket, count in counts:
        rows.append((bucket, before))
        before += count
    firsts = spark.createDataFrame(rows, "bucket long, __first long")
    if len(rows) <= MAX_BROADCAST_BUCKETS:
        firsts = F.broadcast(firsts)
    place = F.col("__first") + F.col("position")
    return shuffled.join(firsts, "bucket").withColumns({
        "shard": F.pmod(place, F.lit(shards)).cast("int"),
        "slot": F.expr(f"(__first + position) div {int(shards)}"),
    }).drop("__first")


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 42, path: str | None = None,
                    text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All records in ``shards`` shards, in random order: every column of
    ``docs`` plus ``bucket, position, shard, slot``.  The law is ``rows``:
    shard sizes differ by one record at most, slots have no gaps.
    """
    path = path or scratch_path(docs.sparkSession, "shards")
    return deal(shuffle_into_buckets(docs, path, seed, text_col, bucket_bytes, shards), shards)
