"""N-gram Jaccard join with grouped prefixes.

A document is its set of word shingles.  Ordered from the rarest shingle of
the corpus to the most frequent, two sets that are similar enough share a
shingle of their *prefixes*, the first ``n - ceil(t n) + 1`` of n shingles.

1. Document frequencies of all shingles come from the packed dictionary join.
2. Documents with the same prefix and set size collapse into one *group*; a
   group is listed under those of its prefix shingles that other documents
   have as well.  Documents with a prefix of their own have no partner.
3. Groups under a common shingle are candidates of each other.  They are
   expanded to their members and gathered into units that a task can hold
   (:mod:`fragstat.llm.units`).
4. In a unit, an inverted index over the whole sets counts what members have
   in common; pairs that may link and are not connected yet are verified, and
   only the links that connect are returned, never the pairs.

So no link between components is lost, a task holds ``UNIT`` sets or two
blocks of that many, and each unit returns fewer links than it has members.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragstat.config import scratch_path
from fragstat.llm.packed import (
    add_up, bucket_bits, count_requests, distinct_counts, packed_table, squeeze_sorted, told, unsqueeze_sorted, with_answers)
from fragstat.llm.tokens import coded, flat, hashes, ngrams, words
from fragstat.llm.units import Forest, Index, connected_members

#: Words of a shingle, and similarity in hundredths.
WORDS, PERCENT = 5, 80
#: Members that a task compares with each other.
UNIT = 4096
#: Text bytes of a chunk.
CHUNK_BYTES = 4 << 20
#: Bits of a shingle's hash that its document frequency is counted by.
KEY_BITS = 48


def shingle_sets(texts: pa.Array, width: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    tokens, counts = words(*flat(texts))
    codes, distinct = coded(tokens)
    grams, sizes = ngrams(hashes(distinct)[codes], counts, width)
    ends = np.cumsum(sizes)
    return [np.unique(grams[end - size:end]) for end, size in zip(ends.tolist(), sizes.tolist())]


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def _profiles(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """A row per document: ``id, size, member`` (digest of its set) and,
    once for each member and chunk, ``grp`` with ``tokens`` (the prefix shingles
    that other documents have) and ``keys`` (the set itself).
    """
    spark = docs.sparkSession
    bits = bucket_bits(spark)
    chunks = packed_table(docs, "_text", CHUNK_BYTES)
    shift = np.uint64(64 - KEY_BITS)

    def keys_of(texts: pa.Table):
        sets = shingle_sets(texts.column("_text"), width)
        return [distinct_counts(np.concatenate([np.zeros(0, np.uint64), *sets]) >> shift)]

    def profile(texts: pa.Table, answer: pa.Table) -> pa.Table:
        sets = shingle_sets(texts.column("_text"), width)
        every = np.concatenate([np.zeros(0, np.uint64), *sets])
        frequency = told(answer, 0, bits)[np.unique(every >> shift, return_inverse=True)[1]]
        rows, seen, begin = [], set(), 0
        for shingles in sets:
            size = len(shingles)
            often = frequency[begin:begin + size]
            begin += size
            if not size:
                rows.append((0, None, None, None, None))
                continue
            member = xxhash.xxh3_128_digest(shingles.tobytes())
            if member in seen:
                rows.append((size, member, None, None, None))
                continue
            seen.add(member)
            first = np.lexsort((shingles, often))[:prefix_length(size, percent)]
            shared = np.flatnonzero(often[first] > 1)
            if not len(shared):
                rows.append((size, member, None, None, None))
                continue
            prefix = shingles[first]
            rows.append((size, member, xxhash.xxh3_128_digest(prefix.tobytes(), size),
                         prefix[shared].view(np.int64), squeeze_sorted(shingles)))
        size, member, group, tokens, keys = zip(*rows)
        return pa.table({
            "id": texts.column("_id"), "size": pa.array(size, pa.int32()), "member": pa.array(member, pa.binary()),
            "grp": pa.array(group, pa.binary()), "tokens": pa.array(tokens, pa.list_(pa.int64())),
            "keys": pa.array(keys, pa.binary())})

    schema = (T.StructType().add("id", docs.schema["_id"].dataType).add("size", T.IntegerType())
              .add("member", T.BinaryType()).add("grp", T.BinaryType()).add("tokens", T.ArrayType(T.LongType()))
              .add("keys", T.BinaryType()))
    answers = add_up(count_requests(chunks, keys_of, bits, KEY_BITS))
    path = scratch_path(spark, "profiles")
    with_answers(chunks, answers, profile, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def connected_sets(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the number of the first one that it is connected with by
    links (pairs of sets that are similar enough)."""
    if len(sets) == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([0, 100 * common < percent * (len(sets[0]) + len(sets[1]) - common)], np.int64)
    index, forest = Index(sets), Forest(len(sets))
    for i, size in enumerate(index.sizes.tolist()):
        mine = index.of(i)
        order = np.lexsort((mine, index.often[mine]))  # rarest in the unit first
        prefix = mine[order[:prefix_length(size, percent)]]
        near = np.unique(index.holders(prefix[index.often[prefix] > 1]))
        own = forest.find(i)
        if all(forest.find(j) == own for j in near.tolist()):
            continue
        common = index.common(i)[near]
        for j in near[100 * common >= percent * (size + index.sizes[near] - common)].tolist():
            forest.join(i, j)
    return forest.roots()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS,
                    percent: int = PERCENT, unit: int = UNIT) -> DataFrame:
    """``id_col, n_shingles, component_id`` for every row.

    Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; a text of fewer than
    ``width`` words has its whole sequence as one shingle, and one without
    words (or null) has none and links with nothing.  Two documents link when
    ``100 |x & y| >= percent |x | y|``; ``component_id`` is the smallest id
    reachable by links.  Repeated rows come back as often as they occur.  A
    row with a null id takes part in links; its component is the smallest
    other id, null without one.  Other columns are not read.
    """
    spark = docs.sparkSession
    profiles = _profiles(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), width, percent)
    listed = profiles.where(F.col("grp").isNotNull())
    members = listed.select("grp", "member").distinct()
    sets = listed.groupBy("member").agg(F.first("keys").alias("keys"))
    listings = listed.groupBy("grp").agg(F.first("tokens").alias("tokens")).select(
        "grp", F.explode("tokens").alias("token"))

    def connect(rows: pa.Table, edges: np.ndarray) -> np.ndarray:
        keys = rows.column("keys").combine_chunks()
        return np.concatenate([a + connected_sets([unsqueeze_sorted(k.as_py()) for k in keys[a:b]], percent)
                               for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())])
    parts = connected_members(listings.join(members, "grp").select("token", "member"), sets, connect, unit)

    roots = profiles.where(F.col("member").isNotNull()).groupBy("member").agg(F.min("id").alias("least")).join(
        parts.withColumnRenamed("node", "member"), "member", "left").select(
        "member", "least", F.coalesce("root", "member").alias("part")).checkpoint()
    least = roots.groupBy("part").agg(F.min("least").alias("component"))
    known = roots.join(least, "part").select("member", "component").checkpoint()
    return (
        profiles.select("id", "size", "member").join(known, "member", "left")
        .select(F.col("id").alias(id_col), F.col("size").cast("long").alias("n_shingles"),
                F.when(F.col("member").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id"))
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS,
             percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, less near copies: of each component
    the row with the smallest id stays (a null id comes last; of rows with one
    id and text, any one).  Texts without words link with nothing and stay."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumn("__near_key", F.struct(
        F.col(id_col).isNull().alias("none"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
        F.sha2(text, 256).alias("text")))
    groups = near_duplicates(keyed.select("__near_key", F.col(text_col).alias("__near_text")), "__near_key", "__near_text", width, percent)
    kept = groups.where((F.col("n_shingles") > 0) & (F.col("__near_key") == F.col("component_id"))).select("__near_key").distinct()
    wordy = text.rlike(r"[^\x20\x09-\x0D]")
    return (
        keyed.where(wordy).join(kept, "__near_key", "left_semi").dropDuplicates(["__near_key"])
        .unionByName(keyed.where(~wordy)).drop("__near_key")
    )
