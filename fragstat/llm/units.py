"""Comparing candidates inside bounded units.

Candidates are members that share a key.  The smallest member under a key leads
it, and all members under the keys of one lead form a *unit*: members that have
much in common share most of their keys, so most of their keys have the same
lead, and a member goes to few units however many keys it has.  Where a unit is
larger than a task should hold, its keys are taken one by one, in pairs of
blocks if those are too large as well.  So any two members with a common key
meet in some unit, a task holds one unit or two blocks, and a unit returns the
links that connect its members -- fewer than it has members -- and never its
pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fragstat.llm.components import connected_components

LINKS = "node binary, root binary"


class Forest:
    """Union-find over 0 .. n - 1; a root is the smallest of its set."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = sorted((self.find(x), self.find(y)))
        self.parent[y] = x

    def roots(self) -> np.ndarray:
        return np.array([self.find(x) for x in range(len(self.parent))], np.int64)


class Index:
    """An inverted index over sets of 64-bit items."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        ends = np.cumsum(self.sizes)
        self.starts = ends - self.sizes
        _, self.items, self.often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.postings = owner[np.argsort(self.items, kind="stable")]
        self.first = np.cumsum(self.often) - self.often

    def of(self, i: int) -> np.ndarray:
        return self.items[self.starts[i]:self.starts[i] + self.sizes[i]]

    def holders(self, items: np.ndarray) -> np.ndarray:
        """The sets that hold each of the items, one item after the other."""
        many = self.often[items]
        ends = np.cumsum(many)
        total = int(ends[-1]) if len(ends) else 0
        return self.postings[np.repeat(self.first[items] - (ends - many), many) + np.arange(total)]

    def common(self, i: int) -> np.ndarray:
        """How many items each set has in common with set i."""
        return np.bincount(self.holders(self.of(i)), minlength=len(self.sizes))


def units_of(rows: DataFrame, size: int) -> DataFrame:
    """``unit, i, j, member`` from (``token``, ``member``) rows: who is compared
    with whom."""
    tokens = rows.groupBy("token").agg(
        F.min("member").alias("lead"), F.max("member").alias("last"), F.count(F.lit(1)).alias("n"))
    shared = rows.join(tokens.where("lead != last").drop("last"), "token")
    led = shared.select("lead", "member").distinct().checkpoint()
    sizes = led.groupBy("lead").agg(F.count(F.lit(1)).alias("n"))
    whole = led.join(sizes.where(F.col("n") <= size).select("lead"), "lead").select(
        F.col("lead").alias("unit"), F.lit(0).alias("i"), F.lit(0).alias("j"), "member")
    large = sizes.where(F.col("n") > size).select("lead")
    if not large.limit(1).count():
        return whole
    split = shared.join(large, "lead").select(
        F.col("token").cast("string").cast("binary").alias("unit"), "member",
        F.ceil(F.col("n") / size).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int")
    paired = (
        split.withColumn("b", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("unit", F.least("b", "other").alias("i"), F.greatest("b", "other").alias("j"), "member")
    )
    return whole.unionByName(paired)


def connected_members(rows: DataFrame, members: DataFrame,
                      connect: Callable[[pa.Table, np.ndarray], np.ndarray], size: int) -> DataFrame:
    """``node, root`` for every member that is linked with another one.

    ``rows`` are (``token``, ``member``); ``members`` holds each member once,
    with what ``connect`` needs (see :func:`unit_links`).
    """
    return connected_components(unit_links(units_of(rows, size).join(members, "member"), connect), "node", "root")


def unit_links(dealt: DataFrame, connect: Callable[[pa.Table, np.ndarray], np.ndarray]) -> DataFrame:
    """``node, root`` links that connect the members of each unit.

    ``dealt`` are the rows of :func:`units_of` with what ``connect`` needs.  Most
    units are tiny, so a task gets many at a time: ``connect(table, edges)`` finds
    unit k in the rows from ``edges[k]`` up to ``edges[k + 1]``, sorted by member,
    and returns for each row the row of the first one of its unit that it is
    connected with.
    """
    def links(table: pa.Table) -> pa.Table:
        table = table.sort_by([("unit", "ascending"), ("i", "ascending"), ("j", "ascending"), ("member", "ascending")])
        unit = table.column("unit").combine_chunks().dictionary_encode().indices.to_numpy()
        ids = np.stack([unit, table.column("i").to_numpy(), table.column("j").to_numpy()], 1)
        begins = np.flatnonzero(np.concatenate(([True], np.any(ids[1:] != ids[:-1], axis=1))))
        first = connect(table, np.append(begins, len(ids)))
        some = np.flatnonzero(first != np.arange(len(first)))
        member = table.column("member")
        return pa.table({"node": member.take(pa.array(some)), "root": member.take(pa.array(first[some]))})
    slots = 4 * int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slotted = dealt.withColumn("slot", F.pmod(F.xxhash64("unit", "i", "j"), F.lit(slots)))
    return slotted.groupBy("slot").applyInArrow(links, LINKS)
