"""Player damage statistics: total damage, rounds played, damage per round.

One ``groupBy`` on the attacker id: sum and distinct-round count are both
computed partially on the map side, so the shuffle carries one small row
per attacker per task whatever the skew of the attacker column.

Rows with a NULL attacker form their own group (player_id NULL), as in the
per-batch statistics; ``drop_null_player=True`` removes it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.decode import damage_dealt
from ..functions.metrics import damage_per_round

MAX_LG_K = 21  # the largest sketch; what has to be finer (errors under 0.08 %) is counted exactly

OUTPUT_COLUMNS = ["player_id", "total_damage", "rounds", "damage_per_round"]


def player_damage_stats(
    damages: DataFrame,
    exact: bool = False,
    rsd: float | None = None,
    round_keys: Sequence[str] = ("round",),
    by: Sequence[str] = (),
    drop_null_player: bool = False,
) -> DataFrame:
    """Per attacker: ``total_damage``, ``rounds``, ``damage_per_round``.

    ``rounds`` is an approximate distinct count of ``round`` (``rsd`` relative error,
    Spark's default 0.05 when None) unless ``exact=True``.  HyperLogLog++ holds all
    registers of each player in every task, 416 bytes at the default but 13 KB at 0.01;
    so with ``rsd`` the count is a sketch's (see :func:`player_damage_sketches`), which grows
    with the rounds it has seen, in an aggregate that sorts instead of holding all players.
    Round numbers of different matches collide; pass
    ``round_keys=("match_checksum", "round")`` to count (match, round) pairs.
    """
    by = list(by)
    if "damage_dealt" not in damages.columns:
        damages = damages.withColumn("damage_dealt", damage_dealt())
    if drop_null_player:
        damages = damages.where(F.col("attacker_steamid").isNotNull())

    keys = [F.col(k) for k in round_keys]
    lg_k = max(4, math.ceil(2 * math.log2(1.04 / rsd))) if rsd else 0
    if exact or lg_k > MAX_LG_K:
        rounds = F.count_distinct(*keys)
    else:
        # A row counts only when every key is set, as count(DISTINCT a, b) does.
        all_set = reduce(lambda a, b: a & b, [k.isNotNull() for k in keys])
        key = keys[0] if len(keys) == 1 else F.when(all_set, F.struct(*keys))
        rounds = F.approx_count_distinct(key)
        if rsd:
            rounds = F.hll_sketch_estimate(F.hll_sketch_agg(F.when(all_set, F.xxhash64(*keys)), lg_k))

    return (
        damages.groupBy(*by, F.col("attacker_steamid").alias("player_id"))
        .agg(
            F.sum("damage_dealt").alias("total_damage"),
            rounds.alias("rounds"),
        )
        .withColumn("damage_per_round", damage_per_round())
        .select(*by, *OUTPUT_COLUMNS)
    )


def player_damage_sketches(damages: DataFrame, by: Sequence[str] = (), round_col: str = "round", lg_k: int = 12) -> DataFrame:
    """Per attacker ``total_damage`` and ``rounds_sketch``, a mergeable sketch of the
    rounds: what a batch stores so that rounds can be counted over many batches.

    Sums of ``rounds`` over batches count a round once for each batch it reaches
    into; sketches do not.  A sketch of ``2 ** lg_k`` registers has a relative error of about
    ``1.04 / 2 ** (lg_k / 2)`` (1.6 % at 12) and is practically exact up to
    ``2 ** (lg_k - 3)`` rounds (512 at 12), below which it keeps the values' hashes.
    """
    by = list(by)
    if "damage_dealt" not in damages.columns:
        damages = damages.withColumn("damage_dealt", damage_dealt())
    return damages.groupBy(*by, F.col("attacker_steamid").alias("player_id")).agg(
        F.sum("damage_dealt").alias("total_damage"), F.hll_sketch_agg(round_col, lg_k).alias("rounds_sketch"))


def merged_damage_stats(sketches: DataFrame) -> DataFrame:
    """The damage statistics over all stored batches: sums of damage, rounds of the
    merged sketches.  Partial merges on the map side; one row per player is shuffled
    for each task."""
    return (
        sketches.groupBy("player_id")
        .agg(F.sum("total_damage").alias("total_damage"),
             F.hll_sketch_estimate(F.hll_union_agg("rounds_sketch")).alias("rounds"))
        .withColumn("damage_per_round", damage_per_round())
        .select(*OUTPUT_COLUMNS)
    )


def damage_dealt_rows(damages: DataFrame, keep: Sequence[str] = ("tick", "round", "attacker_steamid")) -> DataFrame:
    """The derived per-row column with the given identifying columns."""
    return damages.select(*keep, damage_dealt().alias("damage_dealt"))
