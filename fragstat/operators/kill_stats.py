"""Player kill statistics: kills, deaths, assists, K/D ratio, headshot %.

One row per player **with at least one kill** among the input rows, as the
per-batch statistics are defined.  Two implementations:

* :func:`player_kill_stats` -- one scan.  Every kill row is turned into up
  to three (player, role) rows with ``inline``, NULL ids are dropped, and a
  hash aggregate on ``(player_id, name)`` counts each role with
  ``count_if``.  Its partial (map-side) step collapses the 3x fan-out to one
  row per player and name per task before the shuffle, so a player holding
  a third of all rows sends one row per task, not a third of the data.  A
  second, small shuffle folds the name groups of a player together.
* :func:`player_kill_stats_joined` -- three aggregates, a name lookup and
  three equi-joins on the player id (joins of player-sized tables).  It
  scans its input four times: cheap on a columnar table, where each scan
  reads one to four columns, and costly on row-format input (topic
  payloads, CSV), where each scan parses whole lines.  Results are equal.

``player_name`` and ``timestamp_seconds`` come from the player's earliest
kill: lowest tick, kills without a tick last, ties broken by the smaller
name, then the smaller time (kills without a time last).

``by`` adds grouping keys in front of the player id (for example a batch or
match id), so many snapshots are computed in the same single job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import headshot_percentage, kd_ratio

KILLER, VICTIM, ASSISTER = 0, 1, 2
# Ordering value of a kill without a tick: after every real tick.
NO_TICK = 2**63 - 1
# Room for the time beside the tick, and where time zero lies in it: times
# between plus and minus 5e18 fit, and so do all ticks.
TIME_SPAN, TIME_ZERO = 10**19, 5 * 10**18

OUTPUT_COLUMNS = [
    "player_id", "player_name", "kills", "deaths", "assists",
    "kd_ratio", "headshot_percentage", "timestamp_seconds",
]


def _kill_order() -> Column:
    """Tick, then time, as one number: ``tick * TIME_SPAN + time``.  One
    decimal is a fixed-width aggregation buffer, which a struct is not, so its
    minimum stays in a hash aggregate."""
    tick = F.coalesce(F.col("tick").cast("long"), F.lit(NO_TICK)).cast("decimal(19,0)")
    time = F.coalesce(F.col("timestamp_seconds").cast("decimal(19,0)") + F.expr(f"{TIME_ZERO}BD"),
                      F.expr(f"{TIME_SPAN - 1}BD"))
    return (tick * F.expr(f"{TIME_SPAN}BD") + time).cast("decimal(38,0)")


def _first_tick() -> Column:
    return F.expr(f"first_order div {TIME_SPAN}BD")


def _first_time() -> Column:
    time = F.expr(f"first_order % {TIME_SPAN}BD")
    return F.when(time != F.expr(f"{TIME_SPAN - 1}BD"), (time - F.expr(f"{TIME_ZERO}BD")).cast("long"))


def _first_kill(per_name: DataFrame, by: Sequence[str], counts: Sequence[Column] = ()) -> DataFrame:
    """Second level of the identity: per player, the (name, time) of the
    name group holding the earliest kill (ties: smaller name, then time).

    ``per_name`` has one row per (player, name) with ``first_order``, so this
    aggregate sees a handful of rows per player.
    """
    earliest = F.min(F.when(
        F.col("first_order").isNotNull(),
        F.struct(_first_tick().alias("tick"), F.col("name").alias("player_name"),
                 F.col("first_order"), _first_time().alias("timestamp_seconds")),
    )).alias("first_kill")
    return per_name.groupBy(*by, "player_id").agg(*counts, earliest)


def _finish(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.select(
        *by,
        "player_id",
        F.col("first_kill.player_name").alias("player_name"),
        "kills",
        "deaths",
        "assists",
        kd_ratio().alias("kd_ratio"),
        headshot_percentage().alias("headshot_percentage"),
        F.col("first_kill.timestamp_seconds").alias("timestamp_seconds"),
    )


def _role(player: str, role: int, killer: bool) -> Column:
    def only_killer(col: Column, dtype: str) -> Column:
        return col if killer else F.lit(None).cast(dtype)

    return F.struct(
        F.col(player).alias("player_id"),
        F.lit(role).alias("role"),
        ((F.col("headshot") == 1) if killer else F.lit(False)).alias("headshot"),
        only_killer(F.col("killer_name"), "string").alias("name"),
        only_killer(_kill_order(), "decimal(38,0)").alias("kill_order"),
    )


def player_kill_stats(kills: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One-pass form: one scan; every row-level aggregate is a hash
    aggregate with a map-side partial step.

    Level 1 groups the role rows by ``(player_id, name)`` -- counts, and the
    earliest kill of each name group (``min`` of one decimal, so the
    aggregation buffer stays fixed-width).  Level 2 folds the few name
    groups of each player into one row.
    """
    by = list(by)
    roles = F.array(
        _role("killer_steamid", KILLER, True),
        _role("victim_steamid", VICTIM, False),
        _role("assister_steamid", ASSISTER, False),
    )
    role = F.col("role")
    per_name = (
        kills.select(*by, F.inline(roles))
        .where(F.col("player_id").isNotNull())
        .groupBy(*by, "player_id", "name")
        .agg(
            F.count_if(role == KILLER).alias("kills"),
            F.count_if(role == VICTIM).alias("deaths"),
            F.count_if(role == ASSISTER).alias("assists"),
            F.count_if(F.col("headshot")).alias("headshots"),
            F.min("kill_order").alias("first_order"),
        )
    )
    counts = [F.sum(c).alias(c) for c in ("kills", "deaths", "assists", "headshots")]
    per_player = _first_kill(per_name, by, counts).where(F.col("kills") > 0)
    return _finish(per_player, by)


# --- the component aggregates (also the building blocks of the join form) --

def kills_by_killer(kills: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(player_id, kills, headshots)`` per non-NULL killer."""
    return (
        kills.where(F.col("killer_steamid").isNotNull())
        .groupBy(*by, F.col("killer_steamid").alias("player_id"))
        .agg(
            F.count("*").alias("kills"),
            F.sum(F.when(F.col("headshot") == 1, 1).otherwise(0)).alias("headshots"),
        )
    )


def deaths_by_victim(kills: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(player_id, deaths)`` per non-NULL victim (a NULL killer still counts)."""
    return (
        kills.where(F.col("victim_steamid").isNotNull())
        .groupBy(*by, F.col("victim_steamid").alias("player_id"))
        .agg(F.count("*").alias("deaths"))
    )


def assists_by_assister(kills: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(player_id, assists)`` per non-NULL assister."""
    return (
        kills.where(F.col("assister_steamid").isNotNull())
        .groupBy(*by, F.col("assister_steamid").alias("player_id"))
        .agg(F.count("*").alias("assists"))
    )


def _identity_per_name(kills: DataFrame, by: Sequence[str]) -> DataFrame:
    return (
        kills.where(F.col("killer_steamid").isNotNull())
        .groupBy(*by, F.col("killer_steamid").alias("player_id"), F.col("killer_name").alias("name"))
        .agg(F.min(_kill_order()).alias("first_order"))
    )


def player_identity(kills: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per killer: ``(player_id, player_name, timestamp_seconds)``
    of the earliest kill -- a deterministic ``dropDuplicates(killer)``."""
    return _first_kill(_identity_per_name(kills, by), by).select(
        *by,
        "player_id",
        F.col("first_kill.player_name").alias("player_name"),
        F.col("first_kill.timestamp_seconds").alias("timestamp_seconds"),
    )


def player_kill_stats_joined(kills: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Join form: kills LEFT JOIN deaths LEFT JOIN assists JOIN names."""
    by = list(by)
    keys = [*by, "player_id"]
    base = kills.select(
        *by, "killer_steamid", "victim_steamid", "assister_steamid",
        "killer_name", "headshot", "tick", "timestamp_seconds",
    )
    names = _first_kill(_identity_per_name(base, by), by)
    joined = (
        kills_by_killer(base, by)
        .join(deaths_by_victim(base, by), keys, "left")
        .join(assists_by_assister(base, by), keys, "left")
        .join(names, keys, "inner")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("deaths", "assists")})
    )
    return _finish(joined, by)


def with_snapshot_id(kills: DataFrame, window_seconds: int = 60, out_col: str = "batch_id") -> DataFrame:
    """Batch id from replay time: one snapshot per ``window_seconds`` of match
    time, the deterministic stand-in for arrival-time micro-batches."""
    return kills.withColumn(out_col, F.floor(F.col("timestamp_seconds") / window_seconds).cast("long"))


def player_stats_snapshots(kills: DataFrame, window_seconds: int = 60, joined: bool = False) -> DataFrame:
    """Per-batch statistics of every batch at once (backfill of the
    ``player_stats`` table) in one job keyed on ``(batch_id, player_id)``.

    The one-pass form suits row-format input (topic payloads, CSV), where
    every scan parses whole lines; ``joined=True`` suits a columnar history
    table, where the join form's column-pruned scans cost no more than one
    pass and its aggregates key on a ``long`` alone.  Results are equal.
    """
    op = player_kill_stats_joined if joined else player_kill_stats
    return op(with_snapshot_id(kills, window_seconds), by=["batch_id"])
