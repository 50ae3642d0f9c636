"""Kill and damage events derived from the ``lineitem`` test table.

The shared test tables hold no match logs, so the event columns the
statistics read are mapped from ``lineitem`` by plain expressions that the
DuckDB oracle repeats in SQL (see ``fragstat.plans.oracle``).  Every other
event column is a typed NULL, so the frames have the full 44 / 23 column
layout.  Column pruning keeps the ``lineitem`` scan to the columns used.

The mapping is made to be hard on the operators: ticks count within a match
(``l_orderkey div 10000``) and so collide across matches, a killer's name
changes with the tick, attackers, headshots and health values are NULL here
and there, healing gives negative damage, and a match has 61 rounds.
``(l_orderkey, l_linenumber)`` is not unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.routing import elapsed_seconds
from ..schemas import DAMAGES, KILLS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- fixed values: how orders become matches and ticks ----------------------
TICKS_PER_MATCH = 10_000
ROUNDS = 61
# ---------------------------------------------------------------------------


def match_tick() -> Column:
    """Tick within the match, 0 to 9999."""
    return F.pmod(F.col("l_orderkey"), F.lit(TICKS_PER_MATCH).cast("long")).cast("int")


def match_checksum() -> Column:
    return F.concat(F.lit("m"), F.call_function(
        "div", F.col("l_orderkey"), F.lit(TICKS_PER_MATCH).cast("long")).cast("string"))


def _layout(df: DataFrame, schema: StructType, exprs: dict[str, Column]) -> DataFrame:
    """Project ``df`` to the full event layout: the mapped columns, typed
    NULL for the rest, in schema order.  The NULL block is one ``selectExpr``
    (one JVM call instead of three per column); Catalyst collapses the two
    projections into one."""
    mapped = df.select(*[
        expr.cast(schema[name].dataType).alias(name)
        for name, expr in exprs.items()
    ])
    return mapped.selectExpr(*[
        f"`{f.name}`" if f.name in exprs else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in schema.fields
    ])


def kill_events(lineitem: DataFrame) -> DataFrame:
    """One kill per ``lineitem`` row, all 44 kill columns."""
    l = F.col
    exprs = {
        "tick": match_tick(),
        "round": match_tick() % ROUNDS,
        # three names for each player, by tick
        "killer_name": F.concat(F.lit("p"), l("l_suppkey").cast("string"), F.lit("_"),
                                (match_tick() % 3).cast("string")),
        "killer_steamid": F.when(
            (l("l_returnflag") == "R") & (l("l_linenumber") == 1), F.lit(None)
        ).otherwise(l("l_suppkey")),
        "victim_steamid": l("l_partkey") % 97,
        "assister_steamid": F.when(l("l_linestatus") == "O", l("l_partkey") % 89),
        "headshot": F.when(l("l_quantity") > 40, 1).when(l("l_quantity") > 10, 0),
        "match_checksum": match_checksum(),
        "timestamp_seconds": elapsed_seconds(match_tick()),
    }
    return _layout(lineitem, KILLS, exprs)


def damage_events(lineitem: DataFrame) -> DataFrame:
    """One damage event per ``lineitem`` row, all 23 damage columns."""
    l = F.col
    exprs = {
        "tick": match_tick(),
        "round": match_tick() % ROUNDS,
        "attacker_steamid": F.when(l("l_linenumber") != 2, l("l_suppkey")),
        "victim_health": F.when(l("l_quantity") != 7, 100),
        # quantities under 5 heal: negative damage
        "victim_new_health": F.lit(105) - l("l_quantity").cast("int"),
        "match_checksum": match_checksum(),
        "timestamp_seconds": elapsed_seconds(match_tick()),
    }
    return _layout(lineitem, DAMAGES, exprs)


def kills_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kill_events(read_table(spark, sf_dir, "lineitem"))


def damages_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damage_events(read_table(spark, sf_dir, "lineitem"))
