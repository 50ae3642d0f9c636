"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each one reads the shared test tables (or data Spark derives from them) in
full, so its work grows with the scale factor.  The DuckDB twin of every
entry is in :mod:`fragstat.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decode import decode_csv, encode_csv, with_damage_dealt
from ..functions.routing import elapsed_seconds, topic_for_file
from ..operators import damage_stats as dmg
from ..operators import kill_stats as ks
from ..operators.replay import replay_order, to_payload
from ..schemas import DAMAGES_TOPIC, KILLS_TOPIC
from ..sources.testviews import damages_view, kills_view, read_table
from .malformed import damaged_lines
from .staged import STAGED_QUERIES, snapshots

Query = Callable[[SparkSession, str], DataFrame]


def _on_kills(op) -> Query:
    return lambda spark, sf_dir: op(kills_view(spark, sf_dir))


def _on_damages(op) -> Query:
    return lambda spark, sf_dir: op(damages_view(spark, sf_dir))


def csv_roundtrip(events: DataFrame) -> DataFrame:
    """Encode every row as a topic-style binary CSV payload, decode it back
    with the same schema: the decode path at full table size."""
    payload = events.select(encode_csv(events.columns).cast("binary").alias("value"))
    return decode_csv(payload, events.schema)


def csv_malformed_roundtrip(events: DataFrame) -> DataFrame:
    """Decode damaged payloads: what does not parse is NULL, the rest intact,
    and every row is kept (PERMISSIVE)."""
    return decode_csv(damaged_lines(events), events.schema)


def match_file_names(lineitem: DataFrame) -> DataFrame:
    """Match-log file names derived from lineitem rows (with dots, extra
    ``_`` parts, spaces and version suffixes, to exercise the routing rule)."""
    l = F.col
    kind = (F.when(l("l_returnflag") == "A", "kills.v2")
            .when(l("l_returnflag") == "R", " damages ").otherwise("kills"))
    return lineitem.select(F.concat(
        F.lit("team_"), l("l_suppkey").cast("string"), F.lit(".vs_"),
        (l("l_partkey") % 7).cast("string"), F.lit("-m"), l("l_linenumber").cast("string"),
        F.lit("_"), kind, F.lit(".csv")).alias("file_name"))


def topic_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = match_file_names(read_table(spark, sf_dir, "lineitem"))
    return (files.groupBy("file_name", topic_for_file("file_name").alias("topic"))
            .agg(F.count("*").alias("events")))


def elapsed_seconds_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    tick = F.col("l_orderkey")
    return read_table(spark, sf_dir, "lineitem").select(
        tick.alias("tick"),
        elapsed_seconds(tick).alias("timestamp_seconds"),
        elapsed_seconds(tick, 7.8125).alias("timestamp_seconds_128"),
    )


def replay_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both event kinds as (topic, key, value) records, each topic in replay
    order.  Events are sorted first and encoded after, so that the sampling
    pass of the sort encodes nothing."""
    def records(events: DataFrame, topic: str) -> DataFrame:
        ordered = replay_order(events.withColumn("topic", F.lit(topic)), keys=("tick",))
        return to_payload(ordered, events.columns)

    return records(kills_view(spark, sf_dir), KILLS_TOPIC).unionByName(
        records(damages_view(spark, sf_dir), DAMAGES_TOPIC))


QUERIES: dict[str, Query] = {
    "player_kill_stats": _on_kills(ks.player_kill_stats),
    "player_kill_stats_joined": _on_kills(ks.player_kill_stats_joined),
    "kills_by_killer": _on_kills(ks.kills_by_killer),
    "deaths_by_victim": _on_kills(ks.deaths_by_victim),
    "assists_by_assister": _on_kills(ks.assists_by_assister),
    "player_identity": _on_kills(ks.player_identity),
    "damage_dealt": _on_damages(dmg.damage_dealt_rows),
    # 61 rounds: the default error of 5 % may be off by one, this one is exact there
    "player_damage_stats": _on_damages(lambda d: dmg.player_damage_stats(d, rsd=0.01)),
    "player_damage_stats_by_match": _on_damages(
        lambda d: dmg.player_damage_stats(d, exact=True, round_keys=("match_checksum", "round"))),
    "player_damage_stats_exact": _on_damages(lambda d: dmg.player_damage_stats(d, exact=True)),
    "csv_decode_kills": _on_kills(csv_roundtrip),
    "csv_decode_damages": _on_damages(lambda d: with_damage_dealt(csv_roundtrip(d))),
    "csv_decode_malformed": _on_kills(csv_malformed_roundtrip),
    "topic_routing": topic_routing,
    "elapsed_seconds": elapsed_seconds_query,
    "replay_payloads": replay_payloads,
    "player_stats_snapshots": snapshots,
}
QUERIES.update(STAGED_QUERIES)
