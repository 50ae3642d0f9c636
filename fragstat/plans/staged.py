"""Registered queries that go through storage: events derived from the test
tables are written as match-log files or topic-log records under the
session's shared checkpoint folder, then read back by the real sources --
in batch, or as a stream through ``foreachBatch`` into the result table.
"""

from __future__ import annotations

import contextlib
from datetime import date, datetime, time

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import free_shuffles, scratch_path
from ..functions.decode import decode_csv, encode_csv
from ..functions.routing import raw_field
from ..operators import dashboards as dash
from ..operators.damage_stats import merged_damage_stats, player_damage_sketches
from ..operators.kill_stats import player_kill_stats, player_stats_snapshots, with_snapshot_id
from ..operators.replay import replay_messages, to_payload, unplayable_lines
from ..schemas import KILLS_TOPIC, PLAYER_DAMAGE_SKETCHES, PLAYER_DAMAGE_STATS, PLAYER_STATS, REPLAY_TIME_COLUMN
from ..sinks.matchlog import WRITTEN_FILES, write_match_logs, write_ordered_lines
from ..sinks.rollup import roll_up, rolled_totals, rolled_trend
from ..sinks.table import BATCH_COLUMN, RECORDED_AT, append_rows, read_result_table, table_sink, write_batches
from ..sinks.topic import append_topic_log
from ..sources.files import read_lines, read_match_logs, read_roster
from ..sources.lines import read_numbered_lines, with_line_numbers
from ..sources.testviews import damages_view, kills_view, read_table
from ..sources.topic import decode_events, read_topic_log
from ..streaming.jobs import (BAD_COLUMN, CORRUPT_COLUMN, quarantine_schema, run_match_stats, start_damage_stats,
                              start_kill_stats, start_quarantine, start_stats_stream)
from .malformed import damaged_lines

SNAPSHOT_SECONDS = 10


def stage_match_logs(spark: SparkSession, events: DataFrame, kind: str) -> str:
    folder = scratch_path(spark, "matchlogs", kind)
    write_match_logs(events, folder)
    return folder


def match_log_kills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kill events through a match-log folder and back (batch source)."""
    folder = stage_match_logs(spark, kills_view(spark, sf_dir), "kills")
    return read_match_logs(spark, folder, "kills", glob=WRITTEN_FILES, topic=KILLS_TOPIC).drop("file_name")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw, unparsed lines of the kill match-log files (headers dropped),
    with the tick split out of each line without CSV parsing."""
    folder = stage_match_logs(spark, kills_view(spark, sf_dir), "kills")
    lines = read_lines(spark, folder, glob=WRITTEN_FILES)
    return lines.select("line", raw_field("line", 1, "int").alias("tick"))


def line_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines of both event kinds with the match file that each belongs to and
    its place there (by tick, then by a digest of the line).  Lines of every
    3rd tick are followed by empty lines, of every 5th by lines of blanks; those alone carry the digest."""
    parts = []
    for kind, events in (("kills", kills_view(spark, sf_dir)), ("damages", damages_view(spark, sf_dir))):
        cols = [c for c in events.columns if c != REPLAY_TIME_COLUMN]
        parts.append(events.select(
            F.concat("match_checksum", F.lit(f"_{kind}.csv")).alias("file_name"), "tick", encode_csv(cols).alias("line")))
    lines = parts[0].unionByName(parts[1]).withColumn("digest", F.unhex(F.md5("line")))
    blank = F.when(F.col("tick") % 3 == 0, F.lit("")).when(F.col("tick") % 5 == 0, F.lit("  "))
    # (how many lines an event gives is told by its tick alone: counting encodes nothing)
    places = F.explode(F.when(blank.isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1))))
    both = lines.select("file_name", "tick", "digest", "line", places.alias("follows"))
    return both.select("file_name", "tick", F.when(F.col("follows") == 1, F.col("digest")).alias("digest"), "follows", F.when(F.col("follows") == 1, blank).otherwise(F.col("line")).alias("line"))


def stage_line_files(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch_path(spark, "matchlogs", "ordered")
    write_ordered_lines(
        line_files(spark, sf_dir), folder, "frame,tick,round",
        ("tick", F.coalesce("digest", F.unhex(F.md5("line"))), "follows"), sent=("tick", "digest", "follows"), lines_per_part=20_000)
    free_shuffles(spark)
    return folder


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of both kinds' match files, blank ones too, with its number in
    its file."""
    lines = read_numbered_lines(spark, stage_line_files(spark, sf_dir))
    return with_line_numbers(lines).select("file_name", "line_number", "line")


def replay_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replay of both kinds' match files as numbered messages."""
    return replay_messages(read_numbered_lines(spark, stage_line_files(spark, sf_dir)))


def replay_unplayable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines of each file the replay cannot send."""
    lines = read_numbered_lines(spark, stage_line_files(spark, sf_dir))
    return unplayable_lines(lines).groupBy("file_name", "line").agg(F.count("*").alias("n_lines"))


def roster_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of roster files: ``steamid,name`` per supplier row."""
    folder = scratch_path(spark, "matchlogs", "players")
    players = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("steamid"), F.col("s_name").alias("name"))
    write_match_logs(players, folder)
    return read_roster(spark, folder, glob=WRITTEN_FILES).select("line")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return player_stats_snapshots(kills_view(spark, sf_dir), SNAPSHOT_SECONDS)


def stored_player_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every snapshot written to the result table in one job, then read back
    as the dashboards read it."""
    table = scratch_path(spark, "tables", "player_stats_backfill")
    write_batches(snapshots(spark, sf_dir), table)
    return read_result_table(spark, table, PLAYER_STATS)


def backfill_player_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_player_stats(spark, sf_dir).drop(RECORDED_AT)


def kd_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend panel over the stored table."""
    return dash.kd_trend(stored_player_stats(spark, sf_dir))


def player_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals panel over the stored table."""
    return dash.player_totals(stored_player_stats(spark, sf_dir))


def retried_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals panel over a table to which every batch was written, and
    some batches once more, as after a failure."""
    table = scratch_path(spark, "tables", "player_stats_retried")
    rows = snapshots(spark, sf_dir)
    write_batches(rows, table)
    write_batches(rows.where(F.col(BATCH_COLUMN) % 3 == 0), table)
    return dash.player_totals(read_result_table(spark, table, PLAYER_STATS))


def _finish_stream(spark: SparkSession, query, table: str, schema) -> DataFrame:
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))
    return read_result_table(spark, table, schema).drop(RECORDED_AT)


def _kill_records(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    kills = kills_view(spark, sf_dir)
    return to_payload(kills.withColumn("topic", F.lit(KILLS_TOPIC)), kills.columns, keep=keep)


def stream_kill_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kill events as topic records -> stream -> decode -> per-batch stats
    -> result table (all pending records in one ``availableNow`` batch)."""
    log = scratch_path(spark, "topiclog")
    append_topic_log(_kill_records(spark, sf_dir), log)
    stream = decode_events(read_topic_log(spark, log, KILLS_TOPIC), "kills")
    table = scratch_path(spark, "tables", "player_stats")
    query = start_kill_stats(
        stream, table_sink(table), scratch_path(spark, "streams", "kills"),
        trigger={"availableNow": True},
    )
    return _finish_stream(spark, query, table, PLAYER_STATS)


def _log_by_match(spark: SparkSession, sf_dir: str) -> str:
    """The kills as a topic log with one file for each match."""
    log = scratch_path(spark, "topiclog-by-match")
    records = _kill_records(spark, sf_dir, keep=("match_checksum",))
    append_topic_log(records.repartition("match_checksum"), log, by=("match_checksum",))
    return log


def _share_of(spark: SparkSession, log: str, parts: int) -> int:
    """Bytes of a topic log's files, divided into ``parts``; from the list of files alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(log).select("length")
    return max(1, (files.agg(F.sum("length")).first()[0] or 0) // parts)


def _kill_stats_by_match(kills: DataFrame) -> DataFrame:
    return player_kill_stats(kills, by=["match_checksum"]).drop("match_checksum")


def stream_kill_stats_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of each match, in several micro-batches of a bounded number of
    bytes: one file for each match, many files in a batch, read in parallel.  Batch
    numbers follow the files' order and are left out."""
    log = _log_by_match(spark, sf_dir)
    stream = decode_events(
        read_topic_log(spark, log, KILLS_TOPIC, max_bytes_per_trigger=_share_of(spark, log, 3)), "kills")
    table = scratch_path(spark, "tables", "player_stats_by_match")
    query = start_stats_stream(
        stream, _kill_stats_by_match, table_sink(table), scratch_path(spark, "streams", "kills-by-match"),
        trigger={"availableNow": True},
    )
    return _finish_stream(spark, query, table, PLAYER_STATS).drop(BATCH_COLUMN)


class _Interrupted(Exception):
    """Ends a stream on purpose."""


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of each match again, by a stream that breaks off in its second
    batch -- its rows are in the table, their marker is not -- and goes on from
    the checkpoint in a second run."""
    log = _log_by_match(spark, sf_dir)
    table = scratch_path(spark, "tables", "player_stats_restarted")
    checkpoint = scratch_path(spark, "streams", "kills-restarted")
    share = _share_of(spark, log, 3)

    def breaking(df: DataFrame, batch_id: int) -> None:
        if batch_id == 0:
            table_sink(table)(df, batch_id)
        else:
            append_rows(df.withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long")), table)
            raise _Interrupted(f"batch {batch_id}")

    def start(sink):
        records = read_topic_log(spark, log, KILLS_TOPIC, max_bytes_per_trigger=share)
        return start_stats_stream(decode_events(records, "kills"), _kill_stats_by_match, sink, checkpoint,
                                  trigger={"availableNow": True})

    with contextlib.suppress(StreamingQueryException):  # the second run meets any other error again
        start(breaking).awaitTermination()
    return _finish_stream(spark, start(table_sink(table)), table, PLAYER_STATS).drop(BATCH_COLUMN)


def stream_match_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both streams in one run, side by side, into their two tables; one row for
    each player that is in either."""
    kills = stage_match_logs(spark, kills_view(spark, sf_dir), "kills")
    damages = stage_match_logs(spark, damages_view(spark, sf_dir), "damages")
    tables = [scratch_path(spark, "tables", name) for name in ("both_kills", "both_damages")]
    run_match_stats(
        spark, *[read_match_logs(spark, folder, kind, streaming=True, glob=WRITTEN_FILES)
                 for folder, kind in ((kills, "kills"), (damages, "damages"))],
        *map(table_sink, tables), checkpoint_location=scratch_path(spark, "streams", "both"),
        trigger={"availableNow": True}, exact_rounds=True)
    stats = read_result_table(spark, tables[0], PLAYER_STATS).select(
        F.col("player_id").alias("killer"), "player_name", "kills", "deaths", "assists")
    damage = read_result_table(spark, tables[1], PLAYER_DAMAGE_STATS).select("player_id", "total_damage", "rounds")
    both = stats.join(damage, F.col("killer").eqNullSafe(F.col("player_id")), "full")
    return both.select(F.coalesce("killer", "player_id").alias("player_id"), "player_name", "kills", "deaths", "assists",
                       "total_damage", "rounds")


def _quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged kill payloads as a topic log -> stream -> good and bad rows."""
    log = scratch_path(spark, "topiclog-damaged")
    lines = damaged_lines(kills_view(spark, sf_dir))
    append_topic_log(lines.select(F.lit(KILLS_TOPIC).alias("topic"), F.lit(None).cast("string").alias("key"), "value"), log)
    table = scratch_path(spark, "tables", "quarantined")
    query = start_quarantine(read_topic_log(spark, log, KILLS_TOPIC), "kills", table_sink(table, split_by=(BAD_COLUMN,)),
                             scratch_path(spark, "streams", "quarantine"), trigger={"availableNow": True})
    return _finish_stream(spark, query, table, quarantine_schema("kills")).drop(BATCH_COLUMN)


def stream_quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of the lines that parse."""
    return _quarantined(spark, sf_dir).where(f"NOT {BAD_COLUMN}").drop(BAD_COLUMN, CORRUPT_COLUMN)


def stream_quarantine_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that do not, whole."""
    return _quarantined(spark, sf_dir).where(BAD_COLUMN).select(CORRUPT_COLUMN)


def damage_rounds_over_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage statistics over all stored batches: each batch stores a sketch of its
    rounds, and the sketches are merged.  (Adding up the rounds of the batches would
    count a round once for each of them.)"""
    table = scratch_path(spark, "tables", "player_damage_sketches")
    batches = with_snapshot_id(damages_view(spark, sf_dir), SNAPSHOT_SECONDS)
    write_batches(player_damage_sketches(batches, by=[BATCH_COLUMN]), table)
    return merged_damage_stats(read_result_table(spark, table, PLAYER_DAMAGE_SKETCHES))


def _rolled_table(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A result table written over five days, of which four are rolled up in two
    goes; some batches are written again on later days, a rolled and an open one."""
    table, rollup = (scratch_path(spark, "tables", name) for name in ("player_stats_daily", "player_stats_rollup"))
    rows = snapshots(spark, sf_dir)
    days = [date(2024, 5, d) for d in range(1, 6)]

    def write(which: DataFrame, day: date) -> None:
        write_batches(which, table, at=F.lit(datetime.combine(day, time(12))).cast("timestamp"))

    part = F.col(BATCH_COLUMN) % 5
    for number, day in enumerate(days[:2]):
        # the first write of these batches is faulty, the second one counts
        write(rows.where(part == number).withColumn("kills", F.col("kills") + 7), day)
    roll_up(spark, table, rollup, PLAYER_STATS, until=days[2])
    write(rows.where((part == 2) | ((part == 0) & (F.col(BATCH_COLUMN) % 2 == 0))), days[2])
    write(rows.where(part == 3), days[3])
    roll_up(spark, table, rollup, PLAYER_STATS, until=days[4])
    write(rows.where((part == 4) | (part == 1) | ((part == 0) & (F.col(BATCH_COLUMN) % 2 == 1))), days[4])
    return table, rollup


def player_totals_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals panel from closed days' sums and the open day's rows."""
    return rolled_totals(spark, *_rolled_table(spark, sf_dir), PLAYER_STATS)


def kd_trend_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend panel from closed days' points and the open day's rows."""
    return rolled_trend(spark, *_rolled_table(spark, sf_dir), PLAYER_STATS)


def stream_damage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage match-log files -> file stream -> per-batch stats -> table."""
    folder = stage_match_logs(spark, damages_view(spark, sf_dir), "damages")
    stream = read_match_logs(spark, folder, "damages", streaming=True, glob=WRITTEN_FILES)
    table = scratch_path(spark, "tables", "player_damage_stats")
    query = start_damage_stats(
        stream, table_sink(table), scratch_path(spark, "streams", "damages"), exact=True,
        trigger={"availableNow": True},
    )
    return _finish_stream(spark, query, table, PLAYER_DAMAGE_STATS)


def csv_decode_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the decoder keeps aside: the damaged lines, whole."""
    kills = kills_view(spark, sf_dir)
    decoded = decode_csv(damaged_lines(kills), kills.schema, corrupt_col="corrupt")
    return decoded.select("corrupt").where(F.col("corrupt").isNotNull())


STAGED_QUERIES = {
    "match_log_kills": match_log_kills,
    "raw_lines": raw_lines,
    "numbered_lines": numbered_lines,
    "replay_numbered": replay_numbered,
    "replay_unplayable": replay_unplayable,
    "roster_lines": roster_lines,
    "backfill_player_stats": backfill_player_stats,
    "kd_trend": kd_trend,
    "player_totals": player_totals,
    "retried_batches": retried_batches,
    "stream_kill_stats": stream_kill_stats,
    "stream_kill_stats_per_file": stream_kill_stats_per_file,
    "stream_damage_stats": stream_damage_stats,
    "stream_restart": stream_restart,
    "stream_match_stats": stream_match_stats,
    "stream_quarantine_good": stream_quarantine_good,
    "stream_quarantine_bad": stream_quarantine_bad,
    "damage_rounds_over_batches": damage_rounds_over_batches,
    "player_totals_rolled": player_totals_rolled,
    "kd_trend_rolled": kd_trend_rolled,
    "csv_decode_quarantine": csv_decode_quarantine,
}
