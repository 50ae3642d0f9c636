"""Streaming statistics jobs: event stream -> per-batch stats -> result table.

Each micro-batch is handled as a static DataFrame in ``foreachBatch``: the
statistics operator runs on it and the sink writes the result stamped with
the batch id.  The stream itself has no aggregate, so no state store is
kept; progress lives in the checkpoint, which must be on shared storage so
a restarted driver or a lost executor resumes at the last committed batch.
With the table sink the rows of a batch that is run again take the place of the
former ones for every reader.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from ..config import scratch_path
from ..operators.damage_stats import player_damage_stats
from ..operators.kill_stats import player_kill_stats
from ..schemas import EVENT_SCHEMAS, nullable
from ..sources.topic import decode_events

CORRUPT_COLUMN = "corrupt"
BAD_COLUMN = "is_bad"

Sink = Callable[[DataFrame, int], None]
Compute = Callable[[DataFrame], DataFrame]


def batch_handler(compute: Compute, sink: Sink) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: skip empty batches, else compute and write."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        sink(compute(batch), batch_id)
    return handle


def start_stats_stream(
    events: DataFrame,
    compute: Compute,
    sink: Sink,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start one statistics query.  ``trigger`` is passed to
    ``DataStreamWriter.trigger`` (e.g. ``{"availableNow": True}`` for a
    backfill); unset runs the next batch as soon as the last one ends."""
    writer = (
        events.writeStream.foreachBatch(batch_handler(compute, sink))
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_kill_stats(kills: DataFrame, sink: Sink, checkpoint: str, **kwargs) -> StreamingQuery:
    """Kill events -> per-batch ``player_stats``."""
    return start_stats_stream(kills, player_kill_stats, sink, checkpoint, **kwargs)


def start_damage_stats(damages: DataFrame, sink: Sink, checkpoint: str, exact: bool = False, **kwargs) -> StreamingQuery:
    """Damage events -> per-batch ``player_damage_stats``."""
    return start_stats_stream(
        damages, lambda df: player_damage_stats(df, exact=exact), sink, checkpoint, **kwargs
    )


def start_quarantine(records: DataFrame, kind: str, sink: Sink, checkpoint: str, **kwargs) -> StreamingQuery:
    """Topic records -> decoded events of ``kind``, with the lines that do not parse
    kept aside.  Each batch is read and decoded once and written under one write id:
    ``is_bad`` tells good rows (``corrupt`` is NULL) from bad ones (``corrupt`` is the
    whole line).  A sink that splits by ``is_bad`` keeps them in folders of their own."""
    def decode(batch: DataFrame) -> DataFrame:
        events = decode_events(batch, kind, corrupt_col=CORRUPT_COLUMN)
        return events.withColumn(BAD_COLUMN, F.col(CORRUPT_COLUMN).isNotNull())
    return start_stats_stream(records, decode, sink, checkpoint, **kwargs)


def quarantine_schema(kind: str) -> StructType:
    """What :func:`start_quarantine` writes."""
    fields = list(nullable(EVENT_SCHEMAS[kind]).fields) + [StructField(CORRUPT_COLUMN, StringType())]
    if kind == "damages":
        fields.append(StructField("damage_dealt", IntegerType()))
    return StructType([*fields, StructField(BAD_COLUMN, BooleanType())])


@contextlib.contextmanager
def in_pool(spark: SparkSession, pool: str):
    """Jobs of queries started here run in a scheduler pool of their own.  Under
    ``spark.scheduler.mode=FAIR`` pools share the cluster evenly; else this changes
    nothing."""
    context = spark.sparkContext
    before = context.getLocalProperty("spark.scheduler.pool")
    context.setLocalProperty("spark.scheduler.pool", pool)
    try:
        yield
    finally:
        context.setLocalProperty("spark.scheduler.pool", before)


def checkpoint_for(spark: SparkSession, query: str, location: str | None = None) -> str:
    """Checkpoint folder of a named query: under ``location`` if given, else
    under ``spark.sql.streaming.checkpointLocation`` or the session's shared
    checkpoint root.  Stable per name, so a restart resumes."""
    base = location or spark.conf.get("spark.sql.streaming.checkpointLocation", None)
    if base:
        return f"{base.rstrip('/')}/{query}"
    return scratch_path(spark, "streams", query, unique=False)


def run_match_stats(
    spark: SparkSession,
    kills: DataFrame,
    damages: DataFrame,
    kills_sink: Sink,
    damages_sink: Sink,
    checkpoint_location: str | None = None,
    trigger: dict | None = None,
    wait: bool = True,
    exact_rounds: bool = False,
) -> list[StreamingQuery]:
    """Both statistics queries side by side, each in a scheduler pool of its own.

    With ``wait`` and a finite trigger (``availableNow``, ``once``) this
    returns when both have worked off their input; without one the queries
    run on until one of them is stopped or fails, and the other is stopped
    then.  An error in either surfaces here, after the other has ended.
    """
    spark.streams.resetTerminated()  # queries that ended earlier in this session do not count
    queries = []
    with in_pool(spark, "kills"):
        queries.append(start_kill_stats(
            kills, kills_sink, checkpoint_for(spark, "kills", checkpoint_location), trigger=trigger, name="player_stats"))
    with in_pool(spark, "damages"):
        queries.append(start_damage_stats(
            damages, damages_sink, checkpoint_for(spark, "damages", checkpoint_location), exact=exact_rounds,
            trigger=trigger, name="player_damage_stats"))
    if wait:
        _wait(spark, queries, finite=bool(trigger) and not trigger.keys() & {"processingTime", "continuous"})
    return queries


def _wait(spark: SparkSession, queries: list[StreamingQuery], finite: bool) -> None:
    if not finite:
        # Other queries of the session may end as well: go on until one of ours has.
        while all(q.isActive for q in queries):
            with contextlib.suppress(StreamingQueryException):
                spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for query in queries:
            query.stop()
    errors = []
    for query in queries:
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            errors.append(error)
    if errors:
        raise errors[0]
