"""Replay path as Spark jobs: match-log rows -> (topic, key, value) records.

The replayer's per-line work becomes column expressions over a DataFrame of
any size: the topic comes from the file name, the time column from the tick
on a fixed replay clock, and the payload is the row re-encoded as one CSV
line.  Ordering by tick is a distributed range-partitioned sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NullType, StructField, StructType

from ..config import free_shuffles, scratch_path
from ..functions.decode import encode_csv
from ..functions.routing import DEFAULT_MS_PER_TICK, elapsed_seconds, raw_field, topic_for_file
from ..schemas import REPLAY_TIME_COLUMN
from ..sources.lines import LINE_ORDER

REPLAY_ORDER = ("tick", "file_name", "frame")
# Of raw lines, whose place in the file is known (see ``sources.lines``).
LINE_REPLAY_ORDER = ("tick", *LINE_ORDER)


def route_topic(df: DataFrame, file_col: str = "file_name", topic_col: str = "topic") -> DataFrame:
    """Add the topic each row's source file is routed to."""
    return df.withColumn(topic_col, topic_for_file(file_col))


def with_elapsed_seconds(
    df: DataFrame,
    tick_col: str = "tick",
    ms_per_tick: float = DEFAULT_MS_PER_TICK,
    out_col: str = REPLAY_TIME_COLUMN,
) -> DataFrame:
    """Append the replay time column (whole seconds since match start)."""
    return df.withColumn(out_col, elapsed_seconds(tick_col, ms_per_tick))


def replay_order(
    df: DataFrame,
    keys: Sequence[str | F.Column] = REPLAY_ORDER,
    by: Sequence[str] = (),
    num_partitions: int | None = None,
    rows_per_partition: int = 2_000_000,
) -> DataFrame:
    """Rows in replay order: by tick, then file, then frame (within ``by``,
    e.g. a match id).  A row's position inside its file is not exposed by
    the file readers, so ``frame`` stands in for line order.

    The sort is range-partitioned over all tasks.  A hash of the whole row is
    the last sort key: it makes the order total (identical keys no longer
    come out in arbitrary order) and lets the range partitioner split a hot
    key -- say tick 0 of many matches -- across tasks instead of sending it
    to one.  A full sort moves all the data, so the number of partitions
    follows the rows (counted first, which reads no column of a columnar
    table), not a setting.  Sort events before encoding them: the sampling
    pass of the range partitioner computes whatever lies below it once more.

    Keys may be expressions.  Those, and the hash, are computed on both sides of the
    shuffle and not sent: they take as much of it as the rows, and do not compress.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in (*by, *keys) if not isinstance(c, str) or c in df.columns]
    order = [*cols, F.xxhash64(*[F.col(c) for c in df.columns])]
    names = [f"_replay_key{i}" for i in range(len(order))]
    parts = num_partitions or max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_partition))
    ranged = df.repartitionByRange(parts, *order)
    return ranged.select("*", *[c.alias(n) for c, n in zip(order, names)]).sortWithinPartitions(*names).drop(*names)


def message_key(cols: Sequence[str], value: F.Column | None = None) -> F.Column:
    """``a:b:hash`` of the given columns, NULL as empty, so keys keep positions.

    A gap-free global counter would force all rows through one task; a key
    built from the row's own coordinates and 64 bits of the hash of its
    ``value`` is computed where the row lives.  Rows with different values
    get different keys; a record that is sent twice keeps its key.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    if value is not None:
        parts.append(F.substring(F.md5(value), 1, 16))
    return F.concat_ws(":", *parts)


def to_payload(
    df: DataFrame,
    value_cols: Sequence[str] | None = None,
    topic_col: str = "topic",
    key_cols: Sequence[str] = ("match_checksum", "tick"),
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(topic, key, value)`` records: value = the event columns as one CSV
    line (NULL as an empty field), key = :func:`message_key` of those of
    ``key_cols`` that there are and the value; ready for a topic sink.
    ``keep`` carries extra columns (e.g. ``tick`` for ordering) in front."""
    cols = list(value_cols) if value_cols is not None else [
        c for c in df.columns if c not in (topic_col, "file_name")
    ]
    lines = df.withColumn("_value", encode_csv(cols))
    return lines.select(
        *keep,
        F.col(topic_col).alias("topic"),
        message_key([c for c in key_cols if c in df.columns], F.col("_value")).alias("key"),
        F.col("_value").alias("value"),
    )


def with_running_number(df: DataFrame, order: Sequence[str], number_col: str = "number",
                        rows_per_partition: int = 500_000, keep: Sequence[str] | None = None) -> DataFrame:
    """The rows sorted by ``order`` and numbered 0, 1, ... along it.

    No task sees all rows: the sort is range-partitioned, each partition is written
    as a compressed file to the shared folder (so that counting and numbering speak of the
    same rows, also when an executor is lost in between), the rows of each file are
    counted, and a row's number is the count of all files before its own plus its place
    inside.  The driver holds one count for each file.  Rows that are equal
    get numbers of their own; where ``order`` leaves rows undecided, a hash of the
    whole row decides first.  Columns that only the order needs are left out of what
    is stored if ``keep`` names the others.
    """
    spark = df.sparkSession
    ordered = replay_order(df, keys=tuple(order), rows_per_partition=rows_per_partition)
    ordered = ordered.select(*(df.columns if keep is None else keep))
    # (by position: a file's columns may not share a name or be without a type)
    stored = ordered.toDF(*(f"c{i}" for i in range(len(ordered.columns))))
    typed = [f.name for f in stored.schema if not isinstance(f.dataType, NullType)]
    path = scratch_path(spark, "ordered-rows")
    stored.select(*typed, F.lit(True).alias("row")).write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(StructType([*(f for f in stored.schema if f.name in typed), StructField("row", BooleanType())])).parquet(path)
    del stored
    free_shuffles(spark)
    # A task's rows are one file, in their order, whatever the splits that it is read in.
    place = rows.select(*typed, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    counts = place.groupBy("_file").agg(F.count("*").alias("n")).collect()
    before, offsets = 0, []
    for row in sorted(counts, key=lambda r: int(r["_file"].split("-")[1])):
        offsets.append((row["_file"], before))
        before += row["n"]
    table = spark.createDataFrame(offsets, "_file string, _before long")
    numbered = place.join(F.broadcast(table), "_file")
    return numbered.select(
        *[(F.col(f"c{i}") if f"c{i}" in typed else F.lit(None)).alias(name) for i, name in enumerate(ordered.columns)],
        (F.col("_before") + F.col("_place")).alias(number_col))


def replay_messages(lines: DataFrame, ms_per_tick: float = DEFAULT_MS_PER_TICK, rows_per_partition: int = 500_000) -> DataFrame:
    """``number, topic, key, value`` of raw match-log lines (with their place, see
    :func:`fragstat.sources.lines.read_numbered_lines`), in the order of a replay:
    tick by tick, in each tick file by file, in each file line by line.

    The tick is the second field of the line, the value the line as it is with the
    replay clock's seconds appended, the key the running number of the message.  A
    line without a tick (blank ones, say) cannot be replayed and gives no message;
    :func:`unplayable_lines` has those.  A file whose ticks do not rise is sorted
    by tick.
    """
    ticked = lines.withColumn("tick", raw_field("line", 1, "int")).where("tick IS NOT NULL")
    numbered = with_running_number(ticked, LINE_REPLAY_ORDER, rows_per_partition=rows_per_partition,
                                   keep=("tick", "file_name", "line"))
    seconds = elapsed_seconds("tick", ms_per_tick).cast("string")
    return numbered.select(
        "number", topic_for_file("file_name").alias("topic"), F.col("number").cast("string").alias("key"),
        F.concat("line", F.lit(","), seconds).alias("value"))


def unplayable_lines(lines: DataFrame) -> DataFrame:
    """The lines that have no tick, with their place."""
    return lines.where(raw_field("line", 1, "int").isNull())
