"""Result-table sink: append-only writes, of which readers keep the latest.

A write of a batch first appends its rows, stamped with ``batch_id``,
``recorded_at`` and the ``write_id`` of the write; when they are all there, a
second append adds one marker row for each batch.  The marker proves the write:
rows without one are of a write that is still going on, or that broke off, and no
reader sees them.  Nothing is replaced on disk.  :func:`latest_per_batch` keeps, of
each batch, the rows of its latest marked write, so a micro-batch that is run
again after a failure, or a backfill that is repeated, counts once -- also when
the batch has become empty, for which the marker alone stands.

The table is partitioned by the date of the write: the number of folders
follows the days, not the batches.  :func:`compact` rewrites a table into few
files of latest rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, LongType, StringType, StructField, StructType, TimestampType

BATCH_COLUMN = "batch_id"
RECORDED_AT = "recorded_at"
WRITE_ID = "write_id"
MARKER = "is_marker"
DATE_PARTITION = "recorded_date"


def stamp(df: DataFrame, batch_id: int | None = None, at: Column | None = None) -> DataFrame:
    """Add ``recorded_at`` (one value per write, the time now or ``at``) and, if
    given, ``batch_id``."""
    out = df.withColumn(RECORDED_AT, F.current_timestamp() if at is None else at)
    if batch_id is not None:
        out = out.withColumn(BATCH_COLUMN, F.lit(int(batch_id)).cast("long"))
    return out


def table_schema(result: StructType) -> StructType:
    """Layout of a stored table: the result columns and what a write adds."""
    return StructType([
        *result.fields,
        StructField(BATCH_COLUMN, LongType(), True),
        StructField(MARKER, BooleanType(), True),
        StructField(WRITE_ID, StringType(), True),
        StructField(RECORDED_AT, TimestampType(), True),
        StructField(DATE_PARTITION, DateType(), True),
    ])


def _append(df: DataFrame, path: str, fmt: str, write_id: str, marker: bool, split_by: Sequence[str] = (),
            at: Column | None = None) -> None:
    stamped = stamp(df, at=at).withColumns({MARKER: F.lit(marker), WRITE_ID: F.lit(write_id)})
    dated = stamped.withColumn(DATE_PARTITION, F.to_date(RECORDED_AT))
    dated.write.mode("append").partitionBy(DATE_PARTITION, *split_by).format(fmt).save(path)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet", split_by: Sequence[str] = (),
                at: Column | None = None) -> str:
    """First half of a write: append rows that carry ``batch_id``.  Returns the
    write's id, which :func:`mark_written` makes them count with."""
    write_id = uuid.uuid4().hex
    _append(df, path, fmt, write_id, False, split_by, at)
    return write_id


def mark_written(batches: DataFrame, path: str, write_id: str, fmt: str = "parquet", split_by: Sequence[str] = (),
                 at: Column | None = None) -> None:
    """Second half: from now on the rows of this write stand for these batches
    (a frame with ``batch_id``)."""
    markers = batches.select(F.col(BATCH_COLUMN).cast("long").alias(BATCH_COLUMN), *[F.lit(None).cast("boolean").alias(c) for c in split_by])
    _append(markers, path, fmt, write_id, True, split_by, at)


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet", split_by: Sequence[str] = ()) -> None:
    """Append one batch's result; it stands for the batch from now on.  Boolean
    columns named in ``split_by`` become folders, so that one job fills several
    stores under one write id."""
    batch = F.lit(int(batch_id)).cast("long")
    write_id = append_rows(df.withColumn(BATCH_COLUMN, batch), path, fmt, split_by)
    mark_written(df.sparkSession.range(1).select(batch.alias(BATCH_COLUMN)), path, write_id, fmt, split_by)


def _batches_of(spark: SparkSession, path: str, write_id: str, fmt: str) -> DataFrame:
    """The batches that a write has put rows of into the table."""
    schema = StructType([StructField(BATCH_COLUMN, LongType()), StructField(WRITE_ID, StringType()), StructField(MARKER, BooleanType())])
    rows = spark.read.schema(schema).format(fmt).load(path)
    return rows.where((F.col(WRITE_ID) == write_id) & ~F.col(MARKER)).select(BATCH_COLUMN)


def write_batches(df: DataFrame, path: str, fmt: str = "parquet", order: tuple[str, ...] = ("player_id",),
                  batches: DataFrame | None = None, at: Column | None = None) -> None:
    """Backfill: append rows that already carry ``batch_id``, for many batches,
    in one job.

    ``batches`` (a frame with ``batch_id``) names all batches that the backfill
    covers, so that those without rows are emptied; by default they are the
    batches in ``df``.  The input is computed once: rows are written by the tasks
    that made them, each sorting its own by ``(batch_id, *order)``, and the markers
    are taken from what was written.  ``at`` is the time of the write, if not now.
    """
    spark = df.sparkSession
    keys = [BATCH_COLUMN, *[c for c in order if c in df.columns]]
    write_id = append_rows(df.sortWithinPartitions(*keys), path, fmt, at=at)
    covered = _batches_of(spark, path, write_id, fmt)
    if batches is not None:
        covered = covered.unionByName(batches.select(F.col(BATCH_COLUMN).cast("long").alias(BATCH_COLUMN)))
    mark_written(covered.distinct(), path, write_id, fmt, at=at)


def table_sink(path: str, fmt: str = "parquet", split_by: Sequence[str] = ()):
    """``(df, batch_id) -> None`` writer for :mod:`fragstat.streaming`."""
    def sink(df: DataFrame, batch_id: int) -> None:
        write_batch(df, path, batch_id, fmt, split_by)
    return sink


def latest_writes(written: DataFrame) -> DataFrame:
    """``batch_id, write_id, recorded_at`` of the latest marked write of each batch
    (by the marker's time, then by id); from the markers alone."""
    last = written.where(F.col(MARKER)).groupBy(BATCH_COLUMN).agg(F.max(F.struct(RECORDED_AT, WRITE_ID)).alias("_last"))
    return last.select(BATCH_COLUMN, f"_last.{WRITE_ID}", f"_last.{RECORDED_AT}")


def latest_per_batch(df: DataFrame) -> DataFrame:
    """Of each batch the rows of its latest write, without marker rows; for any
    append sink.

    Where there are markers, only marked writes count.  A sink without them has the
    latest ``recorded_at`` of each batch (then the latest ``write_id``, if there is
    one).  The latest write is one row of some 100 bytes per batch from a partial
    aggregation.  It is sent to the rows, which do not move: a batch can hold any number
    of rows, and a join on the batch would bring them to one task.
    """
    if MARKER in df.columns and WRITE_ID in df.columns:
        last = latest_writes(df).select(F.col(BATCH_COLUMN).alias("_batch"), F.col(WRITE_ID).alias("_write"))
        same = F.col(BATCH_COLUMN).eqNullSafe(F.col("_batch")) & (F.col(WRITE_ID) == F.col("_write"))
        return df.where(~F.col(MARKER)).join(F.broadcast(last), same).drop("_batch", "_write")
    order = F.struct(*[c for c in (RECORDED_AT, WRITE_ID) if c in df.columns])
    latest = df.groupBy(BATCH_COLUMN).agg(F.max(order).alias("_latest"))
    return df.join(F.broadcast(latest), BATCH_COLUMN).where(order == F.col("_latest")).drop("_latest")


def read_written(spark: SparkSession, path: str, result: StructType, fmt: str = "parquet") -> DataFrame:
    """Everything ever written to the table, markers included; an empty frame
    before the first write."""
    schema = table_schema(result)
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return spark.createDataFrame([], schema)


def read_result_table(spark: SparkSession, path: str, result: StructType, fmt: str = "parquet") -> DataFrame:
    """The table as readers see it: result columns, ``batch_id`` and
    ``recorded_at`` of each batch's latest write."""
    rows = latest_per_batch(read_written(spark, path, result, fmt))
    return rows.select(*result.fieldNames(), BATCH_COLUMN, RECORDED_AT)


def compact(spark: SparkSession, path: str, target: str, result: StructType, fmt: str = "parquet",
            rows_per_file: int = 5_000_000) -> None:
    """Write the latest rows of the table, and a marker for each batch, to the
    new folder ``target`` in files of up to ``rows_per_file`` rows, sorted by
    batch.  Switch readers and writers to it, then drop the old folder."""
    written = read_written(spark, path, result, fmt)
    rows = latest_per_batch(written)
    parts = max(1, -(-rows.count() // rows_per_file))
    (
        rows.repartitionByRange(parts, BATCH_COLUMN, *result.fieldNames()[:1])
        .sortWithinPartitions(BATCH_COLUMN)
        .write.mode("errorifexists").partitionBy(DATE_PARTITION).format(fmt).save(target)
    )
    last = latest_writes(written).withColumns({MARKER: F.lit(True), DATE_PARTITION: F.to_date(RECORDED_AT)})
    last.write.mode("append").partitionBy(DATE_PARTITION).format(fmt).save(target)
