"""Closed days of the result table, summed once for the dashboards.

A refresh of the panels should not read the whole history again.  :func:`roll_up`
sums each closed day of a result table once: totals by player, the trend's points
with how often each occurs, and which write of which batch they stand for.
:func:`rolled_totals` and :func:`rolled_trend` add the days since to that.  When a
batch of a rolled day has been written again later, its old rows are taken off
again; only then, and only those days of the table, are read once more.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dashboards import HEADSHOT_TOTAL_COLUMN
from .table import BATCH_COLUMN, DATE_PARTITION, MARKER, RECORDED_AT, WRITE_ID, latest_per_batch, latest_writes, read_written

SUMS = ("kills", "deaths", "assists", "kd_cents", "headshot_cents", "snapshots")
TOTALS_DDL = "player_name string, " + ", ".join(f"{c} bigint" for c in SUMS) + f", {DATE_PARTITION} date"
POINTS_DDL = f"kd_ratio double, timestamp_seconds bigint, n bigint, {DATE_PARTITION} date"
WRITES_DDL = f"{BATCH_COLUMN} bigint, {WRITE_ID} string, {RECORDED_AT} timestamp, {DATE_PARTITION} date"


def _read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return spark.createDataFrame([], ddl)


def _totals(rows: DataFrame, *by: str) -> DataFrame:
    """Exact sums by player; the ratios in whole hundredths."""
    cents = {"kd_cents": "kd_ratio", "headshot_cents": "headshot_percentage"}
    return rows.where("player_name IS NOT NULL").groupBy(*by, "player_name").agg(
        *[F.sum(c).alias(c) for c in ("kills", "deaths", "assists")],
        *[F.sum(F.round(F.col(c) * 100).cast("long")).alias(name) for name, c in cents.items()],
        F.count("*").alias("snapshots"))


def _points(rows: DataFrame, *by: str) -> DataFrame:
    return rows.where("timestamp_seconds IS NOT NULL").groupBy(*by, "kd_ratio", "timestamp_seconds").agg(F.count("*").alias("n"))


def rolled_until(spark: SparkSession, rollup: str) -> date | None:
    """The last day that is rolled up."""
    return _read(spark, f"{rollup}/writes", WRITES_DDL).agg(F.max(DATE_PARTITION)).first()[0]


def roll_up(spark: SparkSession, table: str, rollup: str, result: StructType, until: date) -> None:
    """Sum all days before ``until`` that are not rolled up yet into the folder
    ``rollup``.  A day may be rolled up once no write of it can still be under way.

    The list of writes is written last: days that are not in it do not count, so a
    roll-up that broke off is simply run again.
    """
    last = rolled_until(spark, rollup)
    written = read_written(spark, table, result).where(F.col(DATE_PARTITION) < F.lit(until))
    if last is not None:
        written = written.where(F.col(DATE_PARTITION) > F.lit(last))
    rows = latest_per_batch(written)
    for name, summed in (("totals", _totals(rows, DATE_PARTITION)), ("points", _points(rows, DATE_PARTITION))):
        (summed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(DATE_PARTITION).parquet(f"{rollup}/{name}"))
    (latest_writes(written).withColumn(DATE_PARTITION, F.to_date(RECORDED_AT))
     .write.mode("append").partitionBy(DATE_PARTITION).parquet(f"{rollup}/writes"))


def _parts(spark: SparkSession, table: str, rollup: str, result: StructType) -> tuple[date | None, DataFrame, DataFrame | None]:
    """The last rolled day, the rows that count since, and the rows of rolled days
    that count no more (None if there are none, as is usual)."""
    last = rolled_until(spark, rollup)
    written = read_written(spark, table, result)
    if last is None:
        return None, latest_per_batch(written), None
    rolled = _read(spark, f"{rollup}/writes", WRITES_DDL)
    open_days = written.where(F.col(DATE_PARTITION) > F.lit(last))
    both = rolled.select(BATCH_COLUMN, RECORDED_AT, WRITE_ID).unionByName(
        latest_writes(open_days).select(BATCH_COLUMN, RECORDED_AT, WRITE_ID))
    newest = both.groupBy(BATCH_COLUMN).agg(F.max(F.struct(RECORDED_AT, WRITE_ID)).alias("_newest")).select(
        F.col(BATCH_COLUMN).alias("_batch"), F.col(f"_newest.{WRITE_ID}").alias("_write"))
    replaced = rolled.join(newest, (F.col(BATCH_COLUMN) == F.col("_batch")) & (F.col(WRITE_ID) != F.col("_write")))
    days = [r[0] for r in replaced.select(DATE_PARTITION).distinct().collect()]
    if not days:
        return last, latest_per_batch(open_days), None
    old = replaced.select(F.col(BATCH_COLUMN).alias("_old_batch"), F.col(WRITE_ID).alias("_old_write"))
    gone = written.where(F.col(DATE_PARTITION).isin(days) & ~F.col(MARKER)).join(
        F.broadcast(old), (F.col(BATCH_COLUMN) == F.col("_old_batch")) & (F.col(WRITE_ID) == F.col("_old_write")))
    return last, latest_per_batch(open_days), gone


def _together(spark: SparkSession, stored: str, ddl: str, last: date | None, since: DataFrame, gone: DataFrame | None,
              counts: tuple[str, ...]) -> DataFrame:
    frames = [since]
    if last is not None:
        frames.append(_read(spark, stored, ddl).where(F.col(DATE_PARTITION) <= F.lit(last)).select(*since.columns))
    if gone is not None:
        frames.append(gone.withColumns({c: -F.col(c) for c in counts}))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def rolled_totals(spark: SparkSession, table: str, rollup: str, result: StructType) -> DataFrame:
    """The totals panel: as :func:`fragstat.operators.dashboards.player_totals` over
    the whole table."""
    last, since, gone = _parts(spark, table, rollup, result)
    rows = _together(spark, f"{rollup}/totals", TOTALS_DDL, last, _totals(since), None if gone is None else _totals(gone), SUMS)
    sums = rows.groupBy("player_name").agg(*[F.sum(c).alias(c) for c in SUMS]).where("snapshots > 0")
    return sums.select("player_name", "kills", "deaths", "assists",
                       (F.col("kd_cents") / 100).cast("double").alias("kd_ratio"),
                       (F.col("headshot_cents") / 100).cast("double").alias(HEADSHOT_TOTAL_COLUMN))


def rolled_trend(spark: SparkSession, table: str, rollup: str, result: StructType) -> DataFrame:
    """The trend panel: as :func:`fragstat.operators.dashboards.kd_trend` over the
    whole table."""
    last, since, gone = _parts(spark, table, rollup, result)
    rows = _together(spark, f"{rollup}/points", POINTS_DDL, last, _points(since), None if gone is None else _points(gone), ("n",))
    left = rows.groupBy("kd_ratio", "timestamp_seconds").agg(F.sum("n").alias("n")).where("n > 0")
    return left.select("kd_ratio", "timestamp_seconds").orderBy("timestamp_seconds")
