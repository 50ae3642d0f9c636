"""Topic sources: one record per log line, ``value`` = the CSV line.

``read_topic`` is the Kafka subscription (the connector jar must be on the
class path); ``read_topic_log`` reads the same record layout from a folder
of parquet files, a file-backed stand-in used for tests, backfills and
environments without a broker.  Both feed :func:`decode_events`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from ..functions.decode import decode_csv, with_damage_dealt
from ..schemas import EVENT_SCHEMAS

TOPIC_LOG_SCHEMA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
])


def read_topic(
    spark: SparkSession,
    topic: str,
    bootstrap_servers: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
    streaming: bool = True,
    fmt: str = "kafka",
    **options: str,
) -> DataFrame:
    """Subscribe to one topic: new queries start at ``latest`` and lost
    offsets do not fail the query.  ``min_partitions`` splits the topic's
    partitions into more Spark tasks than the topic has partitions (the
    topic may have only two).  Pass ``maxOffsetsPerTrigger`` through
    ``options`` to bound a micro-batch, so a backlog after downtime is
    worked off in several batches instead of one oversized one."""
    reader = spark.readStream if streaming else spark.read
    reader = (
        reader.format(fmt)
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


def read_topic_log(
    spark: SparkSession,
    path: str,
    topic: str | None = None,
    streaming: bool = True,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Records of a file-backed topic log (parquet, partitioned by topic).  A
    micro-batch takes the files that there are, or up to the given bytes of them
    (one file at least): bytes bound the work of a batch, and it still reads all its
    files in parallel."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(TOPIC_LOG_SCHEMA)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if streaming and max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    df = reader.parquet(path)
    return df.where(F.col("topic") == topic) if topic else df


def decode_events(records: DataFrame, kind: str, keep: tuple[str, ...] = (), corrupt_col: str | None = None) -> DataFrame:
    """Topic records -> typed event rows of ``kind`` (kills / damages)."""
    events = decode_csv(records, EVENT_SCHEMAS[kind], "value", keep=keep, corrupt_col=corrupt_col)
    return with_damage_dealt(events) if kind == "damages" else events
