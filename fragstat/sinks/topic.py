"""Topic sinks: publish ``(topic, key, value)`` records.

``publish`` writes to Kafka (connector jar required); ``append_topic_log``
appends the same records to a parquet folder partitioned by topic, which
:func:`fragstat.sources.topic.read_topic_log` reads back as a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _records(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.col("topic"),
    )


def publish(df: DataFrame, bootstrap_servers: str, fmt: str = "kafka", **options: str) -> None:
    """Batch-publish records; each row's ``topic`` column picks its topic."""
    writer = _records(df).write.format(fmt).option("kafka.bootstrap.servers", bootstrap_servers)
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save()


def append_topic_log(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """Append records to a file-backed topic log: one folder per topic, below
    one per value of the columns ``by``."""
    columns = [F.col(c) for c in by]
    records = df.select(*columns, F.col("key").cast("binary").alias("key"),
                        F.col("value").cast("binary").alias("value"), F.col("topic"))
    records.write.mode("append").partitionBy(*by, "topic").parquet(path)
