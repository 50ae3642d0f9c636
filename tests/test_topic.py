"""Topic source/sink wrappers: the Kafka connector is not on this class path
and no broker may be started, so the wrappers are checked up to the data
source lookup; the file-backed topic log covers the data path."""

import pytest
from fragstat.sinks.topic import append_topic_log, publish
from fragstat.sources.topic import TOPIC_LOG_SCHEMA, read_topic, read_topic_log


def test_read_topic_looks_up_the_kafka_source(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, "game.kills", "localhost:1", min_partitions=8, maxOffsetsPerTrigger="1000")


def test_publish_looks_up_the_kafka_sink(spark):
    df = spark.createDataFrame([("game.kills", "1", "a,b")], "topic string, key string, value string")
    with pytest.raises(Exception, match="(?i)kafka"):
        publish(df, "localhost:1")


def test_topic_log_keeps_the_record_layout(spark, tmp_path):
    df = spark.createDataFrame(
        [("game.kills", "1", "x,1"), ("game.damages", "2", "y,2")], "topic string, key string, value string")
    log = str(tmp_path / "log")
    append_topic_log(df, log)
    kills = read_topic_log(spark, log, "game.kills", streaming=False)
    assert dict(kills.dtypes) == {f.name: f.dataType.simpleString() for f in TOPIC_LOG_SCHEMA.fields}
    assert [(r.key, r.value) for r in kills.collect()] == [(bytearray(b"1"), bytearray(b"x,1"))]
    assert read_topic_log(spark, log, streaming=False).count() == 2
