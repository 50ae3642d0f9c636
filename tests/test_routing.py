import pytest

from fragstat.functions.routing import elapsed_seconds, raw_field, topic_for_file


@pytest.mark.parametrize("name, topic", [
    ("a-vs-b-m1_kills.csv", "game.kills"),
    ("x_y.z_kills.v2.csv", "game.kills"),
    ("a-vs-b-m1_damages.csv", "game.damages"),
    ("a_players.csv", "game.players"),
    ("team_1.vs_2-m1_ damages .csv", "game.damages"),
    ("nounderscore.csv", "game.nounderscore"),
    ("a_kills_", "game.kills"),
    ("a_.csv", "game."),
])
def test_topic_for_file(spark, name, topic):
    df = spark.createDataFrame([(name,)], "file_name string")
    assert df.select(topic_for_file()).first()[0] == topic


def test_elapsed_seconds(spark):
    df = spark.range(0, 300).withColumnRenamed("id", "tick")
    got = {r.tick: (r.s7, r.s128) for r in df.select("tick", elapsed_seconds("tick").alias("s7"),
                                                      elapsed_seconds("tick", 7.8125).alias("s128")).collect()}
    assert got[0] == (0, 0)
    assert got[142] == (0, 1)    # 994 ms on the 7 ms clock; 1.109 s at 128 ticks/s
    assert got[143] == (1, 1)
    assert got[127][1] == 0 and got[128][1] == 1
    assert all(s7 == (t * 7) // 1000 for t, (s7, _) in got.items())


def test_raw_field(spark):
    df = spark.createDataFrame([("1,22,3",), ("1",), ("a,x",), (None,)], "line string")
    assert [r[0] for r in df.select(raw_field("line")).collect()] == [22, None, None, None]
