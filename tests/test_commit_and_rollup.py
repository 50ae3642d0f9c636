import os
from datetime import date, datetime

import pytest
from conftest import sorted_rows
from pyspark.sql import functions as F
from test_kill_stats import _random_kills

from fragstat.operators.dashboards import kd_trend, player_totals
from fragstat.operators.damage_stats import merged_damage_stats, player_damage_sketches, player_damage_stats
from fragstat.operators.kill_stats import player_kill_stats
from fragstat.plans.inspect import plan_text
from fragstat.schemas import PLAYER_STATS
from fragstat.sinks.rollup import roll_up, rolled_totals, rolled_trend, rolled_until
from fragstat.sinks.table import (BATCH_COLUMN, append_rows, mark_written, read_result_table, read_written, write_batch,
                                  write_batches)


@pytest.fixture()
def stats(make_kills):
    return player_kill_stats(_random_kills(make_kills, 80, 5))


def _batch(stats, batch_id):
    return stats.withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long"))


def test_rows_without_a_marker_do_not_count(spark, stats, tmp_path):
    table = str(tmp_path / "t")
    write_batch(stats, table, 0)
    before = sorted_rows(read_result_table(spark, table, PLAYER_STATS))
    # a second write of batch 0 and a first of batch 1 break off after their rows
    write_id = append_rows(_batch(stats.withColumn("kills", F.lit(99).cast("long")), 0), table)
    append_rows(_batch(stats, 1), table)
    assert sorted_rows(read_result_table(spark, table, PLAYER_STATS)) == before
    mark_written(spark.range(1).select(F.lit(0).cast("long").alias(BATCH_COLUMN)), table, write_id)
    assert {r.kills for r in read_result_table(spark, table, PLAYER_STATS).collect()} == {99}


def test_markers_follow_the_rows(spark, stats, tmp_path, monkeypatch):
    from fragstat.sinks import table as sink

    def broken(*args, **more):
        raise RuntimeError("lost")
    table = str(tmp_path / "t")
    monkeypatch.setattr(sink, "mark_written", broken)
    with pytest.raises(RuntimeError):
        write_batches(_batch(stats, 3), table)
    assert read_written(spark, table, PLAYER_STATS).count() == stats.count()
    assert read_result_table(spark, table, PLAYER_STATS).collect() == []


def test_a_backfill_computes_its_input_once(spark, stats, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    rows = _batch(stats, 1).unionByName(_batch(stats, 2))
    write_batches(rows.mapInArrow(count, rows.schema), str(tmp_path / "t"))
    assert seen.value == rows.count()
    assert {r.batch_id for r in read_result_table(spark, str(tmp_path / "t"), PLAYER_STATS).collect()} == {1, 2}


def _at(day):
    return F.lit(datetime(2024, 5, day, 12)).cast("timestamp")


def _same(spark, table, rollup):
    whole = read_result_table(spark, table, PLAYER_STATS)
    assert sorted_rows(rolled_totals(spark, table, rollup, PLAYER_STATS)) == sorted_rows(player_totals(whole))
    got = rolled_trend(spark, table, rollup, PLAYER_STATS).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, kd_trend(whole).collect()))
    assert [r.timestamp_seconds for r in got] == sorted(r.timestamp_seconds for r in got)


def test_rollup_equals_the_whole_table(spark, stats, tmp_path):
    table, rollup = str(tmp_path / "t"), str(tmp_path / "r")
    assert rolled_totals(spark, table, rollup, PLAYER_STATS).collect() == []
    halves = [stats.where("player_id % 2 = 0"), stats.where("player_id % 2 = 1")]
    write_batches(_batch(stats, 1).unionByName(_batch(halves[0], 2)), table, at=_at(1))
    write_batches(_batch(halves[1], 2), table, at=_at(1))  # the same batch again on the same day
    _same(spark, table, rollup)
    roll_up(spark, table, rollup, PLAYER_STATS, until=date(2024, 5, 2))
    assert rolled_until(spark, rollup) == date(2024, 5, 1)
    _same(spark, table, rollup)
    write_batches(_batch(stats, 3), table, at=_at(2))
    _same(spark, table, rollup)
    plan = plan_text(rolled_totals(spark, table, rollup, PLAYER_STATS))
    assert "recorded_date" in plan and plan.count("> 2024-05-01") + plan.count("> 19844") >= 1  # only open days of the table
    # a rolled batch is written again, emptied of half its players; another one vanishes
    write_batches(_batch(halves[0], 1), table, at=_at(2), batches=spark.createDataFrame([(1,), (2,)], "batch_id long"))
    _same(spark, table, rollup)
    roll_up(spark, table, rollup, PLAYER_STATS, until=date(2024, 5, 3))
    _same(spark, table, rollup)
    roll_up(spark, table, rollup, PLAYER_STATS, until=date(2024, 5, 3))  # nothing new
    _same(spark, table, rollup)
    assert sorted(os.listdir(rollup + "/totals"))[-1] == "recorded_date=2024-05-02"


def test_a_rollup_that_broke_off_is_run_again(spark, stats, tmp_path, monkeypatch):
    from fragstat.sinks import rollup as module

    table, rollup = str(tmp_path / "t"), str(tmp_path / "r")
    write_batches(_batch(stats, 1), table, at=_at(1))
    with monkeypatch.context() as broken:
        broken.setattr(module, "latest_writes", lambda df: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            roll_up(spark, table, rollup, PLAYER_STATS, until=date(2024, 5, 9))
    _same(spark, table, rollup)
    roll_up(spark, table, rollup, PLAYER_STATS, until=date(2024, 5, 9))
    _same(spark, table, rollup)


def test_merged_sketches_count_a_round_once(spark, make_damages):
    rows = [dict(attacker_steamid=a, round=((a or 0) * 7 + i) % (40 * (a or 1)), tick=i, victim_health=100, victim_new_health=60)
            for a in (None, 1, 2, 8) for i in range(400)]
    rows += [dict(attacker_steamid=5, round=None, tick=3, victim_health=None, victim_new_health=1)]
    damages = make_damages(rows).withColumn("batch_id", F.col("tick") % 9)
    stored = player_damage_sketches(damages, by=["batch_id"])
    got = {r.player_id: (r.total_damage, r.rounds) for r in merged_damage_stats(stored).collect()}
    want = {r.player_id: (r.total_damage, r.rounds) for r in player_damage_stats(damages, exact=True).collect()}
    assert got == want
    # thousands of rounds: within three times the stated error
    many = make_damages([dict(attacker_steamid=1, round=i, tick=i, victim_health=1, victim_new_health=0) for i in range(20_000)])
    rounds = merged_damage_stats(player_damage_sketches(many.withColumn("batch_id", F.col("tick") % 5), by=["batch_id"])).first().rounds
    assert abs(rounds - 20_000) <= 3 * 0.0163 * 20_000


def test_rows_of_a_large_batch_stay_where_they_are_read(spark, tmp_path):
    from pyspark.sql.types import LongType, StructField, StructType

    table = str(tmp_path / "t")
    write_batch(spark.range(4000).repartition(6), table, 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a table that is larger than that
    try:
        rows = read_result_table(spark, table, StructType([StructField("id", LongType())]))
        assert sorted(r.id for r in rows.collect()) == list(range(4000))
        plan = plan_text(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
