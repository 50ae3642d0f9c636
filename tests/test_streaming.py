import os

from pyspark.sql import functions as F

from conftest import sorted_rows
from fragstat.operators.damage_stats import player_damage_stats
from fragstat.operators.kill_stats import player_kill_stats
from fragstat.operators.replay import to_payload
from fragstat.schemas import PLAYER_DAMAGE_STATS, PLAYER_STATS
from fragstat.sinks.matchlog import WRITTEN_FILES, write_match_logs
from fragstat.sinks.table import compact, latest_per_batch, read_result_table, read_written, table_sink, write_batch, write_batches
from fragstat.sinks.topic import append_topic_log
from fragstat.sources.files import read_match_logs
from fragstat.sources.topic import decode_events, read_topic_log
from fragstat.streaming.jobs import run_match_stats, start_damage_stats, start_kill_stats
from test_kill_stats import _random_kills

STAT_COLS = ["player_id", "kills", "deaths", "assists", "kd_ratio", "headshot_percentage"]


def _run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_batch_equals_stream_one_batch(spark, make_kills, tmp_path):
    kills = _random_kills(make_kills, 300, 11)
    folder = str(tmp_path / "logs")
    write_match_logs(kills.repartition(4), folder)
    table = str(tmp_path / "table")
    stream = read_match_logs(spark, folder, "kills", glob=WRITTEN_FILES, streaming=True)
    _run(start_kill_stats(stream, table_sink(table), str(tmp_path / "ck"), trigger={"availableNow": True}))
    got = read_result_table(spark, table, PLAYER_STATS)
    assert set(r.batch_id for r in got.select("batch_id").distinct().collect()) == {0}
    batch = player_kill_stats(read_match_logs(spark, folder, "kills", glob=WRITTEN_FILES))
    assert sorted_rows(got, STAT_COLS) == sorted_rows(batch, STAT_COLS)


def test_one_file_per_batch_is_union_of_per_file_results(spark, make_kills, tmp_path):
    kills = _random_kills(make_kills, 300, 12)
    folder = str(tmp_path / "logs")
    write_match_logs(kills.repartition(3), folder)
    table = str(tmp_path / "table")
    stream = read_match_logs(spark, folder, "kills", glob=WRITTEN_FILES, streaming=True, max_files_per_trigger=1)
    _run(start_kill_stats(stream, table_sink(table), str(tmp_path / "ck"), trigger={"availableNow": True}))
    got = read_result_table(spark, table, PLAYER_STATS)
    assert got.select("batch_id").distinct().count() == 3
    files = [n for n in os.listdir(folder) if n.endswith(".csv")]
    expected = []
    for name in files:
        per_file = read_match_logs(spark, folder, "kills", glob=WRITTEN_FILES).where(F.col("file_name") == name)
        expected += sorted_rows(player_kill_stats(per_file), STAT_COLS)
    assert sorted_rows(got, STAT_COLS) == sorted(expected, key=repr)


def test_rerun_batch_replaces_its_output(spark, make_kills, tmp_path):
    stats = player_kill_stats(_random_kills(make_kills, 50, 13))
    table = str(tmp_path / "table")
    write_batch(stats, table, 0)
    write_batch(stats, table, 1)
    write_batch(stats, table, 1)  # replayed batch
    got = read_result_table(spark, table, PLAYER_STATS)
    n = stats.count()
    assert got.count() == 2 * n
    assert got.where("batch_id = 1").count() == n
    assert dict(got.dtypes)["batch_id"] == "bigint" and dict(got.dtypes)["recorded_at"] == "timestamp"


def test_topic_log_stream_and_restart(spark, make_kills, tmp_path):
    kills = _random_kills(make_kills, 200, 14)
    log = str(tmp_path / "topiclog")
    records = to_payload(kills.withColumn("topic", F.lit("game.kills")), kills.columns)
    append_topic_log(records.limit(100), log)
    table, ck = str(tmp_path / "table"), str(tmp_path / "ck")

    def run():
        stream = decode_events(read_topic_log(spark, log, "game.kills"), "kills")
        _run(start_kill_stats(stream, table_sink(table), ck, trigger={"availableNow": True}))

    run()
    append_topic_log(records.subtract(records.limit(100)), log)
    run()  # restart from the checkpoint: only the new records form batch 1
    got = read_result_table(spark, table, PLAYER_STATS)
    assert sorted(r.batch_id for r in got.select("batch_id").distinct().collect()) == [0, 1]
    decoded = decode_events(read_topic_log(spark, log, "game.kills", streaming=False), "kills")
    assert decoded.count() == 200


def test_both_queries_side_by_side(spark, make_kills, make_damages, tmp_path):
    kills_dir, dmg_dir = str(tmp_path / "k"), str(tmp_path / "d")
    write_match_logs(_random_kills(make_kills, 100, 15), kills_dir)
    dmg = make_damages([dict(attacker_steamid=i % 4, victim_health=100, victim_new_health=100 - i, round=i % 3)
                        for i in range(40)])
    write_match_logs(dmg, dmg_dir)
    kt, dt = str(tmp_path / "kt"), str(tmp_path / "dt")
    queries = run_match_stats(
        spark,
        read_match_logs(spark, kills_dir, "kills", glob=WRITTEN_FILES, streaming=True),
        read_match_logs(spark, dmg_dir, "damages", glob=WRITTEN_FILES, streaming=True),
        table_sink(kt), table_sink(dt),
        checkpoint_location=str(tmp_path / "ck"), trigger={"availableNow": True}, wait=False,
    )
    for q in queries:
        _run(q)
    got = read_result_table(spark, dt, PLAYER_DAMAGE_STATS)
    want = player_damage_stats(read_match_logs(spark, dmg_dir, "damages", glob=WRITTEN_FILES))
    cols = ["player_id", "total_damage", "rounds", "damage_per_round"]
    assert sorted_rows(got, cols) == sorted_rows(want, cols)
    assert read_result_table(spark, kt, PLAYER_STATS).count() > 0


def test_empty_batches_write_nothing(spark, tmp_path):
    folder = tmp_path / "empty"
    folder.mkdir()
    (folder / "h_damages.csv").write_text("frame,tick,round\n")
    table = str(tmp_path / "table")
    stream = read_match_logs(spark, str(folder), "damages", streaming=True)
    _run(start_damage_stats(stream, table_sink(table), str(tmp_path / "ck"), trigger={"availableNow": True}))
    assert not os.path.exists(table)


def test_backfill_replaces_only_its_batches(spark, make_kills, tmp_path):
    kills = _random_kills(make_kills, 300, 21)
    snapshots = player_kill_stats(kills, by=["round"]).withColumnRenamed("round", "batch_id") \
        .withColumn("batch_id", F.col("batch_id").cast("long"))
    table = str(tmp_path / "table")
    write_batches(snapshots, table)
    before = read_result_table(spark, table, PLAYER_STATS)
    counts = {r.batch_id: r["count"] for r in before.groupBy("batch_id").count().collect()}
    assert sorted(counts) == [1, 2, 3]
    write_batches(snapshots.where("batch_id = 2"), table)   # re-run of one batch
    after = read_result_table(spark, table, PLAYER_STATS)
    assert {r.batch_id: r["count"] for r in after.groupBy("batch_id").count().collect()} == counts


def _queries_wait(spark, make_kills, make_damages, tmp_path, name):
    kills_dir, dmg_dir = str(tmp_path / f"k{name}"), str(tmp_path / f"d{name}")
    write_match_logs(_random_kills(make_kills, 400, 15).repartition(6), kills_dir)
    write_match_logs(make_damages([dict(attacker_steamid=1, victim_health=100, victim_new_health=40)]), dmg_dir)
    kt, dt = str(tmp_path / f"kt{name}"), str(tmp_path / f"dt{name}")
    queries = run_match_stats(
        spark,
        read_match_logs(spark, kills_dir, "kills", streaming=True, glob=WRITTEN_FILES, max_files_per_trigger=1),
        read_match_logs(spark, dmg_dir, "damages", streaming=True, glob=WRITTEN_FILES),
        table_sink(kt), table_sink(dt),
        checkpoint_location=str(tmp_path / f"ck{name}"), trigger={"availableNow": True}, wait=True,
    )
    assert not any(q.isActive for q in queries)
    assert read_result_table(spark, kt, PLAYER_STATS).agg(F.sum("kills")).first()[0] == read_match_logs(
        spark, kills_dir, "kills", glob=WRITTEN_FILES).where("killer_steamid IS NOT NULL").count()
    assert read_result_table(spark, dt, PLAYER_DAMAGE_STATS).count() == 1


def test_waiting_for_both_queries(spark, make_kills, make_damages, tmp_path):
    """Both tables are complete on return, also after earlier queries have ended in the session."""
    _queries_wait(spark, make_kills, make_damages, tmp_path, "a")
    _queries_wait(spark, make_kills, make_damages, tmp_path, "b")


def test_an_error_of_either_query_surfaces(spark, make_kills, make_damages, tmp_path):
    import pytest
    from pyspark.errors import StreamingQueryException

    kills_dir, dmg_dir = str(tmp_path / "k"), str(tmp_path / "d")
    write_match_logs(_random_kills(make_kills, 20, 15), kills_dir)
    write_match_logs(make_damages([dict(attacker_steamid=1)]), dmg_dir)

    def broken(df, batch_id):
        raise ValueError("no such sink")
    table = str(tmp_path / "kt")
    with pytest.raises(StreamingQueryException):
        run_match_stats(
            spark, read_match_logs(spark, kills_dir, "kills", streaming=True, glob=WRITTEN_FILES),
            read_match_logs(spark, dmg_dir, "damages", streaming=True, glob=WRITTEN_FILES),
            table_sink(table), broken, checkpoint_location=str(tmp_path / "ck"), trigger={"availableNow": True})
    assert read_result_table(spark, table, PLAYER_STATS).count() > 0


def test_table_before_the_first_write_and_emptied_batches(spark, make_kills, tmp_path):
    table = str(tmp_path / "table")
    assert read_result_table(spark, table, PLAYER_STATS).collect() == []
    stats = player_kill_stats(_random_kills(make_kills, 50, 3))
    batches = stats.withColumn("batch_id", F.lit(1).cast("long")).unionByName(stats.withColumn("batch_id", F.lit(2).cast("long")))
    write_batches(batches, table)
    n = stats.count()
    assert read_result_table(spark, table, PLAYER_STATS).count() == 2 * n
    # the backfill again, now without rows for batch 2
    write_batches(batches.where("batch_id = 1"), table, batches=spark.createDataFrame([(1,), (2,)], "batch_id long"))
    left = read_result_table(spark, table, PLAYER_STATS)
    assert {r.batch_id for r in left.collect()} == {1} and left.count() == n
    target = str(tmp_path / "compacted")
    compact(spark, table, target, PLAYER_STATS)
    assert sorted_rows(read_result_table(spark, target, PLAYER_STATS)) == sorted_rows(left)
    assert read_written(spark, target, PLAYER_STATS).count() == n + 2  # and a marker for each batch


def test_folders_follow_days_not_batches(spark, make_kills, tmp_path):
    table = str(tmp_path / "table")
    stats = player_kill_stats(_random_kills(make_kills, 20, 4))
    for batch_id in range(4):
        write_batch(stats, table, batch_id)
    assert len([n for n in os.listdir(table) if n.startswith("recorded_date=")]) <= 2


def test_latest_per_batch_of_other_sinks(spark):
    rows = spark.createDataFrame(
        [(1, "a", "2024-01-01 00:00:00"), (1, "b", "2024-01-01 00:00:00"), (1, "c", "2024-01-02 00:00:00"), (2, "d", "2024-01-01 00:00:00")],
        "batch_id long, x string, t string").select("batch_id", "x", F.to_timestamp("t").alias("recorded_at"))
    assert sorted(r.x for r in latest_per_batch(rows).collect()) == ["c", "d"]


def test_share_of_a_topic_log_reads_no_records(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameReader

    from fragstat.plans.staged import _share_of
    log = tmp_path / "log"
    records = spark.range(300).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"), F.lit("t").alias("topic"),
                                      (F.col("id") % 5).alias("m"))
    append_topic_log(records, str(log), by=("m",))
    size = sum(p.stat().st_size for p in log.rglob("part-*.parquet"))
    monkeypatch.setattr(DataFrameReader, "parquet", None)
    assert _share_of(spark, str(log), 3) == size // 3 and _share_of(spark, str(log), 10**9) == 1
