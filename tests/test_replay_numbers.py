import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fragstat.operators.replay import replay_messages, replay_order, unplayable_lines, with_running_number
from fragstat.sinks.matchlog import write_ordered_lines
from fragstat.sources.lines import LINE_ORDER, read_numbered_lines


def test_numbers_are_gapless_along_the_order(spark):
    draw = random.Random(1)
    rows = [(draw.choice([0, 0, 0, draw.randint(1, 50), None]), f"v{i % 40}") for i in range(3000)]
    df = spark.createDataFrame(rows, "tick int, v string").repartition(7)
    got = with_running_number(df, ["tick", "v"], rows_per_partition=100).orderBy("number").collect()
    assert [r.number for r in got] == list(range(3000))  # equal rows have numbers of their own
    assert [(r.tick, r.v) for r in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert with_running_number(df.where("false"), ["tick"]).collect() == []


def test_no_task_numbers_all_rows(spark):
    df = spark.range(4000).select(F.lit(0).alias("tick"), "id")
    numbered = with_running_number(df, ["tick"], rows_per_partition=500)
    sizes = numbered.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 2000
    assert "SinglePartition" not in numbered._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def folder(tmp_path):
    """Two kill files and a damage file; ticks tie across and within files."""
    (tmp_path / "a-b-m1_kills.csv").write_text("h\n1,0,x\n2,0,y\n\n3,5,same\n3,5,same\n,bad,z\n")
    (tmp_path / "a-b-m2_kills.csv").write_text("h\n1,5,q\n2,150,w\n")
    (tmp_path / "a-b-m1_damages.csv").write_text("h\n9,0,d\n8,5,d\n")
    return str(tmp_path)


def test_replay_is_by_tick_then_file_then_line(spark, folder):
    lines = read_numbered_lines(spark, folder)
    got = replay_messages(lines, rows_per_partition=2).orderBy("number").collect()
    assert [(r.number, r.key, r.topic, r.value) for r in got] == [
        (0, "0", "game.damages", "9,0,d,0"), (1, "1", "game.kills", "1,0,x,0"), (2, "2", "game.kills", "2,0,y,0"),
        (3, "3", "game.damages", "8,5,d,0"), (4, "4", "game.kills", "3,5,same,0"), (5, "5", "game.kills", "3,5,same,0"),
        (6, "6", "game.kills", "1,5,q,0"), (7, "7", "game.kills", "2,150,w,1")]
    assert sorted(r.line for r in unplayable_lines(lines).collect()) == ["", ",bad,z"]


def test_written_lines_come_back_in_order(spark, tmp_path):
    draw = random.Random(4)
    rows = [(f"m{i % 3}_kills.csv", draw.randint(0, 5), draw.choice(["", "  ", '"a,b', f"{i}", "dup"])) for i in range(500)]
    df = spark.createDataFrame(rows, "file_name string, tick int, line string").repartition(5)
    out = str(tmp_path / "out")
    write_ordered_lines(df, out, "header", ("tick", "line"), lines_per_part=60)
    got = read_numbered_lines(spark, out).orderBy(*LINE_ORDER).collect()
    assert [(r.file_name, r.line) for r in got] == [(f, x) for f, _, x in sorted(rows)]
    assert len({r.file_path for r in got}) >= 500 // 60


def test_lines_are_written_by_the_tasks_that_sort_them(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def stored(*args, **more):
        raise AssertionError("stored in between")
    monkeypatch.setattr(DataFrame, "checkpoint", stored)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(f, t, x) for f in ("a.csv", "b.csv", None) for t in range(40) for x in ("", None, f"{t},x", "é")]
        df = spark.createDataFrame(rows, "file_name string, tick int, line string").repartition(3)
        write_ordered_lines(df.withColumn("n", F.coalesce("line", F.lit("-"))), str(tmp_path / "out"), "h", ("tick", "n"), lines_per_part=9)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    whole = read_numbered_lines(spark, str(tmp_path / "out"), with_header=True).orderBy(*LINE_ORDER).collect()
    parts = {}
    for r in whole:
        parts.setdefault((r.file_name, r.file_path), []).append(r.line)
    assert all(p[0] == "h" and len(p) <= 10 for p in parts.values())
    hive_null = "__HIVE_DEFAULT_PARTITION__"
    want = {f or hive_null: [x or "" for _, x in sorted([(t, x or ("-" if x is None else "")) for g, t, x in rows if g == f],
                                                          key=lambda r: r)] for f in ("a.csv", "b.csv", None)}
    want = {f: ["" if x == "-" else x for x in v] for f, v in want.items()}
    got = {}
    for (f, _), p in sorted(parts.items()):
        got.setdefault(f, []).extend(p[1:])
    assert got == want


def test_only_what_a_message_needs_is_stored(spark, folder):
    lines = read_numbered_lines(spark, folder)
    numbered = with_running_number(lines, LINE_ORDER, keep=("line",))
    assert numbered.columns == ["line", "number"]
    assert [r.line for r in numbered.orderBy("number").collect()] == [r.line for r in lines.orderBy(*LINE_ORDER).collect()]


def test_counting_event_lines_encodes_nothing(spark):
    from conftest import SF_SMALL

    from fragstat.plans.staged import line_files
    plan = line_files(spark, SF_SMALL).groupBy().count()._jdf.queryExecution().optimizedPlan().toString()
    assert "to_csv" not in plan and "md5" not in plan


def test_sort_keys_that_are_computed_are_not_sent(spark):
    from conftest import SF_SMALL

    from fragstat.plans.inspect import plan_text
    from fragstat.plans.staged import line_files
    df = spark.createDataFrame([("f", 1, "x")], "file_name string, tick int, line string")
    ordered = replay_order(df, ["file_name", F.md5("line")], num_partitions=3)
    assert ordered.columns == df.columns
    above, below = plan_text(ordered).split("Exchange", 1)
    assert "_replay_key" in above and "_replay_key" not in below
    assert not line_files(spark, SF_SMALL).where("(follows = 0) = (digest IS NOT NULL)").count()


def test_lines_are_written_in_rounds_and_compressed(spark, tmp_path):
    draw = random.Random(5)
    rows = [(f"m{i % 7}_kills.csv", draw.randint(0, 5), f"{draw.randint(0, 99)}" * 9) for i in range(700)]
    df = spark.createDataFrame(rows, "file_name string, tick int, line string").repartition(3)
    got = []
    for name, at_once in (("whole", 10_000), ("rounds", 200)):
        out = str(tmp_path / name)
        write_ordered_lines(df, out, "h", ("tick", F.md5("line")), lines_per_part=30, sent=("tick",), rows_at_once=at_once)
        got.append([(r.file_name, r.line) for r in read_numbered_lines(spark, out).orderBy(*LINE_ORDER).collect()])
        files = [p for p in (tmp_path / name).rglob("part-*")]
        assert len(files) >= 700 // 30 and all(p.suffix == ".gz" for p in files)
    assert got[0] == got[1] == [(f, x) for f, _, x in sorted(
        rows, key=lambda r: (r[0], r[1], hashlib.md5(r[2].encode()).hexdigest()))]


def test_sorted_rows_are_stored_compressed(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def stored(*args, **more):
        raise AssertionError("a checkpoint is not compressed")
    monkeypatch.setattr(DataFrame, "checkpoint", stored)
    df = spark.range(3000).select((F.col("id") * 7 % 3000).alias("n"), F.lit(None).alias("none"), F.lit("x").alias("a b"))
    got = with_running_number(df, ["n"], rows_per_partition=100)
    assert got.columns == ["n", "none", "a b", "number"] and dict(got.dtypes)["none"] == "void"
    assert [(r.n, r.none, r["a b"], r.number) for r in got.orderBy("number").collect()] == [
        (i, None, "x", i) for i in range(3000)]
