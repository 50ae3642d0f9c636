import random

import pytest
from pyspark.sql import functions as F

from fragstat.sources.files import read_lines, read_roster
from fragstat.sources.lines import LINE_ORDER, file_name_of, read_numbered_lines, with_line_numbers


def in_order(df):
    return df.orderBy(*LINE_ORDER).collect()


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def make_lines(seed, rows):
    draw = random.Random(seed)
    return [draw.choice(["", "  ", "\t", "x" * draw.randint(1, 300), f"{i},{draw.random()}", "dup", '"q,u"o"te', "é\u0001"])
            for i in range(rows)]


def test_every_line_in_file_order_over_many_splits(spark, tmp_path, small_splits):
    files = {f"{c}-m{i}_kills.csv": make_lines(i, n) for i, (c, n) in enumerate(
        [("b", 900), ("a", 1), ("c", 40), ("d", 0), ("e", 2000), ("f", 3)])}
    for name, lines in files.items():
        (tmp_path / name).write_bytes("".join(x + "\n" for x in ["header", *lines]).encode())
    (tmp_path / "empty_kills.csv").write_text("")
    (tmp_path / "other_damages.csv").write_text("h\nno\n")
    lines = read_numbered_lines(spark, str(tmp_path), "*_kills.csv")
    assert lines.rdd.getNumPartitions() > 10
    got = in_order(lines)
    assert [(r.file_name, r.line) for r in got] == [(n, x) for n in sorted(files) for x in files[n]]
    numbers = in_order(with_line_numbers(lines))
    assert [(r.file_name, r.line_number, r.line) for r in numbers] == [
        (n, i, x) for n in sorted(files) for i, x in enumerate(files[n])]
    assert sorted(r.line for r in read_lines(spark, str(tmp_path), "*_kills.csv").collect()) == sorted(
        x for v in files.values() for x in v)


def test_line_ends_and_last_lines(spark, tmp_path):
    texts = {"a.csv": "h\r\n1\r\n\r\n2\r\n", "b.csv": "h\n1\n\n\n", "c.csv": "h\n1\n2", "d.csv": "h", "e.csv": "h\n", "f.csv": "\n\n1\n"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    got = [(r.file_name, r.line) for r in in_order(read_numbered_lines(spark, str(tmp_path)))]
    assert got == [("a.csv", "1"), ("a.csv", ""), ("a.csv", "2"), ("b.csv", "1"), ("b.csv", ""), ("b.csv", ""),
                   ("c.csv", "1"), ("c.csv", "2"), ("f.csv", ""), ("f.csv", "1")]
    whole = in_order(read_numbered_lines(spark, str(tmp_path), with_header=True))
    assert [r.line for r in whole if r.file_name == "d.csv"] == ["h"]


def test_batches_smaller_than_a_split(spark, tmp_path):
    lines = [str(i) for i in range(1000)]
    (tmp_path / "m_kills.csv").write_text("\n".join(["h", *lines]) + "\n")
    (tmp_path / "n_kills.csv").write_text("\n".join(["h", *lines[:7]]) + "\n")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = in_order(read_numbered_lines(spark, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r.file_name, r.line_in_block, r.line) for r in got] == [
        (n, int(x) + 1, x) for n, rows in (("m_kills.csv", lines), ("n_kills.csv", lines[:7])) for x in rows]


def test_parts_of_a_written_file(spark, tmp_path):
    paths = {"file:/x/a_kills.csv": "a_kills.csv", "file:/x/file=m1_kills.csv/part-0001-c0.csv": "m1_kills.csv",
             "s3://b/y/m2_kills.csv/part-00000": "m2_kills.csv", "/x/part-1/z.csv": "z.csv",
             "file:/x/file=m3_kills.csv/chunk=000000000012/part-0001.txt": "m3_kills.csv"}
    got = spark.createDataFrame([(p,) for p in paths], "p string").select("p", file_name_of(F.col("p")).alias("n")).collect()
    assert {r.p: r.n for r in got} == paths


def test_roster_keeps_blank_lines(spark, tmp_path):
    (tmp_path / "m_players.csv").write_text("name,steamid\nalice,1\n\n  \nbob,2\n")
    assert sorted(r.line for r in read_roster(spark, str(tmp_path)).collect()) == ["", "  ", "alice,1", "bob,2"]


def test_plan_is_one_scan_without_shuffle(spark, tmp_path):
    from fragstat.plans.inspect import count_nodes, plan_text

    (tmp_path / "m_kills.csv").write_text("h\n1\n")
    plan = plan_text(read_numbered_lines(spark, str(tmp_path)))
    assert count_nodes(plan, "FileScan text") == 1 and "Exchange" not in plan


def test_a_line_is_neither_searched_for_its_file_name_nor_moved(spark, tmp_path):
    from fragstat.plans.inspect import plan_text

    for match in ("m1", "m2"):
        for chunk in ("chunk=0", "chunk=1"):
            folder = tmp_path / f"file={match}_kills.csv" / chunk
            folder.mkdir(parents=True)
            (folder / "part-0.txt").write_text(f"h\n{chunk}\n{match}\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for splits of a large folder
    try:
        lines = read_numbered_lines(spark, str(tmp_path))
        got = in_order(with_line_numbers(lines))
        plan = plan_text(with_line_numbers(lines))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [(r.file_name, r.line_number, r.line) for r in got] == [
        (f"{m}_kills.csv", i, x) for m in ("m1", "m2") for i, x in enumerate(["chunk=0", m, "chunk=1", m])]
    assert "regexp_extract" not in plan and "SortMergeJoin" not in plan
