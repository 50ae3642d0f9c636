import os

import pytest
from conftest import sorted_rows
from fragstat.operators.kill_stats import player_kill_stats
from fragstat.sinks.matchlog import WRITTEN_FILES, write_match_logs
from fragstat.sources.files import read_lines, read_match_logs, read_roster

KILL_HEADER = "frame,tick,round,killer_name,killer_steamid,victim_name,victim_steamid"


def kill_line(frame, tick, rnd, killer, kid, vid):
    # kill file layout: 43 columns; fields after the first eight are left empty
    fields = [str(frame), str(tick), str(rnd), killer, str(kid), "", "", "", str(vid)]
    return ",".join(fields + [""] * (43 - len(fields)))


@pytest.fixture()
def match_folder(tmp_path):
    d = tmp_path / "match"
    d.mkdir()
    (d / "a-vs-b-m1_kills.csv").write_text(
        "\n".join([KILL_HEADER, kill_line(1, 10, 1, "a", 1, 2), kill_line(2, 150, 1, "b", 2, 1),
                   kill_line(3, 300, 2, "a", 1, 2)]) + "\n")
    # routes to game.kills but must not pass the *_kills.csv filter
    (d / "x_y.z_kills.v2.csv").write_text(KILL_HEADER + "\n" + kill_line(9, 9, 9, "z", 9, 9) + "\n")
    (d / "a-vs-b-m1_damages.csv").write_text(
        "frame,tick,round\n" + "1,20,1,,,100,70" + "," * 15 + "\n")
    (d / "a_players.csv").write_text("name,steamid\nalice,1\nbob,2\n")
    (d / "empty_kills.csv").write_text("")
    (d / "header-only_kills.csv").write_text(KILL_HEADER + "\n")
    return str(d)


def test_read_kills_folder(spark, match_folder):
    df = read_match_logs(spark, match_folder, "kills")
    rows = df.select("frame", "tick", "killer_name", "timestamp_seconds", "file_name", "topic").orderBy("frame").collect()
    assert [tuple(r) for r in rows] == [
        (1, 10, "a", 0, "a-vs-b-m1_kills.csv", "game.kills"),
        (2, 150, "b", 1, "a-vs-b-m1_kills.csv", "game.kills"),
        (3, 300, "a", 2, "a-vs-b-m1_kills.csv", "game.kills"),
    ]
    stats = player_kill_stats(df)
    assert sorted_rows(stats, ["player_id", "kills", "deaths"]) == [(1, 2, 1), (2, 1, 2)]


def test_read_damages_folder(spark, match_folder):
    row = read_match_logs(spark, match_folder, "damages").first()
    assert (row.tick, row.damage_dealt, row.topic) == (20, 30, "game.damages")


def test_read_lines_drops_header_per_file(spark, match_folder):
    lines = read_lines(spark, os.path.join(match_folder, "a_players.csv"))
    assert sorted(r.line for r in lines.collect()) == ["alice,1", "bob,2"]
    all_kill_lines = read_lines(spark, match_folder, glob="*_kills.csv")
    assert all_kill_lines.count() == 3


def test_roster(spark, match_folder, tmp_path):
    roster = read_roster(spark, match_folder)
    assert sorted((r.line, r.file_name) for r in roster.collect()) == [
        ("alice,1", "a_players.csv"), ("bob,2", "a_players.csv")]
    assert read_roster(spark, str(tmp_path / "missing")).count() == 0
    empty = tmp_path / "nofiles"
    empty.mkdir()
    (empty / "other.csv").write_text("x\n1\n")
    assert read_roster(spark, str(empty)).count() == 0


def test_write_then_read_match_logs(spark, make_kills, tmp_path):
    src = make_kills([dict(frame=i, tick=i * 100, round=1, killer_steamid=i % 3, killer_name=f"p,{i}",
                           victim_steamid=7, timestamp_seconds=(i * 100 * 7) // 1000) for i in range(50)])
    folder = str(tmp_path / "out")
    write_match_logs(src.repartition(3), folder)
    assert len([n for n in os.listdir(folder) if n.startswith("part-")]) == 3
    back = read_match_logs(spark, folder, "kills", with_source=False, glob=WRITTEN_FILES)
    assert sorted_rows(back) == sorted_rows(src)


def test_raw_lines_are_whole(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    lines = ["1,2,3", "a\u0001b\u0001c", '"q,u"o"te', " spaced ", "x" * 5000]
    (folder / "m_kills.csv").write_text("\n".join(["header", *lines]) + "\n")
    assert sorted(r.line for r in read_lines(spark, str(folder)).collect()) == sorted(lines)


@pytest.mark.parametrize("name", ["a\nb", "a\rb", "\r\n"])
def test_line_breaks_are_refused(spark, make_kills, tmp_path, name):
    from pyspark.errors import PySparkException

    rows = make_kills([dict(frame=1, tick=1, killer_name="fine"), dict(frame=2, tick=2, killer_name=name)])
    with pytest.raises(PySparkException, match="line break"):
        write_match_logs(rows, str(tmp_path / "out"))
