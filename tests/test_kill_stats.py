import random

import pytest
from pyspark.sql import functions as F

from conftest import sorted_rows
from fragstat.operators import kill_stats as ks

# Hand-made kills (killer, name, victim, assister, headshot, tick, timestamp_seconds)
HAND_KILLS = [
    (1, "a", 2, None, 1, 10, 0),
    (1, "a", 2, 3, 0, 11, 1),
    (1, "a", 3, 2, None, 12, 2),
    (2, "b", 1, 3, 1, 12, 2),
    (None, None, 3, None, 0, 13, 3),
    (3, None, 1, 1, 0, 14, 3),
    (2, "b", 2, None, 0, 15, 4),
]
EXPECTED = [
    (1, "a", 3, 2, 1, 1.5, 33.33, 0),
    (2, "b", 2, 3, 1, 0.67, 50.0, 2),
    (3, None, 1, 2, 2, 0.5, 0.0, 3),
]


def hand(make_kills):
    return make_kills([
        dict(killer_steamid=k, killer_name=n, victim_steamid=v, assister_steamid=a,
             headshot=h, tick=t, timestamp_seconds=ts)
        for k, n, v, a, h, t, ts in HAND_KILLS
    ])


@pytest.mark.parametrize("op", [ks.player_kill_stats, ks.player_kill_stats_joined])
def test_hand_made_case(make_kills, op):
    out = op(hand(make_kills))
    assert out.columns == ks.OUTPUT_COLUMNS
    assert sorted_rows(out) == sorted(EXPECTED, key=repr)


def test_output_types(make_kills):
    out = ks.player_kill_stats(hand(make_kills))
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert types == {
        "player_id": "bigint", "player_name": "string", "kills": "bigint", "deaths": "bigint",
        "assists": "bigint", "kd_ratio": "double", "headshot_percentage": "double",
        "timestamp_seconds": "bigint",
    }


def test_zero_deaths_kd_is_kills(make_kills):
    df = make_kills([dict(killer_steamid=7, killer_name="x", victim_steamid=8, tick=t) for t in range(3)])
    row = ks.player_kill_stats(df).where("player_id = 7").first()
    assert (row.kills, row.deaths, row.kd_ratio, row.headshot_percentage) == (3, 0, 3.0, 0.0)


def test_player_without_kills_is_absent(make_kills):
    df = make_kills([dict(killer_steamid=1, victim_steamid=2, assister_steamid=3, tick=1)])
    assert [r.player_id for r in ks.player_kill_stats(df).collect()] == [1]


def test_half_up_rounding(make_kills):
    # 23 kills / 40 deaths = 0.575 -> 0.58 (half-up)
    rows = [dict(killer_steamid=1, victim_steamid=9, tick=i) for i in range(23)]
    rows += [dict(killer_steamid=9, victim_steamid=1, tick=100 + i) for i in range(40)]
    row = ks.player_kill_stats(make_kills(rows)).where("player_id = 1").first()
    assert row.kd_ratio == 0.58


def test_first_kill_is_deterministic(make_kills):
    rows = [
        dict(killer_steamid=5, killer_name="late", tick=30, timestamp_seconds=9),
        dict(killer_steamid=5, killer_name=None, tick=None, timestamp_seconds=1),
        dict(killer_steamid=5, killer_name="early", tick=3, timestamp_seconds=0),
    ]
    for perm in (rows, rows[::-1]):
        row = ks.player_identity(make_kills(perm)).first()
        assert (row.player_name, row.timestamp_seconds) == ("early", 0)


def _random_kills(make_kills, n, seed):
    rnd = random.Random(seed)

    def pid():
        return None if rnd.random() < 0.1 else rnd.randint(1, 25)

    return make_kills([
        dict(killer_steamid=pid(), killer_name=rnd.choice(["a", "b", None]),
             victim_steamid=pid(), assister_steamid=pid() if rnd.random() < 0.5 else None,
             headshot=rnd.choice([0, 1, None]), tick=rnd.randint(0, 50),
             timestamp_seconds=rnd.randint(0, 5), round=rnd.randint(1, 3))
        for _ in range(n)
    ])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_one_pass_equals_join_form(make_kills, seed):
    df = _random_kills(make_kills, 400, seed)
    cols = ["player_id", "kills", "deaths", "assists", "kd_ratio", "headshot_percentage"]
    assert sorted_rows(ks.player_kill_stats(df), cols) == sorted_rows(ks.player_kill_stats_joined(df), cols)


def test_grouped_equals_per_group(make_kills):
    df = _random_kills(make_kills, 300, 7)
    grouped = ks.player_kill_stats(df, by=["round"])
    for r in (1, 2, 3):
        single = ks.player_kill_stats(df.where(F.col("round") == r))
        cols = ["player_id", "kills", "deaths", "assists", "kd_ratio", "headshot_percentage"]
        assert sorted_rows(grouped.where(F.col("round") == r), cols) == sorted_rows(single, cols)


def test_components(make_kills):
    df = hand(make_kills)
    assert sorted_rows(ks.kills_by_killer(df)) == [(1, 3, 1), (2, 2, 1), (3, 1, 0)]
    assert sorted_rows(ks.deaths_by_victim(df)) == [(1, 2), (2, 3), (3, 2)]
    assert sorted_rows(ks.assists_by_assister(df)) == [(1, 1), (2, 1), (3, 2)]
    assert sorted_rows(ks.player_identity(df)) == sorted([(1, "a", 0), (2, "b", 2), (3, None, 3)], key=repr)


def test_snapshots_split_by_time(make_kills):
    df = make_kills([
        dict(killer_steamid=1, victim_steamid=2, tick=1, timestamp_seconds=5),
        dict(killer_steamid=1, victim_steamid=2, tick=2, timestamp_seconds=65),
    ])
    for joined in (False, True):
        out = ks.player_stats_snapshots(df, window_seconds=60, joined=joined)
        assert sorted_rows(out, ["batch_id", "player_id", "kills", "timestamp_seconds"]) == [(0, 1, 1, 5), (1, 1, 1, 65)]


def test_grouped_join_form_equals_grouped_one_pass(make_kills):
    # time as a function of the tick (the replay clock), so ties on
    # (player, name, tick) cannot carry different times
    df = _random_kills(make_kills, 400, 8).withColumn("timestamp_seconds", (F.col("tick") / 10).cast("long"))
    cols = ["round", "player_id", "player_name", "kills", "deaths", "assists",
            "kd_ratio", "headshot_percentage", "timestamp_seconds"]
    assert sorted_rows(ks.player_kill_stats(df, by=["round"]), cols) == \
        sorted_rows(ks.player_kill_stats_joined(df, by=["round"]), cols)


def test_earliest_kill_is_the_same_in_any_order(spark, make_kills):
    """Ties on the tick: the smaller name, then the smaller time, kills without a time last."""
    rows = [dict(tick=5, killer_steamid=1, killer_name=n, timestamp_seconds=t, victim_steamid=2)
            for n, t in (("b", 1), ("a", 9), ("a", None), ("a", -7), ("a", 1700000000), ("c", 0))]
    rows += [dict(tick=4, killer_steamid=3, killer_name="z", timestamp_seconds=None, victim_steamid=2)] * 2
    kills = make_kills(rows)
    for order in (kills, kills.repartition(4), kills.orderBy("timestamp_seconds"), kills.orderBy(F.desc("killer_name"))):
        for stats in (ks.player_kill_stats(order), ks.player_kill_stats_joined(order), ks.player_identity(order)):
            got = {r.player_id: (r.player_name, r.timestamp_seconds) for r in stats.collect()}
            assert got == {1: ("a", -7), 3: ("z", None)}
