"""Skewed input checked against a pure-Python reading of the semantics.

One player is the killer in a third of all rows and many rows have NULL
ids; the input is spread over many partitions so the map-side partial
aggregates and the merge across tasks are both exercised.
"""

import random
from collections import defaultdict

from fragstat.operators.damage_stats import player_damage_stats
from fragstat.operators.kill_stats import player_kill_stats, player_kill_stats_joined

HOT = 7


def half_up(x: float) -> float:
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def brute_kill_stats(rows):
    kills, hs, deaths, assists, first = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(int), {}
    for r in rows:
        k, v, a = r["killer_steamid"], r["victim_steamid"], r["assister_steamid"]
        if k is not None:
            kills[k] += 1
            hs[k] += r["headshot"] == 1
            key = (r["tick"], r["killer_name"] or "", r["timestamp_seconds"])
            if k not in first or key < first[k][0]:
                first[k] = (key, r["killer_name"], r["timestamp_seconds"])
        if v is not None:
            deaths[v] += 1
        if a is not None:
            assists[a] += 1
    out = {}
    for p, n in kills.items():
        d = deaths[p]
        out[p] = (first[p][1], n, d, assists[p],
                  half_up(n / d) if d else float(n), half_up(hs[p] / n * 100), first[p][2])
    return out


def skewed_rows(n=6000, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        killer = HOT if i % 3 == 0 else (None if rnd.random() < 0.1 else rnd.randint(HOT + 1, 60))
        rows.append(dict(
            killer_steamid=killer,
            killer_name=f"n{killer}" if killer is not None else None,
            victim_steamid=None if rnd.random() < 0.05 else rnd.randint(1, 60),
            assister_steamid=rnd.randint(1, 60) if rnd.random() < 0.4 else None,
            headshot=rnd.choice([0, 1, 1, None]),
            tick=i,  # unique ticks: the first kill is unambiguous
            timestamp_seconds=(i * 7) // 1000,
            round=rnd.randint(1, 30),
        ))
    return rows


def test_kill_stats_under_skew(make_kills):
    rows = skewed_rows()
    df = make_kills(rows).repartition(16)
    want = brute_kill_stats(rows)
    assert want[HOT][1] == 2000
    for op in (player_kill_stats, player_kill_stats_joined):
        got = {r.player_id: (r.player_name, r.kills, r.deaths, r.assists, r.kd_ratio,
                             r.headshot_percentage, r.timestamp_seconds) for r in op(df).collect()}
        assert got == want


def test_damage_stats_under_skew(make_damages):
    rnd = random.Random(9)
    rows = []
    for i in range(6000):
        attacker = None if i % 3 == 0 else rnd.randint(1, 40)   # a third: the NULL group
        rows.append(dict(attacker_steamid=attacker, victim_health=100,
                         victim_new_health=100 - rnd.randint(0, 99), round=rnd.randint(1, 24)))
    total, rounds = defaultdict(int), defaultdict(set)
    for r in rows:
        total[r["attacker_steamid"]] += r["victim_health"] - r["victim_new_health"]
        rounds[r["attacker_steamid"]].add(r["round"])
    want = {p: (total[p], len(rounds[p]), half_up(total[p] / len(rounds[p]))) for p in total}
    df = make_damages(rows).repartition(16)
    got = {r.player_id: (r.total_damage, r.rounds, r.damage_per_round)
           for r in player_damage_stats(df, exact=True).collect()}
    assert got == want
