"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark code: roles via UNION ALL instead of
``inline``, ``arg_min`` for the first kill, and integer arithmetic for the
half-up rounding where DuckDB's ``round`` on a double would differ from
Spark's at exact ties (``(200*a + b) // (2*b) / 100`` = half-up of ``a/b``
to two places, for ``a, b >= 0``).  ``SUM`` is cast to BIGINT because
DuckDB widens it to HUGEINT.
"""

from __future__ import annotations

# --- event views over lineitem (same mapping as sources/testviews.py) ------
KILL_COLUMNS_SQL = """
  CAST(NULL AS INTEGER) AS frame,
  CAST(l_orderkey % 10000 AS INTEGER) AS tick,
  CAST(l_orderkey % 10000 % 61 AS INTEGER) AS round,
  'p' || CAST(l_suppkey AS VARCHAR) || '_' || CAST(l_orderkey % 10000 % 3 AS VARCHAR) AS killer_name,
  CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL ELSE l_suppkey END AS killer_steamid,
  CAST(NULL AS INTEGER) AS killer_side,
  CAST(NULL AS VARCHAR) AS killer_team_name,
  CAST(NULL AS VARCHAR) AS victim_name,
  l_partkey % 97 AS victim_steamid,
  CAST(NULL AS INTEGER) AS victim_side,
  CAST(NULL AS VARCHAR) AS victim_team_name,
  CAST(NULL AS VARCHAR) AS assister_name,
  CASE WHEN l_linestatus = 'O' THEN l_partkey % 89 END AS assister_steamid,
  CAST(NULL AS INTEGER) AS assister_side,
  CAST(NULL AS VARCHAR) AS assister_team_name,
  CAST(NULL AS VARCHAR) AS weapon_name,
  CAST(NULL AS VARCHAR) AS weapon_type,
  CASE WHEN l_quantity > 40 THEN 1 WHEN l_quantity > 10 THEN 0 END AS headshot,
  CAST(NULL AS INTEGER) AS penetrated_objects,
  CAST(NULL AS INTEGER) AS is_flash_assist,
  CAST(NULL AS INTEGER) AS killer_controlling_bot,
  CAST(NULL AS INTEGER) AS victim_controlling_bot,
  CAST(NULL AS INTEGER) AS assister_controlling_bot,
  CAST(NULL AS DOUBLE) AS killer_x,
  CAST(NULL AS DOUBLE) AS killer_y,
  CAST(NULL AS DOUBLE) AS killer_z,
  CAST(NULL AS INTEGER) AS is_killer_airborne,
  CAST(NULL AS INTEGER) AS is_killer_blinded,
  CAST(NULL AS DOUBLE) AS victim_x,
  CAST(NULL AS DOUBLE) AS victim_y,
  CAST(NULL AS DOUBLE) AS victim_z,
  CAST(NULL AS INTEGER) AS is_victim_airborne,
  CAST(NULL AS INTEGER) AS is_victim_blinded,
  CAST(NULL AS INTEGER) AS is_victim_inspecting_weapon,
  CAST(NULL AS DOUBLE) AS assister_x,
  CAST(NULL AS DOUBLE) AS assister_y,
  CAST(NULL AS DOUBLE) AS assister_z,
  CAST(NULL AS INTEGER) AS is_trade_kill,
  CAST(NULL AS INTEGER) AS is_trade_death,
  CAST(NULL AS INTEGER) AS is_through_smoke,
  CAST(NULL AS INTEGER) AS is_no_scope,
  CAST(NULL AS DOUBLE) AS distance,
  'm' || CAST(l_orderkey // 10000 AS VARCHAR) AS match_checksum,
  (l_orderkey % 10000 * 7) // 1000 AS timestamp_seconds
"""

DAMAGE_COLUMNS_SQL = """
  CAST(NULL AS INTEGER) AS frame,
  CAST(l_orderkey % 10000 AS INTEGER) AS tick,
  CAST(l_orderkey % 10000 % 61 AS INTEGER) AS round,
  CAST(NULL AS INTEGER) AS health,
  CAST(NULL AS INTEGER) AS armor,
  CASE WHEN l_quantity <> 7 THEN 100 END AS victim_health,
  105 - CAST(l_quantity AS INTEGER) AS victim_new_health,
  CAST(NULL AS INTEGER) AS victim_armor,
  CAST(NULL AS INTEGER) AS victim_new_armor,
  CASE WHEN l_linenumber <> 2 THEN l_suppkey END AS attacker_steamid,
  CAST(NULL AS INTEGER) AS attacker_side,
  CAST(NULL AS VARCHAR) AS attacker_team_name,
  CAST(NULL AS INTEGER) AS is_attacker_controlling_bot,
  CAST(NULL AS BIGINT) AS victim_steamid,
  CAST(NULL AS INTEGER) AS victim_side,
  CAST(NULL AS VARCHAR) AS victim_team_name,
  CAST(NULL AS INTEGER) AS is_victim_controlling_bot,
  CAST(NULL AS VARCHAR) AS weapon_name,
  CAST(NULL AS VARCHAR) AS weapon_class,
  CAST(NULL AS INTEGER) AS hitgroup,
  CAST(NULL AS VARCHAR) AS weapon_unique_id,
  'm' || CAST(l_orderkey // 10000 AS VARCHAR) AS match_checksum,
  (l_orderkey % 10000 * 7) // 1000 AS timestamp_seconds
"""

KILLS_CTE = f"kills AS (SELECT {KILL_COLUMNS_SQL} FROM lineitem)"
DAMAGES_CTE = f"damages AS (SELECT {DAMAGE_COLUMNS_SQL} FROM lineitem)"


def half_up_2(num: str, den: str) -> str:
    """Half-up rounding of ``num / den`` to two places, in integers."""
    return f"CAST((200 * ({num}) + ({den})) // (2 * ({den})) AS DOUBLE) / 100"


def _kill_stats_sql(by: str = "") -> str:
    """Per-batch player statistics; ``by`` = extra grouping column or ''."""
    b = f"{by}, " if by else ""
    using = f"{by}, player_id" if by else "player_id"
    return f"""
roles AS (
  SELECT {b}killer_steamid AS player_id, 1 AS k, 0 AS d, 0 AS a,
         CASE WHEN headshot = 1 THEN 1 ELSE 0 END AS hs
  FROM kills WHERE killer_steamid IS NOT NULL
  UNION ALL
  SELECT {b}victim_steamid, 0, 1, 0, 0 FROM kills WHERE victim_steamid IS NOT NULL
  UNION ALL
  SELECT {b}assister_steamid, 0, 0, 1, 0 FROM kills WHERE assister_steamid IS NOT NULL
),
counts AS (
  SELECT {b}player_id,
         CAST(SUM(k) AS BIGINT) AS kills, CAST(SUM(d) AS BIGINT) AS deaths,
         CAST(SUM(a) AS BIGINT) AS assists, CAST(SUM(hs) AS BIGINT) AS headshots
  FROM roles GROUP BY {b}player_id
),
ident AS (
  SELECT {b}killer_steamid AS player_id,
         arg_min(killer_name, tick) AS player_name,
         arg_min(timestamp_seconds, tick) AS timestamp_seconds
  FROM kills WHERE killer_steamid IS NOT NULL GROUP BY {b}killer_steamid
),
stats AS (
  SELECT {b}player_id, player_name, kills, deaths, assists,
         CASE WHEN deaths > 0 THEN {half_up_2('kills', 'deaths')}
              ELSE CAST(kills AS DOUBLE) END AS kd_ratio,
         CASE WHEN kills > 0 THEN round(headshots / kills * 100, 2)
              ELSE CAST(0.0 AS DOUBLE) END AS headshot_percentage,
         timestamp_seconds
  FROM counts JOIN ident USING ({using})
  WHERE kills > 0
)"""


PLAYER_KILL_STATS = f"""
WITH {KILLS_CTE},
{_kill_stats_sql()}
SELECT * FROM stats
"""

KILLS_BY_KILLER = f"""
WITH {KILLS_CTE}
SELECT killer_steamid AS player_id, COUNT(*) AS kills,
       CAST(SUM(CASE WHEN headshot = 1 THEN 1 ELSE 0 END) AS BIGINT) AS headshots
FROM kills WHERE killer_steamid IS NOT NULL GROUP BY killer_steamid
"""

DEATHS_BY_VICTIM = f"""
WITH {KILLS_CTE}
SELECT victim_steamid AS player_id, COUNT(*) AS deaths
FROM kills WHERE victim_steamid IS NOT NULL GROUP BY victim_steamid
"""

ASSISTS_BY_ASSISTER = f"""
WITH {KILLS_CTE}
SELECT assister_steamid AS player_id, COUNT(*) AS assists
FROM kills WHERE assister_steamid IS NOT NULL GROUP BY assister_steamid
"""

PLAYER_IDENTITY = f"""
WITH {KILLS_CTE}
SELECT killer_steamid AS player_id,
       arg_min(killer_name, tick) AS player_name,
       arg_min(timestamp_seconds, tick) AS timestamp_seconds
FROM kills WHERE killer_steamid IS NOT NULL GROUP BY killer_steamid
"""

DAMAGE_DEALT = f"""
WITH {DAMAGES_CTE}
SELECT tick, round, attacker_steamid, victim_health - victim_new_health AS damage_dealt
FROM damages
"""

def _damage_stats_sql(rounds: str) -> str:
    return f"""
WITH {DAMAGES_CTE},
agg AS (
  SELECT attacker_steamid AS player_id,
         CAST(SUM(victim_health - victim_new_health) AS BIGINT) AS total_damage,
         COUNT(DISTINCT {rounds}) AS rounds
  FROM damages GROUP BY attacker_steamid
)
SELECT player_id, total_damage, rounds,
       CASE WHEN rounds > 0 THEN sign(total_damage) * {half_up_2('abs(total_damage)', 'rounds')}
            ELSE CAST(0.0 AS DOUBLE) END AS damage_per_round
FROM agg
"""


PLAYER_DAMAGE_STATS = _damage_stats_sql("round")
PLAYER_DAMAGE_STATS_BY_MATCH = _damage_stats_sql("match_checksum || ':' || CAST(round AS VARCHAR)")

ORACLE_SQL: dict[str, str] = {
    "player_kill_stats": PLAYER_KILL_STATS,
    "player_kill_stats_joined": PLAYER_KILL_STATS,
    "kills_by_killer": KILLS_BY_KILLER,
    "deaths_by_victim": DEATHS_BY_VICTIM,
    "assists_by_assister": ASSISTS_BY_ASSISTER,
    "player_identity": PLAYER_IDENTITY,
    "damage_dealt": DAMAGE_DEALT,
    "player_damage_stats": PLAYER_DAMAGE_STATS,
    "player_damage_stats_exact": PLAYER_DAMAGE_STATS,
    "player_damage_stats_by_match": PLAYER_DAMAGE_STATS_BY_MATCH,
}


# --- decode, routing, replay ------------------------------------------------

def _csv_line(columns_sql: str) -> str:
    """SQL for one CSV line of the given ``expr AS name`` list (NULL -> '')."""
    names = [c.strip().rsplit(" AS ", 1)[1] for c in columns_sql.strip().split(",\n")]
    return " || ',' || ".join(f"coalesce(CAST({n} AS VARCHAR), '')" for n in names)


CSV_DECODE_KILLS = f"SELECT {KILL_COLUMNS_SQL} FROM lineitem"

CSV_DECODE_DAMAGES = f"""
WITH {DAMAGES_CTE}
SELECT *, victim_health - victim_new_health AS damage_dealt FROM damages
"""

# Kills without a killer were cut after field 10 (tail NULL); headshot lines
# carry an unparsable tick.
CSV_DECODE_MALFORMED = f"""
WITH {KILLS_CTE}
SELECT * REPLACE (
  CASE WHEN killer_steamid IS NULL THEN tick WHEN headshot = 1 THEN NULL ELSE tick END AS tick,
  CASE WHEN killer_steamid IS NULL THEN NULL ELSE assister_steamid END AS assister_steamid,
  CASE WHEN killer_steamid IS NULL THEN NULL ELSE headshot END AS headshot,
  CASE WHEN killer_steamid IS NULL THEN NULL ELSE match_checksum END AS match_checksum,
  CASE WHEN killer_steamid IS NULL THEN NULL ELSE timestamp_seconds END AS timestamp_seconds
)
FROM kills
"""

MATCH_FILE_NAME_SQL = """
  'team_' || CAST(l_suppkey AS VARCHAR) || '.vs_' || CAST(l_partkey % 7 AS VARCHAR)
  || '-m' || CAST(l_linenumber AS VARCHAR) || '_'
  || CASE l_returnflag WHEN 'A' THEN 'kills.v2' WHEN 'R' THEN ' damages ' ELSE 'kills' END
  || '.csv'
"""

TOPIC_ROUTING = f"""
WITH files AS (SELECT {MATCH_FILE_NAME_SQL} AS file_name FROM lineitem)
SELECT file_name,
       'game.' || trim(split_part(string_split(regexp_replace(file_name, '_+$', ''), '_')[-1], '.', 1)) AS topic,
       COUNT(*) AS events
FROM files GROUP BY ALL
"""

ELAPSED_SECONDS = """
SELECT l_orderkey AS tick,
       (l_orderkey * 7) // 1000 AS timestamp_seconds,
       CAST(floor(l_orderkey * 7.8125 / 1000) AS BIGINT) AS timestamp_seconds_128
FROM lineitem
"""

def _records_sql(topic: str, columns_sql: str, table: str) -> str:
    return f"""
SELECT '{topic}' AS topic, match_checksum || ':' || CAST(tick AS VARCHAR) || ':' || substr(md5(value), 1, 16) AS key, value
FROM (SELECT match_checksum, tick, {_csv_line(columns_sql)} AS value FROM {table})
"""


REPLAY_PAYLOADS = f"""
WITH {KILLS_CTE}, {DAMAGES_CTE}
{_records_sql('game.kills', KILL_COLUMNS_SQL, 'kills')}
UNION ALL
{_records_sql('game.damages', DAMAGE_COLUMNS_SQL, 'damages')}
"""

# --- snapshots and dashboards -------------------------------------------------

SNAPSHOT_KILLS_CTE = (
    f"kills AS (SELECT {KILL_COLUMNS_SQL}, ((l_orderkey % 10000 * 7) // 1000) // 10 AS batch_id FROM lineitem)"
)

PLAYER_STATS_SNAPSHOTS = f"""
WITH {SNAPSHOT_KILLS_CTE},
{_kill_stats_sql('batch_id')}
SELECT * FROM stats
"""

KD_TREND = f"""
WITH {SNAPSHOT_KILLS_CTE},
{_kill_stats_sql('batch_id')}
SELECT DISTINCT kd_ratio, timestamp_seconds FROM stats
WHERE timestamp_seconds IS NOT NULL
ORDER BY timestamp_seconds
"""

PLAYER_TOTALS = f"""
WITH {SNAPSHOT_KILLS_CTE},
{_kill_stats_sql('batch_id')}
SELECT player_name,
       CAST(SUM(kills) AS BIGINT) AS kills,
       CAST(SUM(deaths) AS BIGINT) AS deaths,
       CAST(SUM(assists) AS BIGINT) AS assists,
       round(SUM(kd_ratio), 2) AS kd_ratio,
       round(SUM(headshot_percentage), 2) AS headshots_persantage
FROM stats WHERE player_name IS NOT NULL
GROUP BY player_name
"""

ORACLE_SQL.update({
    "csv_decode_kills": CSV_DECODE_KILLS,
    "csv_decode_damages": CSV_DECODE_DAMAGES,
    "csv_decode_malformed": CSV_DECODE_MALFORMED,
    "topic_routing": TOPIC_ROUTING,
    "elapsed_seconds": ELAPSED_SECONDS,
    "replay_payloads": REPLAY_PAYLOADS,
    "player_stats_snapshots": PLAYER_STATS_SNAPSHOTS,
    "kd_trend": KD_TREND,
    "player_totals": PLAYER_TOTALS,
})


# --- staged through files and streams ----------------------------------------

def _without_replay_time(columns_sql: str) -> str:
    return ",\n".join(c for c in columns_sql.strip().split(",\n") if not c.strip().endswith(" AS timestamp_seconds"))


MATCH_LOG_KILLS = f"""
WITH {KILLS_CTE}
SELECT *, 'game.kills' AS topic FROM kills
"""

RAW_LINES = f"""
WITH {KILLS_CTE}
SELECT {_csv_line(_without_replay_time(KILL_COLUMNS_SQL))} AS line, tick
FROM kills
"""

# Both kinds' lines as they stand in the match files, with the blank lines between.
LINE_FILES_CTE = f"""
{KILLS_CTE}, {DAMAGES_CTE},
event_lines AS (
  SELECT match_checksum || '_kills.csv' AS file_name, tick, {_csv_line(_without_replay_time(KILL_COLUMNS_SQL))} AS line FROM kills
  UNION ALL
  SELECT match_checksum || '_damages.csv', tick, {_csv_line(_without_replay_time(DAMAGE_COLUMNS_SQL))} FROM damages
),
file_lines AS (
  SELECT file_name, tick, md5(line) AS digest, 0 AS follows, line FROM event_lines
  UNION ALL
  SELECT file_name, tick, md5(line), 1, CASE WHEN tick % 3 = 0 THEN '' ELSE '  ' END FROM event_lines
  WHERE tick % 3 = 0 OR tick % 5 = 0
)"""

NUMBERED_LINES = f"""
WITH {LINE_FILES_CTE}
SELECT file_name, row_number() OVER (PARTITION BY file_name ORDER BY tick, digest, follows) - 1 AS line_number, line
FROM file_lines
"""

REPLAY_NUMBERED = f"""
WITH {LINE_FILES_CTE},
played AS (
  SELECT *, row_number() OVER (ORDER BY tick, file_name, digest) - 1 AS number FROM file_lines WHERE follows = 0
)
SELECT number, 'game.' || split_part(split_part(file_name, '_', 2), '.', 1) AS topic, CAST(number AS VARCHAR) AS key,
       line || ',' || CAST((CAST(tick AS BIGINT) * 7) // 1000 AS VARCHAR) AS value
FROM played
"""

REPLAY_UNPLAYABLE = f"""
WITH {LINE_FILES_CTE}
SELECT file_name, line, COUNT(*) AS n_lines FROM file_lines WHERE follows = 1 GROUP BY file_name, line
"""

ROSTER_LINES = "SELECT CAST(s_suppkey AS VARCHAR) || ',' || s_name AS line FROM supplier"

STREAM_KILL_STATS = f"""
WITH {KILLS_CTE},
{_kill_stats_sql()}
SELECT *, CAST(0 AS BIGINT) AS batch_id FROM stats
"""

STREAM_DAMAGE_STATS = f"""
SELECT *, CAST(0 AS BIGINT) AS batch_id FROM ({PLAYER_DAMAGE_STATS})
"""

# One micro-batch for each file, one file for each match.
STREAM_KILL_STATS_PER_FILE = f"""
WITH {KILLS_CTE},
{_kill_stats_sql('match_checksum')}
SELECT * EXCLUDE (match_checksum) FROM stats
"""

# What the quarantine keeps: the damaged lines themselves, whole.
CSV_DECODE_QUARANTINE = f"""
WITH {KILLS_CTE}, lines AS (SELECT *, {_csv_line(KILL_COLUMNS_SQL)} AS line FROM kills)
SELECT CASE WHEN killer_steamid IS NULL THEN array_to_string(string_split(line, ',')[1:10], ',')
            ELSE regexp_replace(line, '^([^,]*),', '\\1,x') END AS corrupt
FROM lines WHERE killer_steamid IS NULL OR headshot = 1
"""

# Both streams' tables, side by side.
STREAM_MATCH_STATS = f"""
WITH {KILLS_CTE}, {DAMAGES_CTE},
{_kill_stats_sql()},
damage AS (
  SELECT attacker_steamid AS player_id, CAST(SUM(victim_health - victim_new_health) AS BIGINT) AS total_damage,
         COUNT(DISTINCT round) AS rounds
  FROM damages GROUP BY attacker_steamid
)
SELECT coalesce(s.player_id, d.player_id) AS player_id, player_name, kills, deaths, assists, total_damage, rounds
FROM stats AS s FULL JOIN damage AS d ON s.player_id IS NOT DISTINCT FROM d.player_id
"""

# What the quarantine lets through.
STREAM_QUARANTINE_GOOD = f"""
WITH {KILLS_CTE}
SELECT * FROM kills WHERE NOT (killer_steamid IS NULL OR coalesce(headshot = 1, false))
"""

ORACLE_SQL.update({
    "stream_restart": STREAM_KILL_STATS_PER_FILE,
    "stream_match_stats": STREAM_MATCH_STATS,
    "stream_quarantine_good": STREAM_QUARANTINE_GOOD,
    "stream_quarantine_bad": CSV_DECODE_QUARANTINE,
    "damage_rounds_over_batches": PLAYER_DAMAGE_STATS,
    "player_totals_rolled": PLAYER_TOTALS,
    "kd_trend_rolled": KD_TREND,
    "stream_kill_stats_per_file": STREAM_KILL_STATS_PER_FILE,
    "csv_decode_quarantine": CSV_DECODE_QUARANTINE,
    "retried_batches": PLAYER_TOTALS,
    "backfill_player_stats": PLAYER_STATS_SNAPSHOTS,
    "match_log_kills": MATCH_LOG_KILLS,
    "raw_lines": RAW_LINES,
    "numbered_lines": NUMBERED_LINES,
    "replay_numbered": REPLAY_NUMBERED,
    "replay_unplayable": REPLAY_UNPLAYABLE,
    "roster_lines": ROSTER_LINES,
    "stream_kill_stats": STREAM_KILL_STATS,
    "stream_damage_stats": STREAM_DAMAGE_STATS,
})
