"""Event and result schemas.

The schemas are fixed and declared here, never inferred.  Every reader and
decoder takes one of these ``StructType`` objects, so batch files, topic
payloads and test views all agree on names, order and types.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values: event layouts (column order = CSV field order) -----------
# kills: 44 columns; the last one (timestamp_seconds) is not in the match-log
# file, it is appended when a line is replayed.
KILLS_DDL = """
frame INT NOT NULL, tick INT NOT NULL, round INT NOT NULL,
killer_name STRING, killer_steamid BIGINT, killer_side INT, killer_team_name STRING,
victim_name STRING, victim_steamid BIGINT, victim_side INT, victim_team_name STRING,
assister_name STRING, assister_steamid BIGINT, assister_side INT, assister_team_name STRING,
weapon_name STRING, weapon_type STRING,
headshot INT, penetrated_objects INT, is_flash_assist INT,
killer_controlling_bot INT, victim_controlling_bot INT, assister_controlling_bot INT,
killer_x DOUBLE, killer_y DOUBLE, killer_z DOUBLE,
is_killer_airborne INT, is_killer_blinded INT,
victim_x DOUBLE, victim_y DOUBLE, victim_z DOUBLE,
is_victim_airborne INT, is_victim_blinded INT, is_victim_inspecting_weapon INT,
assister_x DOUBLE, assister_y DOUBLE, assister_z DOUBLE,
is_trade_kill INT, is_trade_death INT, is_through_smoke INT, is_no_scope INT,
distance DOUBLE, match_checksum STRING,
timestamp_seconds BIGINT
"""

# damages: 23 columns; timestamp_seconds again appended on replay.
DAMAGES_DDL = """
frame INT NOT NULL, tick INT NOT NULL, round INT NOT NULL,
health INT, armor INT,
victim_health INT, victim_new_health INT, victim_armor INT, victim_new_armor INT,
attacker_steamid BIGINT, attacker_side INT, attacker_team_name STRING,
is_attacker_controlling_bot INT,
victim_steamid BIGINT, victim_side INT, victim_team_name STRING,
is_victim_controlling_bot INT,
weapon_name STRING, weapon_class STRING, hitgroup INT,
weapon_unique_id STRING, match_checksum STRING,
timestamp_seconds BIGINT
"""

# result tables (before the sink adds batch_id / recorded_at)
PLAYER_STATS_DDL = """
player_id BIGINT, player_name STRING, kills BIGINT, deaths BIGINT, assists BIGINT,
kd_ratio DOUBLE, headshot_percentage DOUBLE, timestamp_seconds BIGINT
"""

PLAYER_DAMAGE_STATS_DDL = """
player_id BIGINT, total_damage BIGINT, rounds BIGINT, damage_per_round DOUBLE
"""

# What a batch stores so that rounds can be counted over many batches.
PLAYER_DAMAGE_SKETCHES_DDL = "player_id BIGINT, total_damage BIGINT, rounds_sketch BINARY"

# Topic names a match-log file is routed to.
KILLS_TOPIC = "game.kills"
DAMAGES_TOPIC = "game.damages"
# ---------------------------------------------------------------------------

# Column appended on replay; not present in match-log files.
REPLAY_TIME_COLUMN = "timestamp_seconds"


_TYPES: dict[str, DataType] = {
    "INT": IntegerType(),
    "BIGINT": LongType(),
    "STRING": StringType(),
    "DOUBLE": DoubleType(),
    "TIMESTAMP": TimestampType(),
    "BINARY": BinaryType(),
}


def _schema(ddl: str) -> StructType:
    """Flat ``name TYPE [NOT NULL]`` lists only (all the layouts above use)."""
    fields = []
    for item in " ".join(ddl.split()).split(","):
        name, dtype, *rest = item.split()
        fields.append(StructField(name, _TYPES[dtype], nullable=rest != ["NOT", "NULL"]))
    return StructType(fields)


KILLS = _schema(KILLS_DDL)
DAMAGES = _schema(DAMAGES_DDL)
PLAYER_STATS = _schema(PLAYER_STATS_DDL)
PLAYER_DAMAGE_STATS = _schema(PLAYER_DAMAGE_STATS_DDL)
PLAYER_DAMAGE_SKETCHES = _schema(PLAYER_DAMAGE_SKETCHES_DDL)

EVENT_SCHEMAS = {"kills": KILLS, "damages": DAMAGES}


def file_schema(schema: StructType) -> StructType:
    """Layout of a match-log file: the event schema minus the replay time."""
    return StructType([f for f in schema.fields if f.name != REPLAY_TIME_COLUMN])


def nullable(schema: StructType) -> StructType:
    """Every field nullable -- the schema rows have after ``from_csv`` or
    the CSV reader, which do not enforce NOT NULL."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def to_ddl(schema: StructType) -> str:
    """DDL string accepted by ``from_csv`` / ``DataFrameReader.schema``."""
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
    )


def with_field(schema: StructType, name: str, dtype: DataType | None = None) -> StructType:
    return StructType(
        list(schema.fields) + [StructField(name, dtype or StringType(), True)]
    )
