"""fragstat: player statistics from match event logs, on Spark.

Batch and streaming inputs share one code path: every operator takes and
returns a DataFrame.  The main entry points are re-exported here.
"""

from .config import build_session, checkpoint_root
from .functions.decode import decode_csv, encode_csv
from .operators.damage_stats import player_damage_stats
from .operators.dashboards import kd_trend, player_totals
from .operators.kill_stats import (
    player_identity,
    player_kill_stats,
    player_kill_stats_joined,
    player_stats_snapshots,
)
from .operators.replay import replay_order, route_topic, to_payload, with_elapsed_seconds
from .sinks.table import compact, latest_per_batch, read_result_table, table_sink, write_batch, write_batches
from .sources.files import read_lines, read_match_logs, read_roster
from .sources.topic import decode_events, read_topic, read_topic_log
from .streaming.jobs import run_match_stats, start_damage_stats, start_kill_stats

__version__ = "0.1.0"

__all__ = [
    "build_session", "checkpoint_root", "decode_csv", "encode_csv",
    "player_damage_stats", "kd_trend", "player_totals", "player_identity",
    "player_kill_stats", "player_kill_stats_joined", "player_stats_snapshots",
    "replay_order", "route_topic", "to_payload", "with_elapsed_seconds",
    "compact", "latest_per_batch", "read_result_table", "table_sink", "write_batch", "write_batches",
    "read_lines", "read_match_logs", "read_roster",
    "decode_events", "read_topic", "read_topic_log",
    "run_match_stats", "start_damage_stats", "start_kill_stats",
]
