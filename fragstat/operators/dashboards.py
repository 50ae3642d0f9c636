"""Dashboard queries over the ``player_stats`` snapshot table.

The table holds one row per player per processed batch, so both panels
aggregate over snapshots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed value: the totals panel spells its last column this way ----------
HEADSHOT_TOTAL_COLUMN = "headshots_persantage"
# ---------------------------------------------------------------------------


def kd_trend(player_stats: DataFrame) -> DataFrame:
    """``SELECT DISTINCT kd_ratio, timestamp_seconds ... ORDER BY timestamp_seconds``."""
    return (
        player_stats.where(F.col("timestamp_seconds").isNotNull())
        .select("kd_ratio", "timestamp_seconds")
        .distinct()
        .orderBy("timestamp_seconds")
    )


def _cents_sum(col: str) -> F.Column:
    """Exact sum of two-decimal values: summed as whole hundredths, so the
    result does not depend on the order partitions are combined in."""
    return (F.sum(F.round(F.col(col) * 100).cast("long")) / 100).cast("double")


def player_totals(player_stats: DataFrame) -> DataFrame:
    """Per player name, sums over all snapshots of kills, deaths, assists and
    -- as the panel defines it -- of the two ratios."""
    return (
        player_stats.where(F.col("player_name").isNotNull())
        .groupBy("player_name")
        .agg(
            F.sum("kills").alias("kills"),
            F.sum("deaths").alias("deaths"),
            F.sum("assists").alias("assists"),
            _cents_sum("kd_ratio").alias("kd_ratio"),
            _cents_sum("headshot_percentage").alias(HEADSHOT_TOTAL_COLUMN),
        )
    )
