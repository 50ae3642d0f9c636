"""Derived player metrics as column expressions.

All three ratios round half-up to two decimals (``round``) and are guarded
against a zero denominator, which also keeps them safe under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def headshot_percentage(headshots: str | Column = "headshots", kills: str | Column = "kills") -> Column:
    """``kills > 0 ? round(headshots / kills * 100, 2) : 0.0``."""
    k = _c(kills)
    return F.when(k > 0, F.round(_c(headshots) / k * 100, 2)).otherwise(F.lit(0.0))


def kd_ratio(kills: str | Column = "kills", deaths: str | Column = "deaths") -> Column:
    """``deaths > 0 ? round(kills / deaths, 2) : kills`` as a double."""
    k, d = _c(kills), _c(deaths)
    return F.when(d > 0, F.round(k / d, 2)).otherwise(k.cast("double"))


def damage_per_round(total_damage: str | Column = "total_damage", rounds: str | Column = "rounds") -> Column:
    """``rounds > 0 ? round(total_damage / rounds, 2) : 0.0``; NULL damage stays NULL."""
    r = _c(rounds)
    return F.when(r > 0, F.round(_c(total_damage) / r, 2)).otherwise(F.lit(0.0))
