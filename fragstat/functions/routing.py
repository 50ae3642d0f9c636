"""Column functions of the replay path: file name -> topic, tick -> seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
TOPIC_PREFIX = "game."
# The replay loop waits 1000 / 128 ms per tick in integer arithmetic, i.e. 7.
DEFAULT_MS_PER_TICK = 7
# ---------------------------------------------------------------------------


def _c(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def topic_for_file(file_name: str | Column = "file_name", prefix: str = TOPIC_PREFIX) -> Column:
    """Topic of a match-log file: the part after the last ``_`` up to its first
    ``.``, trimmed, with ``prefix`` in front.

    ``a-vs-b-m1_kills.csv`` -> ``game.kills``; ``x_y.z_kills.v2.csv`` ->
    ``game.kills``.  Trailing ``_`` are ignored, as a string split that drops
    trailing empty parts would.
    """
    name = F.regexp_replace(_c(file_name), "_+$", "")
    last_part = F.element_at(F.split(name, "_"), -1)
    return F.concat(F.lit(prefix), F.trim(F.substring_index(last_part, ".", 1)))


def elapsed_seconds(tick: str | Column = "tick", ms_per_tick: float = DEFAULT_MS_PER_TICK) -> Column:
    """Whole seconds since match start of a tick, on the replay clock.

    The replayer sends tick ``t`` after ``t`` sleeps of ``ms_per_tick``
    milliseconds, so its nominal elapsed time is ``floor(t * ms / 1000)``.
    Deterministic, unlike the wall clock; 7.8125 gives true 128-tick time.
    """
    t = _c(tick).cast("long")
    if float(ms_per_tick).is_integer():
        # Exact integer arithmetic: what is left after pmod is a multiple of
        # 1000, so this floors negative ticks too.
        ms = t * F.lit(int(ms_per_tick)).cast("long")
        whole = ms - F.pmod(ms, F.lit(1000).cast("long"))
        return F.call_function("div", whole, F.lit(1000).cast("long"))
    return F.floor(t * float(ms_per_tick) / 1000).cast("long")


def raw_field(line: str | Column, index: int = 1, dtype: str = "int") -> Column:
    """Field ``index`` (0-based) of a raw line split on ``,``, without CSV
    quoting rules; NULL when the line is too short or the value does not
    parse (``get`` / ``try_cast`` never raise under ANSI)."""
    return F.get(F.split(_c(line), ",", index + 2), index).try_cast(dtype)
