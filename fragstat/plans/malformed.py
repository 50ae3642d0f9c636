"""Payloads damaged on purpose, row by row, for the decode queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.decode import encode_csv


def damaged_lines(events: DataFrame) -> DataFrame:
    """``value`` of each kill: lines of kills without a killer keep only their
    first 10 fields, headshot lines get an unparsable tick, others are intact."""
    line = encode_csv(events.columns)
    payload = (
        F.when(F.col("killer_steamid").isNull(), F.substring_index(line, ",", 10))
        .when(F.col("headshot") == 1, F.regexp_replace(line, "^([^,]*),", "$1,x"))
        .otherwise(line)
    )
    return events.select(payload.alias("value"))
