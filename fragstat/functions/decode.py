"""Payload decode and encode: one CSV line per event <-> typed row.

Everything here is a column expression (``from_csv`` / ``to_csv``), so it
runs inside whole-stage codegen on the executors and works unchanged on a
streaming frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import to_ddl, with_field

# PERMISSIVE is the only mode that keeps bad rows; ``from_csv`` rejects
# DROPMALFORMED and FAILFAST would stop a stream on one bad line.
DECODE_OPTIONS = {"mode": "PERMISSIVE", "delimiter": ","}

# Outer spaces and doubles must survive an encode -> decode round trip.
ENCODE_OPTIONS = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def payload_text(value: str | Column = "value") -> Column:
    """Kafka-style ``value`` (binary or string) as a string."""
    col = F.col(value) if isinstance(value, str) else value
    return col.cast("string")


def decode_csv(
    df: DataFrame,
    schema: StructType,
    value_col: str = "value",
    keep: tuple[str, ...] = (),
    corrupt_col: str | None = None,
) -> DataFrame:
    """Parse one CSV line per row into the fields of ``schema``.

    Semantics follow ``from_csv`` PERMISSIVE: missing trailing fields and
    unparsable numbers become NULL, extra fields are dropped, the row is
    always kept.  ``keep`` carries source columns (topic, offset, ...) next
    to the decoded fields.  With ``corrupt_col`` the raw line of every row
    that did not parse cleanly is kept in that column (quarantine output).
    """
    options = dict(DECODE_OPTIONS)
    target = schema
    if corrupt_col:
        target = with_field(schema, corrupt_col)
        options["columnNameOfCorruptRecord"] = corrupt_col
    parsed = F.from_csv(payload_text(value_col), to_ddl(target), options)
    return df.select(*keep, parsed.alias("_event")).select(*keep, "_event.*")


def encode_csv(columns: list[str] | None = None, df: DataFrame | None = None) -> Column:
    """One CSV line from the given columns (all columns of ``df`` if omitted)."""
    names = columns if columns is not None else df.columns
    return F.to_csv(F.struct(*[F.col(c) for c in names]), ENCODE_OPTIONS)


def damage_dealt(health: str = "victim_health", new_health: str = "victim_new_health") -> Column:
    """``victim_health - victim_new_health``; NULL if either side is NULL.

    No clamp, so it may be negative.  ``try_subtract`` returns NULL on
    integer overflow instead of failing the job under ANSI mode.
    """
    return F.try_subtract(F.col(health), F.col(new_health))


def with_damage_dealt(df: DataFrame) -> DataFrame:
    return df.withColumn("damage_dealt", damage_dealt())
