"""JDBC result sink and reader (PostgreSQL in production).

Spark's JDBC writer in ``append`` mode creates a missing table from the
frame's schema using the database dialect; for PostgreSQL that gives the
same column types as :data:`SQL_TYPES`.  :func:`create_table_ddl` spells
the statement out for databases provisioned ahead of time.  Complex
columns (array, map, struct) are stored as JSON text.

Delivery is at-least-once: a batch that is run again is appended again.
Rows carry ``batch_id`` and ``recorded_at``; readers apply
:func:`fragstat.sinks.table.latest_per_batch`, which keeps the latest write
of each batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructType,
    TimestampType,
)

from .table import stamp

# --- fixed values: column type of each Spark type in the result tables -------
SQL_TYPES: list[tuple[type[DataType], str]] = [
    (StringType, "TEXT"),
    (IntegerType, "INTEGER"),
    (LongType, "BIGINT"),
    (DoubleType, "DOUBLE PRECISION"),
    (FloatType, "REAL"),
    (BooleanType, "BOOLEAN"),
    (DecimalType, "DECIMAL"),
    (TimestampType, "TIMESTAMP"),
    (DateType, "DATE"),
    (ArrayType, "TEXT"),
]
DEFAULT_SQL_TYPE = "TEXT"
# ---------------------------------------------------------------------------


def sql_type(dtype: DataType) -> str:
    for spark_type, name in SQL_TYPES:
        if isinstance(dtype, spark_type):
            return name
    return DEFAULT_SQL_TYPE


def column_types(schema: StructType) -> str:
    """``name TYPE, ...`` for Spark's ``createTableColumnTypes``.

    Spark parses these types itself before it hands them to the database, so
    only those go in that its own parser knows; it derives the others
    (``TEXT``, ``DOUBLE PRECISION``) from the database's dialect, with the
    same result."""
    known = {"INTEGER", "BIGINT", "REAL", "BOOLEAN", "DECIMAL", "TIMESTAMP", "DATE"}
    return ", ".join(f"{f.name} {sql_type(f.dataType)}" for f in schema.fields if sql_type(f.dataType) in known)


def create_table_ddl(table: str, schema: StructType) -> str:
    cols = ", ".join(f"{f.name} {sql_type(f.dataType)}" for f in schema.fields)
    return f"CREATE TABLE IF NOT EXISTS {table} ({cols})"


def jdbc_ready(df: DataFrame) -> DataFrame:
    """Complex columns as JSON strings (stored as TEXT)."""
    cols = [
        F.to_json(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (ArrayType, MapType, StructType)) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    batch_id: int | None = None,
    num_partitions: int | None = None,
    batch_size: int | None = None,
) -> None:
    """Stamp and append a result to a JDBC table (created if missing).

    ``num_partitions`` caps concurrent connections (Spark coalesces to it);
    ``batch_size`` sets rows per insert round trip.
    """
    rows = jdbc_ready(stamp(df, batch_id))
    writer = rows.write.mode("append")
    if types := column_types(rows.schema):
        writer = writer.option("createTableColumnTypes", types)
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    if batch_size:
        writer = writer.option("batchsize", str(batch_size))
    writer.jdbc(url, table, properties=properties)


def jdbc_sink(url: str, table: str, properties: dict[str, str], **kwargs):
    """``(df, batch_id) -> None`` writer for :mod:`fragstat.streaming`."""
    def sink(df: DataFrame, batch_id: int) -> None:
        write_jdbc(df, url, table, properties, batch_id=batch_id, **kwargs)
    return sink


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Result table over JDBC; filters on it are pushed to the database.

    Without a partition column the read is one query on one connection (one
    task).  For a large table pass a numeric column (``batch_id``) with its
    bounds and ``num_partitions``: Spark then issues that many range queries
    in parallel.
    """
    if partition_column:
        return spark.read.jdbc(
            url, table, column=partition_column, lowerBound=lower_bound,
            upperBound=upper_bound, numPartitions=num_partitions, properties=properties,
        )
    return spark.read.jdbc(url, table, properties=properties)
