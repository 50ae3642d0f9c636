"""Match-log folder sources (batch or streaming).

A match folder holds ``<match>_kills.csv``, ``<match>_damages.csv`` and
``<match>_players.csv`` files, each with a header line.  Files are selected
by name suffix with ``pathGlobFilter`` (the folder itself, not recursive),
parsed with the fixed event schema by Spark's CSV reader -- which prunes
unused columns and splits large files across tasks -- and tagged with the
source file name from ``_metadata``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.decode import with_damage_dealt
from ..functions.routing import DEFAULT_MS_PER_TICK
from ..operators.replay import route_topic, with_elapsed_seconds
from ..schemas import EVENT_SCHEMAS, file_schema
from .lines import read_numbered_lines

LINE_SCHEMA = StructType([StructField("line", StringType(), True)])


def name_glob(kind: str) -> str:
    return f"*_{kind}.csv"


def read_match_logs(
    spark: SparkSession,
    folder: str,
    kind: str = "kills",
    streaming: bool = False,
    ms_per_tick: float = DEFAULT_MS_PER_TICK,
    max_files_per_trigger: int | None = None,
    with_source: bool = True,
    glob: str | None = None,
    topic: str | None = None,
) -> DataFrame:
    """Events of one kind from every ``*_<kind>.csv`` file in ``folder``, or
    from the files that ``glob`` names.

    The header line of each file is skipped; ``timestamp_seconds`` (not in
    the files) is added from the tick on the replay clock, ``damage_dealt``
    for damages.  With ``with_source`` the rows carry ``file_name`` and the
    ``topic`` the file routes to (or the given ``topic``, for files whose
    names do not tell, such as those of Spark's own writers).  Malformed fields become NULL (PERMISSIVE).
    """
    schema = EVENT_SCHEMAS[kind]
    reader = spark.readStream if streaming else spark.read
    reader = (
        reader.schema(file_schema(schema))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", glob or name_glob(kind))
    )
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.csv(folder)
    events = with_elapsed_seconds(df, "tick", ms_per_tick)
    if with_source:
        events = events.withColumn("file_name", F.col("_metadata.file_name"))
        events = events.withColumn("topic", F.lit(topic)) if topic else route_topic(events)
    if kind == "damages":
        events = with_damage_dealt(events)
    return events


def read_lines(spark: SparkSession, path: str, glob: str | None = None, with_file: bool = False) -> DataFrame:
    """Raw lines of CSV files, unparsed and whole, without each file's first line.

    Every other line comes back, blank ones too.  Empty and header-only files
    give no rows.  Row order is not promised; :func:`read_numbered_lines` also
    gives each line's place.
    """
    df = read_numbered_lines(spark, path, glob)
    return df.select("line", *(["file_name"] if with_file else []))


def read_roster(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """Lines of the ``*_players.csv`` roster file(s) in ``folder`` (or of the
    files that ``glob`` names) with the file name; empty (not an error) when the folder or the file is missing."""
    try:
        return read_lines(spark, folder, glob=glob or name_glob("players"), with_file=True)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err) and "does not exist" not in str(err):
            raise
        schema = StructType(LINE_SCHEMA.fields + [StructField("file_name", StringType(), True)])
        return spark.createDataFrame([], schema)
