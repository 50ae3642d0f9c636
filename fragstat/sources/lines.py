"""Raw lines of match-log files, all of them, with their place.

Spark's text source gives every line, blank ones included, but not its number.
A task reads a split of a file from its beginning to its end, so a counter that
starts anew with each split gives the number of a line within its split;
``(file, first byte of the split, number)`` orders the lines of a file as they
stand in it, whatever the splits, and the first line of the split at byte 0 is
the file's header.  The counter is the one thing that the built-in functions
cannot say without a shuffle: it runs over Arrow batches, in the scan's task.

A file that Spark wrote is a folder of parts; it is known by the folder's name,
and its parts, or the numbered chunks that hold them, follow each other by name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: What orders the lines of a folder.
LINE_ORDER = ("file_name", "file_path", "block_start", "line_in_block")
LINES = StructType([
    StructField("file_name", StringType()), StructField("file_path", StringType()),
    StructField("block_start", LongType()), StructField("line_in_block", LongType()), StructField("line", StringType())])
_ARROW = pa.schema([("file_name", pa.string()), ("file_path", pa.string()), ("block_start", pa.int64()),
                    ("line_in_block", pa.int64()), ("line", pa.string())])
_NAME = r"([^/=]+)(?:/chunk=[0-9]+)?(?:/part-[^/]*)?$"


def file_name_of(path: Column) -> Column:
    """The name of the match-log file that a path belongs to: its last element,
    or, for a part that Spark wrote, the folder's name (or its partition value)."""
    return F.regexp_extract(path, _NAME, 1)


def _name_of(path: str) -> str:
    """:func:`file_name_of` of one path."""
    found = re.search(_NAME, path)
    return found.group(1) if found else ""


def _count_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the lines of each split.  The name is taken from a path once for each
    batch: the expression tries every place of a long path, so it is dear for a line."""
    path, block, number = None, None, 0  # of the next line, if it continues the split
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        paths, blocks = batch.column("file_path"), batch.column("block_start").to_numpy()
        distinct = paths.dictionary_encode()  # few: a task reads its splits one after the other
        codes = distinct.indices.to_numpy()
        names = pa.array([_name_of(p) for p in distinct.dictionary.to_pylist()], pa.string()).take(distinct.indices)
        new = np.ones(rows, bool)
        new[1:] = (np.diff(codes) != 0) | (np.diff(blocks) != 0)
        new[0] = paths[0].as_py() != path or int(blocks[0]) != block
        starts = np.flatnonzero(new)
        if not new[0]:
            starts = np.concatenate(([-number], starts))  # where the split would have begun
        numbers = np.arange(rows) - starts[np.cumsum(new) - int(new[0])]
        path, block, number = paths[rows - 1].as_py(), int(blocks[-1]), int(numbers[-1]) + 1
        yield pa.RecordBatch.from_arrays([names, paths, batch.column("block_start"), pa.array(numbers, pa.int64()),
                                          pc.fill_null(batch.column("line"), "")], schema=_ARROW)


def read_numbered_lines(spark: SparkSession, path: str, glob: str | None = None, with_header: bool = False) -> DataFrame:
    """``file_name, file_path, block_start, line_in_block, line`` of every line of
    the text files in ``path``, without each file's first line (unless ``with_header``).

    Blank lines are lines.  A line ends with ``\\n``, ``\\r\\n`` or ``\\r``; what
    follows the last one counts if it is not empty.  Order by :data:`LINE_ORDER`
    to have the lines as they stand in the files.  One scan, no shuffle.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    read = reader.text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block_start"),
        F.col("value").alias("line"))
    lines = read.mapInArrow(_count_lines, LINES)
    return lines if with_header else lines.where("block_start > 0 OR line_in_block > 0")


def with_line_numbers(lines: DataFrame, number_col: str = "line_number") -> DataFrame:
    """Add the number of each line in its file (0 is the first that is there).

    Splits are counted, one row for each; a file's offsets are running sums over
    its splits.  They are sent to the lines, which stay where they are read: a row of
    some 200 bytes for each split of a file, where the lines would move with their paths.
    """
    split = ["file_name", "file_path", "block_start"]
    counts = lines.groupBy(*split).agg(F.count("*").alias("_count"), F.min("line_in_block").alias("_first"))
    offsets = counts.selectExpr(
        *split, "_first", "coalesce(sum(_count) OVER (PARTITION BY file_name ORDER BY file_path, block_start "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before")
    return lines.join(F.broadcast(offsets), split).withColumn(
        number_col, F.col("_before") + F.col("line_in_block") - F.col("_first")).drop("_before", "_first")
