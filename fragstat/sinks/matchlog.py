"""Write events as a folder of match-log files: CSV with a header.

The inverse of :func:`fragstat.sources.files.read_match_logs`: Spark's CSV
writer produces the files in parallel (one or more per task, so no match
has to fit one task).  One folder holds one kind of file, under the names
that the writer gives; read it with ``glob="*.csv"``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..config import free_shuffles
from ..functions.decode import ENCODE_OPTIONS
from ..operators.replay import replay_order
from ..schemas import REPLAY_TIME_COLUMN

WRITTEN_FILES = "*.csv"
#: Of ``monotonically_increasing_id``: the bits that count a task's rows, below those of its number.
PLACE_BITS = 33
PLACE_MASK = (1 << PLACE_BITS) - 1
#: Lines that a task sorts, in memory.
ROWS_PER_TASK = 500_000
#: Lines that are sorted at once: their shuffle is on disk.
ROWS_AT_ONCE = 150_000_000


def _one_line(df: DataFrame) -> DataFrame:
    """Fail on texts with line breaks: the readers take a line for a row."""
    checked = {
        f.name: F.when(
            F.col(f"`{f.name}`").rlike(r"[\r\n]"),
            F.raise_error(F.lit(f"line break in column {f.name}: match-log files hold one row per line")).cast("string"),
        ).otherwise(F.col(f"`{f.name}`"))
        for f in df.schema.fields if isinstance(f.dataType, StringType)
    }
    return df.withColumns(checked) if checked else df


def write_match_logs(df: DataFrame, folder: str, max_records_per_file: int | None = None) -> None:
    """Write ``df`` (event columns in schema order) as match-log files into
    the new folder ``folder``.  The replay time column is left out, as
    match-log files do not hold it.  A text with a line break fails the job:
    the line-based readers would take it for two damaged rows."""
    cols = [c for c in df.columns if c != REPLAY_TIME_COLUMN]
    writer = _one_line(df.select(*cols)).write.mode("errorifexists").option("header", True)
    for key, value in ENCODE_OPTIONS.items():
        writer = writer.option(key, value)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.csv(folder)


def _with_headers(header: str, lines_per_part: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Put the header before the first line of each part.  A task's rows stand in order,
    ``place`` counts them; a part is ``lines_per_part`` places of one file."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # file and part of the row before
        for batch in batches:
            if not batch.num_rows:
                continue
            file, value, place = (batch.column(name) for name in ("file", "value", "place"))
            codes = file.dictionary_encode(null_encoding="encode").indices.to_numpy()
            parts = (place.to_numpy() & PLACE_MASK) // lines_per_part
            first = np.ones(batch.num_rows, bool)
            first[1:] = (np.diff(codes) != 0) | (np.diff(parts) != 0)
            first[0] = (file[0].as_py(), parts[0]) != last
            last = (file[-1].as_py(), parts[-1])
            value = pc.fill_null(value, "")
            value = pc.if_else(pa.array(first), pc.binary_join_element_wise(header, value, "\n"), value)
            yield pa.RecordBatch.from_arrays([file, value, place], names=["file", "value", "place"])
    return add


def write_ordered_lines(lines: DataFrame, folder: str, header: str, order: tuple[str | Column, ...],
                        file_col: str = "file_name", line_col: str = "line", lines_per_part: int = 1_000_000,
                        sent: tuple[str, ...] | None = None, rows_at_once: int = ROWS_AT_ONCE) -> None:
    """Write raw lines as match-log files into the new folder ``folder``: a folder
    for each value of ``file_col``, in which the lines stand in ``order`` under
    the ``header``.  Read them with :mod:`fragstat.sources.lines`.

    Blank lines are written as they are.  The lines are range-partitioned along the
    order, so a file is a task's stretch of rows, or those of several tasks that follow
    each other; every ``lines_per_part`` rows of a task a new part begins (with a header
    of its own).  A part is named by its task's number and its own, 10 digits each.  Each
    task writes the rows that it has sorted: one shuffle, nothing stored in between.

    ``order`` may have expressions over the columns that are ``sent`` (those that it
    names, if not given) besides the file and the line.  Files are compressed.  Beyond
    ``rows_at_once`` lines they are written in rounds, each file in one of them, so that only one
    round's shuffle is on disk.
    """
    sent = tuple(c for c in order if isinstance(c, str)) if sent is None else sent
    lines = lines.select(*dict.fromkeys((file_col, *sent, line_col)))
    spark = lines.sparkSession
    many = -(-lines.count() // rows_at_once)
    if many <= 1:
        _write_round(lines, folder, header, (file_col, *order), file_col, line_col, lines_per_part, "errorifexists")
        return
    for k in range(many):
        own = lines.where(F.pmod(F.xxhash64(file_col), F.lit(many)) == k)
        _write_round(own, folder, header, (file_col, *order), file_col, line_col, lines_per_part,
                     "append" if k else "errorifexists")
        free_shuffles(spark)


def _write_round(lines: DataFrame, folder: str, header: str, order: tuple[str | Column, ...], file_col: str, line_col: str,
                 lines_per_part: int, mode: str) -> None:
    ordered = replay_order(lines, order, rows_per_partition=ROWS_PER_TASK)
    placed = ordered.select(
        F.col(file_col).alias("file"), F.col(line_col).alias("value"), F.monotonically_increasing_id().alias("place")).mapInArrow(
        _with_headers(header, lines_per_part), "file string, value string, place long")
    part = F.call_function("div", F.col("place").bitwiseAND(F.lit(PLACE_MASK)), F.lit(lines_per_part).cast("long"))
    chunk = F.concat(*[F.lpad(n.cast("string"), 10, "0") for n in (F.shiftright("place", PLACE_BITS), part)])
    keys = ["file", "chunk"]
    rows = placed.select("value", "file", chunk.alias("chunk"), "place").sortWithinPartitions(*keys, "place")
    rows.select("value", *keys).write.mode(mode).option("compression", "gzip").partitionBy(*keys).text(folder)
