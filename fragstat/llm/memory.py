"""Giving back memory between the chunks of a task, and disk between the steps of a job.

A Python worker serves one task after the other.  What a chunk has freed stays
with the allocators, and with two workers an executor that adds up to more than
any chunk needs.
"""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

from fragstat.config import free_shuffles

try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library: nothing to trim
    _TRIM = None


def release() -> None:
    """Return free memory to the system."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def drop_staged(spark: SparkSession, *paths: str) -> None:
    """Delete staged tables that nothing reads any more.

    Spark removes the shuffle files of finished steps, and their checkpoints where
    it is told to, once the driver's garbage collector finds their frames gone,
    which in a long job may be hours later; so collect here, too.  Only call this
    when everything that is still to be computed starts from written tables.
    """
    free_shuffles(spark)
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
