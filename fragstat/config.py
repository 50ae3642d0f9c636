"""Session settings and the shared scratch folder.

Durable intermediate data (stream checkpoints, staged match logs, result
tables of the registered queries) lives under the folder the cluster names
in ``spark.checkpoint.dir``, which must be shared storage on a cluster.  A
private folder is only created when that setting is unset, which happens in
local tests.
"""

from __future__ import annotations

import gc
import os
import re
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Seconds until nothing in the driver holds a job that has ended.
SETTLE = 1.0


def session_settings(cpus: int | None = None) -> dict[str, str]:
    """Settings for the jobs in this package.

    * AQE re-plans at run time: it coalesces small shuffle partitions and
      splits skewed join partitions.
    * ``spark.sql.shuffle.partitions`` is set only when the core count is
      known (local masters): about 2x the cores.  On a cluster the driver's
      own core count says nothing about the executors, so the cluster's
      setting is kept; the aggregates here shuffle only map-side reduced
      rows, and full sorts take an explicit partition count.
    * Parquet scans split at 128 MB, so a task's input fits executor memory.
    * Python call-site capture for error messages is off (driver planning
      cost only; errors still carry the JVM plan context).
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # No Python call-site capture per DataFrame/Column call: it costs two
        # JVM round trips and a stack walk each, which dominates planning time.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if cpus:
        settings["spark.sql.shuffle.partitions"] = str(max(8, 2 * cpus))
    return settings


def local_cores(master: str | None) -> int | None:
    """Cores of a ``local[N]`` / ``local[*]`` / ``local`` master, else None."""
    if not master or not master.startswith("local"):
        return None
    match = re.match(r"local\[(\d+|\*)", master)
    if not match:
        return 1
    return os.cpu_count() or 1 if match.group(1) == "*" else int(match.group(1))


def build_session(
    master: str | None = None,
    app_name: str = "fragstat",
    cpus: int | None = None,
    local_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with :func:`session_settings`.  ``local_memory`` sizes the
    driver heap for ``local[...]`` masters, where the driver JVM also runs
    every task; on a cluster, memory is a deploy-time setting."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if local_memory and master.startswith("local"):
            builder = builder.config("spark.driver.memory", local_memory)
    settings = session_settings(cpus or local_cores(master))
    for key, value in {**settings, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from ``spark.checkpoint.dir``; only when it is unset (local tests)
    a private folder is made and registered, so ``DataFrame.checkpoint()``
    and everything else here use the same place.
    """
    # (raises on a cluster without the setting)
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set and the master is {master}: executors would write to their own disks. "
                "Name a folder that the driver and all executors share.")
        root = tempfile.mkdtemp(prefix="fragstat-checkpoint-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of jobs that have ended: it does so once the
    driver's garbage collectors find their frames gone.  Written tables stay.

    On a cluster the driver still holds the job that has just ended for a moment, so
    one collection frees the jobs before it only; a second one follows ``SETTLE`` later.
    """
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(SETTLE)
    spark._jvm.System.gc()


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the checkpoint root; a fresh one per call unless
    ``unique=False`` (stable paths for restartable streams)."""
    tail = "/".join(parts)
    if unique:
        tail = f"{tail}-{uuid.uuid4().hex[:12]}"
    return f"{checkpoint_root(spark)}/fragstat/{tail}"
