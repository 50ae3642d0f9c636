"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

After a JVM warm-up, each query runs once untimed, then ``BENCH_REPEAT``
(default 3) timed runs; the median is reported.  A run includes building the
DataFrame (driver-side planning) and executing it.  Queries are executed in full with the
``noop`` sink, so nothing is collected to the driver.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fragstat.config import build_session, scratch_path  # noqa: E402
from fragstat.operators.kill_stats import player_kill_stats, player_kill_stats_joined  # noqa: E402
from fragstat.plans.registry import QUERIES  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from fragstat.operators.replay import to_payload  # noqa: E402
from fragstat.schemas import KILLS_TOPIC  # noqa: E402
from fragstat.sinks.matchlog import WRITTEN_FILES, write_match_logs  # noqa: E402
from fragstat.sinks.topic import append_topic_log  # noqa: E402
from fragstat.sources.files import read_match_logs  # noqa: E402
from fragstat.sources.testviews import kills_view  # noqa: E402
from fragstat.sources.topic import decode_events, read_topic_log  # noqa: E402

HEADLINE = [
    "player_kill_stats",
    "player_kill_stats_joined",
    "player_damage_stats",
    "player_damage_stats_exact",
    "player_stats_snapshots",
    "kd_trend",
    "player_totals",
    "csv_decode_kills",
    "replay_payloads",
    "match_log_kills",
    "stream_kill_stats",
    "stream_damage_stats",
    # inputs staged once, untimed, spread over twice as many files as cores:
    # CSV match logs (every scan re-parses the lines) ...
    "csv_player_kill_stats",
    "csv_player_kill_stats_joined",
    # ... and topic payloads, the streaming path: decode alone, then decode
    # with each form of the statistics
    "topic_decode_kills",
    "topic_player_kill_stats",
    "topic_player_kill_stats_joined",
]

STAGED = ("csv_", "topic_")


def staged_queries(spark, sf_dir: str, cpus: int) -> dict:
    # The test table has one row group: one task reads it, and would write one file.
    kills = kills_view(spark, sf_dir).repartition(2 * cpus)
    folder = scratch_path(spark, "bench", "matchlogs")
    write_match_logs(kills, folder)
    log = scratch_path(spark, "bench", "topiclog")
    records = to_payload(kills.withColumn("topic", F.lit(KILLS_TOPIC)), kills.columns)
    append_topic_log(records, log)

    def csv(s):
        return read_match_logs(s, folder, "kills", glob=WRITTEN_FILES)

    def topic(s):
        return decode_events(read_topic_log(s, log, KILLS_TOPIC, streaming=False), "kills")

    return {
        "csv_player_kill_stats": lambda s, _: player_kill_stats(csv(s)),
        "csv_player_kill_stats_joined": lambda s, _: player_kill_stats_joined(csv(s)),
        "topic_decode_kills": lambda s, _: topic(s),
        "topic_player_kill_stats": lambda s, _: player_kill_stats(topic(s)),
        "topic_player_kill_stats_joined": lambda s, _: player_kill_stats_joined(topic(s)),
    }


def default_heap() -> str:
    """Half the machine's memory, at most 8 GB (local mode: one JVM runs all)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "2g"
    return f"{max(1, min(8, total // 2**30 // 2))}g"


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    memory = os.environ.get("BENCH_MEMORY") or default_heap()
    event_log = os.environ.get("BENCH_EVENT_LOG")  # a scratch folder; see tools/stage_report.py
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log} if event_log else {}
    spark = build_session(f"local[{cpus}]", app_name="fragstat-bench", cpus=cpus,
                          local_memory=memory, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")

    lineitem_rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    # JVM warm-up (class loading, JIT) so the first timed query is not charged for it
    for name in ("player_kill_stats", "player_damage_stats"):
        run(QUERIES[name](spark, sf_dir))
    queries = dict(QUERIES)
    if any(n.startswith(STAGED) and n not in QUERIES for n in names):
        queries.update(staged_queries(spark, sf_dir, cpus))
    timings: dict[str, float] = {}
    for name in names:
        query = queries[name]
        run(query(spark, sf_dir))  # warm-up
        samples = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(query(spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 4)

    match = re.search(r"sf([0-9.]+)$", sf_dir)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
        "memory": memory,
        "input_rows": lineitem_rows,
        "rows_per_sec": {k: round(lineitem_rows / v) for k, v in timings.items() if v > 0},
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
