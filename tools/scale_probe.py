"""Scaling check: the headline operators on N shifted copies of lineitem.

    python tools/scale_probe.py [sf_dir] [copies] [cores]

Copy i shifts l_orderkey (the tick) by i * (max + 1), so each copy is a new
run of kills by the same players.  The enlarged table is written once to the
session's scratch folder as one file per core, then every operator runs on
1x and Nx input; times are medians of 3 after a warm-up.
"""

from __future__ import annotations

import os
import statistics
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from fragstat.config import build_session, scratch_path  # noqa: E402
from fragstat.operators.damage_stats import player_damage_stats  # noqa: E402
from fragstat.operators.kill_stats import player_kill_stats, player_kill_stats_joined  # noqa: E402
from fragstat.sources.testviews import damage_events, kill_events, read_table  # noqa: E402

OPERATORS = {
    "player_kill_stats": lambda li: player_kill_stats(kill_events(li)),
    "player_kill_stats_joined": lambda li: player_kill_stats_joined(kill_events(li)),
    "player_damage_stats": lambda li: player_damage_stats(damage_events(li)),
    "player_damage_stats_exact": lambda li: player_damage_stats(damage_events(li), exact=True),
}


def timed(df) -> float:
    samples = []
    df.write.format("noop").mode("overwrite").save()
    for _ in range(3):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        samples.append(time.perf_counter() - t0)
    return statistics.median(samples)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    cores = int(sys.argv[3]) if len(sys.argv) > 3 else (os.cpu_count() or 8)
    spark = build_session(f"local[{cores}]", app_name="fragstat-scale", local_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")

    base = read_table(spark, sf_dir, "lineitem")
    span = base.agg(F.max("l_orderkey")).first()[0] + 1
    shifted = [base.withColumn("l_orderkey", F.col("l_orderkey") + i * span) for i in range(copies)]
    path = scratch_path(spark, "scale", f"lineitem_x{copies}")
    reduce(lambda a, b: a.unionByName(b), shifted).repartition(cores).write.parquet(path)
    small = base.repartition(cores).cache()
    small.count()

    inputs = {"1x": small, f"{copies}x": spark.read.parquet(path)}
    rows = {k: v.count() for k, v in inputs.items()}
    print(f"rows: {rows}")
    for name, op in OPERATORS.items():
        t = {k: timed(op(v)) for k, v in inputs.items()}
        ratio = t[f"{copies}x"] / t["1x"]
        print(f"{name:28s} 1x {t['1x']:6.2f} s   {copies}x {t[f'{copies}x']:6.2f} s   ratio {ratio:4.1f}")
    spark.stop()


if __name__ == "__main__":
    main()
