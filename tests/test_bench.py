"""bench.py prints exactly one JSON line with the contract's fields."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_REPEAT="1", BENCH_MEMORY="1g")
    out = subprocess.run(
        [sys.executable, os.path.join(REPO, "bench.py"), "player_damage_stats", "topic_decode_kills"],
        env=env, capture_output=True, text=True, timeout=600, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"player_damage_stats", "topic_decode_kills"}
    assert result["value"] == round(sum(result["queries"].values()), 4)
