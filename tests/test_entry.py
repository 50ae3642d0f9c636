import glob
import importlib
import os
import sys

import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
E = importlib.import_module("__spark_entry__")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["player_id", "player_name", "kills", "deaths", "assists",
                          "kd_ratio", "headshot_percentage", "timestamp_seconds"]
    assert df.count() > 0


def test_every_query_has_oracle_sql():
    from fragstat.plans.registry import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_without_the_removable_parts(tmp_path):
    """Without fragstat/llm and corpus_pipeline.py the entry imports and lists the rest; other import errors are not hidden."""
    import shutil
    import subprocess

    from fragstat.plans.registry import QUERIES

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/fragstat", tmp_path / "fragstat", ignore=shutil.ignore_patterns("llm", "__pycache__"))

    def listed():
        return subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__ as e; print(*sorted(e.queries()))"],
                              cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert listed().stdout.split() == sorted(QUERIES)
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module\n")
    assert "no_such_module" in listed().stderr


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_duckdb_at_sf0001(spark, name):
    import duckdb

    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{SF_SMALL}/*.parquet")):
        table = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    order = [cols.index(c) for c in df.columns]
    want = [tuple(r[i] for i in order) for r in want]

    def key(t):
        return repr(tuple(round(x, 9) if isinstance(x, float) else x for x in t))
    assert sorted(map(key, got)) == sorted(map(key, want))
