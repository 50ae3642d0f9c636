from conftest import sorted_rows
from fragstat.operators.dashboards import HEADSHOT_TOTAL_COLUMN, kd_trend, player_totals

COLS = "player_id bigint, player_name string, kills bigint, deaths bigint, assists bigint, " \
       "kd_ratio double, headshot_percentage double, timestamp_seconds bigint, batch_id bigint"


def snapshots(spark):
    return spark.createDataFrame([
        (1, "a", 2, 1, 0, 2.0, 50.0, 30, 0),
        (1, "a", 1, 1, 1, 1.0, 0.0, 90, 1),
        (2, "b", 1, 3, 0, 0.33, 100.0, 30, 0),
        (2, "b", 1, 3, 0, 0.33, 100.0, 30, 0),   # at-least-once duplicate
        (3, None, 1, 0, 0, 1.0, 0.0, None, 1),
        (4, "c", 1, 0, 0, 0.1, 0.1, 5, 2),
        (4, "c", 1, 0, 0, 0.2, 0.2, 6, 3),
    ], COLS)


def test_kd_trend_distinct_and_ordered(spark):
    rows = [tuple(r) for r in kd_trend(snapshots(spark)).collect()]
    assert [r[1] for r in rows] == sorted(r[1] for r in rows)
    assert sorted(rows) == sorted([(2.0, 30), (1.0, 90), (0.33, 30), (0.1, 5), (0.2, 6)])


def test_player_totals(spark):
    out = player_totals(snapshots(spark))
    assert out.columns == ["player_name", "kills", "deaths", "assists", "kd_ratio", HEADSHOT_TOTAL_COLUMN]
    assert sorted_rows(out) == [
        ("a", 3, 2, 1, 3.0, 50.0),
        ("b", 2, 6, 0, 0.66, 200.0),
        ("c", 2, 0, 0, 0.3, 0.3),    # exactly 0.3, not 0.30000000000000004
    ]
