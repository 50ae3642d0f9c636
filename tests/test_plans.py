"""Physical-plan shape: the properties the design relies on at scale."""

from fragstat.operators.damage_stats import player_damage_stats
from fragstat.operators.kill_stats import player_kill_stats, player_kill_stats_joined
from fragstat.plans.inspect import plan_text, count_nodes
from fragstat.sources.testviews import damages_view, kills_view

from conftest import SF_SMALL


def test_one_pass_reads_once_and_hash_aggregates_rows(spark):
    plan = plan_text(player_kill_stats(kills_view(spark, SF_SMALL)))
    assert count_nodes(plan, "FileScan parquet") == 1
    assert "BroadcastExchange" not in plan
    # row level: one hash aggregate on (player, name) with a map-side partial
    # step; the second exchange only carries one row per player and name
    lines = plan.splitlines()
    exchanges = [i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l]
    assert len(exchanges) == 2
    below_first_shuffle = lines[exchanges[-1]:]
    assert any("HashAggregate" in l and "partial_count" in l for l in below_first_shuffle)
    assert not any("SortAggregate" in l for l in below_first_shuffle)


def test_join_form_scans_four_times(spark):
    plan = plan_text(player_kill_stats_joined(kills_view(spark, SF_SMALL)))
    assert count_nodes(plan, "FileScan parquet") == 4


def test_scan_reads_only_needed_columns(spark):
    plan = plan_text(player_kill_stats(kills_view(spark, SF_SMALL)))
    read_schema = [l for l in plan.splitlines() if "ReadSchema" in l][0]
    for col in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"):
        assert col in read_schema
    for col in ("l_extendedprice", "l_discount", "l_tax", "l_shipdate"):
        assert col not in read_schema


def test_damage_stats_single_shuffle(spark):
    plan = plan_text(player_damage_stats(damages_view(spark, SF_SMALL)))
    assert count_nodes(plan, "Exchange hashpartitioning") == 1
    assert "HashAggregate" in plan


def test_no_registered_plan_funnels_through_one_task(spark):
    """No single-partition exchange, cartesian product or nested-loop join in
    any registered query; of those that stage data, in what reads it back."""
    from fragstat.plans.registry import QUERIES

    for name, query in QUERIES.items():
        plan = plan_text(query(spark, SF_SMALL))
        for bad in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_replay_order_is_a_range_partitioned_sort(spark):
    from fragstat.plans.registry import QUERIES

    plan = plan_text(QUERIES["replay_payloads"](spark, SF_SMALL))
    assert "rangepartitioning" in plan
