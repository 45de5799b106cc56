"""Physical-plan checks: the shapes we rely on for scale."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cartesian_or_nested_loop(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_q1_one_scan_has_no_join_and_bounded_top_k(spark):
    p = plan(spark, "top_days_top_user")
    assert "Join" not in p
    assert "TakeOrderedAndProject" in p
    assert "partial_count" in p
    # only the columns the question needs reach the scan
    read = [line for line in p.splitlines() if "ReadSchema" in line or "FileScan" in line]
    assert read and not any("props" in line or "event_type" in line for line in read)


def test_q1_two_scan_broadcasts_only_the_k_days(spark):
    p = plan(spark, "top_days_top_user_two_scan")
    assert "BroadcastHashJoin" in p and "LeftSemi" in p
    assert "TakeOrderedAndProject" in p


def test_top_n_per_group_limits_before_shuffle(spark):
    p = plan(spark, "top_n_users_per_day")
    assert "WindowGroupLimit" in p


def test_counts_combine_map_side(spark):
    for name in ("top_mentioned", "top_emojis", "posts_per_user"):
        assert "partial_count" in plan(spark, name)


def test_element_wise_q3_does_not_regroup_lines(spark):
    p = plan(spark, "top_mentioned")
    assert "collect_list" not in p


@pytest.mark.parametrize("name", ["top_days_top_user", "count_by_day", "best_user_per_day", "daily_rollup_top_days", "time_range"])
def test_date_text_parsed_once(spark, name):
    df = E.queries()[name](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert p.count("try_cast(") == 2, p  # one for each accepted layout


def test_ingested_q1_prunes_partitions_dynamically(spark):
    assert "dynamicpruning" in plan(spark, "top_days_top_user_ingested")
