"""Shapes of the physical plans: shuffles, columns read, pushed filters."""

import pytest

import __spark_entry__ as registry


@pytest.fixture
def plan(spark, small_dir):
    def of(name):
        df = registry.queries()[name](spark, small_dir)
        return df._jdf.queryExecution().executedPlan().toString()

    return of


def shuffles(text):
    return text.count("Exchange hashpartitioning") + text.count("Exchange SinglePartition")


def test_fixed_threshold_is_one_shuffle_of_partial_counts(plan):
    text = plan("fixed_threshold_alerts")
    assert shuffles(text) == 1
    assert "partial_count" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_lookup_counts_the_log_before_the_join(plan):
    text = plan("lookup_alerts_parts")
    join, count = text.index("BroadcastHashJoin"), text.index("partial_count")
    assert join < count  # the count is below the join
    assert shuffles(text) == 2  # one of the log's counts, one of the table
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz>" in text


def test_broadcast_as_of_join_does_not_shuffle_the_log(plan):
    text = plan("temporal_join_rows")
    log_side = text[text.index("BroadcastHashJoin"):text.index("BroadcastExchange")]
    assert shuffles(log_side) == 0 and "FileScan" in log_side
    assert shuffles(text) == 1  # the changes, to find each one's end


def test_sorted_as_of_join_shuffles_the_log_once(plan):
    text = plan("temporal_join_sorted")
    assert text.count("hashpartitioning(dim_url") == 1
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_changes_are_filtered_in_the_scan(plan):
    assert "EqualTo(event_type,signup)" in plan("dim_versions")


@pytest.mark.parametrize(
    "name", sorted(n for n in registry.queries() if not (n.startswith("op") or n == "pipeline"))
)
def test_no_python_in_batch_plans(plan, name):
    if name.startswith("stream_"):
        pytest.skip("runs a stream")
    text = plan(name)
    assert "Python" not in text and "Pandas" not in text and "NestedLoop" not in text
