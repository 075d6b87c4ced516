import random

import pytest

from helpers import found, make_logs
from surgewatch.operators.lookup import lookup_counts, lookup_join
from surgewatch.operators.windows import tumble_counts

DIM = "id int, trigger_value int, url string"
ROWS = [(1, 3, "a"), (2, 5, "a"), (3, 2, "b"), (4, 2, "b"), (5, None, "c"), (6, 1, None)]
KEYS = ("ip", "url", "trigger_value")


def logs_of(spark, n=300):
    rng = random.Random(1)
    return make_logs(
        spark,
        [(rng.choice("12"), rng.choice(["a", "a", "b", "c", "A", None]), rng.randrange(100))
         for _ in range(n)],
    )


@pytest.mark.parametrize("max_rows", [0, 100])
def test_every_match_gives_a_row(spark, max_rows):
    logs = make_logs(spark, [("1", "a", 0), ("1", "b", 1), ("1", "x", 2), ("1", None, 3), ("2", "A", 4)])
    got = lookup_join(logs, spark.createDataFrame(ROWS, DIM), max_rows)
    assert found(got) == [
        ("1", "a", 0, 3, "a"), ("1", "a", 0, 5, "a"), ("1", "b", 1, 2, "b"), ("1", "b", 1, 2, "b"),
    ]


@pytest.mark.parametrize("max_rows", [0, 100])
def test_counting_first_equals_joining_first(spark, max_rows):
    logs, dim = logs_of(spark), spark.createDataFrame(ROWS, DIM)
    joined = tumble_counts(lookup_join(logs, dim), 10, keys=KEYS)
    counted = lookup_counts(logs, dim, 10, max_rows=max_rows)
    assert found(counted, *joined.columns) == found(joined)


def test_broadcast_only_below_the_limit(spark):
    logs, dim = logs_of(spark), spark.createDataFrame(ROWS, DIM)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for max_rows, operator in ((5, "SortMergeJoin"), (6, "BroadcastHashJoin")):
            plan = lookup_join(logs, dim, max_rows)._jdf.queryExecution().executedPlan().toString()
            assert operator in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
