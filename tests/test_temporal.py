import random

import pytest

from helpers import as_of, found, make_changes, make_logs
from surgewatch.operators import temporal
from surgewatch.operators.temporal import temporal_join

COLUMNS = ("ip", "url", "ts", "trigger_value")


def random_case(seed, logs=400, changes=60, span=2000):
    rng = random.Random(seed)
    urls = ["a", "a", "a", "b", "c", None]
    return (
        [(rng.choice("123"), rng.choice(urls), rng.randrange(span)) for _ in range(logs)],
        [(rng.choice(urls), rng.choice(["1", "2", "x", None]), rng.randrange(50, span), i)
         for i in range(changes)],
    )


@pytest.mark.parametrize("strategy", ["broadcast", "sorted", "auto"])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, strategy, seed):
    logs, changes = random_case(seed)
    got = temporal_join(make_logs(spark, logs), make_changes(spark, changes), strategy=strategy)
    assert found(got, *COLUMNS) == as_of(logs, changes)
    assert got.columns == ["ip", "url", "ts", "trigger_value", "dim_url"]


@pytest.mark.parametrize("seconds", [1, 37, 100000])
@pytest.mark.parametrize("group_rows", [1, 5, 1000])
def test_sorted_slices_and_parts(spark, seconds, group_rows):
    logs, changes = random_case(3)
    known = make_changes(spark, changes).where("url is not null")
    got = temporal._sorted_join(
        make_logs(spark, logs), known, temporal.measure(known), "ts", seconds, group_rows
    )
    assert found(got, *COLUMNS) == as_of(logs, changes)


def test_one_url_and_one_instant_hold_nearly_all(spark):
    logs = [("1", "a", 500)] * 300 + [("2", "a", 499), ("2", "b", 500)]
    changes = [("a", str(i), 500, i) for i in range(200)] + [("a", "0", 10, 900)]
    known = make_changes(spark, changes)
    got = temporal._sorted_join(make_logs(spark, logs), known, temporal.measure(known), "ts", 1, 10)
    assert found(got, *COLUMNS) == as_of(logs, changes)


@pytest.mark.parametrize("strategy", ["broadcast", "sorted"])
def test_boundaries(spark, strategy):
    logs = [("1", "a", s) for s in (9, 10, 19, 20, 21, 10_000_000)]
    changes = [("a", "1", 10, 1), ("a", "2", 20, 2), ("a", "3", 20, 3)]
    got = temporal_join(make_logs(spark, logs), make_changes(spark, changes), strategy=strategy)
    assert [(s, v) for _, _, s, v in found(got, *COLUMNS)] == [
        (10, "1"), (19, "1"), (20, "3"), (21, "3"), (10_000_000, "3")
    ]


@pytest.mark.parametrize("strategy", ["broadcast", "sorted", "auto"])
def test_no_changes(spark, strategy):
    logs = make_logs(spark, [("1", "a", 1)])
    assert temporal_join(logs, make_changes(spark, []), strategy=strategy).count() == 0


@pytest.mark.parametrize("strategy", ["broadcast", "sorted"])
def test_zoned_times(spark, strategy):
    logs, changes = random_case(4)
    zoned = make_logs(spark, logs)
    zoned = zoned.withColumn("ts", zoned["ts"].cast("timestamp"))
    got = temporal_join(zoned, make_changes(spark, changes), strategy=strategy)
    got = got.withColumn("ts", got["ts"].cast("timestamp_ntz"))
    assert found(got, *COLUMNS) == as_of(logs, changes)


def test_broadcast_needs_few_rows_bytes_and_versions_per_slice(spark, monkeypatch):
    few = make_changes(spark, [("a", "1", s, s) for s in range(0, 500, 10)])
    assert temporal.fits(few, temporal.measure(few), 1000)
    assert not temporal.fits(few, temporal.measure(few), 49)
    logs = make_logs(spark, [])
    with pytest.raises(ValueError):
        temporal_join(logs, few, strategy="broadcast", max_rows=49)
    dense = make_changes(spark, [("a", "1", 0, s) for s in range(300)] + [("b", "1", 9999, 0)])
    assert not temporal.fits(dense, temporal.measure(dense), 1000)
    long = make_changes(spark, [("a" * 5000, "1", s, s) for s in range(50)])
    monkeypatch.setattr(temporal, "MAX_BROADCAST_BYTES", 100_000)
    assert not temporal.fits(long, temporal.measure(long), 1000)


def test_slice_copies_stay_in_bounds(spark):
    rng = random.Random(9)
    rows = [(f"u{rng.randrange(20)}", "1", rng.randrange(1_000_000), i) for i in range(200)]
    changes = make_changes(spark, rows)
    size = temporal.measure(changes)
    seconds = size.slice_seconds(400)
    copies = temporal._sliced(temporal.whole_versions(changes), size, seconds).count()
    assert copies <= size.rows + 400 + size.urls


def test_a_version_lies_in_a_bounded_number_of_slices():
    size = temporal.Size(10**9, 1, 10**9, 100, 10 * 365 * 86400, None)
    assert size.length / size.slice_seconds(size.rows) <= temporal.MAX_SLICES
    assert temporal.Size(5, 1, 5, 100, 0, None).slice_seconds(10) == 1


def test_no_pairs_of_all_with_all(spark):
    logs, changes = random_case(5)
    for strategy in ("broadcast", "sorted"):
        got = temporal_join(make_logs(spark, logs), make_changes(spark, changes), strategy=strategy)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        temporal_join(make_logs(spark, []), make_changes(spark, []), strategy="fast")
