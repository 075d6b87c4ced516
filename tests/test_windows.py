import random

import pytest
from pyspark.sql import functions as F

from helpers import found, hop_counts as brute, make_logs
from surgewatch.operators.windows import hop_counts, tumble_counts


def random_logs(n=400, seed=3):
    rng = random.Random(seed)
    return [
        (rng.choice(["1", "2", None]), rng.choice(["a", "b", None]), rng.randrange(0, 500))
        for _ in range(n)
    ]


def test_tumble(spark):
    rows = random_logs()
    got = tumble_counts(make_logs(spark, rows), 70)
    # 70 s do not divide a day: windows start at multiples since 1970.
    offset = 1704067200 % 70
    want = brute([(ip, url, s + offset) for ip, url, s in rows], 70, 70)
    want = [(ip, url, n, a - offset, b - offset) for ip, url, n, a, b in want]
    assert found(got) == want
    assert sum(r[2] for r in found(got)) == len(rows)


@pytest.mark.parametrize("size,slide", [(10, 5), (10, 10), (25, 10), (60, 5), (50, 15)])
@pytest.mark.parametrize("panes", [None, True, False])
def test_hop(spark, size, slide, panes):
    rows = random_logs()
    got = hop_counts(make_logs(spark, rows), size, slide, panes=panes)
    assert found(got) == brute(rows, size, slide)


def test_hop_of_full_slide_is_tumble(spark):
    logs = make_logs(spark, random_logs())
    assert found(hop_counts(logs, 20, 20)) == found(tumble_counts(logs, 20))


def test_order_of_rows_does_not_matter(spark):
    logs = make_logs(spark, random_logs())
    assert found(tumble_counts(logs.orderBy(F.rand(1)), 20)) == found(tumble_counts(logs, 20))


def test_window_edges(spark):
    got = tumble_counts(make_logs(spark, [("1", "a", 9.999999), ("1", "a", 10)]), 10)
    assert found(got) == [("1", "a", 1, 0, 10), ("1", "a", 1, 10, 20)]


@pytest.mark.parametrize("size,slide", [(0, 1), (-5, 1), (5, 6), (5, 0), ("5", 1), (5, 2.5), (True, 1)])
def test_bad_windows_are_refused(spark, size, slide):
    with pytest.raises(ValueError):
        hop_counts(make_logs(spark, []), size, slide)
