import random

import pytest

from helpers import found, in_order, make_changes
from surgewatch.operators import dims
from surgewatch.operators.dims import latest_per_key, versions


def random_changes(n=300, seed=5, span=3000):
    rng = random.Random(seed)
    return [
        (rng.choice(["a", "b", "b", "c", None]), rng.choice(["1", "2", "x", None]),
         rng.randrange(0, span, 7), i)
        for i in range(n)
    ]


def test_latest(spark):
    rows = random_changes()
    best = {}
    for url, value, s, seq in rows:
        if url not in best or (s, seq) > best[url][:2]:
            best[url] = (s, seq, value)
    want = in_order([(url, value, s) for url, (s, _, value) in best.items()])
    assert found(latest_per_key(make_changes(spark, rows))) == want


def test_latest_of_equal_times_is_the_last(spark):
    rows = [("a", "1", 5, 1), ("a", "2", 5, 3), ("a", "3", 5, 2), ("a", "9", 4, 9)]
    assert found(latest_per_key(make_changes(spark, rows))) == [("a", "2", 5)]


@pytest.mark.parametrize("slice_seconds", [None, 1, 10, 1000, 100000])
def test_versions(spark, slice_seconds):
    rows = random_changes()
    want = []
    for url in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == url), key=lambda r: (r[2], r[3]))
        for row, after in zip(mine, mine[1:] + [None]):
            want.append((*row, after[2] if after else None))
    got = versions(make_changes(spark, rows), slice_seconds=slice_seconds)
    assert found(got) == in_order(want)


def test_a_busy_url_is_cut_into_slices(spark, monkeypatch):
    changes = make_changes(spark, random_changes())
    want = found(versions(changes))
    monkeypatch.setattr(dims, "GROUP_ROWS", 10)
    assert found(versions(changes)) == want
    assert "slice" in versions(changes)._jdf.queryExecution().analyzed().toString()


def test_slices_follow_dense_hours(spark, monkeypatch):
    """One url has nearly all its changes in one hour; another has a few, and one none too many."""
    rng = random.Random(8)
    rows = [("a", str(i % 3), rng.random() * 3600, i) for i in range(900)]
    rows += [("a", "1", 5000.0 + 100 * i, 1000 + i) for i in range(60)] + [(None, "2", float(i % 40), i) for i in range(120)]
    rows += [("b", "1", float(i), i) for i in range(30)]
    changes = make_changes(spark, rows)
    cut = dims.quantile_slices(changes, 960, group_rows=50)
    sizes = {(r.url, r.slice): r["count"] for r in cut.groupBy("url", "slice").count().collect()}
    assert max(sizes.values()) <= 50 and sum(sizes.values()) == len(rows)
    assert sum(url == "a" for url, _ in sizes) > 20 and ("b", 0) in sizes and len([u for u, _ in sizes if u == "b"]) == 1
    monkeypatch.setattr(dims, "GROUP_ROWS", 50)
    names = ("url", "trigger_value", "proc_time", "seq", "valid_to")
    assert found(versions(changes), *names) == found(dims.whole_versions(changes), *names)
