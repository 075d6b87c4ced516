"""Groups of a window's ids, and the check that ids give a text back, against plain loops."""

import random
from itertools import accumulate
from types import SimpleNamespace

from pyspark import cloudpickle

from surgewatch.llm import alignment
from surgewatch.llm.alignment import PAIR, Sides


def sides(entries):
    made = Sides.__new__(Sides)
    made.a, made.b = (SimpleNamespace(bytes=e) for e in entries)
    made.lengths = [[len(x) for x in e] for e in entries]
    made.names = [str(i) for i in range(100)]
    return made


def test_groups_cut_where_tokens_of_both_end():
    rng, entry = random.Random(5), [b"x" * (i + 1) for i in range(9)]
    made = sides([entry, entry])
    for _ in range(300):
        a = [rng.randrange(4) for _ in range(rng.randrange(1, 9))]
        left, b = sum(x + 1 for x in a), []
        while left:
            b.append(rng.randrange(min(left, rng.choice([1, 3, 9]))))
            left -= b[-1] + 1
        ends_a, ends_b = ([*accumulate(x + 1 for x in ids)] for ids in (a, b))
        text, links, low = [], [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            part = [[str(x) for x, e in zip(ids, ends) if low < e <= end] for ids, ends in ((a, ends_a), (b, ends_b))]
            text.append("|".join(map(",".join, part)))
            links.append(a[ends_a.index(end)] * PAIR + b[ends_b.index(end)])
            low = end
        got = made.groups(a, b)
        assert (got[0], got[1], memoryview(got[2]).cast("q").tolist()) == (";".join(text), len(text), links)


def test_chunks_are_given_back_all_or_one_by_one():
    made = sides([[b"a", b"bc"], [b"ab", b"c"]])
    assert made.back(0, [[0, 1], [1], []], [b"abc", b"bc", b""]) == [True, True, True]
    # The bytes of all together are right, those of each are not.
    assert made.back(1, [[0], [1]], [b"a", b"bc"]) == [False, False]
    assert made.back(1, [[0, 1], [1]], [b"abc", b"d"]) == [True, False]


def test_the_operator_travels_to_workers():
    cloudpickle.dumps(alignment.stage("a", "b"))
