import random

import pytest

from surgewatch.functions.parse import LITERAL_TAB, TAB, malformed_counts, parse_lines

BAD = ("error", "error")

EDGES = [
    ("1.1.1.1{d}a.html", ("1.1.1.1", "a.html")),
    ("a{d}", BAD),
    ("{d}b", ("", "b")),
    ("{d}", BAD),
    ("", BAD),
    ("a{d}{d}c", ("a", "")),
    ("a{d}b{d}c", ("a", "b")),
    ("a{d}b\r\n", ("a", "b\r")),
    ("a\n{d}\nb", ("a", "b")),
    ("a", BAD),
    ("a{d}{d}{d}", BAD),
    ("{d}{d}", BAD),
    ("a{d}{d}{d}d", ("a", "")),
    ("a{d}b{d}{d}", ("a", "b")),
]


def parsed(spark, lines, delimiter):
    rows = list(enumerate(lines))
    df = spark.createDataFrame(rows, "n int, line string")
    result = {r["n"]: (r["ip"], r["url"]) for r in parse_lines(df, delimiter).collect()}
    return [result[n] for n in range(len(rows))]


@pytest.mark.parametrize("delimiter", [TAB, LITERAL_TAB])
def test_edge_lines(spark, delimiter):
    lines = [text.replace("{d}", delimiter) for text, _ in EDGES] + [None]
    assert parsed(spark, lines, delimiter) == [want for _, want in EDGES] + [BAD]


def test_the_two_delimiters_differ(spark):
    assert parsed(spark, [r"a\tb", "a\tb"], TAB) == [BAD, ("a", "b")]
    assert parsed(spark, [r"a\tb", "a\tb"], LITERAL_TAB) == [("a", "b"), BAD]


@pytest.mark.parametrize("delimiter", [TAB, LITERAL_TAB, "aa", "|"])
def test_random_lines(spark, delimiter):
    rng = random.Random(7)
    lines = [
        "".join(rng.choice(["a", "b", "\\", "t", "\n", delimiter]) for _ in range(rng.randrange(9)))
        for _ in range(800)
    ]

    def expected(line):
        fields = line.replace("\n", "").split(delimiter)
        while fields and fields[-1] == "":
            fields.pop()
        return (fields[0], fields[1]) if len(fields) >= 2 else BAD

    assert parsed(spark, lines, delimiter) == [expected(line) for line in lines]


def test_other_columns_drop_and_metric(spark):
    df = spark.createDataFrame([(1, "a\tb"), (2, "a"), (3, None)], "id int, line string")
    assert parse_lines(df).columns == ["ip", "url", "id"]
    assert [r["id"] for r in parse_lines(df, drop_malformed=True).collect()] == [1]
    assert malformed_counts(df).first().asDict() == {"lines": 3, "malformed": 2}


def test_metric_is_observed(spark):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "a\tb"), (2, "a")], "id int, line string")
    rows = parse_lines(df, metric="m")
    assert "CollectMetrics" in rows._jdf.queryExecution().analyzed().toString()
    seen = Observation("outer")
    rows.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 2}


def test_empty_delimiter_is_refused(spark):
    with pytest.raises(ValueError):
        parse_lines(spark.createDataFrame([("a",)], "line string"), "")
