"""Helpers shared by the operators."""

from pyspark.sql import functions as F

from surgewatch.llm import common, mixing


def test_salts_do_not_depend_on_the_order_of_rows(spark, monkeypatch):
    monkeypatch.setattr(common, "SMALL_ROWS", 0)
    left = spark.range(5000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, name string")
    plan = common.salted_join(left, right, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "rand(" not in plan and "xxhash64(" in plan
    joined = common.salted_join(left.orderBy(F.desc("v")), right, ["k"])
    assert sorted(map(tuple, joined.collect())) == sorted((i % 2, i, "ab"[i % 2]) for i in range(5000))


def test_parts_of_a_hot_key_grow_with_its_rows(spark, monkeypatch):
    monkeypatch.setattr(common, "SMALL_ROWS", 0)
    left = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    right = spark.range(30_000).select(F.col("id").alias("k"), F.lit(1).alias("one"))
    seen = common.salted_join(left, right, ["k"])
    assert seen.agg(F.count("v"), F.sum("one")).first() == (30_000, 30_000)
    # A key of two thirds of the rows has about 2/3 of 2,048 parts.
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert "_salts" in plan
    monkeypatch.setattr(common, "HOT_KEYS", 2)
    assert common.salted_join(left, right, ["k"], "left").count() == 30_000


def test_hot_keys_are_listed_in_bounds():
    assert common.hot_limit(204_800) == 100
    assert common.hot_limit(10**10) == common.HOT_ROWS
    for rows in (10**5, 10**9, 10**12, 10**15):
        assert rows / common.hot_limit(rows) <= common.MOST_KEYS


def test_mixing_with_dealt_keys(spark, monkeypatch):
    """The names a salted join uses are none of the operators' own."""
    monkeypatch.setattr(common, "SMALL_ROWS", 0)
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 7).cast("int")).alias("text"),
    )
    sums = mixing.digest(docs).groupBy("source_size").agg(F.max("target").alias("target"), F.sum("taken").alias("taken"))
    for row in sums.collect():
        assert abs(row.taken - row.target) <= 7
