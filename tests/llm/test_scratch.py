"""What is left on disk: shuffle files of saved tables, intermediate tables of the near-copy join."""

import os
import time

from pyspark.sql import functions as F

from surgewatch.llm import common, jaccard


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {
        os.path.join(at, f) for folder in folders for at, _, files in os.walk(folder) for f in files
        if f.startswith("shuffle_") and f.endswith(".data")
    }


def names(paths):
    return {os.path.basename(p).split("-")[1] for p in paths if os.path.exists(p.removeprefix("file:"))}


def test_shuffle_files_go_when_a_table_is_saved(spark):
    before = shuffle_files(spark)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key)
    rows = spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).agg(F.sum("id").alias("s"))
    table = common.saved(rows, "sums")
    end = time.time() + 5
    while (new := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.1)
    assert not new
    assert spark.conf.get(key) == setting
    assert table.count() == 5000 and table.agg(F.sum("s")).first()[0] == sum(range(20_000))


def test_noted_inside_noted(spark):
    with common.noted() as outer:
        with common.noted() as inner:
            common.saved(spark.range(1), "one")
        common.saved(spark.range(1), "two")
    assert len(inner) == 1 and len(outer) == 2 and outer[0] == inner[0]


def test_components_leave_one_table(spark):
    edges = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).where("a <> 19")
    with common.noted() as paths:
        roots = common.components(edges)
    assert names(paths) == {"edges"} and sum(map(os.path.exists, paths)) == 1
    assert {r.node: r.root for r in roots.collect()} == {i: 0 if i < 20 else 20 for i in range(41)}


def test_tables_go_after_their_last_use(spark, monkeypatch):
    there = []

    def watched(df, name):
        table = common.saved(df, name)
        there.append((name, names(paths)))
        return table

    monkeypatch.setattr(jaccard, "saved", watched)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join([*words[:59], "x"]), " ".join(words), "a b c", None, " ".join(words[::-1])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    with common.noted() as paths:
        found = jaccard.similar_documents(docs)
    assert names(paths) == {"listed", "components"}
    # The first hashes of all sets are wide: they are gone before whole sets are made.
    assert not {"sketch", "elsewhere"} & next(seen for name, seen in there if name == "sets")
    assert not {"tokens", "candidates"} & next(seen for name, seen in there if name == "keys")
    expected = {(0, 56, 0), (1, 56, 0), (2, 56, 0), (3, 1, 3), (4, 0, 4), (5, 56, 5)}
    assert set(map(tuple, found.collect())) == expected
