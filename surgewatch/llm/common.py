"""Helpers shared by the operators: saved tables, skewed joins, components, positions."""

from __future__ import annotations

from collections.abc import Collection, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surgewatch.session import scratch_dir, session_conf

#: A key with more than this share of a table's rows counts as hot,
HOT_KEYS = 2048
#: or, in large tables, with more rows than this,
HOT_ROWS = 1_000_000
#: but no share below this: at most so many keys are listed, whatever the table's size.
MOST_KEYS = 65_536
#: A table with fewer rows is joined as it is: one task could take all of it.
SMALL_ROWS = 20_000

#: Shuffle files go with the query that wrote them, not when the driver happens to collect its garbage.
NO_SHUFFLES_KEPT = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def saved(df: DataFrame, name: str) -> DataFrame:
    """The table, written once to the shared scratch folder and read from there.

    What was shuffled for it is deleted once it is written.
    """
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    for paths in _NOTED:
        paths.append(path)
    with session_conf(df.sparkSession, NO_SHUFFLES_KEPT):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Lists that take the paths of saved tables, one per open ``noted``.
_NOTED: list[list[str]] = []


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of the tables that are saved inside the block and not dropped there."""
    paths: list[str] = []
    _NOTED.append(paths)
    try:
        yield paths
    finally:
        # The list itself, not one of the same paths.
        _NOTED[:] = [x for x in _NOTED if x is not paths]


def dropped(spark: SparkSession, paths: Collection[str]) -> None:
    """Delete saved tables, which are then noted nowhere. Nothing that is still to be computed may read them."""
    gone = set(paths)
    for path in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    for open_ in _NOTED:
        open_[:] = [path for path in open_ if path not in gone]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join with a ``right`` that has one row per key, however skewed ``left`` is.

    ``left`` should be cheap to read twice: its keys are counted first, unless
    ``counts`` has the rows ``_n`` of at least the keys in ``right``. Rows of
    a hot key (:func:`hot_limit`) are dealt out to parts of about as many rows as
    make a key hot, and the key's one row of ``right`` is copied to each, twice
    the number of listed keys in all; rows equal in all columns go to one part.
    Only the list of hot keys (at most 65,536) is broadcast. ``how`` is inner,
    left or left_semi. Null keys match nothing.
    """
    rows = left.count()
    if rows < SMALL_ROWS:
        return left.join(right, keys, how)
    limit = hot_limit(rows)
    if counts is None:
        counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(
        counts.where(F.col("_n") > limit).select(*keys, F.ceil(F.col("_n") / limit).alias("_salts"))
    )
    parts = F.coalesce("_salts", F.lit(1).cast("bigint"))
    # By what a row holds: a task that runs again may read its rows in another order.
    spread = F.pmod(F.xxhash64(*left.columns), parts)
    dealt = left.join(hot, keys, "left").withColumn("_salt", spread)
    copied = right.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))
    )
    joined = dealt.drop("_salts").join(copied.drop("_salts"), [*keys, "_salt"], how)
    return joined.drop("_salt")


def hot_limit(rows: int) -> float:
    """Rows that make a key of a table hot: 1/2048 of all, or a million where that is
    more, but at least 1/65,536 of all, so that the list of hot keys stays small.
    """
    return max(min(rows / HOT_KEYS, HOT_ROWS), rows / MOST_KEYS)


def renamed(docs: DataFrame, *kept: str) -> tuple[DataFrame, list[Column]]:
    """The rows with names that clash with none, ``c0, c1`` and so on, but for those ``kept``.

    The second part are the columns that give all names back.
    """
    names = [c.lower() if c.lower() in kept else f"c{i}" for i, c in enumerate(docs.columns)]
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])
    return plain, [F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of the undirected edges ``a, b``; root is its smallest node.

    Alternates large-star and small-star steps until nothing changes. Each step
    takes minima per node (combined before the shuffle) and one join, dealt out
    for nodes with very many edges; no node's neighbours are gathered. A step's
    tables are deleted after the next one.
    """
    spark = edges.sparkSession
    with noted() as old:
        edges = saved(
            edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct(),
            "edges",
        )
    before = None
    while True:
        # Large star: neighbours above a node move to the smallest around it.
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = salted_join(both, least, ["a"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        with noted() as passing:
            large = saved(large.where("a <> b").distinct(), "large")
        # Small star: neighbours below a node, and the node, move to the smallest.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = salted_join(large, least, ["a"])
        with noted() as new:
            edges = saved(
                small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                .unionAll(least.select("a", F.col("m").alias("b"))).distinct(),
                "edges",
            )
        dropped(spark, old + passing)
        old = new
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def spaces(text: Column) -> Column:
    """How many blanks a text has."""
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def places(text: Column, pattern: Column, measure=F.length) -> Column:
    """``start, end, value`` of each leftmost match, in order, by built-in functions.

    Offsets are sums of ``measure`` over the pieces between matches and the
    matches: code points, or blanks to count words. The text is searched once,
    and split only if there are matches.
    """
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")

    def step(state, x):
        start = state["at"] + measure(x["p"]).cast("bigint")
        end = start + measure(x["f"]).cast("bigint")
        one = F.struct(start.alias("start"), end.alias("end"), x["f"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(state["out"], one).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("out"))

    def located(found):
        pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        steps = F.zip_with(pieces, found, lambda p, f: F.struct(p.alias("p"), f.alias("f")))
        placed = F.aggregate(steps, start, step, lambda s: s["out"])
        return F.when(F.size(found) > 0, placed).otherwise(empty)

    return once(F.regexp_extract_all(text, pattern, F.lit(0)), located)


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
