"""Size-aware heavy-light join of documents on their word shingles, by exact Jaccard similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgewatch.llm.common import components, dropped, noted, renamed, salted_join, saved

#: Words of a shingle, and the least similarity in hundredths.
SHINGLE = 5
PERCENT = 75
#: Keys a set contributes to the hub rounds: its most and least frequent ones.
HUB_KEYS = 4
#: Sets of a block; a task compares two blocks.
BLOCK_SETS = 1500
#: Cost of a set's entry in a long inverted list: itself, two hubs, and what is left over.
LIST_COST = 4

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(raw: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    A-Z are lower-cased; words are separated by space and tab to carriage
    return. Fewer words than a shingle make one shingle, none make none.
    """
    words = raw.translate(_FOLD).split() if raw else []
    if not words:
        return np.empty(0, np.int64)
    if len(words) <= size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64).view(np.int64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    found = hashes[: len(words) - size + 1].copy()
    for i in range(1, size):
        found = (found ^ (found >> np.uint64(29))) * _ODD + hashes[i : len(words) - size + 1 + i]
    found ^= found >> np.uint64(32)
    return np.unique(found.view(np.int64))


def _prefix(n: int, percent: int) -> tuple[int, int]:
    """How many smallest hashes of a set to look at, and how many of them another set must have.

    Linked sets share at least ``percent`` of either, so they share ``need``
    among the first n - least + need of both, in any common order.
    """
    least = -(-n * percent // 100)
    need = max(1, n // 8)
    return min(n, n - least + need), min(need, least)


def sketcher(size: int, percent: int):
    """Row number, doc_id, size and identity of the set, first hashes and how many must be shared."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            counts, sets, firsts, needs = [], [], [], []
            numbers = pa.array(range(row, row + len(batch)), pa.int64())
            row += len(batch)
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                found = shingles(raw, size)
                first, need = _prefix(len(found), percent)
                counts.append(len(found))
                sets.append(xxhash.xxh3_128_digest(found.tobytes()))
                firsts.append(found[:first])
                needs.append(need)
            yield pa.RecordBatch.from_arrays(
                [numbers, batch.column("doc_id"), batch.column("key"), pa.array(counts, pa.int64()), pa.array(sets, pa.binary()),
                 pa.array(firsts, pa.list_(pa.int64())), pa.array(needs, pa.int64())],
                names=["row", "doc_id", "key", "n", "id", "first", "need"],
            )

    return sketch


def whole_sets(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(raw, size) for raw in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n"), pa.array(found, pa.list_(pa.int64()))],
                names=["id", "n", "hashes"],
            )

    return sets


def _least(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100)


def boundary(sets: DataFrame, percent: int) -> int:
    """The largest size that counts as light, by the cost of the keys.

    A light set of p possible first tokens costs p (p + 1) / 2 subsets. A heavy
    one costs an entry in each token's inverted list and its comparisons there,
    which hubs keep to a few however long the list is. Costs are summed by
    size class (eight per doubling, so some hundred rows) and compared at each.
    """
    p = F.col("lead").cast("double")
    lists = F.aggregate(F.slice("freqs", F.lit(1), F.col("lead")), F.lit(0).cast("bigint"), lambda a, x: a + F.least(x, F.lit(LIST_COST)))
    classes = sets.groupBy(F.floor(F.log2("n") * 8).alias("class")).agg(
        F.sum(p * (p + 1) / 2).alias("light"), F.sum(lists).alias("heavy")
    )
    rows = sorted(classes.limit(1000).collect(), key=lambda r: r["class"])
    edges = [0] + [int(2 ** ((r["class"] + 1) / 8)) for r in rows]

    def cost(edge: int) -> float:
        light = sum(r.light for r in rows if 2 ** ((r["class"] + 1) / 8) <= edge + 1)
        return light + sum(r.heavy for r in rows if 2 ** ((r["class"] + 1) / 8) > edge * percent / 100)

    return min(edges, key=cost)


def join_keys(sets: DataFrame, light: int, percent: int) -> DataFrame:
    """``key, id, n, pick``: subsets of two tokens for light sets, single tokens for heavy.

    Tokens are ordered from rare to frequent. Linked sets share one of the
    first ``lead`` tokens, and two of the first ``lead`` + 1. Two light sets
    meet in a subset; a pair with a heavy set meets in a token, for which light
    sets that could link with a heavy one give tokens too.
    """
    single = F.slice("hashes", F.lit(1), F.col("lead"))
    more = F.slice("hashes", F.lit(1), F.col("lead") + 1)
    pairs = F.flatten(F.transform(more, lambda x, i: F.transform(
        F.slice(more, i + 2, F.size(more)), lambda y: F.xxhash64(x, y, F.lit("pair"))
    )))
    none = F.array().cast("array<bigint>")
    keys = F.concat(
        F.when(F.col("n") <= light, pairs).otherwise(none),
        F.when(F.col("n") >= F.floor(F.lit(light) * percent / 100), single).otherwise(none),
    )
    listed = sets.select("id", "n", F.posexplode(keys).alias("at", "key"), F.size(keys).alias("of"))
    pick = (F.col("at") < HUB_KEYS // 2) | (F.col("at") >= F.col("of") - HUB_KEYS)
    return listed.select("key", "id", "n", pick.alias("pick"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets link, by the size of their intersection.

    Tokens that only one set has were left out of ``hashes``; they count in n.
    """
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("hashes").alias("hb"))
    both = salted_join(salted_join(pairs, left, ["a"]), right, ["b"])
    shared = F.size(F.array_intersect("ha", "hb")).cast("bigint")
    linked = shared * 100 >= (F.col("na") + F.col("nb") - shared) * percent
    return both.where(linked).select("a", "b")


def _sizes_fit(n: str, other: str, percent: int) -> Column:
    return F.least(n, other) * 100 >= F.greatest(n, other) * percent


def links(sets: DataFrame, keys: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links ``a, b`` enough to connect all sets that links connect.

    A group of near copies would give the square of its size in pairs. So each
    key first compares its sets with two of them, its hubs, which connects most
    groups. Keys whose sets are then in one component have nothing left to
    find; sets of the others are compared in blocks (:func:`left_over`).
    """
    spread = F.struct(F.xxhash64("id"), "id", "n")
    hubs = keys.groupBy("key").agg(F.min(spread).alias("h1"), F.max(spread).alias("h2"))
    near = salted_join(keys.where("pick"), hubs, ["key"])
    near = near.select("id", "n", F.explode(F.array("h1", "h2")).alias("h"))
    pairs = near.where((F.col("id") != F.col("h.id")) & _sizes_fit("n", "h.n", percent)).select(
        F.least("id", "h.id").alias("a"), F.greatest("id", "h.id").alias("b")
    )
    found = saved(verified(saved(pairs.distinct(), "hubs"), sets, percent), "links")
    return found.unionByName(left_over(sets, keys, components(found), percent))


def left_over(sets: DataFrame, keys: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Links between sets of different components that share a key.

    Components that share keys form a cluster. A cluster of over a block's sets
    is taken apart into its keys if comparing the sets of each key with each
    other is less than comparing the cluster's: chains of keys, as common
    passages make them, cost what their keys cost and not the square of the
    chain. The sets of such a unit, a cluster or a key, are dealt to blocks: in
    units larger than a block by size, and there a component larger than a block
    to blocks of its own. Each two blocks whose sizes can link are compared by
    one task, unless both are of the same component. So no pairs are listed, a
    task holds two blocks, and a large component meets only what is not part of it.
    """
    own = saved(_labelled(keys, label), "labelled")
    open_ = own.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    own = saved(
        salted_join(own, open_.select("key", "low"), ["key"]).select("key", "id", "n", "root", "low").distinct(), "open"
    )
    roots = own.select(F.col("root").alias("a"), F.col("low").alias("b"))
    clusters = saved(
        components(roots).select(F.col("node").alias("root"), F.col("root").alias("cluster")), "clusters"
    )
    rows = saved(_units(own, clusters, percent), "units")
    blocks, placed = _blocks(rows)
    x = blocks.select("*", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)).alias("near")).alias("x")
    y = blocks.alias("y")
    tasks = x.join(y, (F.col("x.unit") == F.col("y.unit")) & (F.col("x.near") == F.col("y.size"))).where(
        (F.col("x.block") <= F.col("y.block"))
        & ~((F.col("x.only") == F.col("y.only")) & (F.col("x.only") != F.lit(b"")))
    ).select(F.xxhash64("x.block", "y.block").alias("task"), F.col("x.block").alias("b1"), F.col("y.block").alias("b2"))
    sides = saved(tasks.select("task", F.col("b1").alias("block"), F.lit(0).alias("side")).unionAll(
        tasks.where("b1 <> b2").select("task", F.col("b2").alias("block"), F.lit(1).alias("side"))
    ), "tasks")
    rows = placed.join(sides, "block").select("task", "side", "id", "root")
    rows = salted_join(rows, sets.select("id", "n", "hashes"), ["id"])
    return rows.repartition("task").sortWithinPartitions("task").mapInArrow(
        comparer(percent), "a binary, b binary"
    )


def _units(own: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """``unit, id, root, size``: the sets to compare, by cluster or by key.

    ``size`` is a class: linked sets are of one or of neighbouring classes.
    """
    members = own.select("id", "root").distinct().groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    sizes = members.join(clusters, "root").groupBy("cluster").agg(F.sum("m").alias("all"))
    by_key = own.groupBy("key").agg(F.count(F.lit(1)).cast("double").alias("m"), F.min("root").alias("root"))
    costs = by_key.join(clusters, "root").groupBy("cluster").agg(F.sum(F.col("m") * F.col("m")).alias("apart"))
    whole = F.col("all").cast("double")
    apart = sizes.join(costs, "cluster").select(
        "cluster", ((F.col("all") > BLOCK_SETS) & (F.col("apart") < whole * whole)).alias("apart")
    )
    of_root = salted_join(clusters, apart, ["cluster"])
    unit = F.when(F.col("apart"), F.xxhash64("key", F.lit("key"))).otherwise(F.xxhash64("cluster"))
    # A little wider than the ratio, so that rounding puts no linked sets two classes apart.
    width = max(math.log(100 / percent) * 1.000001, 0.05)
    return salted_join(own, of_root, ["root"]).select(
        unit.alias("unit"), "id", "root", F.floor(F.log("n") / width).alias("size")
    ).distinct()


def _blocks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The blocks ``unit, only, size, block`` and the sets in them, ``id, root, block``.

    ``only`` is the component all sets of a block are of, empty if they are of several.
    """
    per = saved(rows.groupBy("unit", "root", "size").agg(F.count(F.lit(1)).alias("m")), "per")
    whole = per.groupBy("unit").agg(F.sum("m").alias("all"))
    of_root = per.groupBy("unit", "root").agg(F.sum("m").alias("in_root"))
    plan = salted_join(salted_join(per, of_root, ["unit", "root"]), whole, ["unit"]).select(
        "unit", "root", F.col("size").alias("own"), "m",
        F.when(F.col("all") > BLOCK_SETS, F.col("size")).otherwise(0).alias("size"),
        F.when(F.col("in_root") > BLOCK_SETS, F.col("root")).otherwise(F.lit(b"")).alias("only"),
    )
    plan = saved(plan, "plan")
    parts = plan.groupBy("unit", "only", "size").agg(F.ceil(F.sum("m") / BLOCK_SETS).alias("parts"))
    placing = saved(salted_join(plan, parts, ["unit", "only", "size"]), "placing").select(
        "unit", "root", "only", F.col("own").alias("size"), F.col("size").alias("class"), "parts"
    )
    block = F.xxhash64("unit", "only", "class", F.pmod(F.xxhash64("id"), F.col("parts")))
    placed = salted_join(rows, placing, ["unit", "root", "size"]).select(
        "unit", "id", "root", "only", F.col("class").alias("size"), block.alias("block")
    )
    placed = saved(placed, "blocks")
    return saved(placed.select("unit", "only", "size", "block").distinct(), "blocks"), placed.select("id", "root", "block")


def comparer(percent: int):
    """Links between the two sides of each task, or within its only side."""

    def between(rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        left = [r for r in rows if r[0] == 0]
        right = [r for r in rows if r[0] == 1] or left
        lengths = np.array([len(r[4]) for r in right])
        tokens = np.concatenate([r[4] for r in right])
        owners = np.repeat(np.arange(len(right)), lengths)
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        sizes = np.array([r[3] for r in right])
        number = {root: i for i, root in enumerate({r[2] for r in right})}
        roots = np.array([number[r[2]] for r in right])
        for _, one, root, n, hashes in left:
            low, high = np.searchsorted(tokens, hashes, "left"), np.searchsorted(tokens, hashes, "right")
            count = high - low
            at = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
            shared = np.bincount(owners[at], minlength=len(right))
            linked = (shared * 100 >= (n + sizes - shared) * percent) & (roots != number.get(root, -1))
            hits = np.flatnonzero(linked)
            # One link to each other component is enough.
            for hit in hits[np.unique(roots[hits], return_index=True)[1]]:
                yield one, right[hit][1]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            found = list(between(rows)) if rows else []
            columns = [[a for a, _ in found], [b for _, b in found]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["a", "b"])

        rows: list[tuple] = []
        task = None
        for batch in batches:
            hashes = batch.column("hashes")
            columns = [batch.column(c).to_pylist() for c in ("task", "side", "id", "root", "n")]
            for i, (at, side, one, root, n) in enumerate(zip(*columns, strict=True)):
                if at != task:
                    yield out(rows)
                    rows, task = [], at
                rows.append((side, one, root, n, hashes[i].values.to_numpy(zero_copy_only=False)))
        yield out(rows)

    return compare


def _labelled(keys: DataFrame, label: DataFrame) -> DataFrame:
    roots = label.select(F.col("node").alias("id"), "root")
    return keys.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))


def similar_documents(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``.

    Sets are compared by 64-bit hashes of the shingles. Null and wordless texts
    are empty sets, linked with nothing: their component is their own doc_id.
    Rows with equal sets are linked. A null doc_id links like others and is
    never a component's id, unless all of its are null. Repeated rows give
    repeated results.

    Equal sets are one set from the start. A first pass looks at a part of each
    set only, the smallest hashes, and keeps the sets of which enough tokens
    occur in other sets; whole sets are made of these alone. Then tokens are
    counted, those in one set dropped, the boundary between light and heavy sets
    chosen, and keys joined (:func:`join_keys`, :func:`links`).

    A table is deleted when the last step that reads it is written. The result
    reads two: what is returned of each row, and the sets' components.
    """
    spark = docs.sparkSession
    plain = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"),
        F.md5(F.col("text").cast("string")).alias("key"),
    )
    with noted() as sketched:
        sketch = saved(
            plain.mapInArrow(
                sketcher(size, percent),
                "row bigint, doc_id bigint, key string, n bigint, id binary, first array<bigint>, need bigint",
            ),
            "sketch",
        )
    listed = saved(sketch.select("doc_id", "n", F.when(F.col("n") > 0, F.col("id")).alias("id")), "listed")
    full = sketch.where("n > 0")
    # The row that stands for a set; of several with its doc_id, by key.
    stand = full.groupBy("id").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("s")
    ).select("id", F.col("s.doc_id").alias("doc_id"), F.col("s.key").alias("key"))
    with noted() as standing:
        stand = saved(stand, "stand")
    tokens = full.select("row", F.explode("first").alias("token"))
    short = full.select(F.xxhash64("id").alias("short"), F.explode("first").alias("token"))
    with noted() as counted:
        elsewhere = saved(
            short.groupBy("token").agg(
                F.min("short").alias("low"), F.max("short").alias("high"), F.count(F.lit(1)).alias("_n")
            ).where("low <> high").select("token", "_n"),
            "elsewhere",
        )
    shared = salted_join(tokens, elsewhere.select("token"), ["token"], "left_semi", elsewhere)
    hits = shared.groupBy("row").agg(F.count(F.lit(1)).alias("hits"))
    # A set is a candidate if one of its rows is; equal sets have equal rows.
    candidates = full.select("row", "id", "n", "need").join(hits, "row").where("hits >= need").select(
        "id", "n"
    ).distinct()
    with noted() as chosen:
        rows = saved(stand.join(candidates, "id"), "candidates")
    dropped(spark, sketched + counted)
    texts = plain.alias("d").join(
        rows.alias("r"),
        (F.col("d.key") == F.col("r.key")) & F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")),
    ).select("r.id", "r.n", "d.text")
    with noted() as made:
        whole = saved(texts.mapInArrow(whole_sets(size), "id binary, n bigint, hashes array<bigint>"), "sets")
    whole = whole.dropDuplicates(["id"])
    with noted() as exploded:
        tokens = saved(whole.select("id", "n", F.explode("hashes").alias("token")), "tokens")
    dropped(spark, chosen + made)
    freqs = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("freq")).where("freq > 1")
    ordered = salted_join(tokens, freqs, ["token"]).groupBy("id", "n").agg(
        F.array_sort(F.collect_list(F.struct("freq", "token"))).alias("t")
    )
    least = _least(F.col("n"), percent)
    # The tokens left out come first in the order: they are the rarest.
    lead = F.col("n") - least + 1 - (F.col("n") - F.size("t"))
    with noted() as joined:
        sets = saved(
            ordered.where((F.size("t") >= least) & (lead > 0)).select(
                "id", "n", F.col("t.token").alias("hashes"), F.col("t.freq").alias("freqs"),
                lead.cast("int").alias("lead"),
            ),
            "sets",
        )
        dropped(spark, exploded)
        light = boundary(sets, percent)
        keys = join_keys(sets, light, percent)
        twice = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key")
        keys = saved(salted_join(keys, twice, ["key"], "left_semi"), "keys")
        roots = components(links(sets, keys, percent))
    smallest = roots.join(stand, roots["node"] == stand["id"]).groupBy("root").agg(
        F.min("doc_id").alias("component")
    )
    of_set = stand.select("id", "doc_id").join(
        roots.join(smallest, "root").select(F.col("node").alias("id"), "component"), "id", "left"
    ).select("id", F.coalesce("component", "doc_id").alias("component"))
    of_set = saved(of_set, "components")
    dropped(spark, standing + joined)
    named = salted_join(listed, of_set, ["id"], "left")
    return named.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row, all columns, of each group of linked rows: the smallest doc_id's, null last.

    Rows are told apart by a number of their own, so different texts under one
    doc_id, or none, are different documents. Rows without words are in no
    group and stay.
    """
    plain, names = renamed(docs, "doc_id", "text")
    rows = saved(plain.withColumn("_row", F.monotonically_increasing_id()), "rows")
    groups = similar_documents(rows.select(F.col("_row").alias("doc_id"), "text"), size, percent)
    named = groups.select(F.col("doc_id").alias("_row"), "component_id").join(rows.select("_row", "doc_id"), "_row")
    keep = named.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("k")
    ).select("k._row")
    return rows.join(keep, "_row", "left_semi").select(*names)
