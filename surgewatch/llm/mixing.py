"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgewatch.llm.common import renamed, salted_join, saved, word_count

# Weights of the sources in code point order, repeating; share of
# all words; most times a document or source can be taken.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2.0

#: Rows of a source that are rounded together.
ROUND_ROWS = 50_000
#: Times that what rounding left over is made up for by single copies.
REPAIRS = 3
NEWTON_STEPS = 60
TOLERANCE = 1e-9


def _running(table: DataFrame, name: str, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """The table with ``{key}`` per entry of ``sums``: the sum over all rows before it in an order.

    The order must have no ties. The table is dealt by ranges of the order and
    written; each task sums its own range, and sums of whole ranges, one row a
    range, are put before it.
    """
    ranged = saved(table.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    totals = ranged.groupBy("_range").agg(*[F.sum(v).alias(f"_all_{k}") for k, v in sums.items()])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = totals.select("_range", *[F.sum(f"_all_{k}").over(before).alias(f"_all_{k}") for k in sums])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.select("*", *[F.sum(v).over(inside).alias(f"_own_{k}") for k, v in sums.items()])
    none = F.lit(0).cast("bigint")
    return rows.join(F.broadcast(whole), "_range").select(*table.columns, *[
        (F.coalesce(F.col(f"_all_{k}"), none) + F.coalesce(F.col(f"_own_{k}"), none)).alias(k) for k in sums
    ])


def _targets(sources: DataFrame) -> DataFrame:
    """``source_size, source_rows``, ``most`` and ``target`` per source: a common level times
    the weight, stopped at ``LIMIT`` times the size, the excess going to the others by weight.

    Sums are of whole numbers, so the order of rows changes nothing.
    """
    place = _running(sources, "sources", [F.col("source").asc_nulls_last()], {"place": F.lit(1)})
    weight = F.element_at(
        F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int")
    )
    weighed = place.withColumn("weight", weight).withColumn("most", F.col("source_size") * int(LIMIT))
    # Sources stop in the order of most / weight. A row's level is what the
    # others share if exactly the rows before it have stopped.
    ratio = F.col("most") / F.col("weight")
    ranked = saved(_running(
        weighed, "weighed", [ratio.asc(), F.col("place").asc()],
        {"full": F.col("most"), "gone": F.col("weight"), "rank": F.lit(1)},
    ), "ranked")
    total, weights = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (SHARE * (total or 0) - F.col("full")) / ((weights or 0) - F.col("gone"))
    goes_on = F.col("most") > level * F.col("weight")
    first = ranked.where(goes_on).agg(F.min(F.struct(F.col("rank"), level.alias("level")))).first()[0]
    most = F.col("most").cast("double")
    target = most if first is None else F.least(most, F.lit(first.level) * F.col("weight"))
    return ranked.select("source", "source_size", "source_rows", most.alias("most"), target.alias("target"))


def _rate(tilt, feature):
    """Times a document is taken: an exponential tilt under the bounds 0 and ``LIMIT``.

    Among rates with a given sum of size * rate, these have the least relative
    entropy to taking each document once: minus the sum of r log r + (LIMIT - r)
    log(LIMIT - r) is stationary where log(r / (LIMIT - r)) is the constraint's
    multiplier times its coefficient, the size.
    """
    return LIMIT / (1.0 + F.exp(-F.greatest(F.least(tilt * feature, F.lit(500.0)), F.lit(-500.0))))


def _feature():
    """The coefficient of a document in its source's constraint: its size over the source's mean."""
    mean = F.col("source_size") / F.col("source_rows")
    return F.when(mean > 0, F.col("size") / mean).otherwise(0.0)


def balance(classes: DataFrame, targets: DataFrame) -> DataFrame:
    """``tilt`` per source: where the gradient of the convex dual is 0, by Newton steps with a bracket.

    ``classes`` has ``source, feature, words``, words being the sum of the sizes
    that have the feature. The gradient is words taken less the target, the
    Hessian the sum of words * feature * r (1 - r / LIMIT). A source with
    nothing to take has tilt -inf, one that is taken in full +inf. Tilts are
    rounded, so that the order of sums does not show.
    """
    infinite = F.lit(float("inf"))
    state = targets.select(
        "source", "target", "most",
        F.when(F.col("target") <= 0, -infinite)
        .when(F.col("target") >= F.col("most") * (1 - 1e-12), infinite)
        .otherwise(F.lit(0.0)).alias("tilt"),
        F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"),
    )
    state = saved(state, "dual")
    fixed = F.abs("tilt") == infinite
    for _ in range(NEWTON_STEPS):
        open_ = state.where(~fixed)
        joined = classes.alias("c").join(
            open_.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))
        )
        rate = _rate(F.col("tilt"), F.col("feature"))
        slope = rate * (1 - rate / LIMIT) * F.col("feature")
        sums = joined.groupBy(F.col("s.source").alias("source")).agg(
            F.sum(F.col("words") * rate).alias("taken"), F.sum(F.col("words") * slope).alias("slope")
        ).alias("n")
        s = state.alias("s")
        over = F.col("n.taken") - F.col("s.target")
        low = F.when(over < 0, F.col("s.tilt")).otherwise(F.col("s.low"))
        high = F.when(over > 0, F.col("s.tilt")).otherwise(F.col("s.high"))
        step = F.col("s.tilt") - over / F.col("n.slope")
        inside = (F.col("n.slope") > 0) & (step > low) & (step < high)
        # Outside of its bracket a step is replaced by halving, bounded ones first.
        middle = F.when((low <= -1e6) & (high < 1e6), F.least(high * 2, high - 1)).when(
            (high >= 1e6) & (low > -1e6), F.greatest(low * 2, low + 1)
        ).otherwise((low + high) / 2)
        done = F.col("n.source").isNull() & F.col("n.taken").isNull()
        state = saved(
            s.join(sums, F.col("s.source").eqNullSafe(F.col("n.source")), "left").select(
                "s.source", "s.target", "s.most",
                F.when(done | (over == 0), F.col("s.tilt")).when(inside, step).otherwise(middle).alias("tilt"),
                F.when(done, F.col("s.low")).otherwise(low).alias("low"),
                F.when(done, F.col("s.high")).otherwise(high).alias("high"),
                F.coalesce(F.abs(over) / F.col("s.target"), F.lit(0.0)).alias("error"),
            ),
            "dual",
        )
        worst = state.agg(F.max("error")).first()[0]
        if worst is None or worst < TOLERANCE:
            break
    return state.select("source", F.when(fixed, F.col("tilt")).otherwise(F.round("tilt", 11)).alias("tilt"))


def _key(source: str) -> Column:
    """A source as a key that equals itself, null too."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("null"))


def mix_rates(docs: DataFrame, *carried: str) -> DataFrame:
    """``doc_id, source, size``, ``source_size, target``, ``rate`` and ``copies`` per row.

    Sources are ordered by code point, null last, and weigh 5, 2, 1, repeating.
    A null text has size 0; such rows have a rate and may be copied, which
    takes no words. An empty table gives no rows; if all sizes are 0 so are all
    targets. Repeated rows count each for itself. ``carried`` columns are kept.

    Documents of a source with one size have one rate, so that sums over (source,
    size) replace rows in the iterations. Rates become copies by systematic
    rounding along the sizes: running sums of rates, started at a place drawn
    from the source's name, are rounded down, and their steps are the copies.
    A source with more rows than 50,000 is rounded in parts drawn by hash. What
    is left over in a part is made up for by one copy more or less of documents
    that fit it.
    """
    base = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string")).alias("_hash"), *carried,
    )
    base = saved(base, "sizes")
    groups = saved(base.groupBy("source", "size").agg(F.count(F.lit(1)).alias("rows")), "groups")
    sources = groups.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("source_rows")
    )
    targets = saved(_targets(sources), "targets")
    of_source = targets.select(F.col("source").alias("_s"), "source_size", "source_rows")
    classes = saved(salted_join(
        groups.withColumn("_key", _key("source")), of_source.withColumn("_key", _key("_s")), ["_key"]
    ).select(
        "source", _feature().alias("feature"), (F.col("size") * F.col("rows")).cast("double").alias("words")
    ), "classes")
    tilts = balance(classes, targets)
    plan = targets.alias("t").join(
        tilts.alias("b"), F.col("t.source").eqNullSafe(F.col("b.source"))
    ).select(
        _key("t.source").alias("_key"), "source_size", "source_rows", "target", "tilt",
        F.ceil(F.col("source_rows") / ROUND_ROWS).alias("_parts"),
    )
    keyed = base.withColumn("_key", _key("source"))
    rows = salted_join(keyed, plan, ["_key"])
    infinite = float("inf")
    rate = F.when(F.col("tilt") == infinite, F.lit(LIMIT)).when(
        F.col("tilt") == -infinite, F.lit(0.0)
    ).otherwise(_rate(F.col("tilt"), _feature()))
    part = F.pmod(F.col("_hash"), F.col("_parts"))
    within = Window.partitionBy("_key", "_part").orderBy(F.desc("size"), "_hash", "doc_id")
    upto = F.sum("rate").over(within.rowsBetween(Window.unboundedPreceding, 0))
    start = (F.pmod(F.xxhash64("_key", "_part"), F.lit(1 << 20)) + 0.5) / (1 << 20)
    rows = rows.withColumn("rate", rate).withColumn("_part", part).withColumn("_upto", upto)
    copies = F.floor(F.col("_upto") + start) - F.floor(F.col("_upto") - F.col("rate") + start)
    rows = rows.withColumn("copies", F.least(F.greatest(copies, F.lit(0)), F.lit(int(LIMIT))))
    for _ in range(REPAIRS):
        rows = _repaired(rows)
    return rows.withColumn("copies", F.col("copies").cast("int")).drop(
        "_hash", "_key", "_part", "_parts", "_upto", "tilt", "source_rows"
    )


def _repaired(rows: DataFrame) -> DataFrame:
    """Take off, or add, one copy of the largest documents that fit what rounding left over."""
    part = Window.partitionBy("_key", "_part")
    rows = rows.withColumn("_over", F.sum(F.col("size") * (F.col("copies") - F.col("rate"))).over(part))
    room = F.when(F.col("_over") > 0, F.col("copies") > 0).otherwise(F.col("copies") < int(LIMIT))
    fits = room & (F.col("size") > 0) & (F.col("size") <= F.abs("_over"))
    order = part.orderBy(F.desc("_fits"), F.desc("size"), "_hash", "doc_id")
    upto = F.sum(F.when(F.col("_fits"), F.col("size"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_fits", fits).withColumn("_sum", upto)
    change = F.col("_fits") & (F.col("_sum") <= F.abs("_over"))
    return rows.withColumn(
        "copies", F.when(change, F.col("copies") - F.signum("_over").cast("bigint")).otherwise(F.col("copies"))
    ).drop("_over", "_fits", "_sum")


def mixed(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, each as often as the mix takes it.

    Rates are computed without texts; equal rows share the sum of their copies.
    """
    docs, names = renamed(docs, "doc_id", "source", "text")
    hashed = [f.name for f in docs.schema if not f.dataType.simpleString().startswith("map<")]
    keyed = docs.withColumn("_key", F.concat_ws("|", F.xxhash64(*hashed), F.col("doc_id")))
    rates = mix_rates(keyed.select("doc_id", "source", "text", F.col("_key").alias("_row")), "_row")
    totals = rates.groupBy(F.col("_row").alias("_key")).agg(F.sum("copies").cast("int").alias("_copies"))
    rows = keyed.dropDuplicates(["_key"]).join(totals.where("_copies > 0"), "_key")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*names)


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` and the copies and rate per row."""
    return mix_rates(docs).select(
        "doc_id", "size", F.col("source_size").cast("bigint").alias("source_size"), "target",
        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"), "copies", "rate",
    )
