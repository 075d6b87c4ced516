"""Thresholds that change over time: latest value and version history."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgewatch.operators.sizing import fits_broadcast

# A url with more changes than this has them put in order slice by slice.
GROUP_ROWS = 4_000_000
# Slices of urls cut by time in the sorted form of the as-of join.
SLICE_SECONDS = 3600


def change_order(changes: DataFrame, time_col: str = "proc_time") -> list[Column]:
    """Order of changes: time, then sequence number, then the value itself."""
    names = [time_col, "seq", "trigger_value"]
    return [F.col(c) for c in names if c in changes.columns]


def time_slice(time_col: str, seconds: int) -> Column:
    """Start of the slice of ``seconds`` that holds the time."""
    return F.window(time_col, f"{seconds} seconds")["start"]


def latest_per_key(changes: DataFrame, time_col: str = "proc_time") -> DataFrame:
    """``url, trigger_value, proc_time`` of the latest change of each url.

    ``max_by`` combines before the shuffle, so each map task sends one row per
    url however many changes that url has.
    """
    newest = F.max_by(
        F.struct("trigger_value", time_col), F.struct(*change_order(changes, time_col))
    )
    return changes.groupBy("url").agg(newest.alias("v")).select("url", "v.*")


def versions(
    changes: DataFrame, time_col: str = "proc_time", slice_seconds: int | None = None
) -> DataFrame:
    """Add ``valid_to``: the time of the next change of the same url, or NULL.

    The changes of the busiest url are counted first. If they are few enough
    for one task, the next change is simply the next row of the url. If not,
    busy urls are cut where their changes are dense (``quantile_slices``); if
    ``slice_seconds`` is given, each url is cut into slices of that length.
    """
    if slice_seconds is not None:
        return sliced_versions(changes, time_col, slice_seconds)
    busiest = changes.groupBy("url").count().agg(F.max("count").alias("n")).first()["n"] or 0
    if busiest <= GROUP_ROWS:
        return whole_versions(changes, time_col)
    return cut_versions(quantile_slices(changes, busiest, time_col), changes.columns, time_col)


def quantile_slices(
    changes: DataFrame, busiest: int, time_col: str = "proc_time", group_rows: int | None = None
) -> DataFrame:
    """Add ``slice``: for urls with over ``group_rows`` changes, between which quantiles of their times.

    The quantiles are sketched per url, combined before the shuffle, and leave
    about half of ``group_rows`` changes to a slice, however dense some hours
    are; only changes of one instant are never cut. Other urls have one slice.
    The list of busy urls is bounded by rows / ``group_rows`` and broadcast if
    it was measured to be small.
    """
    group_rows = group_rows or GROUP_ROWS
    pieces = ceil(2 * busiest / group_rows)
    at = F.unix_micros(F.col(time_col).cast("timestamp"))
    busy = changes.groupBy("url").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group_rows)
    busy = busy.select(F.col("url").alias("busy_url"))
    # Accurate to a twentieth of a slice.
    quantiles = F.percentile_approx(at, [i / pieces for i in range(1, pieces)], 20 * pieces)
    same = F.col("url").eqNullSafe(F.col("busy_url"))
    # A left semi join keeps the columns of the changes alone.
    borders = changes.join(_small(busy), same, "left_semi").groupBy(F.col("url").alias("busy_url"))
    borders = borders.agg(F.array_distinct(quantiles).alias("borders"))
    cut = changes.join(_small(borders), same, "left")
    number = F.coalesce(F.size(F.filter("borders", lambda border: border < at)), F.lit(0))
    return cut.select(*[changes[c] for c in changes.columns], F.when(F.col("borders").isNull(), 0).otherwise(number).alias("slice"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def whole_versions(changes: DataFrame, time_col: str = "proc_time") -> DataFrame:
    """``versions`` with all changes of a url in one task."""
    by_url = Window.partitionBy("url").orderBy(*change_order(changes, time_col))
    return changes.withColumn("valid_to", F.lead(time_col).over(by_url))


def sliced_versions(
    changes: DataFrame, time_col: str = "proc_time", slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    """``versions`` with the changes of a url and time slice in one task."""
    sliced = changes.withColumn("slice", time_slice(time_col, slice_seconds))
    return cut_versions(sliced, changes.columns, time_col)


def cut_versions(sliced: DataFrame, columns: list[str], time_col: str = "proc_time") -> DataFrame:
    """``versions`` of changes with a ``slice`` that grows with time.

    Inside a slice the next change is the next row. For the last row of a
    slice it is the first change of the url's next slice that has any, taken
    from one summary row per url and slice.
    """
    in_slice = Window.partitionBy("url", "slice").orderBy(*change_order(sliced, time_col))
    over_slices = Window.partitionBy("url").orderBy("slice")
    following = (
        sliced.groupBy("url", "slice")
        .agg(F.min(time_col).alias("first_at"))
        .select("url", "slice", F.lead("first_at").over(over_slices).alias("next_at"))
    )
    ordered = sliced.withColumn("in_slice", F.lead(time_col).over(in_slice))
    return (
        ordered.alias("o")
        .join(
            following.alias("f"),
            F.col("o.url").eqNullSafe(F.col("f.url")) & (F.col("o.slice") == F.col("f.slice")),
        )
        .select(
            *[F.col(f"o.{c}") for c in columns],
            F.coalesce("o.in_slice", "f.next_at").alias("valid_to"),
        )
    )
