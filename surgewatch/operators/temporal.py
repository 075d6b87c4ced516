"""As-of join: each log row with the threshold that was valid at its time."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgewatch.operators.dims import (
    GROUP_ROWS,
    sliced_versions,
    time_slice,
    whole_versions,
)
from surgewatch.operators.sizing import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, text_bytes

# Broadcast form: versions a log row is compared with, at most.
MAX_VERSIONS_PER_SLICE = 256

# Slices that the time from the first change to the last is cut into, at most.
MAX_SLICES = 65_536


def temporal_join(
    logs: DataFrame,
    changes: DataFrame,
    time_col: str = "ts",
    strategy: str = "auto",
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int | None = None,
    delay: str = "0 seconds",
    change_delay: str = "0 seconds",
    bucket_seconds: int | None = None,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Inner as-of join on ``url``: log columns, ``trigger_value``, ``dim_url``.

    The latest change with ``proc_time <= ts`` counts; of changes at the same
    time, the last one. Rows before the first change of their url are dropped.

    ``strategy`` is ``broadcast`` (versions sent to all tasks, the log is not
    shuffled; an error if they were measured to be too large for that),
    ``sorted`` (log and versions merged in time order) or ``auto``: broadcast
    if the versions are small enough, sorted otherwise.
    ``initial`` is a table ``url, trigger_value`` of thresholds known before
    all changes, valid from its ``proc_time`` on if it has that column.
    Streams keep the versions in state instead; ``salts``, the delays and
    ``bucket_seconds`` belong to them (see ``streaming.temporal``).
    """
    if logs.isStreaming or changes.isStreaming:
        from surgewatch.streaming.temporal import BUCKET_SECONDS, temporal_join_stream

        width = BUCKET_SECONDS if bucket_seconds is None else bucket_seconds
        return temporal_join_stream(
            logs, changes, time_col, salts, delay, change_delay, width, initial
        )
    if strategy not in ("auto", "broadcast", "sorted"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if initial is not None:
        changes = _known_before(initial, changes)
    changes = changes.where("url is not null and proc_time is not null")
    kind = logs.schema[time_col].dataType
    if changes.schema["proc_time"].dataType != kind:
        changes = changes.withColumn("proc_time", F.col("proc_time").cast(kind))
    size = measure(changes)
    if strategy != "sorted" and fits(changes, size, max_rows):
        return _broadcast_join(logs, changes, size, time_col)
    if strategy == "broadcast":
        raise ValueError("the versions are too large to be broadcast")
    return _sorted_join(logs, changes, size, time_col)


def _known_before(initial: DataFrame, changes: DataFrame) -> DataFrame:
    """The changes, and the initial thresholds as changes from long ago or from their time on."""
    kind = changes.schema["proc_time"].dataType
    long_ago = F.lit("0001-01-01 00:00:00").cast(kind)
    at = F.coalesce(F.col("proc_time").cast(kind), long_ago) if "proc_time" in initial.columns else long_ago
    columns = {"url": F.col("url"), "trigger_value": F.col("trigger_value").cast("string"), "proc_time": at}
    if "seq" in changes.columns:
        seq = F.col("seq").cast("bigint") if "seq" in initial.columns else F.lit(None).cast("bigint")
        columns["seq"] = F.coalesce(seq, F.lit(0).cast("bigint"))
    rows = initial.select(*[column.alias(name) for name, column in columns.items()])
    return changes.select(*columns).unionByName(rows)


@dataclass(frozen=True)
class Size:
    """What one pass over the changes tells about them."""

    rows: int
    urls: int
    busiest: int  # changes of the url that has most
    row_bytes: int  # of the longest row
    length: int  # seconds from the first change to the last
    last: Column  # time of the last change, a literal

    def slice_seconds(self, copies: int) -> int:
        """Shortest slices whose borders cut all versions at most so often.

        A version lies in at most ``MAX_SLICES`` of them, all in one array
        before they become rows.
        """
        wanted = ceil(self.length * self.urls / max(1, copies))
        return max(1, wanted, ceil(self.length / MAX_SLICES))


def measure(changes: DataFrame) -> Size:
    """Rows, urls and time span of the changes, in one aggregation."""
    zoned = isinstance(changes.schema["proc_time"].dataType, T.TimestampType)
    last = "unix_micros(max(last))" if zoned else "cast(max(last) as string)"
    found = (
        changes.groupBy("url")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.max(text_bytes(["url", "trigger_value"])).alias("row_bytes"),
            F.min("proc_time").alias("first"),
            F.max("proc_time").alias("last"),
        )
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("urls"),
            F.coalesce(F.max("rows"), F.lit(0)).alias("busiest"),
            F.coalesce(F.max("row_bytes"), F.lit(0)).alias("row_bytes"),
            F.expr("coalesce(timestampdiff(SECOND, min(first), max(last)), 0)").alias("length"),
            F.expr(last).alias("last"),
        )
        .first()
        .asDict()
    )
    last = F.lit(found["last"])
    found["last"] = F.timestamp_micros(last) if zoned else last.cast("timestamp_ntz")
    return Size(**found)


def fits(changes: DataFrame, size: Size, max_rows: int) -> bool:
    """Whether the versions, cut into slices, may be broadcast.

    There are at most ``max_rows`` changes, and cutting adds twice as many
    copies at most, and one per url. The longest row bounds the bytes. No url
    may change more than a fixed number of times in one slice, which bounds
    the comparisons per log row.
    """
    seconds = size.slice_seconds(2 * size.rows)
    copies = size.rows + size.urls * (size.length // seconds + 1)
    if size.rows > max_rows or copies * size.row_bytes > MAX_BROADCAST_BYTES:
        return False
    if size.busiest < MAX_VERSIONS_PER_SLICE:
        return True
    per_slice = changes.groupBy("url", time_slice("proc_time", seconds).alias("slice")).count()
    deepest = per_slice.agg(F.max("count").alias("n")).first()["n"] or 0
    return deepest < MAX_VERSIONS_PER_SLICE


def _sliced(with_ends: DataFrame, size: Size, seconds: int) -> DataFrame:
    """A copy of each version in every time slice in which it is valid.

    All time from the slice of the last change on is one slice.
    """
    end = F.least(F.coalesce("valid_to", size.last), size.last)
    return (
        with_ends.where("valid_to is null or valid_to > proc_time")
        .withColumn("end_at", end)
        .withColumn("from_slice", time_slice("proc_time", seconds))
        .withColumn("to_slice", time_slice("end_at", seconds))
        .select(
            F.col("url").alias("dim_url"),
            "trigger_value",
            F.col("proc_time").alias("valid_from"),
            "valid_to",
            F.explode(
                F.sequence("from_slice", "to_slice", F.expr(f"interval {seconds} seconds"))
            ).alias("slice"),
        )
        .where("valid_to is null or valid_to > slice")
    )


def _with_slice(logs: DataFrame, size: Size, seconds: int, time_col: str) -> DataFrame:
    """The log with the slice its time falls into, as ``log_slice``."""
    capped = logs.withColumn("slice_at", F.least(F.col(time_col), size.last))
    return capped.withColumn("log_slice", time_slice("slice_at", seconds)).drop("slice_at")


def _broadcast_join(
    logs: DataFrame, changes: DataFrame, size: Size, time_col: str
) -> DataFrame:
    """Hash join on url and slice, then the exact validity interval."""
    seconds = size.slice_seconds(2 * size.rows)
    joined = _with_slice(logs, size, seconds, time_col).join(
        F.broadcast(_sliced(whole_versions(changes), size, seconds)),
        (F.col("url") == F.col("dim_url"))
        & (F.col("log_slice") == F.col("slice"))
        & (F.col(time_col) >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col(time_col) < F.col("valid_to"))),
    )
    return joined.select(*logs.columns, "trigger_value", "dim_url")


def _sorted_join(
    logs: DataFrame,
    changes: DataFrame,
    size: Size,
    time_col: str,
    seconds: int | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Merge log rows and versions in time order and carry the version on.

    Work is grouped by url and time slice; a version that is valid in several
    slices has a copy in each, so no slice needs another one. A group with
    more than ``group_rows`` log rows is split, and each part gets the group's
    versions.
    """
    if seconds is None:
        # As many copies from cutting as there are versions.
        seconds = size.slice_seconds(size.rows)
    if size.busiest <= group_rows:
        with_ends = whole_versions(changes)
    else:
        with_ends = sliced_versions(changes)
    sliced = _sliced(with_ends, size, seconds)
    log = _with_slice(logs.where("url is not null"), size, seconds, time_col)

    # Both lists have at most one row per ``group_rows`` log rows. Slices are
    # counted only for urls that are hot as a whole; without any, adaptive
    # execution drops that second count and both joins with its result.
    hot_urls = log.groupBy("url").count().where(F.col("count") > group_rows).select("url")
    hot = (
        log.join(F.broadcast(hot_urls), "url", "left_semi")
        .groupBy("url", "log_slice")
        .agg(F.ceil(F.count(F.lit(1)) / group_rows).cast("int").alias("parts"))
        .where("parts > 1")
        .select(F.col("url").alias("hot_url"), F.col("log_slice").alias("hot_slice"), "parts")
    )
    hot = F.broadcast(hot)
    parts = F.coalesce("parts", F.lit(1))
    # The partition id keeps equal rows from all landing in one part; unlike a
    # random number it is the same when a lost task is run again.
    spread = F.xxhash64(*logs.columns, F.spark_partition_id())
    log_rows = log.join(
        hot, (F.col("url") == F.col("hot_url")) & (F.col("log_slice") == F.col("hot_slice")), "left"
    ).select(
        F.col("url").alias("dim_url"),
        F.col("log_slice").alias("slice"),
        F.pmod(spread, parts).cast("int").alias("part"),
        F.col(time_col).alias("at"),
        F.lit(True).alias("is_log"),
        F.lit(None).cast("struct<trigger_value:string>").alias("version"),
        F.struct(*logs.columns).alias("log"),
    )
    version_rows = sliced.join(
        hot, (F.col("dim_url") == F.col("hot_url")) & (F.col("slice") == F.col("hot_slice")), "left"
    ).select(
        "dim_url",
        "slice",
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"),
        F.greatest("valid_from", "slice").alias("at"),
        F.lit(False).alias("is_log"),
        F.struct("trigger_value").alias("version"),
    )
    so_far = (
        Window.partitionBy("dim_url", "slice", "part")
        .orderBy("at", "is_log")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        log_rows.unionByName(version_rows, allowMissingColumns=True)
        .withColumn("current", F.last("version", ignorenulls=True).over(so_far))
        .where("is_log and current is not null")
        .select("log.*", "current.trigger_value", "dim_url")
    )
