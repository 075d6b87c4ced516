"""Counts per time window and key."""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_KEYS = ("ip", "url")

# From this many windows per row on, a batch hop count first counts per pane.
PANE_FACTOR = 4


def check_window(size: int, slide: int | None = None) -> None:
    """Window arguments are whole seconds, 0 < slide <= size."""
    for name, value in (("window_size", size), ("window_interval", slide)):
        if value is None:
            continue
        if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
            raise ValueError(f"{name} must be a positive whole number of seconds: {value!r}")
    if slide is not None and slide > size:
        raise ValueError(f"window_interval {slide} is larger than window_size {size}")


def _request_count(logs: DataFrame) -> Column:
    """Rows per group; rows may stand for several requests or be clock rows."""
    if "hits" in logs.columns:
        return F.sum("hits")
    if "hb" in logs.columns:
        return F.count_if(~F.col("hb"))
    return F.count(F.lit(1))


def _requests(logs: DataFrame) -> Column:
    """What a row adds to ``_request_count``."""
    if "hits" in logs.columns:
        return F.col("hits")
    if "hb" in logs.columns:
        return F.coalesce((~F.col("hb")).cast("bigint"), F.lit(0))
    return F.lit(1)


def _counts(logs: DataFrame, window: Column, keys: Sequence[str], total: Column) -> DataFrame:
    return (
        logs.groupBy(window.alias("w"), *keys)
        .agg(total.alias("times"))
        .select(
            *keys,
            "times",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
        )
    )


def tumble_counts(
    logs: DataFrame,
    window_size: int,
    time_col: str = "ts",
    keys: Sequence[str] = LOG_KEYS,
    buckets: int | None = None,
) -> DataFrame:
    """Requests per ``keys`` in windows of ``window_size`` seconds.

    One shuffle of partial counts: a key that holds a large share of all rows
    reaches it as one row per window and map task.

    With ``buckets`` a stream keeps its counts in so many keys of state, for
    windows that stay open over many micro-batches (``streaming.windowed``);
    no effect in batch. The choice is part of a stream's state.
    """
    check_window(window_size)
    if buckets is not None and logs.isStreaming:
        return _bucketed(logs, window_size, window_size, time_col, keys, buckets)
    window = F.window(time_col, f"{window_size} seconds")
    return _counts(logs, window, keys, _request_count(logs))


def _bucketed(
    logs: DataFrame, size: int, slide: int, time_col: str, keys: Sequence[str], buckets: int
) -> DataFrame:
    from surgewatch.streaming.windowed import windowed_counts

    return windowed_counts(logs, size, slide, time_col, keys, _requests(logs), buckets)


def hop_counts(
    logs: DataFrame,
    window_size: int,
    window_interval: int,
    time_col: str = "ts",
    keys: Sequence[str] = LOG_KEYS,
    panes: bool | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Requests per ``keys`` in windows of ``window_size`` seconds, one
    starting every ``window_interval`` seconds.

    Every row belongs to about size/slide windows. Plans with many windows per
    row count once per pane (the longest interval that divides both lengths)
    and copy the pane counts, not the rows, into the windows. ``panes``
    overrides that choice. A stream does the same in two chained counts: a row
    changes one row of state, that of its pane, and windows take a pane when
    the watermark has closed it. With ``buckets`` (see ``tumble_counts``) it
    keeps its panes in so many keys of state and makes a window of them when it
    closes. The choice is part of a stream's state.
    """
    check_window(window_size, window_interval)
    if buckets is not None and logs.isStreaming:
        return _bucketed(logs, window_size, window_interval, time_col, keys, buckets)
    window = F.window(time_col, f"{window_size} seconds", f"{window_interval} seconds")
    if panes is None:
        panes = window_size >= PANE_FACTOR * window_interval
    if panes and window_interval < window_size:
        length = gcd(window_size, window_interval)
        if logs.isStreaming:
            pane = logs.groupBy(F.window(time_col, f"{length} seconds").alias("pane"), *keys)
            pane = pane.agg(_request_count(logs).alias("times"))
            # Spark takes the pane's last instant, with its watermark, as its time.
            window = F.window("pane", f"{window_size} seconds", f"{window_interval} seconds")
            return _counts(pane, window, keys, F.sum("times"))
        pane = tumble_counts(logs, length, time_col, keys)
        pane = pane.withColumnRenamed("window_start", time_col)
        return _counts(pane, window, keys, F.sum("times"))
    return _counts(logs, window, keys, _request_count(logs))
