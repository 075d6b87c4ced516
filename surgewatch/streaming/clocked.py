"""Counts in windows of processing time that close by themselves."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from surgewatch.operators.windows import check_window

# The processor below travels with the query, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Keys among which clients and urls are dealt out.
BUCKETS = 256

OUTPUT = "ip string, url string, times bigint, window_start timestamp, window_end timestamp"


def partial_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Requests per client and url, batch by batch of a task."""
    for batch in batches:
        counts = batch.groupby(["ip", "url"], dropna=False)["hits"].sum().reset_index()
        yield counts.astype({"ip": object, "url": object}).where(counts.notna(), None)


class ClockedCounts(StatefulProcessor):
    """Per client and url: requests by window. A timer at a window's end emits it and forgets it."""

    def __init__(self, size_ms: int) -> None:
        self.size_ms = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start bigint", "times bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start = timerValues.getCurrentProcessingTimeInMs() // self.size_ms * self.size_ms
        times = sum(int(batch["hits"].sum()) for batch in rows)
        if self.windows.containsKey((start,)):
            times += self.windows.getValue((start,))[0]
        else:
            self.handle.registerTimer(start + self.size_ms)
        self.windows.updateValue((start,), (times,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        start = (end - self.size_ms,)
        times = self.windows.getValue(start)[0]
        self.windows.removeKey(start)
        yield pd.DataFrame(
            {
                "ip": [key[0]],
                "url": [key[1]],
                "times": [times],
                "window_start": pd.to_datetime([start[0]], unit="ms", utc=True),
                "window_end": pd.to_datetime([end], unit="ms", utc=True),
            }
        )

    def close(self) -> None:
        pass


class BucketCounts(StatefulProcessor):
    """As ``ClockedCounts`` for a bucket of many clients and urls, since calls for each of them cost most.

    Each micro-batch adds a part to the bucket's window, without reading what is
    there. The timer at a window's end adds its parts up, emits and forgets them.
    """

    def __init__(self, size_ms: int) -> None:
        self.size_ms = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "start bigint", "n int")
        self.counts = handle.getMapState(
            "counts", "start bigint, part int", "ip array<string>, url array<string>, times array<bigint>"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start = timerValues.getCurrentProcessingTimeInMs() // self.size_ms * self.size_ms
        part = self.parts.getValue((start,))[0] if self.parts.containsKey((start,)) else 0
        if not part:
            self.handle.registerTimer(start + self.size_ms)
        for counts in partial_counts(rows):
            self.counts.updateValue((start, part), tuple(counts[name].tolist() for name in counts))
            part += 1
        self.parts.updateValue((start,), (part,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        start = end - self.size_ms
        columns: tuple[list, list, list] = ([], [], [])
        for part in range(self.parts.getValue((start,))[0]):
            for column, values in zip(columns, self.counts.getValue((start, part))):
                column += values
            self.counts.removeKey((start, part))
        self.parts.removeKey((start,))
        rows = pd.DataFrame(dict(zip(("ip", "url", "hits"), columns)))
        for counts in partial_counts([rows]):
            yield counts.rename(columns={"hits": "times"}).assign(
                window_start=pd.Timestamp(start, unit="ms", tz="UTC"),
                window_end=pd.Timestamp(end, unit="ms", tz="UTC"),
            )

    def close(self) -> None:
        pass


def processing_time_counts(logs: DataFrame, window_size: int) -> DataFrame:
    """``ip, url, times, window_start, window_end`` of a stream, by the time rows are processed.

    Windows are aligned to the epoch. Timers of processing time close them,
    also while no rows arrive, so the log needs neither a time column, nor a
    watermark, nor clock rows; no row is ever late. Tasks count before the
    shuffle: a client with a third of all requests sends one row per batch.
    Clients and urls share ``BUCKETS`` keys of state; state belongs to that number.
    """
    check_window(window_size)
    rows = logs.select("ip", "url", F.lit(1).cast("bigint").alias("hits"))
    bucket = F.pmod(F.hash("ip", "url"), F.lit(BUCKETS))
    return (
        rows.mapInPandas(partial_counts, "ip string, url string, hits bigint")
        .withColumn("bucket", bucket)
        .groupBy("bucket")
        .transformWithStateInPandas(
            BucketCounts(1000 * window_size), OUTPUT, "append", "processingTime"
        )
    )
