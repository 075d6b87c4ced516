"""Counts per window of a stream that keeps windows open for long, as one that reads recorded tables."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import partial
from math import gcd

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The processor below travels with the query, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Keys of state among which counts are dealt out.
BUCKETS = 256

# Rows at most: of a part of state, added up before the shuffle, and handed on at once.
PART_ROWS = 10_000
GATHERED_ROWS = 200_000
EMITTED_ROWS = 100_000

# No window over the kept rows ends.
NEVER = 2**62


def pack(counts: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, counts.schema) as writer:
        writer.write_table(counts)
    return sink.getvalue().to_pybytes()


def unpack(part: bytes) -> pa.Table:
    with pa.ipc.open_stream(pa.py_buffer(part)) as reader:
        return reader.read_all()


def joined(parts: list[pa.Table]) -> pa.Table:
    # A micro-batch of clock rows alone may have columns that are never NULL.
    return pa.concat_tables(parts, promote_options="default")


def summed(counts: pa.Table) -> pa.Table:
    """One row for rows that are equal but for ``times``; NULL is a key like others."""
    keys = [name for name in counts.column_names if name != "times"]
    total = counts.group_by(keys, use_threads=False).aggregate([("times", "sum")])
    return total.rename_columns([c.removesuffix("_sum") for c in total.column_names]).select(counts.column_names)


def bucket_parts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Counts of a task's rows, some hundred thousand at a time, and a row ``bucket, part`` for each bucket.

    Buckets without rows get one without a part, so that all have a clock from the first micro-batch on.
    """

    def parts(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        found = [None] * buckets
        if rows:
            counts = summed(pa.Table.from_batches(rows)).sort_by("bucket")
            starts = np.searchsorted(counts["bucket"].to_numpy(), np.arange(buckets + 1))
            counts = counts.drop_columns("bucket")
            for bucket, (low, high) in enumerate(zip(starts, starts[1:])):
                if high > low:
                    found[bucket] = pack(counts.slice(low, high - low))
        columns = [pa.array(range(buckets), pa.int32()), pa.array(found, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "part"])

    gathered, rows, given = [], 0, False
    for batch in batches:
        gathered.append(batch)
        rows += batch.num_rows
        if rows >= GATHERED_ROWS:
            yield parts(gathered)
            gathered, rows, given = [], 0, True
    if rows or not given:
        yield parts(gathered)


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in batch["part"]:
            yield from unpack(part.as_py()).to_batches()


class WindowCounts(StatefulProcessor):
    """Counts of a bucket of keys, per pane of ``pane`` milliseconds, until the windows over the panes close.

    A micro-batch adds parts and does not read those that are there. A part is
    filed under the first end of a window over its rows. When the watermark has
    passed it, the windows that have closed are emitted, and rows that belong to
    later windows as well are filed again.

    A timer just beyond the watermark follows it: input is late by the watermark
    of the micro-batch before, as in Spark's own aggregate.
    """

    def __init__(self, size: int, slide: int) -> None:
        self.size, self.slide, self.pane = size, slide, gcd(size, slide)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # The last watermark, the first end under which a part is filed, and the next part's number.
        self.clock = handle.getValueState("clock", "seen bigint, due bigint, part bigint")
        # Windows that end until ``since`` have been emitted with the part's rows.
        self.filed = handle.getMapState("filed", "part bigint", "due bigint, since bigint")
        self.parts = handle.getMapState("parts", "part bigint", "counts binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Each call of the state's is a message to the JVM: few per micro-batch.
        clock = self.clock.get()
        seen, first, number = clock or (0, NEVER, 0)
        given = [unpack(part) for batch in rows for part in batch["part"] if part is not None]
        if given:
            counts = joined(given)
            counts = counts.filter(pc.greater(counts["pane"], seen - self.pane))
            first, number = self._file(counts, 0, first, number)
        if clock is None:
            self._tick(seen, first, number)
        elif given:
            self.clock.update((seen, first, number))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        _, first, number = self.clock.get()
        if first <= watermark:
            closed, later = [], []
            latest = (watermark - self.size) // self.slide * self.slide
            first = NEVER
            for part, (due, since) in [(part, filed) for (part,), filed in self.filed.iterator()]:
                if due > watermark:
                    first = min(first, due)
                    continue
                counts = unpack(self.parts.getValue((part,))[0])
                self.parts.removeKey((part,))
                self.filed.removeKey((part,))
                pane = counts["pane"].to_numpy()
                last = pane // self.slide * self.slide
                closed.append(self._spread(counts, self._first(pane, since), np.minimum(last, latest)))
                later.append(counts.filter(pa.array(last > latest)))
            yield from self._emitted(summed(joined(closed)))
            first, number = self._file(joined(later), watermark, first, number)
        self._tick(watermark, first, number)

    def _tick(self, seen: int, first: int, number: int) -> None:
        self.clock.update((seen, first, number))
        self.handle.registerTimer(seen + 1)

    def _first(self, pane: np.ndarray, since: int) -> np.ndarray:
        """Start of the first window over a pane that ends after ``since``."""
        first = -((self.size - self.pane - pane) // self.slide) * self.slide
        return np.maximum(first, ((since - self.size) // self.slide + 1) * self.slide)

    def _file(self, counts: pa.Table, since: int, first: int, number: int) -> tuple[int, int]:
        """Keep counts, those of near panes in one part; the first end, and the next part's number."""
        counts = summed(counts).sort_by("pane")
        for low in range(0, counts.num_rows, PART_ROWS):
            part = counts.slice(low, PART_ROWS)
            due = int(self._first(part["pane"].to_numpy(), since).min()) + self.size
            self.parts.updateValue((number,), (pack(part),))
            self.filed.updateValue((number,), (due, since))
            first, number = min(first, due), number + 1
        return first, number

    def _spread(self, counts: pa.Table, first: np.ndarray, last: np.ndarray) -> pa.Table:
        """A row for each window from ``first`` to ``last``, whose start takes the place of the pane."""
        n = np.maximum((last - first) // self.slide + 1, 0)
        row = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        starts = pa.array(first[row] + nth * self.slide, pa.int64())
        place = counts.column_names.index("pane")
        return counts.take(pa.array(row)).set_column(place, "pane", starts)

    def _emitted(self, counts: pa.Table) -> Iterator[pd.DataFrame]:
        for low in range(0, counts.num_rows, EMITTED_ROWS):
            yield pd.DataFrame({"part": [pack(counts.slice(low, EMITTED_ROWS))]})

    def close(self) -> None:
        pass


def windowed_counts(
    logs: DataFrame,
    window_size: int,
    window_interval: int,
    time_col: str,
    keys: Sequence[str],
    times: Column,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``keys, times, window_start, window_end`` of a stream; ``times`` is what a row adds to its counts.

    Spark's own aggregate keeps a row of state per count and looks through all of
    them in each micro-batch. Here ``buckets`` keys of state keep parts of many
    counts, a micro-batch writes only what it adds, and reads only the parts of
    windows that close. Rows are late when their pane is, as in that aggregate.
    Tasks add up and pack their rows before the shuffle, since Python gets rows
    one by one there. A task has the counts of a bucket in memory when they
    close. State belongs to ``buckets``.
    """
    if isinstance(buckets, bool) or not isinstance(buckets, int) or buckets <= 0:
        raise ValueError(f"buckets must be a positive whole number: {buckets!r}")
    for key in keys:
        kind = logs.schema[key].dataType
        if not isinstance(kind, (T.StringType, T.IntegralType)):
            raise ValueError(f"{key} is neither text nor a whole number: {kind.simpleString()}")
    pane = gcd(window_size, window_interval)
    rows = logs.withColumn("_w", F.window(time_col, f"{pane} seconds")).select(
        *keys,
        F.unix_millis("_w.start").alias("pane"),
        times.cast("bigint").alias("times"),
        F.pmod(F.hash(*keys), F.lit(buckets)).alias("bucket"),
    )
    output = T.StructType([field for field in rows.schema if field.name != "bucket"])
    counts = (
        rows.mapInArrow(partial(bucket_parts, buckets=buckets), "bucket int, part binary")
        .groupBy("bucket")
        .transformWithStateInPandas(
            WindowCounts(1000 * window_size, 1000 * window_interval), "part binary", "append", "eventTime"
        )
        .mapInArrow(unpacked, output)
    )
    return counts.select(
        *keys,
        "times",
        F.timestamp_millis("pane").alias("window_start"),
        F.timestamp_millis(F.col("pane") + 1000 * window_size).alias("window_end"),
    )
