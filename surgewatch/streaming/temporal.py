"""As-of join of two streams: log rows with the threshold of their time."""

from __future__ import annotations

import pickle
import sys
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from surgewatch.session import SALTS

# The processor below travels with the query, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHANGE, LOG, CLOCK = 0, 1, 2

#: Event time of changes behind their watermark: Spark must not drop a late one.
NEVER_LATE = "2200-01-01"

#: Time of initial thresholds without one: before all others.
EVER = -(1 << 62)

#: Log rows that wait for their threshold are kept in buckets of this length.
BUCKET_SECONDS = 60

#: Keys whose thresholds a task remembers between the timers of a micro-batch.
KNOWN_KEYS = 64

#: Changes that one entry of state holds, at most.
PART_CHANGES = 10_000

#: Changes of a url that travel together: the newest one's time, and their columns, pickled.
PACKED = "url string, kind int, at bigint, part binary"

OUTPUT = "ip string, url string, {time} timestamp, hits bigint, trigger_value string, dim_url string"


class AsOf(StatefulProcessor):
    """Per url and salt: known thresholds, and log rows not yet decided.

    A log row is decided once the watermark has passed its time: no change
    that is valid at that time can arrive any more. So the result does not
    depend on how the two streams interleave. A change later than its stream's
    delay still applies to all log rows not yet decided.

    Waiting log rows are kept by time bucket, in parts: a micro-batch adds a
    part to each bucket it has rows for, without reading what is there. Each
    bucket has its own timer, so only buckets whose time has come are read, and
    only the one that the watermark stands in is written again.

    Thresholds that no undecided row can meet any more are dropped when the
    watermark passes the changes after them, requests or not. Thresholds known
    before the stream starts come as initial state.
    """

    def __init__(self, time_col: str, bucket_ms: int) -> None:
        self.time_col = time_col
        self.bucket_ms = bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.changes = handle.getListState(
            "changes", "at array<bigint>, seq array<bigint>, trigger_value array<string>"
        )
        self.parts = handle.getMapState("parts", "bucket bigint", "n int")
        self.waiting = handle.getMapState(
            "waiting", "bucket bigint, part int", "at array<bigint>, ip array<string>, hits array<bigint>"
        )
        self.known: dict[tuple, list] = {}

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._add_changes(_columns(initialState))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.known.pop(key, None)
        last = None
        for batch in rows:
            changes = batch[batch["kind"] == CHANGE]
            if len(changes):
                columns = _columns(changes)
                self._add_changes(columns)
                newest = max(columns[0])
                last = newest if last is None else max(last, newest)
            logs = batch[batch["kind"] == LOG]
            if len(logs):
                hits = logs.groupby(["at", "ip"], dropna=False).size()
                times = hits.index.get_level_values("at").to_numpy()
                ips = [None if pd.isna(ip) else ip for ip in hits.index.get_level_values("ip")]
                self._add_waiting(times, ips, hits.tolist())
        if last is not None:
            # One millisecond late: the watermark has then passed the change.
            self.handle.registerTimer(last // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark, expiry = timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()
        starts, known = self._known(key, min(watermark, expiry) * 1000)
        at, ips, hits = self._due(expiry, watermark)
        current = np.searchsorted(starts, at, side="right") - 1
        hit = np.flatnonzero(current >= 0)
        if not len(hit):
            return iter(())
        result = pd.DataFrame(
            {
                "ip": [ips[i] for i in hit],
                "url": key[0],
                self.time_col: pd.to_datetime(at[hit], unit="us", utc=True),
                "hits": [hits[i] for i in hit],
                "trigger_value": [known[current[i]][2] for i in hit],
                "dim_url": key[0],
            }
        )
        return iter([result])

    def _add_changes(self, columns: tuple[list, list, list]) -> None:
        if columns[0]:
            self.changes.appendList([columns])

    def _add_waiting(self, at: np.ndarray, ips: list, hits: list) -> None:
        """Add log rows, ordered by time, to their buckets."""
        # Times before 1970 share the first bucket, as timers do not reach back there.
        bucket = np.maximum(at // (1000 * self.bucket_ms), 0)
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(at)]
        for low, high in zip(cuts, cuts[1:]):
            number = int(bucket[low])
            self._put(number, at[low:high].tolist(), ips[low:high], hits[low:high])

    def _put(self, bucket: int, at: list, ips: list, hits: list, wake: int = 1) -> None:
        """Add a part to a bucket, which is looked at from the time of its first row on, not before ``wake``."""
        part = self.parts.getValue((bucket,))[0] if self.parts.containsKey((bucket,)) else 0
        self.waiting.updateValue((bucket, part), (at, ips, hits))
        self.parts.updateValue((bucket,), (part + 1,))
        # One millisecond early: the watermark has whole milliseconds.
        self.handle.registerTimer(max(wake, at[0] // 1000 - 1))

    def _due(self, expiry: int, watermark: int) -> tuple[np.ndarray, list, list]:
        """Take the log rows that the watermark has passed from the bucket of a timer."""
        due: tuple[list, list, list] = ([], [], [])
        # A timer is a millisecond early, or up to one late if it was put off.
        for bucket in sorted({(expiry + late) // self.bucket_ms for late in (-1, 0, 1)}):
            if not self.parts.containsKey((bucket,)):
                continue
            later: tuple[list, list, list] = ([], [], [])
            for part in range(self.parts.getValue((bucket,))[0]):
                rows = self.waiting.getValue((bucket, part))
                # Parts are in order of time.
                cut = bisect_right(rows[0], watermark * 1000)
                for column, more, values in zip(due, later, rows):
                    column += values[:cut]
                    more += values[cut:]
                self.waiting.removeKey((bucket, part))
            self.parts.removeKey((bucket,))
            if later[0]:
                order = sorted(range(len(later[0])), key=later[0].__getitem__)
                # This timer is deleted after it was handled: another time, beyond the watermark.
                self._put(bucket, *([c[i] for i in order] for c in later), wake=watermark + 1)
        return np.array(due[0], dtype=np.int64), due[1], due[2]

    def _known(self, key: tuple, limit: int) -> tuple[np.ndarray, list]:
        """Start times of the key's thresholds, and the thresholds.

        Timers come in order of time, so later ones need no threshold that
        another one has replaced by ``limit``. Such are dropped once they are
        the greater part, from what is kept; what is remembered for the
        batch's other timers has them still.
        """
        if key not in self.known:
            if len(self.known) >= KNOWN_KEYS:
                self.known.clear()
            parts = self.changes.get() if self.changes.exists() else ()
            known = sorted(
                (change for part in parts for change in zip(*part)),
                key=lambda c: (c[0], c[1], c[2] is not None, c[2] or ""),
            )
            self.known[key] = [np.array([c[0] for c in known], dtype=np.int64), known, 0]
        starts, known, dropped = self.known[key]
        passed = int(np.searchsorted(starts, limit, side="right"))
        if passed - 1 - dropped > 0 and passed - 1 - dropped >= len(known) - (passed - 1):
            kept = known[passed - 1 :]
            self.changes.put([tuple(map(list, zip(*part))) for part in _cut(kept, PART_CHANGES)])
            self.known[key][2] = passed - 1
        return starts, known

    def close(self) -> None:
        pass


def _cut(rows: list, size: int) -> list[list]:
    return [rows[low : low + size] for low in range(0, len(rows), size)]


def _columns(changes: pd.DataFrame) -> tuple[list, list, list]:
    """Times, sequence numbers and values of changes, in rows or ``packed``."""
    if "part" in changes:
        parts = [pickle.loads(part) for part in changes["part"]]
        at, seq, values = ([v for part in parts for v in part[i]] for i in range(3))
        return at, seq, values
    values = changes["trigger_value"].astype(object)
    return changes["at"].tolist(), changes["seq"].tolist(), values.where(values.notna(), None).tolist()


def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each url's changes in a batch of a task; clock rows are dropped, they have moved the watermark.

    Changes without a time hold for no request and are dropped too.
    """
    for batch in batches:
        changes = batch[(batch["kind"] == CHANGE) & batch["at"].notna() & batch["url"].notna()]
        changes = changes.astype({"at": "int64"})
        rows = [
            (url, CHANGE, int(part["at"].max()), pickle.dumps(_columns(part)))
            for url, part in changes.groupby("url", sort=False)
        ]
        yield pd.DataFrame(rows, columns=["url", "kind", "at", "part"])


def temporal_join_stream(
    logs: DataFrame,
    changes: DataFrame,
    time_col: str = "ts",
    salts: int | None = None,
    delay: str = "0 seconds",
    change_delay: str = "0 seconds",
    bucket_seconds: int = BUCKET_SECONDS,
    initial: DataFrame | None = None,
) -> DataFrame:
    """``ip, url``, time, ``hits``, ``trigger_value, dim_url`` as a stream.

    ``hits`` is the number of equal log rows a row stands for. Both inputs
    must be streams without a watermark; each gets its own here, with ``delay``
    and ``change_delay``. The smaller of the two counts (Spark's policy
    ``min``), so neither stream makes the other one late, and a log row is
    decided when both streams have passed it. Clock rows of the log
    (``streaming.heartbeat``) stand for both streams; without them a stream
    that is quiet holds results back until it has newer rows. State lives in
    RocksDB (``session.STREAM_CONF``).

    A url's log rows are dealt out to ``salts`` keys (``session.SALTS`` by
    default), and each key gets all changes of the url, so that one popular
    url keeps many tasks busy. Log rows wait in buckets of ``bucket_seconds``:
    short ones for streams that are decided within minutes, long ones for
    recorded data read in few large steps. State belongs to its salts and
    buckets: give a query the same numbers at each start.

    ``initial`` is a table ``url, trigger_value`` of thresholds known before
    the stream starts, each valid from its ``proc_time`` on (and ordered by
    ``seq``), if it has those columns, or ever before. It is loaded by the
    first micro-batch, before any log row; restarts do not read it.
    """
    if salts is None:
        salts = SALTS
    if bucket_seconds <= 0:
        raise ValueError(f"bucket_seconds must be positive: {bucket_seconds!r}")
    kind = F.when(F.col("hb"), CLOCK).otherwise(LOG) if "hb" in logs.columns else F.lit(LOG)
    # Seeded, so by position in the scan: equal when a lost task is run again.
    dealt = F.floor(F.rand(7) * salts).cast("int")
    rows = logs.select(
        "url",
        dealt.alias("salt"),
        F.col(time_col).cast("timestamp").alias(time_col),
        kind.alias("kind"),
        "ip",
    ).withWatermark(time_col, delay)
    known = changes.select(
        "url",
        F.col("proc_time").cast("timestamp").alias(time_col),
        F.lit(CHANGE).alias("kind"),
        F.col("trigger_value").cast("string").alias("trigger_value"),
        (F.coalesce("seq", F.lit(0)) if "seq" in changes.columns else F.lit(0))
        .cast("bigint")
        .alias("seq"),
    )
    if "hb" in logs.columns:
        beats = logs.where("hb").select(
            "url",
            F.col(time_col).cast("timestamp").alias(time_col),
            F.lit(CLOCK).alias("kind"),
            F.lit(None).cast("string").alias("trigger_value"),
            F.lit(0).cast("bigint").alias("seq"),
        )
        known = known.unionByName(beats)
    # Packed before they are copied to the salts.
    known = (
        known.withWatermark(time_col, change_delay)
        .withColumn("at", F.unix_micros(time_col))
        .drop(time_col)
        .mapInPandas(packed, PACKED)
        .select(
            "url",
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
            F.lit(NEVER_LATE).cast("timestamp").alias(time_col),
            "kind",
            F.lit(None).cast("string").alias("ip"),
            "at",
            "part",
        )
    )
    return (
        rows.withColumns({"at": F.unix_micros(time_col), "part": F.lit(None).cast("binary")})
        .unionByName(known)
        .where("url is not null and at is not null")
        .groupBy("url", "salt")
        .transformWithStateInPandas(
            AsOf(time_col, 1000 * bucket_seconds),
            OUTPUT.format(time=time_col),
            "append",
            "eventTime",
            initialState=None if initial is None else _initial_state(initial, salts),
            eventTimeColumnName=time_col,
        )
    )


def _initial_state(initial: DataFrame, salts: int) -> GroupedData:
    """Thresholds of a table, a copy for each salt of their url."""
    at = F.coalesce(F.unix_micros(F.col("proc_time").cast("timestamp")), F.lit(EVER)) if "proc_time" in initial.columns else F.lit(EVER)
    seq = F.coalesce(F.col("seq").cast("bigint"), F.lit(0)) if "seq" in initial.columns else F.lit(0)
    return (
        initial.where("url is not null")
        .select(
            "url",
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
            at.cast("bigint").alias("at"),
            seq.cast("bigint").alias("seq"),
            F.col("trigger_value").cast("string").alias("trigger_value"),
        )
        .groupBy("url", "salt")
    )
