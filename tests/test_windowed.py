"""Streams that keep their counts in buckets until windows close."""

import random
from collections import Counter
from types import SimpleNamespace

import pandas as pd
import pyarrow as pa
import pytest

import __spark_entry__ as registry
from helpers import at, found, hop_counts as brute_hops, in_order, make_logs
from surgewatch import fixed_threshold_alerts, lookup_alerts
from surgewatch.functions.timeattr import with_watermark
from surgewatch.operators.lookup import lookup_join, salted
from surgewatch.operators.windows import hop_counts, tumble_counts
from surgewatch.session import STREAM_CONF, session_conf
from surgewatch.streaming.heartbeat import with_heartbeat
from surgewatch.streaming.windowed import WindowCounts, bucket_parts, pack, unpack
from test_stream_state import FakeMap
from test_streaming import BATCHES, DIM, LOGS, Feed, run, timed, written

COUNTS = "ip string, url string, times bigint, window_start timestamp_ntz, window_end timestamp_ntz"


class Map(FakeMap):
    def iterator(self):
        return iter(list(self.rows.items()))


class Value:
    value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Bucket:
    """One bucket's processor, driven as Spark drives it: input, then timers that are due."""

    def __init__(self, size, slide):
        self.timers, self.watermark = set(), 0
        self.processor = WindowCounts(size, slide)
        handle = SimpleNamespace(
            getMapState=lambda *_: Map(), getValueState=lambda *_: Value(), registerTimer=self.timers.add
        )
        self.processor.init(handle)

    def batch(self, rows, watermark):
        """``rows`` of client, pane and count, read while the watermark moves on; the closed windows."""
        names, found = ["ip", "pane", "times"], []
        parts = [pack(pa.Table.from_pylist([dict(zip(names, row))])) for row in rows]
        list(self.processor.handleInputRows((0,), iter([pd.DataFrame({"part": [None, *parts]})]), None))
        values = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        for timer in sorted(t for t in self.timers if t <= watermark):
            self.timers.remove(timer)
            info = SimpleNamespace(getExpiryTimeInMs=lambda: timer)
            for frame in self.processor.handleExpiredTimer((0,), values, info):
                found += [tuple(row.values()) for part in frame["part"] for row in unpack(part).to_pylist()]
        return sorted(found, key=str)


@pytest.fixture
def feeds(spark, tmp_path):
    return lambda name, schema: Feed(spark, tmp_path / name, schema)


@pytest.mark.parametrize("size, slide", [(5, 5), (10, 2), (7, 3), (6, 4)])
def test_windows_close_once_with_the_rows_that_were_in_time(size, slide, monkeypatch):
    monkeypatch.setattr("surgewatch.streaming.windowed.PART_ROWS", 3)
    random.seed(size)
    bucket, kept, late = Bucket(size, slide), [], 0
    pane = bucket.processor.pane
    for n in range(60):
        rows = [(random.choice("ab") if random.random() < 0.9 else None, random.randrange(max(0, 2 * n - 15), 2 * n + 9) // pane * pane, 2) for _ in range(4)]
        # Late by the watermark of the micro-batch before.
        kept += [row for row in rows if row[1] + pane > late]
        now = late if n % 3 else 2 * n
        want = Counter()
        for ip, p, times in kept:
            for start in range(-size // slide * slide, 200, slide):
                if start <= p < start + size and late < start + size <= now:
                    want[ip, start] += times
        assert bucket.batch(rows, now) == sorted(((*key, times) for key, times in want.items()), key=str)
        late = now
    bucket.batch([], 10_000)
    assert not bucket.processor.filed.rows and not bucket.processor.parts.rows


def test_open_windows_are_not_read():
    bucket = Bucket(1000, 1000)
    for n in range(50):
        assert bucket.batch([("a", 5000, 1), ("b", 6000, 1)], n) == []
    assert bucket.processor.parts.reads == []
    assert bucket.batch([], 6000) == [("a", 5000, 50)]
    assert bucket.batch([], 9000) == [("b", 6000, 50)]


def test_tasks_add_up_before_the_shuffle():
    rows = pa.table({"ip": ["a", None] * 500, "pane": [0] * 1000, "times": [1] * 1000, "bucket": pa.array([2, 0] * 500, pa.int32())})
    parts, = bucket_parts(iter(rows.to_batches(10)), 4)
    assert parts["bucket"].to_pylist() == [0, 1, 2, 3]
    given = [part and unpack(part).to_pylist() for part in parts["part"].to_pylist()]
    assert given == [[{"ip": None, "pane": 0, "times": 500}], None, [{"ip": "a", "pane": 0, "times": 500}], None]
    none, = bucket_parts(iter([]), 2)
    assert none["part"].to_pylist() == [None, None]  # a clock for each bucket all the same


@pytest.mark.parametrize("size, slide", [(10, 10), (10, 2)])
def test_same_counts_as_the_aggregate(spark, tmp_path, feeds, size, slide):
    """Late rows, rows before 1970, NULLs, many files and restarts."""
    random.seed(slide)
    logs, beats = feeds("logs", LOGS), feeds("beats", "ts timestamp")
    rows = with_watermark(with_heartbeat(logs.stream, beats.stream), delay="8 seconds")
    counts = {
        "own": hop_counts(rows, size, slide, buckets=5),
        "spark": hop_counts(rows, size, slide, panes=True),
    }
    state = []

    def go():
        for name, stream in counts.items():
            with session_conf(spark, STREAM_CONF):
                query = stream.where("times > 0").writeStream.format("parquet").trigger(availableNow=True)
                query = query.option("checkpointLocation", str(tmp_path / f"ck_{name}")).start(str(tmp_path / name))
                query.awaitTermination()
            if name == "own":
                state.extend(p.stateOperators[0].numRowsTotal for p in query.recentProgress)

    logs.put([("1", "a", at(-500_000_000)), (None, None, None)])
    for n in range(4):
        for _ in range(2):
            clients = [str(random.randrange(80)) for _ in range(60)] + [None]
            logs.put(timed([(ip, random.choice(["a", "b", None]), 1000 + 12 * n + random.randrange(-15, 15)) for ip in clients]))
        go()
    beats.put([(at(5000),)])
    go()
    results = [spark.read.schema(COUNTS).parquet(str(tmp_path / name)).collect() for name in counts]
    own, native = (Counter(map(tuple, rows)) for rows in results)
    assert own == native and len(own) > 100
    assert max(state) < 5 * 30  # keys of state are buckets, not counts


def test_lookup_with_a_kept_table(spark, tmp_path, feeds):
    logs, beats = feeds("logs", LOGS), feeds("beats", "ts timestamp")
    dim = spark.createDataFrame([(1, 2, "a"), (2, 3, "a"), (3, 2, "b"), (4, None, "a"), (5, 2, None)], DIM)
    everything = make_logs(spark, [row for batch in BATCHES for row in batch])
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        kept = salted(dim, 3).persist()
        rows = with_watermark(with_heartbeat(logs.stream, beats.stream))
        alerts = lookup_alerts(rows, kept, 10, salts=3, buckets=4)
        for batch in BATCHES:
            logs.put(timed(batch))
        run(alerts, tmp_path)
        beats.put([(at(1000),)])
        with session_conf(spark, STREAM_CONF):
            query = alerts.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "plan"))
            query = query.trigger(availableNow=True).start()
            query.awaitTermination()
        run(alerts, tmp_path)
        shuffles = [s for s in query._jsq.explainInternal(False).splitlines() if "Exchange" in s and "ENSURE_REQUIREMENTS" in s]
        kept.unpersist()
    assert written(spark, tmp_path / "out") == found(lookup_alerts(everything, dim, 10))
    assert shuffles and not any("dim_url" in s for s in shuffles)
    for log, salts in ((everything, None), (everything, 3), (rows, None), (rows, 4)):
        with pytest.raises(ValueError, match="salted"):
            lookup_join(log, kept, salts=salts)


def test_batch_has_no_buckets(spark):
    logs = make_logs(spark, [("1", "a", s) for s in (1, 2, 15)])
    assert found(tumble_counts(logs, 10, buckets=3)) == found(tumble_counts(logs, 10))
    assert found(hop_counts(logs, 10, 2, buckets=3)) == in_order(brute_hops([("1", "a", s) for s in (1, 2, 15)], 10, 2))


def test_refused(feeds):
    logs = with_watermark(feeds("logs", LOGS).stream)
    for buckets in (0, -1, True, 1.5):
        with pytest.raises(ValueError, match="buckets"):
            tumble_counts(logs, 10, buckets=buckets)
    with pytest.raises(ValueError, match="whole number"):
        tumble_counts(logs, 10, keys=("ip", "ts"), buckets=2)


@pytest.mark.parametrize("name", ["stream_lookup_alerts_parts", "stream_hop_counts_panes", "stream_lookup_alerts", "stream_fixed_threshold_alerts"])
def test_registered_streams_keep_buckets(spark, small_dir, name, monkeypatch):
    used = []
    from surgewatch.streaming import windowed

    def spy(*args):
        used.append(args[-1])
        return counted(*args)

    counted = windowed.windowed_counts
    monkeypatch.setattr(windowed, "windowed_counts", spy)
    batch = registry.queries()[name.removeprefix("stream_")](spark, small_dir).where("times > 0")
    columns = ["ip", "url", "times", "window_start", "window_end"]
    stream = registry.queries()[name](spark, small_dir)
    assert Counter(map(tuple, stream.select(columns).collect())) == Counter(map(tuple, batch.select(columns).collect()))
    assert used == [registry.BUCKETS] * 2
