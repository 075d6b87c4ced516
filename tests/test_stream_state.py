"""State of streams: buckets of waiting requests, first thresholds, changelogs, clocks and panes."""

import random
from datetime import timedelta
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from helpers import EPOCH, as_of, at, found, hop_counts as brute_hops, in_order, make_changes, make_logs
from surgewatch import hop_temporal_alerts, temporal_alerts
from surgewatch.functions.timeattr import with_watermark
from surgewatch.operators.dims import latest_per_key
from surgewatch.operators.windows import hop_counts
from surgewatch.params import TemporalParams
from surgewatch.session import STREAM_CONF, session_conf
from surgewatch.sources import replay as tables
from surgewatch.streaming import audit
from surgewatch.streaming.changelog import latest_stream, upserted
from surgewatch.streaming.clocked import ClockedCounts, partial_counts
from surgewatch.streaming.heartbeat import with_heartbeat
from surgewatch.streaming.jobs import Endpoint, run_temporal
from surgewatch.streaming.replay import changelog_to, replay_alerts, replay_clocked, replay_latest
from surgewatch.streaming.temporal import CHANGE, LOG, AsOf
from test_streaming import CHANGES, LINE, LOGS, Feed, job_params, lines, run, timed, written


@pytest.fixture
def feeds(spark, tmp_path):
    return lambda name, schema: Feed(spark, tmp_path / name, schema)


# --- processors with state in plain dictionaries -----------------------------


class FakeMap:
    def __init__(self):
        self.rows, self.reads = {}, []

    def containsKey(self, key):
        return key in self.rows

    def getValue(self, key):
        self.reads.append(key)
        return self.rows.get(key)

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        self.rows.pop(key, None)


class FakeList:
    def __init__(self):
        self.rows = []

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(list(self.rows))

    def put(self, rows):
        self.rows = list(rows)

    def appendList(self, rows):
        self.rows += rows


class FakeHandle:
    def __init__(self):
        self.timers = set()

    def getListState(self, name, schema):
        return FakeList()

    def getMapState(self, name, key, value):
        return FakeMap()

    def registerTimer(self, expiry):
        assert expiry > 0
        self.timers.add(expiry)


def started(processor):
    handle = FakeHandle()
    processor.init(handle)
    return processor, handle


KEY = ("a", 0)
ROW = ["kind", "at", "ip", "seq", "trigger_value"]


def give(processor, rows):
    list(processor.handleInputRows(KEY, iter([pd.DataFrame(rows, columns=ROW)]), None))


def advance(processor, handle, watermark):
    """Fire timers as Spark does: in order, each deleted after it was handled."""
    out, values = [], SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
    for expiry in sorted(t for t in handle.timers if t <= watermark):
        info = SimpleNamespace(getExpiryTimeInMs=lambda expiry=expiry: expiry)
        for frame in processor.handleExpiredTimer(KEY, values, info):
            out += list(zip(frame["ip"], frame["ts"].map(lambda t: t.value // 1000), frame["hits"], frame["trigger_value"]))
        handle.timers.discard(expiry)
    processor.known.clear()  # the next micro-batch has a processor of its own
    return out


def test_only_due_buckets_are_read():
    processor, handle = started(AsOf("ts", 1000))
    give(processor, [(CHANGE, 0, None, 0, "5")] + [(LOG, s * 1_000_000 + 1, f"c{s}", 0, None) for s in range(1, 50)])
    assert len(processor.waiting.rows) == 49
    processor.waiting.reads.clear()
    assert [r[0] for r in advance(processor, handle, 3000)] == ["c1", "c2"]
    # Buckets 1 and 2 are decided; bucket 3 was looked at, since the watermark stands in it.
    assert processor.waiting.reads == [(1, 0), (2, 0), (3, 0)]
    assert len(processor.waiting.rows) == 47
    assert [r[0] for r in advance(processor, handle, 3001)] == ["c3"]


def test_a_timer_that_comes_too_early_is_put_off():
    processor, handle = started(AsOf("ts", 1000))
    give(processor, [(CHANGE, 0, None, 0, "5"), (LOG, 4_999_700, "x", 0, None)])
    assert handle.timers == {1, 4998}
    assert advance(processor, handle, 4998) == []  # deleted, though it registered itself again
    assert handle.timers == {4999}
    assert advance(processor, handle, 4999) == []
    assert handle.timers == {5000}
    assert advance(processor, handle, 5000) == [("x", 4_999_700, 1, "5")]
    assert not processor.waiting.rows and not processor.parts.rows


def test_random_interleavings_give_the_batch_result():
    for seed in range(40):
        rng = random.Random(seed)
        processor, handle = started(AsOf("ts", rng.choice([1, 7, 1000, 60_000])))
        logs = [(rng.randrange(-3_000_000, 40_000_000), rng.choice(["p", "q", None])) for _ in range(60)]
        changes = [(rng.randrange(0, 40_000_000), n, rng.choice(["1", "2", None])) for n in range(15)]
        events = [(t, (LOG, t, ip, 0, None)) for t, ip in logs] + [(t, (CHANGE, t, None, n, v)) for t, n, v in changes]
        events.sort(key=lambda e: e[0] + rng.randrange(5_000_000))  # late by less than the delay
        out, seen = [], -10_000_000
        for low in range(0, len(events), 9):
            batch = events[low : low + 9]
            give(processor, [row for _, row in batch])
            seen = max([seen] + [t for t, _ in batch])
            out += advance(processor, handle, max(0, seen // 1000 - 5001))
        out += advance(processor, handle, 100_000)
        want = {}
        for t, ip in logs:
            known = [c for c in changes if c[0] <= t]
            if known:
                key = (ip, t, max(known, key=lambda c: c[:2])[2])
                want[key] = want.get(key, 0) + 1
        got = {}
        for ip, t, hits, value in out:
            got[ip, t, value] = got.get((ip, t, value), 0) + hits
        assert got == want, seed
        assert not processor.waiting.rows and len(processor.changes.rows) == 1


def test_clocked_counts():
    processor, handle = started(ClockedCounts(1000))

    def batch(now, hits):
        values = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now)
        list(processor.handleInputRows(KEY, iter([pd.DataFrame({"hits": hits})]), values))

    batch(1500, [2, 3])
    batch(1999, [1])
    batch(2000, [4])
    assert handle.timers == {2000, 3000}
    info = SimpleNamespace(getExpiryTimeInMs=lambda: 2000)
    frame, = processor.handleExpiredTimer(KEY, None, info)
    assert frame["times"].tolist() == [6] and frame["window_start"][0] == pd.Timestamp(1, unit="s", tz="UTC")
    assert processor.windows.rows == {(2000,): (4,)}
    rows = pd.DataFrame({"ip": ["1", None, "1", None], "url": ["a", "b", "a", None], "hits": [1, 1, 1, 1]})
    counts, = partial_counts(iter([rows]))
    assert sorted(map(str, counts.itertuples(index=False, name=None))) == sorted(map(str, [("1", "a", 2), (None, "b", 1), (None, None, 1)]))


# --- first thresholds --------------------------------------------------------


def test_no_request_before_the_first_change_is_lost(spark, tmp_path, feeds):
    logs, changes, beats = feeds("logs", LOGS), feeds("changes", CHANGES), feeds("beats", "ts timestamp")
    first = spark.createDataFrame([("a", "2"), ("b", "1"), (None, "1")], "url string, trigger_value string")

    def alerts(initial):
        rows = with_heartbeat(logs.stream, beats.stream)
        return temporal_alerts(rows, changes.stream, 10, salts=3, delay="5 seconds", initial=initial)

    batches = [[("1", "a", 1), ("1", "a", 2), ("2", "b", 3), ("2", "c", 3)], [("1", "a", 31), ("1", "a", 32), ("2", "b", 33)]]
    moves = [[("a", "9", 20, 1)], [("b", "2", 25, 2)]]
    for log_batch, change_batch in zip(batches, moves):
        logs.put(timed(log_batch))
        changes.put([(u, v, at(s), n) for u, v, s, n in change_batch])
        run(alerts(first), tmp_path)
        # A restart reads no initial thresholds: these would alert on everything.
        first = spark.createDataFrame([("a", "0"), ("b", "0")], "url string, trigger_value string")
    beats.put([(at(1000),)])
    run(alerts(first), tmp_path)
    assert written(spark, tmp_path / "out") == [("1", "a", 2, 0, 10), ("2", "b", 1, 0, 10)]


def test_initial_thresholds_in_batch(spark):
    logs = [("1", "a", 1), ("1", "a", 30), ("2", "b", 5), ("2", "c", 5)]
    changes = [("a", "7", 20, 1)]
    first = spark.createDataFrame([("a", "2", at(-5), 0), ("b", "3", at(6), 0), ("c", "4", None, 0)], "url string, trigger_value string, proc_time timestamp_ntz, seq bigint")
    from surgewatch.operators.temporal import temporal_join

    got = temporal_join(make_logs(spark, logs), make_changes(spark, changes), initial=first)
    want = as_of(logs, [*changes, ("a", "2", -5, 0), ("b", "3", 6, 0), ("c", "4", -1e9, 0)])
    assert found(got, "ip", "url", "ts", "trigger_value") == want


# --- jobs: numbers that state belongs to -------------------------------------


def test_restart_with_other_partitions_salts_and_buckets(spark, tmp_path, feeds):
    logs, changes = feeds("logs", LINE), feeds("dim", LINE)
    params = job_params(TemporalParams, tmp_path, dim_stream_name=changes.folder)
    source = Endpoint("json", schema=LINE, time_col="at", delay="10 seconds")
    sink, checkpoint = Endpoint("text"), str(tmp_path / "ck")
    beats = feeds("beats", "ts timestamp")

    def go(**more):
        run_temporal(spark, params, source, source, sink, checkpoint, beats=beats.stream, available_now=True, **more).awaitTermination()

    changes.put([('{"url":"a","trigger_value":1}', at(0)), ('{"url":"never","trigger_value":1}', at(0)), ('{"url":"never","trigger_value":2}', at(1))])
    logs.put(lines([("1", "a", 2), ("2", "a", 3)]))
    go(salts=3, bucket_seconds=5)
    waiting = audit.waiting_state(spark, checkpoint).collect()
    assert [(r.url, r.hits) for r in waiting] == [("a", 2)]
    # Files may be read one by one after a restart, with other settings of the session.
    logs.put(lines([("1", "a", 4)]))
    with session_conf(spark, {"spark.sql.shuffle.partitions": "7"}):
        go()
        for wrong in ({"salts": 4}, {"bucket_seconds": 6}):
            with pytest.raises(ValueError, match="made with"):
                go(**wrong)
    beats.put([(at(1000),)])
    go(salts=3)
    assert written(spark, tmp_path / "out") == [("1", "a", 2, 0, 10), ("2", "a", 1, 0, 10)]
    # A url that changed and was never asked for has one threshold per salt.
    kept = {r.url: (r.salts, r.fewest, r.most) for r in audit.threshold_state(spark, checkpoint).collect()}
    assert kept == {"a": (3, 1, 1), "never": (3, 1, 1)}
    assert audit.waiting_state(spark, checkpoint).count() == 0


# --- recorded tables in several files, in any order ---------------------------


@pytest.fixture
def split_events(spark, small_dir, tmp_path):
    """The events in four files whose times overlap, one of them far ahead."""
    events = spark.read.schema(registry.SCHEMAS["events"]).parquet(f"{small_dir}/events.parquet").where("event_id < 800")
    path = str(tmp_path / "events.parquet")
    for part in (2, 0, 3, 1):
        events.where(F.col("event_id") % 4 == part).coalesce(1).write.mode("append").parquet(path)
    return path


def test_files_in_any_order_give_the_batch_result(spark, split_events):
    schema = registry.SCHEMAS["events"]
    events = spark.read.schema(schema).parquet(split_events)
    logs, changes = tables.event_logs(events), tables.event_changes(events)

    def job(rows, stream, delay):
        options = {"delay": delay, "change_delay": delay, "bucket_seconds": 86_400, "salts": 2}
        return hop_temporal_alerts(rows, tables.event_changes(stream), 21_600, 7200, **options)

    got = replay_alerts(spark, split_events, schema, tables.event_logs, job, 21_600, files_per_trigger=1)
    want = found(hop_temporal_alerts(logs, changes, 21_600, 7200))
    assert want and found(got) == want
    latest = replay_latest(spark, split_events, schema, tables.event_changes, files_per_trigger=1)
    assert found(latest) == found(latest_per_key(changes))
    clocked = replay_clocked(spark, split_events, schema, tables.event_logs, 1, files_per_trigger=1)
    assert found(clocked.groupBy("ip", "url").agg(F.sum("times").alias("n"))) == found(logs.groupBy("ip", "url").agg(F.count("*").alias("n")))


def test_an_empty_table_gives_no_alerts(spark, tmp_path):
    schema = registry.SCHEMAS["events"]
    path = str(tmp_path / "events.parquet")
    spark.createDataFrame([], schema).write.parquet(path)

    def job(rows, stream, delay):
        return temporal_alerts(rows, tables.event_changes(stream), 10, delay=delay, salts=1)

    assert replay_alerts(spark, path, schema, tables.event_logs, job, 10).count() == 0


# --- changelog ----------------------------------------------------------------


def test_changelog_of_the_latest_threshold(spark, tmp_path, feeds):
    changes = feeds("changes", CHANGES)
    batches = [
        [("a", "1", 10, 1), ("a", "2", 10, 2), ("b", None, 5, 1), (None, "7", 1, 1)],
        [("a", "9", 9, 9), ("b", None, 5, 1)],  # older, and repeated: nothing changes
        [("a", "3", 10, 2), ("b", "1", 5, 1), ("c", "1", 0, None)],
    ]
    for batch in batches:
        changes.put([(u, v, at(s), n) for u, v, s, n in batch])
        with session_conf(spark, STREAM_CONF):
            changelog_to(latest_stream(changes.stream), str(tmp_path / "log"), availableNow=True).awaitTermination()
    log = spark.read.parquet(str(tmp_path / "log" / "changes"))
    rows = sorted((r.batch_id, str(r.url), r.trigger_value, r.change) for r in log.collect())
    assert rows == [
        (0, "None", "7", "insert"), (0, "a", "2", "insert"), (0, "b", None, "insert"),
        (2, "a", "3", "update"), (2, "b", "1", "update"), (2, "c", "1", "insert"),
    ]
    table = upserted(log).select("url", "trigger_value", F.col("proc_time").cast("timestamp_ntz").alias("proc_time"))
    everything = make_changes(spark, [row for batch in batches for row in batch])
    assert found(table, "url", "trigger_value") == found(latest_per_key(everything), "url", "trigger_value")


# --- hops by panes --------------------------------------------------------------


def test_a_row_changes_one_pane_of_state(spark, tmp_path, feeds):
    logs, beats = feeds("logs", LOGS), feeds("beats", "ts timestamp")
    size, slide = 100, 1
    rows = [("1", "a", s) for s in (1000, 1000, 1001, 1037)] + [("2", None, 1500)]
    counts = hop_counts(with_watermark(with_heartbeat(logs.stream, beats.stream)), size, slide).where("times > 0")
    sink = str(tmp_path / "out")

    def go():
        with session_conf(spark, STREAM_CONF):
            query = counts.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
            query = query.trigger(availableNow=True).start(sink)
            query.awaitTermination()
            return query.recentProgress[0].stateOperators

    logs.put(timed(rows))
    windows, panes = go()
    assert panes.numRowsUpdated == 4  # one per client, url and second
    assert windows.numRowsUpdated == 0  # the pane that holds the watermark is open
    beats.put([(at(3000),)])
    go()
    # Written as instants in UTC.
    got = spark.read.schema("ip string, url string, times bigint, window_start timestamp_ntz, window_end timestamp_ntz").parquet(sink)
    assert found(got, "ip", "url", "times", "window_start", "window_end") == in_order(brute_hops(rows, size, slide))
