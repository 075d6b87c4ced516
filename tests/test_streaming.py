"""Streams give the batch result: several files, restarts, late changes."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from helpers import EPOCH, as_of, at, found, in_order, make_changes, make_logs
from surgewatch import (
    fixed_threshold_alerts,
    hop_temporal_alerts,
    lookup_alerts,
    temporal_alerts,
)
from surgewatch.functions.timeattr import with_event_time, with_watermark
from surgewatch.params import (
    FixedThresholdParams,
    HopTemporalParams,
    LookupParams,
    TemporalParams,
)
from surgewatch.session import STREAM_CONF, session_conf
from surgewatch.streaming import jobs
from surgewatch.streaming.heartbeat import HEARTBEAT_URL, with_heartbeat
from surgewatch.streaming.jobs import Endpoint, run_fixed_threshold, run_lookup, run_temporal
from surgewatch.streaming.sinks import write_alerts
from surgewatch.streaming.snapshot import SnapshotCache

LOGS = "ip string, url string, ts timestamp"
CHANGES = "url string, trigger_value string, proc_time timestamp, seq bigint"
DIM = "id int, trigger_value int, url string"


class Feed:
    """A folder that is read as a stream, one file per micro-batch."""

    def __init__(self, spark, folder, schema, per_batch=1):
        os.makedirs(folder, exist_ok=True)
        self.spark, self.folder, self.schema, self.count = spark, str(folder), schema, 0
        reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch)
        self.stream = reader.json(self.folder)

    def put(self, rows):
        names = [part.split()[0] for part in self.schema.split(", ")]
        lines = [json.dumps(dict(zip(names, row)), default=lambda t: t.isoformat() + "Z") for row in rows]
        path = f"{self.folder}/{self.count:04d}.json"
        with open(path, "w") as file:
            file.write("\n".join(lines))
        os.utime(path, (1_000_000_000 + self.count * 10,) * 2)
        self.count += 1


@pytest.fixture
def feeds(spark, tmp_path):
    def feed(name, schema):
        return Feed(spark, tmp_path / name, schema)

    return feed


def timed(rows):
    return [(ip, url, at(s)) for ip, url, s in rows]


def run(alerts, tmp_path):
    """Process what is there, from the last checkpoint on."""
    query = write_alerts(
        alerts, "text", str(tmp_path / "ck"), {"path": str(tmp_path / "out")}, available_now=True
    )
    query.awaitTermination()


def written(spark, path):
    rows = [json.loads(r["value"]) for r in spark.read.text(str(path)).collect()]
    result = []
    for row in rows:
        start, end = (
            (time.mktime(time.strptime(row[c], "%Y-%m-%d %H:%M:%S")) - time.mktime(EPOCH.timetuple()))
            for c in ("window_start", "window_end")
        )
        result.append((row["ip"], row["url"], row["times"], start, end))
    return in_order(result)


BATCHES = [
    [("1", "a", 1), ("1", "a", 2), ("2", "a", 3)],
    [("1", "a", 9), ("1", "b", 11), ("1", "b", 12), (None, "a", 13)],
    [("2", "a", 24), ("2", "a", 25), ("2", None, 26), ("2", None, 27)],
]
FAR = [("x", "x", 1_000_000)]


def test_fixed_threshold_with_restart(spark, tmp_path, feeds):
    logs, beats = feeds("logs", LOGS), feeds("beats", "ts timestamp")
    rows = with_watermark(with_heartbeat(with_event_time(logs.stream, "ts"), beats.stream))
    alerts = fixed_threshold_alerts(rows, 10, 2)
    for batch in BATCHES:
        logs.put(timed(batch))
        run(alerts, tmp_path)
    everything = [row for batch in BATCHES for row in batch]
    want = found(fixed_threshold_alerts(make_logs(spark, everything), 10, 2))
    assert ("2", None, 2, 20, 30) in want
    # The last window is open until a clock row passes its end.
    assert written(spark, tmp_path / "out") == [w for w in want if w[4] <= 20]
    beats.put([(at(1000),)])
    run(alerts, tmp_path)
    assert written(spark, tmp_path / "out") == want


def test_clock_rows_are_no_requests(spark, tmp_path, feeds):
    logs, beats = feeds("logs", LOGS), feeds("beats", "ts timestamp")
    rows = with_watermark(with_heartbeat(logs.stream, beats.stream))
    logs.put(timed([("", HEARTBEAT_URL, 1), ("", HEARTBEAT_URL, 2)]))
    beats.put([(at(s),) for s in (1, 2, 3, 500)])
    run(fixed_threshold_alerts(rows, 10, 0), tmp_path)
    assert written(spark, tmp_path / "out") == [("", HEARTBEAT_URL, 2, 0, 10)]


@pytest.mark.parametrize("salts", [None, 3])
def test_lookup(spark, tmp_path, feeds, salts):
    logs, beats = feeds("logs", LOGS), feeds("beats", "ts timestamp")
    dim = spark.createDataFrame([(1, 2, "a"), (2, 3, "a"), (3, 2, "b")], DIM)
    rows = with_watermark(with_heartbeat(logs.stream, beats.stream))
    alerts = lookup_alerts(rows, dim, 10, salts=salts)
    for batch in BATCHES:
        logs.put(timed(batch))
    run(alerts, tmp_path)
    beats.put([(at(1000),)])
    run(alerts, tmp_path)
    everything = make_logs(spark, [row for batch in BATCHES for row in batch])
    assert written(spark, tmp_path / "out") == found(lookup_alerts(everything, dim, 10))


def temporal_case(feeds, hop):
    logs, changes, beats = (
        feeds("logs", LOGS), feeds("changes", CHANGES), feeds("beats", "ts timestamp")
    )
    rows = with_heartbeat(logs.stream, beats.stream)
    options = {"salts": 3, "delay": "30 seconds"}
    if hop:
        return logs, changes, beats, hop_temporal_alerts(rows, changes.stream, 10, 5, **options)
    return logs, changes, beats, temporal_alerts(rows, changes.stream, 10, **options)


@pytest.mark.parametrize("hop", [False, True])
def test_temporal_with_late_changes_and_restart(spark, tmp_path, feeds, hop):
    logs, changes, beats, alerts = temporal_case(feeds, hop)
    log_rows = [
        [("1", "a", s) for s in (1, 2, 3, 12, 13)] + [("2", "b", 4), ("2", None, 5)],
        # 11 is late, but within the delay: the watermark is at 40 - 30.
        [("1", "a", s) for s in (14, 11, 11, 41)] + [("2", "b", 45), ("2", "b", 46)],
    ]
    change_rows = [
        # The change at 12 arrives after log rows that are newer.
        [("a", "2", 2, 1), ("a", None, 40, 4)],
        [("a", "1", 12, 2), ("a", "3", 12, 1), ("b", "2", 45, 3), ("b", "x", 44, 1)],
    ]
    for log_batch, change_batch in zip(log_rows, change_rows):
        logs.put(timed(log_batch))
        changes.put([(u, v, at(s), n) for u, v, s, n in change_batch])
        run(alerts, tmp_path)
    beats.put([(at(1000),)])
    run(alerts, tmp_path)
    all_logs = [row for batch in log_rows for row in batch]
    all_changes = [row for batch in change_rows for row in batch]
    assert len(as_of(all_logs, all_changes)) == 10  # a: 8, b: 2
    tables = make_logs(spark, all_logs), make_changes(spark, all_changes)
    want = found(hop_temporal_alerts(*tables, 10, 5) if hop else temporal_alerts(*tables, 10))
    assert want and written(spark, tmp_path / "out") == want


def test_temporal_state_keeps_the_last_threshold(spark, tmp_path, feeds):
    logs, changes, beats, alerts = temporal_case(feeds, False)
    changes.put([("a", "9", at(0), 1), ("a", "2", at(1), 2)])
    logs.put(timed([("1", "a", 5), ("1", "a", 6)]))
    for beat in (200, 400):
        run(alerts, tmp_path)
        beats.put([(at(beat),)])
    run(alerts, tmp_path)
    logs.put(timed([("1", "a", 501), ("1", "a", 502)]))
    run(alerts, tmp_path)
    beats.put([(at(1000),)])
    run(alerts, tmp_path)
    assert written(spark, tmp_path / "out") == [("1", "a", 2, 0, 10), ("1", "a", 2, 500, 510)]


# --- lookup table that somebody else changes --------------------------------


@pytest.fixture
def table(spark, tmp_path):
    """A table read anew by every query, like one in a database."""
    path = str(tmp_path / "table.json")

    class OutsideTable(DataSource):
        @classmethod
        def name(cls):
            return "outside_table"

        def schema(self):
            return DIM

        def reader(self, schema):
            class Reader(DataSourceReader):
                def read(self, partition):
                    import json

                    with open(path) as file:
                        yield from map(tuple, json.load(file))

            return Reader()

    def put(rows):
        with open(path, "w") as file:
            json.dump(rows, file)

    put([(1, 2, "a")])
    spark.dataSource.register(OutsideTable)
    return spark.read.format("outside_table").load(), put


def lookup_stream(spark, tmp_path, feeds, dim):
    logs = feeds("logs", LOGS)
    rows = logs.stream.join(dim, "url").select("ip", "trigger_value")
    with session_conf(spark, STREAM_CONF):
        query = (
            rows.writeStream.format("memory")
            .queryName("seen_" + os.path.basename(tmp_path).replace("-", "_"))
            .option("checkpointLocation", str(tmp_path / "ck"))
            .start()
        )

    def seen(ip):
        logs.put([(ip, "a", at(1))])
        query.processAllAvailable()
        return [r[0] for r in spark.table(query.name).where(F.col("ip") == ip).select("trigger_value").collect()]

    return query, seen


def test_without_cache_each_batch_sees_the_table(spark, tmp_path, feeds, table):
    dim, put = table
    cache = SnapshotCache(dim, 0)
    cache.refresh()
    query, seen = lookup_stream(spark, tmp_path, feeds, dim)
    assert seen("1") == [2]
    put([(1, 7, "a"), (2, 8, "a")])
    assert sorted(seen("2")) == [7, 8]
    query.stop()


def test_cached_table_is_read_again_after_its_time(spark, tmp_path, feeds, table):
    dim, put = table
    cache = SnapshotCache(dim, 1000, max_rows=5)
    cache.refresh()
    query, seen = lookup_stream(spark, tmp_path, feeds, dim)
    put([(1, 7, "a")])
    assert seen("1") == [2]
    assert cache.refresh_if_stale() is False
    assert seen("2") == [2]
    cache.ttl_seconds = 0.001
    time.sleep(0.01)
    assert cache.refresh_if_stale() is True
    assert seen("3") == [7]
    cache.release()
    query.stop()


def test_cache_refreshes_in_the_background(spark, tmp_path, feeds, table):
    dim, put = table
    cache = SnapshotCache(dim, 1)
    cache.refresh()
    query, seen = lookup_stream(spark, tmp_path, feeds, dim)
    cache.keep_fresh(query)
    put([(1, 7, "a")])
    deadline = time.time() + 60
    tries = 0
    while seen(f"try{tries}") != [7]:
        assert time.time() < deadline
        tries += 1
        time.sleep(0.5)
    query.stop()


def test_a_table_over_the_row_limit_is_not_kept(spark, tmp_path, feeds, table):
    dim, put = table
    put([(i, 2, "a") for i in range(3)])
    cache = SnapshotCache(dim, 1000, max_rows=2)
    cache.refresh()
    assert not dim.storageLevel.useMemory
    query, seen = lookup_stream(spark, tmp_path, feeds, dim)
    put([(1, 7, "a")])
    assert seen("1") == [7]
    query.stop()


def test_a_failing_read_keeps_the_copy(spark, tmp_path, feeds, table):
    dim, put = table
    # An id below 0 makes the read fail.
    checked = dim.withColumn("id", F.when(F.col("id") >= 0, F.col("id")).otherwise(F.raise_error(F.lit("no table"))))
    cache = SnapshotCache(checked, 1000, max_rows=5)
    cache.refresh()
    query, seen = lookup_stream(spark, tmp_path, feeds, cache.table)
    put([(-1, 7, "a")])
    for ip in ("1", "2"):
        with pytest.raises(Exception, match="no table"):
            cache.refresh()
        assert cache.kept and seen(ip) == [2]
    put([(1, 9, "a")])
    assert seen("3") == [2]
    cache.refresh()
    put([(1, 4, "a")])
    assert seen("4") == [9]
    put([(i, i, "a") for i in range(6)])
    cache.refresh()
    assert not cache.kept and sorted(seen("5")) == [0, 1, 2, 3, 4, 5]
    put([(1, 3, "a")])
    cache.refresh()
    put([(1, 5, "a")])
    assert cache.kept and seen("6") == [3]
    cache.release()
    query.stop()


# --- whole jobs -------------------------------------------------------------

LINE = "value string, at timestamp"


def job_params(kind, tmp_path, **more):
    return kind.from_options(
        {
            "input_stream_name": str(tmp_path / "logs"),
            "target_stream_name": str(tmp_path / "out"),
            "stream_init_position": "AT_TIMESTAMP",
            "stream_initial_timestamp": "2024-01-01T00:00:01",
            "window_size": "10",
            **more,
        }
    )


def lines(rows, delimiter="\t"):
    return [(f"{ip}{delimiter}{url}\n", at(s)) for ip, url, s in rows]


JOB_ROWS = [("1", "a", s) for s in (0, 1, 2, 3)] + [("2", "b", 4), ("2", "b", 5)]


@pytest.fixture
def job(spark, tmp_path, feeds):
    """Feed text lines with event times, and close the windows."""
    logs, beats = feeds("logs", LINE), feeds("beats", "ts timestamp")
    logs.put(lines(JOB_ROWS) + [("junk", at(6)), ("junk", at(7))])
    beats.put([(at(1000),)])
    source = Endpoint("json", schema=LINE, time_col="at")
    sink = Endpoint("text")
    common = {"beats": beats.stream, "available_now": True}
    return source, sink, str(tmp_path / "ck"), common


def test_fixed_threshold_job(spark, tmp_path, job):
    source, sink, checkpoint, common = job
    params = job_params(FixedThresholdParams, tmp_path, trigger_value="2")
    query = run_fixed_threshold(spark, params, source, sink, checkpoint, **common)
    assert query.name == "fixed-threshold-alerts"
    query.awaitTermination()
    assert written(spark, tmp_path / "out") == [
        ("1", "a", 3, 0, 10), ("2", "b", 2, 0, 10), ("error", "error", 2, 0, 10)
    ]
    seen = [p.observedMetrics["log_lines"] for p in query.recentProgress if p.observedMetrics]
    assert sum(row["malformed"] for row in seen) == 2


def test_event_times_long_past_are_not_late(spark, tmp_path, job):
    source, sink, checkpoint, _ = job
    feed = Feed(spark, tmp_path / "logs", LINE)
    feed.count = 1
    feed.put(lines([("1", "a", 25)]))
    params = job_params(FixedThresholdParams, tmp_path, trigger_value="2")
    query = run_fixed_threshold(spark, params, source, sink, checkpoint, available_now=True)
    query.awaitTermination()
    # The row at 25 closes the first window; its own window stays open.
    assert written(spark, tmp_path / "out") == [
        ("1", "a", 3, 0, 10), ("2", "b", 2, 0, 10), ("error", "error", 2, 0, 10)
    ]


@pytest.mark.parametrize("ttl", ["3600s", "0"])
def test_lookup_job(spark, tmp_path, job, table, ttl, monkeypatch):
    source, sink, checkpoint, common = job
    params = job_params(
        LookupParams, tmp_path, mysql_host="jdbc:x", mysql_table="dim_tb",
        cache_ttl=ttl, cache_maxrows="1000",
    )
    monkeypatch.setattr(jobs, "read_dim_jdbc", lambda *args: table[0])
    query = run_lookup(spark, params, source, sink, checkpoint, **common)
    query.awaitTermination()
    assert written(spark, tmp_path / "out") == [("1", "a", 3, 0, 10)]


@pytest.mark.parametrize("hop", [False, True])
def test_temporal_job(spark, tmp_path, feeds, job, hop):
    source, sink, checkpoint, common = job
    changes = feeds("dim", LINE)
    changes.put([('{"url":"a","trigger_value":2}', at(2)), ('{"url":"b","trigger_value":3}', at(0))])
    dim = Endpoint("json", schema=LINE, time_col="at")
    more = {"dim_stream_name": str(tmp_path / "dim")}
    if hop:
        params = job_params(HopTemporalParams, tmp_path, window_interval="5", **more)
    else:
        params = job_params(TemporalParams, tmp_path, **more)
    query = run_temporal(spark, params, source, dim, sink, checkpoint, salts=2, **common)
    query.awaitTermination()
    want = [("1", "a", 2, -5, 5), ("1", "a", 2, 0, 10)] if hop else [("1", "a", 2, 0, 10)]
    assert written(spark, tmp_path / "out") == want


def test_changes_from_latest_on(spark, tmp_path, feeds, job):
    """No change is newer than the start, so no request has a threshold."""
    source, sink, checkpoint, common = job
    feeds("dim", LINE).put([('{"url":"a","trigger_value":1}', at(0))])
    dim = Endpoint("json", schema=LINE, time_col="at")
    params = job_params(
        TemporalParams, tmp_path, dim_stream_name=str(tmp_path / "dim"),
        dim_stream_init_position="LATEST",
    )
    query = run_temporal(spark, params, source, dim, sink, checkpoint, salts=1, **common)
    query.awaitTermination()
    assert written(spark, tmp_path / "out") == []
    assert os.path.isdir(checkpoint + "-start-changes")


@pytest.mark.parametrize("kind", ["fixed", "temporal"])
def test_processing_time_closes_windows_by_itself(spark, tmp_path, feeds, kind):
    logs = feeds("logs", "value string")
    logs.put([("1\ta",)] * 3 + [("2\ta",)])
    shared = {
        "input_stream_name": logs.folder, "target_stream_name": str(tmp_path / "out"),
        "stream_init_position": "TRIM_HORIZON", "window_size": "2",
    }
    source, sink = Endpoint("json", schema="value string"), Endpoint("text")
    if kind == "fixed":
        params = FixedThresholdParams.from_options({**shared, "trigger_value": "3"})
        query = run_fixed_threshold(
            spark, params, source, sink, str(tmp_path / "ck"), trigger_seconds=1
        )
    else:
        dim = feeds("dim", "value string")
        dim.put([('{"url":"a","trigger_value":3}',)])
        params = TemporalParams.from_options({**shared, "dim_stream_name": dim.folder})
        query = run_temporal(
            spark, params, source, source, sink, str(tmp_path / "ck"), salts=1, trigger_seconds=1
        )
    try:
        deadline = time.time() + 120
        while time.time() < deadline and query.isActive:
            files = [f for f in os.listdir(tmp_path / "out")] if (tmp_path / "out").exists() else []
            if any(f.endswith(".txt") and os.path.getsize(tmp_path / "out" / f) for f in files):
                break
            time.sleep(1)
        rows = written(spark, tmp_path / "out")
    finally:
        query.stop()
    assert [r[:3] for r in rows] == [("1", "a", 3)]
    assert rows[0][4] - rows[0][3] == 2
