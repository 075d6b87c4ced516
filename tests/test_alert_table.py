"""The transactional sink: each alert once, whatever is repeated."""

import json
import os

import pytest
from pyspark.sql import Row
from pyspark.sql.types import StringType, StructField, StructType

from helpers import at
from surgewatch import fixed_threshold_alerts
from surgewatch.functions.timeattr import with_watermark
from surgewatch.streaming.alert_table import AlertTable, AlertWriter, listed_files, read_alerts
from surgewatch.streaming.heartbeat import with_heartbeat
from surgewatch.streaming.sinks import write_alerts
from test_streaming import LOGS, Feed, timed


def lines(path):
    return [line for f in listed_files(path) for line in open(f"{path}/{f}").read().splitlines()]


def test_a_batch_appears_once_and_as_a_whole(tmp_path):
    path = str(tmp_path / "t")
    writer = AlertWriter(path)
    parts = [writer.write(iter([Row(value=f"{t}{i}") for i in range(n)])) for t, n in (("a", 2), ("b", 0), ("c", 1))]
    assert parts[1].file is None and lines(path) == []
    writer.commit(parts, 0)
    assert lines(path) == ["a0", "a1", "c0"]
    # The same micro-batch again: its files go, the list stays.
    again = [writer.write(iter([Row(value="a0"), Row(value="a1")]))]
    writer.commit(again, 0)
    assert lines(path) == ["a0", "a1", "c0"]
    # One that fails, with a task that wrote nothing.
    writer.abort([writer.write(iter([Row(value="x")])), None], 1)
    assert lines(path) == ["a0", "a1", "c0"]
    assert len(os.listdir(f"{path}/files")) == 2
    writer.commit([writer.write(iter([Row(value="d")]))], 1)
    writer.commit([], 2)
    assert lines(path) == ["a0", "a1", "c0", "d"]


def test_options(spark, tmp_path):
    one = StructType([StructField("value", StringType())])
    with pytest.raises(ValueError, match="path"):
        AlertTable({}).streamWriter(one, False)
    with pytest.raises(ValueError, match="one column"):
        AlertTable({"path": "x"}).streamWriter(StructType([StructField("ip", StringType())]), False)
    assert read_alerts(spark, str(tmp_path / "none")).count() == 0


def test_a_stream_that_repeats_a_batch(spark, tmp_path):
    logs = Feed(spark, tmp_path / "logs", LOGS)
    beats = Feed(spark, tmp_path / "beats", "ts timestamp")
    alerts = fixed_threshold_alerts(with_watermark(with_heartbeat(logs.stream, beats.stream)), 10, 2)
    path, checkpoint = str(tmp_path / "t"), tmp_path / "ck"

    def go():
        write_alerts(alerts, "alert_table", str(checkpoint), {"path": path}, available_now=True).awaitTermination()
        found = [json.loads(r.value) for r in read_alerts(spark, path).collect()]
        return sorted((r["ip"], r["url"], r["times"]) for r in found)

    logs.put(timed([("1", "a", 1), ("1", "a", 2), ("2", "b", 3), ("2", "b", 4)]))
    go()
    beats.put([(at(1000),)])
    want = [("1", "a", 2), ("2", "b", 2)]
    assert go() == want
    # As after a crash between the sink's commit and Spark's own: Spark repeats the last batch.
    commits = sorted((f for f in os.listdir(checkpoint / "commits") if f.isdigit()), key=int)
    for name in (commits[-1], f".{commits[-1]}.crc"):
        if os.path.exists(checkpoint / "commits" / name):
            os.remove(checkpoint / "commits" / name)
    assert go() == want
    logs.put(timed([("3", "c", 2001), ("3", "c", 2002)]))
    go()
    beats.put([(at(3000),)])
    assert go() == [*want, ("3", "c", 2)]
