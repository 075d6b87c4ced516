import json

from helpers import make_logs
from surgewatch import fixed_threshold_alerts
from surgewatch.functions.jsonio import alert_json, parse_changes
from surgewatch.streaming.sinks import batch_folders


def test_changes(spark):
    lines = [
        ('{"url":"a.html","trigger_value":2}', "a.html", "2"),
        ('{"url":"a.html","trigger_value":"3"}', "a.html", "3"),
        ('{"trigger_value":4}', None, "4"),
        ('{"url":"b.html"}', "b.html", None),
        ('{"url":"b.html","trigger_value":5,"more":[1]}\n', "b.html", "5"),
        ("junk", None, None),
        ("", None, None),
        (None, None, None),
    ]
    df = spark.createDataFrame([(i, t[0]) for i, t in enumerate(lines)], "seq int, value string")
    rows = {r["seq"]: (r["url"], r["trigger_value"]) for r in parse_changes(df).collect()}
    assert [rows[i] for i in range(len(lines))] == [t[1:] for t in lines]


def test_bytes_are_read_as_text(spark):
    df = spark.createDataFrame([(bytearray(b'{"url":"a","trigger_value":2}'),)], "value binary")
    assert parse_changes(df).first().asDict() == {"url": "a", "trigger_value": "2"}


def test_alert_document(spark):
    logs = make_logs(spark, [('say "hi"\t', None, 1), ("ü", "a.html", 2)])
    texts = sorted(r["value"] for r in alert_json(fixed_threshold_alerts(logs, 10, 1)).collect())
    times = '"times":1,"window_start":"2024-01-01 00:00:00","window_end":"2024-01-01 00:00:10"}'
    assert texts == [
        '{"ip":"say \\"hi\\"\\t","url":null,' + times,
        '{"ip":"ü","url":"a.html",' + times,
    ]
    assert list(json.loads(texts[0])) == ["ip", "url", "times", "window_start", "window_end"]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    write = batch_folders(str(tmp_path / "out"))
    alerts = fixed_threshold_alerts(make_logs(spark, [("1", "a", 1), ("2", "a", 1)]), 10, 1)
    for batch_id in (0, 1, 1):
        write(alerts, batch_id)
    assert spark.read.text(str(tmp_path / "out")).count() == 4
