from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from helpers import at, found, make_logs
from surgewatch.functions.timeattr import with_event_time, with_processing_time
from surgewatch.session import scratch_dir
from surgewatch.sources import table_replay
from surgewatch.sources.dims import range_predicates, read_dim_changes, read_dim_jdbc
from surgewatch.sources.logs import own_start, read_logs
from surgewatch.sources.positions import (
    StartPosition,
    kafka_start,
    pinned_start,
    start_at,
    start_time,
)
from surgewatch.streaming.jobs import Endpoint


def test_position_names():
    assert StartPosition.of(" trim_horizon ") is StartPosition.TRIM_HORIZON
    with pytest.raises(ValueError):
        StartPosition.of("MIDDLE")


def test_start_times():
    want = datetime(2024, 1, 1, tzinfo=timezone.utc)
    for value in (1704067200, "1704067200.0", "2024-01-01T00:00:00", "2024-01-01T01:00:00+01:00"):
        assert start_time(value) == want


def test_kafka_options():
    assert kafka_start("LATEST", "ignored") == {"startingOffsets": "latest"}
    assert kafka_start("trim_horizon") == {"startingOffsets": "earliest"}
    assert kafka_start("at_timestamp", 1.5)["startingTimestamp"] == "1500"
    with pytest.raises(ValueError):
        kafka_start("AT_TIMESTAMP")


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_start_of_a_replay(spark, kind):
    logs = make_logs(spark, [("1", "a", s) for s in (0, 10, 20)])
    logs = logs.withColumn("ts", F.col("ts").cast(kind))
    assert start_at(logs, "TRIM_HORIZON").count() == 3
    assert start_at(logs, "AT_TIMESTAMP", "2024-01-01 00:00:10").count() == 2
    assert start_at(logs, "LATEST", "2024-01-01 00:00:10").count() == 0
    with pytest.raises(ValueError):
        start_at(logs, "AT_TIMESTAMP")


def test_start_filter_reaches_the_scan(events):
    plan = start_at(events, "AT_TIMESTAMP", "2024-01-15")._jdf.queryExecution().executedPlan()
    assert "GreaterThanOrEqual(ts" in plan.toString()


def test_latest_is_pinned_at_the_first_start(spark, tmp_path):
    folder = str(tmp_path / "start")
    assert pinned_start(spark, "TRIM_HORIZON", folder) is None
    assert pinned_start(spark, "AT_TIMESTAMP", folder) is None
    first = pinned_start(spark, "LATEST", folder)
    assert first[0] is StartPosition.AT_TIMESTAMP
    assert datetime.now(timezone.utc) - start_time(first[1]) < timedelta(minutes=5)
    assert pinned_start(spark, "latest", folder) == first


def test_scratch_is_in_the_shared_folder():
    class Session:
        class conf:
            settings = {"spark.checkpoint.dir": "hdfs://x/shared/"}
            get = settings.get

    assert scratch_dir(Session, "a").startswith("hdfs://x/shared/a-")
    Session.conf.settings.clear()
    assert scratch_dir(Session, "a").startswith("/")


def test_files_without_times_have_no_start_position(spark, tmp_path):
    with pytest.raises(ValueError):
        read_logs(spark, "text", {"path": str(tmp_path)}, position="LATEST")


def test_text_logs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("1\ta.html\n2\tb.html\n")
    path = {"path": str(tmp_path / "in")}
    rows = read_logs(spark, "text", path, streaming=False)
    assert found(rows) == [("1\ta.html",), ("2\tb.html",)]
    stream = read_logs(spark, "text", path)
    assert stream.isStreaming and stream.columns == ["line"]


def test_change_source(spark, tmp_path):
    rows = [('{"url":"a","trigger_value":2}', at(5), 7)]
    rows = spark.createDataFrame(rows, "value string, at timestamp_ntz, n int")
    rows.write.parquet(str(tmp_path / "changes"))
    options = {"path": str(tmp_path / "changes")}
    got = read_dim_changes(
        spark, "parquet", options, streaming=False, time_col="at", seq_col="n"
    )
    assert found(got) == [("a", "2", 5, 7)]
    now = read_dim_changes(spark, "parquet", options, streaming=False)
    assert now.columns == ["url", "trigger_value", "proc_time"]
    with pytest.raises(ValueError):
        read_dim_changes(spark, "parquet", options, position="AT_TIMESTAMP")


def test_jdbc_options(spark):
    """What is asked of the connector; no database takes part."""
    asked = {}

    class Reader:
        def format(self, name):
            asked["format"] = name
            return self

        def options(self, **options):
            asked.update(options)
            return self

        def load(self):
            columns = "ID int, TRIGGER_VALUE int, URL string, NOTE string"
            return spark.createDataFrame([(1, 2, "a", "x")], columns)

    class Session:
        read = Reader()

    rows = read_dim_jdbc(Session(), "jdbc:x", "dim_tb", "me", "pw", {"fetchsize": "10"})
    assert asked == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "dim_tb", "user": "me", "password": "pw",
        "fetchsize": "10",
    }
    assert rows.columns == ["id", "trigger_value", "url"] and rows.first() == (1, 2, "a")


def test_time_columns(spark):
    logs = make_logs(spark, [("1", "a", 3)])
    now = datetime.now()
    stamped = with_processing_time(logs.drop("ts")).first()["ts"]
    assert abs(stamped - now) < timedelta(minutes=5)
    assert found(with_event_time(logs.withColumnRenamed("ts", "t"), "t")) == [("1", "a", 3)]


def test_ranges_hold_every_row():
    import duckdb

    rows = "(SELECT range AS id FROM range(-999, 5000) UNION ALL SELECT NULL)"
    for low, high, parts in ((1, 1000, 8), (5, 5, 4), (0, 3, 10), (-50, 7, 3), (None, None, 4)):
        tests = range_predicates("id", low, high, parts)
        assert 1 <= len(tests) <= parts
        hits = " + ".join(f"CAST(coalesce({test}, false) AS INT)" for test in tests)
        assert duckdb.sql(f"SELECT DISTINCT {hits} FROM {rows}").fetchall() == [(1,)]
    with pytest.raises(ValueError):
        range_predicates("id", 1, 2, 0)


def test_jdbc_table_read_by_several_tasks(spark):
    asked = {}

    class Reader:
        def format(self, name):
            return self

        def options(self, **options):
            asked["bounds"] = options
            return self

        def load(self):
            return spark.createDataFrame([(1, 100)], "low int, high int")

        def jdbc(self, url, table, predicates, properties):
            asked["read"] = url, table, predicates, properties
            return spark.createDataFrame([(1, 2, "a")], "id int, trigger_value int, url string")

    class Session:
        read = Reader()

    read_dim_jdbc(Session(), "jdbc:x", "dim_tb", "me", "pw", {"fetchsize": "10"}, "id", 4)
    assert asked["bounds"]["query"] == "SELECT MIN(id) AS low, MAX(id) AS high FROM dim_tb"
    assert "dbtable" not in asked["bounds"] and asked["bounds"]["user"] == "me"
    url, table, predicates, properties = asked["read"]
    assert (url, table, len(predicates)) == ("jdbc:x", "dim_tb", 4)
    assert properties == {"user": "me", "password": "pw", "fetchsize": "10"}


@pytest.fixture
def recorded(spark, tmp_path):
    """Three files of two row groups each; times grow with the files."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "table"
    folder.mkdir()

    def put(n):
        rows = [{"value": f"{i}\ta", "at": at(i)} for i in range(10 * n, 10 * n + 10)]
        schema = pa.schema([("value", pa.string()), ("at", pa.timestamp("us"))])
        pq.write_table(pa.Table.from_pylist(rows, schema), folder / f"{n:04d}.parquet", row_group_size=5)

    for n in range(3):
        put(n)
    return str(folder), put


def replayed(spark, tmp_path, path, **options):
    rows = read_logs(spark, "table_replay", {"path": path}, schema="value string, at timestamp_ntz", **options)
    query = rows.select("line").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
    query = query.trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    lines = spark.read.schema("line string").parquet(str(tmp_path / "out")).collect() if query.recentProgress else []
    return sorted(int(r.line.split("\t")[0]) for r in lines)


def test_replay_goes_on_from_its_offsets(spark, tmp_path, recorded):
    path, put = recorded
    assert replayed(spark, tmp_path, path, time_col="at") == list(range(30))
    put(3)
    assert replayed(spark, tmp_path, path, time_col="at") == list(range(40))


def test_replay_starts_at_a_time(spark, tmp_path, recorded):
    path, put = recorded
    start = {"position": "AT_TIMESTAMP", "timestamp": at(17).isoformat(), "time_col": "at"}
    assert replayed(spark, tmp_path, path, **start) == list(range(17, 30))


def test_replay_positions():
    reader = lambda **o: table_replay.TableReplay({"path": "/", **o}).streamReader(None)
    with pytest.raises(ValueError, match="none of"):
        reader(position="MIDDLE")
    with pytest.raises(ValueError, match="needs"):
        reader(position="AT_TIMESTAMP", timestamp="0")
    with pytest.raises(ValueError, match="no option"):
        reader(speed="9")


def test_replay_offsets(recorded):
    path, put = recorded
    reader = table_replay.ReplayReader(None, {"path": path, "position": "LATEST"})
    assert reader.initialOffset() == reader.latestOffset() == {"group": 6}
    put(3)
    assert reader.latestOffset() == {"group": 8}
    parts = reader.partitions({"group": 5}, {"group": 7})
    assert [(p.path[-12:], p.group) for p in parts] == [("0002.parquet", 1), ("0003.parquet", 0)]
    with pytest.raises(ValueError, match="gone"):
        reader.partitions({"group": 5}, {"group": 9})
    late = {"path": path, "position": "AT_TIMESTAMP", "timestamp": at(26).isoformat(), "timecol": "at"}
    assert table_replay.ReplayReader(None, late).initialOffset() == {"group": 5}


def test_an_unknown_connector_gets_its_position_or_an_error(spark):
    with pytest.raises(ValueError, match="no start position"):
        read_logs(spark, "someconnector", {}, position="LATEST")
    asked = own_start(StartPosition.AT_TIMESTAMP, "2024-01-01T00:00:00", "startingposition", "startingtime")
    assert asked == {"startingposition": "AT_TIMESTAMP", "startingtime": "2024-01-01T00:00:00+00:00"}
    with pytest.raises(ValueError, match="option for the time"):
        own_start(StartPosition.AT_TIMESTAMP, 0, "startingposition", None)


def test_connector_parameters_reach_the_connector():
    source = Endpoint("x", {"region": "own"}, name_option="stream", parameters={"ak": "accessKey", "aws_region": "region"})
    given = {"ak": "key", "sk": "secret", "aws_region": "elsewhere"}
    assert source.named("in", "subscribe", given) == {"stream": "in", "accessKey": "key", "region": "own"}
