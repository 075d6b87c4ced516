"""Run a streaming job over a recorded table until all of it is processed."""

from __future__ import annotations

import re
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from surgewatch.session import STREAM_CONF, scratch_dir, session_conf
from surgewatch.streaming import alert_table
from surgewatch.streaming.changelog import latest_stream, upserted
from surgewatch.streaming.clocked import processing_time_counts
from surgewatch.streaming.heartbeat import with_heartbeat
from surgewatch.streaming.sinks import write_alerts

ALERT_SCHEMA = """ip string, url string, times bigint, window_start timestamp_ntz,
    window_end timestamp_ntz"""
CHANGE_SCHEMA = "url string, trigger_value string, proc_time timestamp_ntz, change string"


def exactly(path: str) -> str:
    """A file pattern that only this path matches."""
    path = path.rstrip("/")
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path[:-1]) + f"[{path[-1]}]"


def read_table(
    spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The table's files as a stream."""
    stream = spark.readStream.schema(schema)
    if files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    # A pattern, though of this one name, lets a file stand where a folder is expected.
    return stream.parquet(exactly(path))


def replay_alerts(
    spark: SparkSession,
    path: str,
    schema: str,
    to_logs: Callable[[DataFrame], DataFrame],
    job: Callable[[DataFrame, DataFrame, str], DataFrame],
    window_size: int,
    files_per_trigger: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """The alerts a job writes for a table read as a stream.

    ``job`` gets the log stream with clock rows, the table as a stream (for
    jobs that take their threshold changes from it), and how late rows may be:
    as long as the table spans, so that files may come in any order, a few per
    micro-batch, and none of their rows is late. When the table is used up, the
    job is started again from its checkpoint with one clock row, derived from
    the table, that lies well after the last log row and closes every window.
    Alerts are written to the shared scratch folder and read back from there:
    as rows, or with the format ``alert_table`` as ``value``, their JSON.
    """
    if fmt not in ("parquet", alert_table.NAME):
        raise ValueError(f"alerts are read back from parquet or {alert_table.NAME}, not {fmt}")
    work = scratch_dir(spark, "replay")
    with session_conf(spark, STREAM_CONF):
        times = to_logs(spark.read.schema(schema).parquet(path)).select(F.col("ts").cast("timestamp"))
        span, last = times.agg(
            F.coalesce(F.timestamp_diff("SECOND", F.min("ts"), F.max("ts")), F.lit(0)), F.max("ts")
        ).first()
        late = span + 1
        clock = times.agg(
            (F.max("ts") + F.expr(f"interval {late + 2 * window_size + 1} seconds")).alias("ts")
        )
        clock.limit(0).write.parquet(f"{work}/clock")

        def run() -> None:
            rows = read_table(spark, path, schema, files_per_trigger)
            beats = spark.readStream.schema("ts timestamp").parquet(f"{work}/clock")
            logs = to_logs(rows).withColumn("ts", F.col("ts").cast("timestamp"))
            alerts = job(with_heartbeat(logs, beats), rows, f"{late} seconds")
            target = {"path": f"{work}/alerts"}
            write_alerts(
                alerts, fmt, f"{work}/checkpoint", target, available_now=True
            ).awaitTermination()

        run()
        if last is not None:
            clock.write.mode("append").parquet(f"{work}/clock")
            run()
    if fmt == alert_table.NAME:
        return alert_table.read_alerts(spark, f"{work}/alerts")
    # Instants in UTC are written; read without a zone they are the table's times.
    return spark.read.schema(ALERT_SCHEMA).parquet(f"{work}/alerts")


def replay_latest(
    spark: SparkSession,
    path: str,
    schema: str,
    to_changes: Callable[[DataFrame], DataFrame],
    files_per_trigger: int | None = None,
) -> DataFrame:
    """The latest threshold of each url, from the changelog of a table read as a stream."""
    work = scratch_dir(spark, "replay")
    with session_conf(spark, STREAM_CONF):
        changes = to_changes(read_table(spark, path, schema, files_per_trigger))
        query = changelog_to(latest_stream(changes), work, availableNow=True)
        query.awaitTermination()
    return upserted(spark.read.schema(f"{CHANGE_SCHEMA}, batch_id bigint").parquet(f"{work}/changes"))


def changelog_to(changelog: DataFrame, work: str, **trigger: object) -> StreamingQuery:
    """Write each micro-batch to a folder of its own, which a repeated one replaces."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{work}/changes/batch_id={batch_id}")

    writer = changelog.writeStream.outputMode("update").foreachBatch(write)
    return writer.option("checkpointLocation", f"{work}/checkpoint").trigger(**trigger).start()


def replay_clocked(
    spark: SparkSession,
    path: str,
    schema: str,
    to_logs: Callable[[DataFrame], DataFrame],
    window_size: int,
    files_per_trigger: int | None = None,
    timeout: float = 600,
) -> DataFrame:
    """Counts in windows of processing time for a table read as a stream, until all rows are counted.

    Windows close by the clock of the cluster, without clock rows. An error
    if rows are missing after ``timeout`` seconds.
    """
    work = scratch_dir(spark, "replay")
    total = to_logs(spark.read.schema(schema).parquet(path)).count()
    counted, done = {}, threading.Event()

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{work}/counts/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(target)
        counted[batch_id] = spark.read.parquet(target).agg(F.sum("times")).first()[0] or 0
        if sum(counted.values()) >= total:
            done.set()

    with session_conf(spark, STREAM_CONF):
        logs = to_logs(read_table(spark, path, schema, files_per_trigger)).drop("ts")
        query = (
            processing_time_counts(logs, window_size)
            .writeStream.outputMode("append")
            .option("checkpointLocation", f"{work}/checkpoint")
            .foreachBatch(write)
            .trigger(processingTime="1 second")
            .start()
        )
        try:
            waited = 0
            while query.isActive and waited < timeout and not done.wait(1):
                waited += 1
            if query.exception() is not None:
                raise query.exception()
            if not done.is_set():
                raise TimeoutError(f"{sum(counted.values())} of {total} rows counted")
        finally:
            query.stop()
    return spark.read.schema(f"{ALERT_SCHEMA}, batch_id bigint").parquet(f"{work}/counts").drop("batch_id")
