"""Starting a stream of alerts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from surgewatch.functions.jsonio import alert_json
from surgewatch.session import STREAM_CONF, session_conf
from surgewatch.streaming.alert_table import NAME, AlertTable

# Fixed value: seconds between micro-batches (and so between checkpoints).
CHECKPOINT_SECONDS = 5


def write_alerts(
    alerts: DataFrame,
    fmt: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    *,
    name: str | None = None,
    trigger_seconds: int = CHECKPOINT_SECONDS,
    available_now: bool = False,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Start the query: one JSON document per alert, appended to the target.

    ``text`` writes files of JSON lines and ``alert_table`` a table of finished
    micro-batches (each alert exactly once in both), ``kafka`` writes to a
    topic (at least once). With ``foreach_batch`` the alert rows
    themselves go to that function; see ``batch_folders``.
    """
    rows = alerts if foreach_batch or fmt == "parquet" else alert_json(alerts)
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.options(**(options or {}))
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    writer = writer.foreachBatch(foreach_batch) if foreach_batch else writer.format(fmt)
    if fmt == NAME:
        alerts.sparkSession.dataSource.register(AlertTable)
    with session_conf(alerts.sparkSession, STREAM_CONF):
        return writer.start()


def batch_folders(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreach_batch`` function that writes each micro-batch to a folder
    of its own, so that a repeated micro-batch replaces what it wrote before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        alert_json(batch).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write
