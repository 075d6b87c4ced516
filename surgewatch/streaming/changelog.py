"""The latest threshold of each url, kept up to date by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE = "insert", "update"


def latest_stream(changes: DataFrame, time_col: str = "proc_time") -> DataFrame:
    """Changelog ``url, trigger_value, proc_time, change`` of the latest threshold of each url.

    A url's first row is an ``insert``, each newer value an ``update``; write
    it in update mode, to a target that replaces by url (see ``upserted``). At
    most one row a url comes of each micro-batch. Changes may arrive in any
    order: an older one changes nothing, and of changes at one time the last
    (``seq``, then the value; null first) counts. A null url is a url like others.

    State is one row a url: its latest change, and the time of the micro-batches
    that brought it and the url's first one. A repeated micro-batch has the time
    of its first attempt. Tasks send on only the newest change they have of a
    url, so a url with a third of all changes is no hot key.
    """
    seq = F.col("seq").cast("bigint") if "seq" in changes.columns else F.lit(None).cast("bigint")
    rows = changes.select(
        F.col("url").cast("string").alias("url"),
        F.unix_micros(F.col(time_col).cast("timestamp")).alias("at"),
        seq.alias("seq"),
        F.col("trigger_value").cast("string").alias("trigger_value"),
        F.unix_millis(F.current_timestamp()).alias("batch"),
    )
    # Of equal changes the first one: it is no news when it comes again.
    newest = F.max(F.struct("at", "seq", "trigger_value", (-F.col("batch")).alias("since")))
    latest = rows.groupBy("url").agg(newest.alias("v"), F.min("batch").alias("first"))
    now = F.unix_millis(F.current_timestamp())
    return latest.where(F.col("v.since") == -now).select(
        "url",
        "v.trigger_value",
        F.timestamp_micros("v.at").alias("proc_time"),
        F.when(F.col("first") == now, INSERT).otherwise(UPDATE).alias("change"),
    )


def upserted(changelog: DataFrame) -> DataFrame:
    """``url, trigger_value, proc_time``: the last row of each url of a changelog with ``batch_id``."""
    last = F.max_by(F.struct("trigger_value", "proc_time"), "batch_id")
    return changelog.groupBy("url").agg(last.alias("v")).select("url", "v.*")
