"""Clock rows that close windows while no log rows arrive.

A stream closes a window only when a newer row moves its watermark. Clock rows
are united with the log *before* the watermark is set, are marked by ``hb``,
and count as zero requests. They must not be filtered out: the filter would be
moved below the watermark, and they would no longer move it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the url of clock rows. It must not be NULL.
HEARTBEAT_URL = "__hb__"


def clock(
    spark: SparkSession, time_col: str = "ts", rows_per_second: int = 1, lag_seconds: int = 0
) -> DataFrame:
    """A stream of the current time, ``lag_seconds`` late.

    For logs with event times choose a lag longer than logs take to arrive.
    """
    beats = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    beats = beats.option("numPartitions", 1).load()
    now = F.current_timestamp() - F.expr(f"interval {int(lag_seconds)} seconds")
    return beats.select(now.alias(time_col))


def with_heartbeat(logs: DataFrame, beats: DataFrame, time_col: str = "ts") -> DataFrame:
    """``ip, url``, time and ``hb``: the log rows and the clock rows."""
    rows = logs.select("ip", "url", time_col, F.lit(False).alias("hb"))
    return rows.unionByName(
        beats.select(
            F.lit("").alias("ip"),
            F.lit(HEARTBEAT_URL).alias("url"),
            F.col(time_col).cast("timestamp").alias(time_col),
            F.lit(True).alias("hb"),
        )
    )
