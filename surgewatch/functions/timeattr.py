"""The time column of a log: processing time or event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_processing_time(df: DataFrame, name: str = "ts") -> DataFrame:
    """Stamp rows with the time they are processed (one value per micro-batch)."""
    return df.withColumn(name, F.current_timestamp())


def with_event_time(df: DataFrame, time_col: str, name: str = "ts") -> DataFrame:
    """Use a column of the data as the time column.

    Batch keeps a zone-less timestamp as it is. A stream needs an instant for
    its watermark, so there it is read in the session's time zone (UTC for
    the streams started by this package).
    """
    if df.isStreaming and not isinstance(df.schema[time_col].dataType, T.TimestampType):
        df = df.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return df if name == time_col else df.withColumnRenamed(time_col, name)


def with_watermark(df: DataFrame, time_col: str = "ts", delay: str = "0 seconds") -> DataFrame:
    """Let windows of a stream close; a no-op in batch."""
    return df.withWatermark(time_col, delay) if df.isStreaming else df
