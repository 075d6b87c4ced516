"""Where in a stream reading begins."""

from __future__ import annotations

from datetime import datetime, timezone
from enum import Enum

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class StartPosition(Enum):
    """Newest records only, everything kept, or everything since a time."""

    LATEST = "LATEST"
    TRIM_HORIZON = "TRIM_HORIZON"
    AT_TIMESTAMP = "AT_TIMESTAMP"

    @classmethod
    def of(cls, value: StartPosition | str) -> StartPosition:
        if isinstance(value, cls):
            return value
        try:
            return cls(str(value).strip().upper())
        except ValueError:
            names = ", ".join(p.value for p in cls)
            raise ValueError(f"start position {value!r} is none of {names}") from None


def start_time(value: datetime | str | float) -> datetime:
    """A start time from a datetime, ISO text or seconds since 1970, in UTC."""
    if not isinstance(value, datetime):
        try:
            return datetime.fromtimestamp(float(value), timezone.utc)
        except ValueError:
            value = datetime.fromisoformat(str(value))
    return value if value.tzinfo else value.replace(tzinfo=timezone.utc)


def start_at(
    rows: DataFrame,
    position: StartPosition | str,
    timestamp: datetime | str | float | None = None,
    time_col: str = "ts",
) -> DataFrame:
    """Start position for rows with a time column (replays of files or tables).

    A plain comparison with a constant, so it reaches the file scan. The
    timestamp is looked at only for ``AT_TIMESTAMP``; ``LATEST`` starts at the
    time of this call.
    """
    position = StartPosition.of(position)
    if position is StartPosition.TRIM_HORIZON:
        return rows
    if position is StartPosition.LATEST:
        begin = datetime.now(timezone.utc)
    elif timestamp is None:
        raise ValueError("AT_TIMESTAMP needs a start timestamp")
    else:
        begin = start_time(timestamp)
    if isinstance(rows.schema[time_col].dataType, T.TimestampNTZType):
        text = begin.astimezone(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
        bound = F.lit(text).cast("timestamp_ntz")
    else:
        bound = F.timestamp_micros(F.lit(int(begin.timestamp() * 1_000_000)))
    return rows.where(F.col(time_col) >= bound)


def pinned_start(
    spark: SparkSession, position: StartPosition | str, folder: str
) -> tuple[StartPosition, str] | None:
    """``LATEST`` as a fixed time, kept in ``folder`` from the first start on.

    A job that is started again goes on from its checkpoint, so its start must
    not move with it. ``None`` for the other positions, which do not move.
    """
    if StartPosition.of(position) is not StartPosition.LATEST:
        return None
    return StartPosition.AT_TIMESTAMP, pinned(spark, datetime.now(timezone.utc).isoformat(), folder)


def pinned(spark: SparkSession, value: str, folder: str) -> str:
    """The value kept in ``folder``; the first call keeps ``value`` there.

    A folder without a row, left by a start that was broken off, is filled.
    """
    try:
        kept = spark.read.schema("value string").text(folder).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = None
    if kept is not None:
        return kept[0]
    row = spark.range(1).select(F.lit(value).alias("value")).coalesce(1)
    row.write.mode("append").text(folder)
    return value


def kafka_start(
    position: StartPosition | str, timestamp: datetime | str | float | None = None
) -> dict[str, str]:
    """The same as options of the Kafka source."""
    position = StartPosition.of(position)
    if position is StartPosition.LATEST:
        return {"startingOffsets": "latest"}
    if position is StartPosition.TRIM_HORIZON:
        return {"startingOffsets": "earliest"}
    if timestamp is None:
        raise ValueError("AT_TIMESTAMP needs a start timestamp")
    millis = int(start_time(timestamp).timestamp() * 1000)
    return {
        "startingTimestamp": str(millis),
        "startingOffsetsByTimestampStrategy": "latest",
    }
