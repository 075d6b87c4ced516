"""Log records as text lines, from any Spark source."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgewatch.sources import table_replay
from surgewatch.sources.positions import StartPosition, kafka_start, start_at, start_time

# Spark's file formats, which know no start position.
FILE_FORMATS = ("text", "json", "csv", "parquet", "orc", "avro", "xml")


def read_records(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    *,
    streaming: bool = True,
    schema: str | None = None,
    position: StartPosition | str = StartPosition.TRIM_HORIZON,
    timestamp: datetime | str | float | None = None,
    time_col: str | None = None,
    position_option: str | None = None,
    timestamp_option: str | None = None,
) -> DataFrame:
    """Records of a source, from a start position on.

    Kafka and ``table_replay`` get the position as their own options, other
    connectors as the options named by ``position_option`` (``LATEST`` and so
    on) and ``timestamp_option`` (ISO text). Without such names, rows are
    filtered on ``time_col``. A position that reaches nobody is an error.
    """
    position = StartPosition.of(position)
    from_start = position is StartPosition.TRIM_HORIZON
    own = fmt in ("kafka", table_replay.NAME) or position_option is not None
    if not from_start and not own and not time_col:
        what = f"{fmt} files have" if fmt in FILE_FORMATS else f"the connector {fmt} has"
        raise ValueError(f"{what} no start position without a time column or options for it")
    settings = dict(options or {})
    if fmt == "kafka":
        settings = {**kafka_start(position, timestamp), **settings}
    elif own:
        settings = {**own_start(position, timestamp, position_option, timestamp_option), **settings}
    if fmt == table_replay.NAME:
        spark.dataSource.register(table_replay.TableReplay)
        if time_col:
            settings.setdefault("timecol", time_col)
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt).options(**settings)
    if schema:
        reader = reader.schema(schema)
    rows = reader.load()
    if not own and not from_start:
        rows = start_at(rows, position, timestamp, time_col)
    return rows


def own_start(
    position: StartPosition,
    timestamp: datetime | str | float | None,
    position_option: str | None,
    timestamp_option: str | None,
) -> dict[str, str]:
    """A start position as a connector's own options."""
    settings = {position_option or "position": position.value}
    if position is StartPosition.AT_TIMESTAMP:
        if timestamp is None:
            raise ValueError("AT_TIMESTAMP needs a start timestamp")
        if position_option and not timestamp_option:
            raise ValueError("AT_TIMESTAMP needs the name of the connector's option for the time")
        settings[timestamp_option or "timestamp"] = start_time(timestamp).isoformat()
    return settings


def read_logs(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    *,
    payload_col: str = "value",
    time_col: str | None = None,
    **source: object,
) -> DataFrame:
    """``line``, and the record's time as ``ts`` if ``time_col`` names one."""
    rows = read_records(spark, fmt, options, time_col=time_col, **source)
    columns = [F.col(payload_col).cast("string").alias("line")]
    if time_col:
        columns.append(F.col(time_col).alias("ts"))
    return rows.select(*columns)
