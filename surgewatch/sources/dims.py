"""Thresholds from a stream of JSON changes or from a JDBC table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgewatch.functions.jsonio import parse_changes
from surgewatch.sources.logs import read_records
from surgewatch.sources.positions import StartPosition


def read_dim_changes(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    *,
    payload_col: str = "value",
    time_col: str | None = None,
    seq_col: str | None = None,
    position: StartPosition | str = StartPosition.TRIM_HORIZON,
    **source: object,
) -> DataFrame:
    """``url, trigger_value, proc_time`` and, if named or Kafka's, ``seq``.

    The change stream has its own start position, which cannot be a time.
    ``proc_time`` is the processing time unless ``time_col`` names a column.
    """
    if StartPosition.of(position) is StartPosition.AT_TIMESTAMP:
        raise ValueError("the change stream starts at LATEST or TRIM_HORIZON")
    rows = read_records(spark, fmt, options, position=position, time_col=time_col, **source)
    if fmt == "kafka":
        seq_col = seq_col or "offset"
    columns = [
        F.col(payload_col).alias("value"),
        (F.col(time_col) if time_col else F.current_timestamp()).alias("proc_time"),
    ]
    if seq_col:
        columns.append(F.col(seq_col).cast("bigint").alias("seq"))
    return parse_changes(rows.select(*columns))


def read_dim_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    options: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    partitions: int = 8,
) -> DataFrame:
    """``id, trigger_value, url`` of a JDBC table.

    Only the needed columns are read. Further options (driver, fetch size) are
    passed on. With ``partition_column``, a numeric column such as ``id``, the
    table is read by ``partitions`` tasks: its smallest and largest value are
    asked for first and cut into ranges, the outer ones open, so rows that come
    later are read too.
    """
    settings = {"url": url, "dbtable": table}
    if user is not None:
        settings["user"] = user
    if password is not None:
        settings["password"] = password
    settings.update(options or {})
    if partition_column is None:
        rows = spark.read.format("jdbc").options(**settings).load()
    else:
        query = f"SELECT MIN({partition_column}) AS low, MAX({partition_column}) AS high FROM {table}"
        asked = {k: v for k, v in settings.items() if k != "dbtable"}
        low, high = spark.read.format("jdbc").options(**asked, query=query).load().first()
        ranges = range_predicates(partition_column, low, high, partitions)
        rest = {k: v for k, v in settings.items() if k not in ("url", "dbtable")}
        rows = spark.read.jdbc(url, table, predicates=ranges, properties=rest)
    return rows.select(
        F.col("id").cast("int").alias("id"),
        F.col("trigger_value").cast("int").alias("trigger_value"),
        F.col("url").cast("string").alias("url"),
    )


def range_predicates(column: str, low: float | None, high: float | None, parts: int) -> list[str]:
    """SQL conditions that deal out all rows, null values too, to ``parts`` ranges of a column."""
    if parts < 1:
        raise ValueError(f"partitions must be positive: {parts!r}")
    borders = [] if low is None else sorted({low + (high - low) * i // parts for i in range(1, parts)} - {low})
    if not borders:
        return ["1 = 1"]
    first = f"{column} < {borders[0]} OR {column} IS NULL"
    inner = [f"{column} >= {x} AND {column} < {y}" for x, y in zip(borders, borders[1:])]
    return [first, *inner, f"{column} >= {borders[-1]}"]
