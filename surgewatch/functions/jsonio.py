"""JSON in (dimension changes) and JSON out (alerts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The fields of a dimension change and of an alert, in order.
CHANGE_SCHEMA = "url string, trigger_value string"
ALERT_COLUMNS = ["ip", "url", "times", "window_start", "window_end"]

# Fixed value: SQL form of a timestamp.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_changes(records: DataFrame, value_col: str = "value") -> DataFrame:
    """``url, trigger_value`` from JSON text; all other columns are kept.

    A JSON number is read as its text. A missing field is NULL, and text that
    is no JSON gives NULL in both fields (such a change matches no request).
    """
    others = [c for c in records.columns if c != value_col]
    decoded = F.from_json(F.col(value_col).cast("string"), CHANGE_SCHEMA)
    return records.select(decoded.alias("change"), *others).select("change.*", *others)


def alert_json(alerts: DataFrame) -> DataFrame:
    """One JSON document per alert in the column ``value``."""
    options = {
        "timestampFormat": TIMESTAMP_FORMAT,
        "timestampNTZFormat": TIMESTAMP_FORMAT,
        "ignoreNullFields": "false",
    }
    return alerts.select(F.to_json(F.struct(*ALERT_COLUMNS), options).alias("value"))
