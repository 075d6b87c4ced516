"""The four alert jobs, as functions from logs to alerts.

Logs have the columns ``ip, url`` and a time column. Alerts have the columns
``ip, url, times, window_start, window_end``. All functions take batch and
streaming DataFrames; a stream needs a watermark on its time column (see
``functions.timeattr`` and ``streaming.heartbeat``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgewatch.functions.jsonio import ALERT_COLUMNS
from surgewatch.functions.thresholds import as_number, at_least
from surgewatch.operators.lookup import lookup_counts
from surgewatch.operators.sizing import MAX_BROADCAST_ROWS
from surgewatch.operators.temporal import temporal_join
from surgewatch.operators.windows import check_window, hop_counts, tumble_counts

THRESHOLD_KEYS = ("ip", "url", "trigger_value")


def fixed_threshold_alerts(
    logs: DataFrame,
    window_size: int,
    trigger_value: int,
    time_col: str = "ts",
    buckets: int | None = None,
) -> DataFrame:
    """Clients with at least ``trigger_value`` requests to a url in a window."""
    if isinstance(trigger_value, bool) or not isinstance(trigger_value, int):
        raise ValueError(f"trigger_value must be a whole number: {trigger_value!r}")
    counts = tumble_counts(logs, window_size, time_col, buckets=buckets)
    return at_least(counts, trigger_value).select(*ALERT_COLUMNS)


def lookup_alerts(
    logs: DataFrame,
    dim: DataFrame,
    window_size: int,
    time_col: str = "ts",
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """As above with a threshold per url from the table ``dim``."""
    counts = lookup_counts(logs, dim, window_size, time_col, max_rows, salts, buckets)
    return at_least(counts, F.col("trigger_value")).select(*ALERT_COLUMNS)


def temporal_alerts(
    logs: DataFrame,
    changes: DataFrame,
    window_size: int,
    time_col: str = "ts",
    **join_options: object,
) -> DataFrame:
    """As above with the threshold that was valid at each request's time.

    A change inside a window splits its requests: each threshold is compared
    with the requests made under it.
    """
    check_window(window_size)
    joined = temporal_join(logs, changes, time_col, **join_options)
    counts = tumble_counts(joined, window_size, time_col, THRESHOLD_KEYS)
    return at_least(counts, as_number(F.col("trigger_value"))).select(*ALERT_COLUMNS)


def hop_temporal_alerts(
    logs: DataFrame,
    changes: DataFrame,
    window_size: int,
    window_interval: int,
    time_col: str = "ts",
    **join_options: object,
) -> DataFrame:
    """``temporal_alerts`` over hopping windows."""
    check_window(window_size, window_interval)
    joined = temporal_join(logs, changes, time_col, **join_options)
    counts = hop_counts(joined, window_size, window_interval, time_col, THRESHOLD_KEYS)
    return at_least(counts, as_number(F.col("trigger_value"))).select(*ALERT_COLUMNS)
